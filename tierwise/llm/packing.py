"""Hierarchical multi-length packing of tokenized documents.

Each document becomes its token ids and one end id. It is routed to context-size tiers: whole windows
of the largest size are cut off first, the rest goes to the smallest tier that holds it. Rests of the
largest tier open long windows; their gaps are filled from the shorter tiers, largest piece first, and
the last gap by cutting a piece. What is left of a shorter tier is packed into windows of that tier's
own size. At the end of a task the open windows are cut into sequences of powers of two, so no
sequence needs padding. Sequences of one tier are dealt to step groups of equal token counts.

A task packs the documents of its own input partition, window by window: nothing is exchanged, and a
task holds one batch of documents and the open windows.

Defined cases: a null or empty text is only the end id; texts are tokenized whole, however long;
repeated rows are packed each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import os
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import read_table, small_batches

TIERS = (256, 512, 1024, 2048)
END = (1).to_bytes(4, "little")
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "sequence_length long, step_group long"
)


#: Characters of a word's end that the splitting pattern sets apart from the letters before them.
STOPS = ".,;:!?"


class _Pieces(dict):
    """Token ids (little-endian bytes) of a word with the space before it, or with its line break."""

    def __init__(self, encode, limit: int):
        super().__init__()
        self.encode, self.limit = encode, limit

    def __missing__(self, piece: str) -> bytes:
        ids = self.encode(piece)
        if len(self) >= self.limit:
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """Token ids of whole texts, as little-endian unsigned 32-bit bytes.

    The vocabulary's splitting pattern always starts a new token at a single space or line break that
    stands between two other characters, and between letters and the full stops (and the like) that end a word,
    so words can be encoded apart and kept in a bounded cache. Words of Latin letters are one match of the
    pattern; where the vocabulary is also there as ranks (``.tiktoken`` beside it), they are encoded by its
    merges alone, which gives the same ids at a quarter of the cost. A text with any other white space, or with
    the string of a special token, is encoded in one piece."""

    def __init__(self, path: str, limit: int = 100_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.merges = _merges(path)
        self.pieces = _Pieces(self.word, limit)
        self.ends = _Pieces(self.whole, limit // 10)

    def whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def word(self, piece: str) -> bytes:
        start = "" if piece[:1] == "\n" else " "
        core = piece[1 - len(start) :].rstrip(STOPS)
        if self.merges is None or not core.isalpha() or max(core) > "\u024f":
            return self.whole(start + piece)
        ids = _packed(self.merges((start + core).encode()))
        if not start:
            ids = self.ends["\n"] + ids
        end = piece[1 - len(start) + len(core) :]
        return ids + self.ends[end] if end else ids

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if " ".join(text.split()) != text.replace("\n", " ") or any(x in text for x in self.special):
            return self.whole(text)
        head, *rest = text.replace("\n", " \n").split(" ")
        return self.whole(head) + b"".join(map(self.pieces.__getitem__, rest))

    def forget(self) -> None:
        self.pieces.clear()
        self.ends.clear()


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _merges(path: str):
    """The merges of a byte-level vocabulary that lies as ranks beside its ``.json`` file, or None."""
    ranks = f"{path.removesuffix('.json')}.tiktoken"
    if not os.path.exists(ranks):
        return None
    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("pieces", pat_str=r"\S+", mergeable_ranks=table, special_tokens={})._core_bpe.encode_single_piece


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for a worker process; its tokenizer is kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Packer:
    """Packs pieces (doc key, start, length) into sequences of the tiers' sizes; see the module text."""

    def __init__(self, first_id: int, tiers: tuple[int, ...] = TIERS, step_tokens: int = 65536):
        self.tiers, self.top, self.step_tokens = tiers, tiers[-1], step_tokens
        self.next_id = first_id
        self.first_id = first_id
        self.dealt: dict[int, int] = defaultdict(int)  # sequences so far, by length
        self.short: dict[int, list] = {t: [] for t in tiers[:-1]}
        self.open: list | None = None  # a long window that waits for fillers
        self.done: list[tuple] = []  # (doc, start, length, sequence, offset, sequence length, step group)

    def close(self, pieces: list, size: int) -> None:
        group = self.dealt[size] // max(1, self.step_tokens // size)
        self.dealt[size] += 1
        at = 0
        for doc, start, length in pieces:
            self.done.append((doc, start, length, self.next_id, at, size, self.first_id + (size << 20) + group))
            at += length
        self.next_id += 1

    def filler(self, gap: int):
        """The largest waiting piece that fits; else the smallest waiting one, cut at the gap."""
        for tier in reversed(self.tiers[:-1]):
            if tier <= gap and self.short[tier]:
                return self.short[tier].pop()
        for tier in self.tiers[:-1]:
            waiting = self.short[tier]
            if waiting:
                doc, start, length = waiting.pop()
                if length > gap:
                    self.wait(doc, start + gap, length - gap)
                    length = gap
                return doc, start, length
        return None

    def wait(self, doc, start: int, length: int) -> None:
        self.short[next(t for t in self.tiers if t >= length)].append((doc, start, length))

    def fill(self, pieces: list) -> None:
        gap = self.top - sum(p[2] for p in pieces)
        while gap:
            piece = self.filler(gap)
            if piece is None:
                self.open = pieces
                return
            pieces.append(piece)
            gap -= piece[2]
        self.close(pieces, self.top)

    def wave(self, docs: list[tuple[int, int]]) -> None:
        """Route and pack a batch of (doc key, tokens). Afterwards less than one window of each size waits."""
        long_rests = []
        for doc, n in docs:
            whole = n // self.top
            for k in range(whole):
                self.close([(doc, k * self.top, self.top)], self.top)
            start, rest = whole * self.top, n - whole * self.top
            if rest > self.tiers[-2]:
                long_rests.append((doc, start, rest))
            elif rest:
                self.wait(doc, start, rest)
        if self.open:
            pieces, self.open = self.open, None
            self.fill(pieces)
        for doc, start, length in sorted(long_rests, key=lambda p: -p[2]):
            if self.open is None:
                self.fill([(doc, start, length)])
            else:  # nothing short is left: this rest is cut to close the open window
                pieces, self.open = self.open, None
                gap = self.top - sum(p[2] for p in pieces)
                cut = min(gap, length)
                pieces.append((doc, start, cut))
                if cut == gap:
                    self.close(pieces, self.top)
                    if length > cut:
                        rest = length - cut
                        if rest > self.tiers[-2]:
                            self.open = [(doc, start + cut, rest)]
                        else:
                            self.wait(doc, start + cut, rest)
                else:
                    self.open = pieces
        for tier in self.tiers[:-1]:
            self.pack_tier(tier)

    def pack_tier(self, tier: int) -> None:
        waiting = self.short[tier]
        total = sum(p[2] for p in waiting)
        pieces, held = [], 0
        while total >= tier:
            doc, start, length = waiting.pop()
            cut = min(length, tier - held)
            pieces.append((doc, start, cut))
            held += cut
            if length > cut:
                waiting.append((doc, start + cut, length - cut))
            if held == tier:
                self.close(pieces, tier)
                pieces, held, total = [], 0, total - tier
        waiting.extend(pieces)

    def finish(self) -> None:
        """Cut everything that waits into sequences whose lengths are powers of two."""
        rest = list(self.open or [])
        for tier in self.tiers[:-1]:
            rest += self.short[tier]
            self.short[tier] = []
        self.open = None
        left = sum(p[2] for p in rest)
        rest.reverse()
        while left:
            size = min(self.top, 1 << (left.bit_length() - 1))
            pieces, held = [], 0
            while held < size:
                doc, start, length = rest.pop()
                cut = min(length, size - held)
                pieces.append((doc, start, cut))
                held += cut
                if length > cut:
                    rest.append((doc, start + cut, length - cut))
            self.close(pieces, size)
            left -= size


def pack(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", tiers=TIERS) -> DataFrame:
    """One row per piece; see ``SCHEMA``. ``start`` and ``offset`` count token ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        task = TaskContext.get()
        packer = Packer((task.partitionId() if task else 0) << 32, tiers)
        waiting: dict[int, tuple] = {}  # document key -> (doc_id, ids) while pieces of it wait
        key = 0

        def out() -> pa.RecordBatch:
            rows = []
            for doc, start, length, seq, at, size, group in packer.done:
                name, ids = waiting[doc]
                crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])
                rows.append((name, start, length, crc, len(ids) // 4, seq, at, size, group))
            packer.done = []
            held = [packer.open or [], *packer.short.values()]
            still = {piece[0] for pieces in held for piece in pieces}
            for doc in [d for d in waiting if d not in still]:
                del waiting[doc]
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                wave = []
                for name, body in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = encode(body or "") + END
                    waiting[key] = (name, ids)
                    wave.append((key, len(ids) // 4))
                    key += 1
                packer.wave(wave)
                yield out()
        packer.finish()
        yield out()
        encode.forget()  # the worker process may go on to other work: keep no words between tasks

    small_batches(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, SCHEMA)


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_packing(spark, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), tokenizer_file())
