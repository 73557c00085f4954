"""Language identification by segmentation-marginalised unigrams.

Pieces come from a fixed public vocabulary. Each language has piece probabilities, fitted by
expectation maximisation to word counts of a bounded training sample (``sample_docs`` documents a
language, the ones with the smallest hash of their id). A word's probability in a language is the sum
over all its segmentations into pieces, from a forward pass; a text's log-probability is the sum over
its words. The score is the posterior of the predicted language (with the sample's equal priors).

Words are maximal runs of letters, lower-cased, with the vocabulary's word-start mark before them; a
letter outside the vocabulary is a piece of its own with a small fixed probability. Distinct words are
scored once for a task and looked up for every later occurrence (a bounded cache, by 64-bit hash).

Defined cases: a null text and a text without letters give ``und`` with score 0; texts are scored
whole; repeated rows are scored each; a tie goes to the first language in order; an empty table gives
no rows; a training table without labelled rows gives ``und`` for all; other columns are ignored.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierwise.llm.common import crc_mod, read_table, small_batches
from tierwise.llm.textarrays import mix, slices

MARK = 0x2581  # the vocabulary's word-start mark
SCHEMA = "doc_id long, lang_pred string, score double"
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ALPHA: list[np.ndarray] = []


def alphabet() -> np.ndarray:
    """For each code point: is it a letter?"""
    if not _ALPHA:
        _ALPHA.append(np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)), bool))
    return _ALPHA[0]


def pieces_of(path: str) -> list[str]:
    """Distinct vocabulary entries of letters (with or without the word-start mark)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    ok = {p for p in names if p.lstrip("▁").isalpha() and p.count("▁") == (p[0] == "▁")}
    return sorted({p.lower() for p in ok} | {"▁"})


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)


def words_of(lowered: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points of a lower-cased text with a space at both ends, word starts, word ends)."""
    codes = np.concatenate(([32], _codes(lowered), [32])).astype(np.uint32)
    letter = alphabet()[codes]
    edge = np.flatnonzero(letter[1:] != letter[:-1]) + 1
    return codes, edge[0::2], edge[1::2]


def _extend(h: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hashes of spans that are one letter longer."""
    h = (h + codes + np.uint64(1)) * _ODD
    return h ^ (h >> np.uint64(29))


def _span_hash(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of code points, built letter by letter (longest span: one round each)."""
    out = np.zeros(len(starts), np.uint64)
    live = np.arange(len(starts))
    for j in range(int(lengths.max()) if len(lengths) else 0):
        live = live[lengths[live] > j]
        out[live] = _extend(out[live], codes[starts[live] + j])
    return mix(out)


def _blocks(lengths: np.ndarray, cells: int = 150_000) -> Iterator[np.ndarray]:
    """Word indices in blocks of like length; words x longest stays near ``cells``."""
    order = np.argsort(lengths, kind="stable")
    a = 0
    while a < len(order):
        longest = lengths[order[min(a + 8191, len(order) - 1)]]
        size = int(min(8192, max(1, cells // longest)))
        yield order[a : a + size]
        a += size


@dataclass
class Model:
    """Piece hashes (sorted) and a row of probabilities for each piece and language."""

    langs: list[str]
    keys: np.ndarray
    probs: np.ndarray
    unknown: float = 1e-7
    scale: float = 16.0  # probabilities are multiplied by this for each letter, to stay in range
    part: int = 4096  # longer runs of letters go through a window of this many
    longest: int = 16  # letters in a piece

    def lattice(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        """(word, begin, end, piece) of every piece that matches inside a marked word; piece -1 for a
        single letter outside the vocabulary. Words are given by their spans in ``codes``."""
        word = np.repeat(np.arange(len(starts)), lengths)
        begin = np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        room, at = lengths[word] - begin, starts[word] + begin
        h, found = np.zeros(len(word), np.uint64), []
        for length in range(1, self.longest + 1):
            live = room >= length
            word, begin, room, at, h = word[live], begin[live], room[live], at[live], h[live]
            if not len(word):
                break
            h = _extend(h, codes[at + length - 1])
            key = mix(h)
            piece = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[piece] == key
            if length == 1:
                piece = np.where(hit, piece, -1)
                hit[:] = True
            found.append((word[hit], begin[hit], begin[hit] + length, piece[hit]))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))

    def edge_probs(self, begin, end, piece) -> np.ndarray:
        probs = np.vstack([self.probs, np.full((1, len(self.langs)), self.unknown)])
        return probs[piece] * (self.scale ** (end - begin))[:, None]

    def forward(self, word, begin, end, probs, n_words: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
        """(alpha[position, word, language], log of the factor each word's last values were raised by)."""
        alpha = np.zeros((longest + 1, n_words, len(self.langs)))
        alpha[0] = 1.0
        raised = np.zeros(n_words)
        order = np.argsort(end, kind="stable")
        cut = np.searchsorted(end[order], np.arange(longest + 2))
        for e in range(1, longest + 1):
            rows = order[cut[e] : cut[e + 1]]
            w = word[rows]
            gain = alpha[begin[rows], w] * probs[rows]
            for k in range(len(self.langs)):
                alpha[e, :, k] = np.bincount(w, gain[:, k], n_words)
            top = alpha[e].max(1)
            for odd, factor in (((top > 0) & (top < 1e-100), 1e100), (top > 1e100, 1e-100)):
                if odd.any():
                    alpha[max(0, e - self.longest + 1) : e + 1, odd] *= factor
                    raised[odd] += np.log(factor)
        return alpha, raised

    def long_word(self, codes: np.ndarray, start: int, length: int) -> np.ndarray:
        """log P of one long span, by a window that moves over it: sums that reach beyond the window are carried on, so
        no segmentation is lost and memory does not grow with the span."""
        carry = np.zeros((self.longest + 1, len(self.langs)))
        carry[0] = 1.0
        raised = 0.0
        for at in range(0, length, self.part):
            span = min(self.part, length - at)
            reach = min(span + self.longest, length - at)
            _, begin, end, piece = self.lattice(codes, np.array([start + at]), np.array([reach]))
            inside = begin < span
            begin, end, piece = begin[inside], end[inside], piece[inside]
            probs = self.edge_probs(begin, end, piece)
            order = np.argsort(end, kind="stable")
            cut = np.searchsorted(end[order], np.arange(reach + 2))
            alpha = np.zeros((reach + 1, len(self.langs)))
            alpha[: len(carry)] = carry[: reach + 1]
            for e in range(1, reach + 1):
                rows = order[cut[e] : cut[e + 1]]
                alpha[e] += (alpha[begin[rows]] * probs[rows]).sum(0)
                top = alpha[e].max()
                if e <= span and (0 < top < 1e-100 or top > 1e100):
                    factor = 1e100 if top < 1 else 1e-100
                    alpha[max(0, e - self.longest + 1) :] *= factor
                    raised += np.log(factor)
            carry = alpha[span:]
        return np.log(np.maximum(carry[0], 1e-300)) - raised - length * np.log(self.scale)

    def word_scores(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """log P(word | language) for spans of ``codes`` that begin with the mark."""
        out = np.zeros((len(starts), len(self.langs)))
        for i in np.flatnonzero(lengths > self.part):
            out[i] = self.long_word(codes, int(starts[i]), int(lengths[i]))
        short = np.flatnonzero(lengths <= self.part)
        for block in _blocks(lengths[short]):
            part = short[block]
            n = lengths[part]
            word, begin, end, piece = self.lattice(codes, starts[part], n)
            alpha, raised = self.forward(word, begin, end, self.edge_probs(begin, end, piece), len(part), int(n.max()))
            last = np.maximum(alpha[n, np.arange(len(part))], 1e-300)
            out[part] = np.log(last) - (raised + n * np.log(self.scale))[:, None]
        return out


def marked(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the words, each after the word-start mark, with span starts and lengths."""
    codes = _codes("".join("▁" + w for w in words))
    lengths = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
    return codes, np.cumsum(lengths) - lengths, lengths


@np.errstate(over="ignore", invalid="ignore")  # words out of a double's range are summed as logarithms
def _expect(model: Model, expected: np.ndarray, codes: np.ndarray, starts: np.ndarray, n: np.ndarray, weight: np.ndarray) -> None:
    """Add the expected piece counts of a block of words (spans of lengths ``n``, weights by language)."""
    longest, ids = int(n.max()), np.arange(len(n))
    word, begin, end, piece = model.lattice(codes, starts, n)
    probs = model.edge_probs(begin, end, piece)
    alpha, raised = model.forward(word, begin, end, probs, len(n), longest)
    beta = np.zeros_like(alpha)
    beta[n, ids] = 1.0
    back = np.argsort(begin, kind="stable")
    cut = np.searchsorted(begin[back], np.arange(longest + 1))
    for b in range(longest - 1, -1, -1):
        rows = back[cut[b] : cut[b + 1]]
        gain = beta[end[rows], word[rows]] * probs[rows]
        for k in range(len(model.langs)):
            beta[b, :, k] += np.bincount(word[rows], gain[:, k], len(n))
    share = alpha[begin, word] * beta[end, word] * probs
    usable = (raised == 0)[:, None] & (alpha[n, ids] > 0)
    share *= np.where(usable, weight / np.where(usable, alpha[n, ids], 1.0), 0.0)[word]
    share = np.nan_to_num(share, nan=0.0, posinf=0.0)
    known = piece >= 0
    for k in range(len(model.langs)):
        expected[:, k] += np.bincount(piece[known], share[known, k], len(expected))
    for i in np.flatnonzero(~usable.all(1)):
        mine = word == i
        lost = ~usable[i]
        extra = _log_shares(begin[mine], end[mine], probs[mine][:, lost], int(n[i])) * weight[i][lost]
        np.add.at(expected, (piece[mine & known][:, None], np.flatnonzero(lost)), extra[known[mine]])


def fit(counts: list[tuple[str, str, int]], vocabulary: list[str], rounds: int = 3, prior: float = 0.05) -> Model:
    """Expectation maximisation over (lang, word, count): expected piece counts from forward and backward
    sums, plus ``prior`` for each piece, normalised in each language. Starts from equal probabilities. Words too long
    for the range of a double are summed as logarithms."""
    langs = sorted({c[0] for c in counts})
    codes, starts, lengths = marked(vocabulary)
    keys = np.sort(_span_hash(codes, starts + 1, lengths - 1))
    model = Model(langs, keys, np.full((len(keys), len(langs)), 1.0 / len(keys)), longest=int(lengths.max()) - 1)
    words = sorted({w for _, w, _ in counts})
    index, column = {w: i for i, w in enumerate(words)}, {x: i for i, x in enumerate(langs)}
    weight = np.zeros((len(words), len(langs)))
    for lang, w, n in counts:
        weight[index[w], column[lang]] += n
    codes, starts, lengths = marked(words)
    for _ in range(rounds):
        expected = np.full(model.probs.shape, prior)
        for part in _blocks(lengths):
            _expect(model, expected, codes, starts[part], lengths[part], weight[part])
        model.probs = expected / expected.sum(0)
    return model


def _log_shares(begin: np.ndarray, end: np.ndarray, probs: np.ndarray, length: int) -> np.ndarray:
    """For each piece of one word, the share of the segmentations (by probability) that use it."""
    with np.errstate(divide="ignore"):
        logs = np.log(probs)
    alpha = np.full((length + 1, probs.shape[1]), -np.inf)
    beta = alpha.copy()
    alpha[0] = beta[length] = 0.0
    for order, at, into, out in ((np.argsort(end, kind="stable"), begin, end, alpha), (np.argsort(-begin, kind="stable"), end, begin, beta)):
        for rows in np.split(order, np.flatnonzero(np.diff(into[order])) + 1):
            out[into[rows[0]]] = np.logaddexp.reduce(out[at[rows]] + logs[rows], axis=0)
    total = alpha[length]
    with np.errstate(invalid="ignore"):
        return np.where(np.isfinite(total), np.exp(alpha[begin] + logs + beta[end] - total), 0.0)


def sample_counts(docs: DataFrame, keep: Column, sample_docs: int = 300) -> list[tuple[str, str, int]]:
    """(lang, word, count) of the training sample: for each language the ``sample_docs`` kept documents
    with the smallest id hash. Hashes are uniform, so a threshold leaves about twice as many ids for the
    ranking; ids are ranked without texts, and the chosen ids (languages x ``sample_docs``) are broadcast."""
    usable = docs.where(keep & F.col("lang").isNotNull() & F.col("text").isNotNull())
    ids = usable.select("lang", "doc_id", F.xxhash64("doc_id").alias("h"))
    share = ids.groupBy("lang").agg((F.lit(2.0 * sample_docs + 20) / F.count(F.lit(1))).alias("share"))
    few = ids.join(F.broadcast(share), "lang").where(F.col("h") / F.lit(2.0**64) + F.lit(0.5) <= F.col("share"))
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    chosen = few.withColumn("r", F.row_number().over(order)).where(F.col("r") <= sample_docs).select("doc_id").distinct()
    texts = usable.select("doc_id", "lang", "text").join(F.broadcast(chosen), "doc_id")
    rows = texts.select("lang", F.explode(F.split(F.lower("text"), r"\P{L}+")).alias("w")).where("w <> ''")
    return [(r[0], r[1], r[2]) for r in rows.groupBy("lang", "w").count().collect()]


class Scorer:
    """Scores texts; keeps the scores of up to ``limit`` distinct words between texts."""

    def __init__(self, model: Model, limit: int = 600_000):
        self.model, self.limit = model, limit
        self.keys, self.scores = np.zeros(0, np.uint64), np.zeros((0, len(model.langs)), np.float32)

    def lookup(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Scores of spans (letters of a word, without mark)."""
        keys, first, back = np.unique(_span_hash(codes, starts, lengths), return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        hit = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        scores = np.zeros((len(keys), len(self.model.langs)), np.float32)
        scores[hit] = self.scores[at[hit]]
        miss = np.flatnonzero(~hit)
        if len(miss):
            s, n = starts[first[miss]], lengths[first[miss]]
            new = np.full(int((n + 1).sum()), MARK, np.uint32)
            begins = np.cumsum(n + 1) - (n + 1)
            inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            new[np.repeat(begins + 1, n) + inner] = codes[np.repeat(s, n) + inner]
            scores[miss] = self.model.word_scores(new, begins, n + 1)
            if len(self.keys) + len(miss) > self.limit:
                self.keys, self.scores = self.keys[:0], self.scores[:0]
            merged = np.concatenate([self.keys, keys[miss]])
            order = np.argsort(merged, kind="stable")
            self.keys = merged[order]
            self.scores = np.concatenate([self.scores, scores[miss]])[order]
        return scores[back]

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(log-probabilities, number of words) of each text."""
        lowered = [t.lower() for t in texts]
        codes, starts, ends = words_of("\n".join(lowered))
        lengths = np.fromiter((len(t) + 1 for t in lowered), np.int64, len(texts))
        owner = np.searchsorted(np.cumsum(lengths), starts - 1, side="right")
        n = np.bincount(owner, minlength=len(texts)) if len(owner) else np.zeros(len(texts), np.int64)
        out = np.zeros((len(texts), len(self.model.langs)))
        if len(starts):
            scores = self.lookup(codes, starts, ends - starts).astype(np.float64)
            for k in range(out.shape[1]):
                out[:, k] = np.bincount(owner, scores[:, k], len(texts))
        return out, n


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for each row. The model (vocabulary x languages) is sent to the tasks."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        scorer = Scorer(m) if m.langs else None
        for ids, raw in slices(batches, 2 << 20):
            texts = [b.decode("utf-8", "replace") for b in raw]
            if scorer is None:
                pred, score = ["und"] * len(ids), [0.0] * len(ids)
            else:
                logs, n = scorer.texts(texts)
                best = logs.argmax(1)
                post = 1.0 / np.exp(logs - logs.max(1, keepdims=True)).sum(1)
                pred = [m.langs[b] if c else "und" for b, c in zip(best, n, strict=True)]
                score = np.where(n > 0, post, 0.0).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, SCHEMA)


def keep_identified(docs: DataFrame, model: Model, least_score: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) whose language is told with at least ``least_score``; nothing is exchanged."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value) if shared.value.langs else None
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            rows = pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows)), batch.column(place)], ["i", "text"])
            for at, raw in slices([rows], 2 << 20) if scorer else ():
                logs, n = scorer.texts([b.decode("utf-8", "replace") for b in raw])
                keep[at] = (n > 0) & (1.0 / np.exp(logs - logs.max(1, keepdims=True)).sum(1) >= least_score)
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def vocabulary_file(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def train(docs: DataFrame, keep: Column, sample_docs: int = 300, vocabulary: str | None = None) -> Model:
    counts = sample_counts(docs, keep, sample_docs)
    names = pieces_of(vocabulary or vocabulary_file())
    return fit(counts, names) if counts else Model([], np.zeros(0, np.uint64), np.zeros((0, 0)))


def op6_lang_id(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs, crc_mod(F.col("doc_id"), 5) != 0)
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(True))  # a row without an id teaches nothing
    return predict(docs, model).withColumn("held_out", held_out)
