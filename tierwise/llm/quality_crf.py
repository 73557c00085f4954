"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Every line with a word has features of its own (character classes, word shapes, repetition, length) and
of the lines before and after it; the chain has two states, bad and good, with transition weights.
Training lines take the label of their document. Forward-backward gives each line's probability of
good, and the document's quality is their mean weighted by line length, passed through a logistic
calibration fitted on the training documents.

The model is fitted on a bounded sample: of the labelled training documents the ``sample_docs`` with the
smallest id hash, whole texts. Scoring reads whole texts, too.

Defined cases: null, empty and wordless texts have no line and get the share of good documents in the
sample; without labels of both kinds every score is that share (or 0.5 without any); repeated rows are
scored each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import crc_mod, read_table
from tierwise.llm.textarrays import mix, slices, word_arrays

SCHEMA = "doc_id long, score double, n_lines long"
_BYTES = np.arange(256)
#: Byte classes counted in each line.
CLASSES = {
    "upper": (_BYTES >= 65) & (_BYTES <= 90),
    "lower": (_BYTES >= 97) & (_BYTES <= 122),
    "digit": (_BYTES >= 48) & (_BYTES <= 57),
    "sentence": np.isin(_BYTES, [ord(c) for c in ".,;:?"]),
    "mark": _BYTES == ord("!"),
    "symbol": np.isin(_BYTES, [ord(c) for c in "#*$%&|<>{}[]\\^~_=+@"]),
    "quote": np.isin(_BYTES, [ord(c) for c in "\"'()/-"]),
    "high": _BYTES >= 128,
}
OWN = len(CLASSES) + 7


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of each line with a word, its text, its length in bytes)."""
    owner_of, lines = [], []
    for i, t in enumerate(texts):
        part = [x for x in t.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
        lines += part
        owner_of += [i] * len(part)
    if not lines:
        return np.zeros((0, OWN)), np.zeros(0, np.int64), np.zeros(0)
    owner = np.array(owner_of)
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    data = np.frombuffer(b"".join(lines), np.uint8)
    start = np.cumsum(size) - size
    columns = [np.add.reduceat(member[data], start, dtype=np.int64) / size for member in CLASSES.values()]
    hashes, n = word_arrays(lines)
    n_words = np.maximum(n, 1)
    of_line = np.repeat(np.arange(len(lines)), n)
    # repetition: words equal to the word before them, and words seen earlier in the line
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (of_line[1:] == of_line[:-1])
    key = mix(hashes + of_line.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(key, return_index=True)
    seen = np.ones(len(key), bool)
    seen[first] = False
    line_name = np.add.reduceat(mix(hashes), np.cumsum(n) - n)
    doc_line = mix(line_name + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(doc_line, return_index=True)
    copy = np.ones(len(lines), bool)
    copy[first] = False
    columns += [
        np.bincount(of_line, again, len(lines)) / n_words,
        np.bincount(of_line, seen, len(lines)) / n_words,
        copy,
        np.minimum(size / n_words, 30) / 10,
        np.log1p(n_words) / 5,
        n_words < 4,
        np.ones(len(lines)),
    ]
    return np.column_stack(columns).astype(np.float64), owner, size.astype(np.float64)


def with_neighbours(own: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Own features, then those of the line before and after in the same document (zeros at the ends)."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    same = owner[1:] == owner[:-1]
    before[1:][same] = own[:-1][same]
    after[:-1][same] = own[1:][same]
    return np.hstack([own, before, after])


def chain(emit: np.ndarray, move: np.ndarray, owner: np.ndarray):
    """Forward-backward over all documents at once.

    emit: log potential of state good at each line (bad is 0); move[a, b]: log potential of a step.
    Returns (probability of good at each line, expected steps[a, b], sum of log partition)."""
    n = len(emit)
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    length = np.diff(np.append(first, n))
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    potential = np.stack([np.zeros(n), emit], 1)
    alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
    alpha[first] = potential[first]
    longest = int(length[0]) if len(length) else 0
    live = len(first) - np.searchsorted(length[::-1], np.arange(longest + 1), side="right")  # documents longer than k
    for k in range(1, longest):
        at = first[: live[k]] + k
        step = alpha[at - 1][:, :, None] + move
        alpha[at] = np.logaddexp(step[:, 0], step[:, 1]) + potential[at]
    for k in range(longest - 2, -1, -1):
        at = first[: live[k + 1]] + k
        step = move + (potential[at + 1] + beta[at + 1])[:, None, :]
        beta[at] = np.logaddexp(step[:, :, 0], step[:, :, 1])
    last = first + length - 1
    z = np.logaddexp(alpha[last, 0], alpha[last, 1])
    z_line = np.zeros(n)
    z_line[first] = z
    z_line = z_line[np.maximum.accumulate(np.where(np.diff(owner, prepend=-1) != 0, np.arange(n), 0))]
    good = np.exp(np.minimum(alpha[:, 1] + beta[:, 1] - z_line, 0.0))
    inner = np.flatnonzero(owner[1:] == owner[:-1])
    pair = alpha[inner][:, :, None] + move + (potential[inner + 1] + beta[inner + 1])[:, None, :] - z_line[inner][:, None, None]
    return good, np.exp(pair).sum(0), z.sum()


@dataclass
class Crf:
    prior: float = 0.5
    weights: np.ndarray = field(default_factory=lambda: np.zeros(3 * OWN))
    move: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    slope: float = 0.0
    offset: float = 0.0

    def qualities(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(length-weighted mean of the lines' probabilities, or nan without lines; number of lines)."""
        own, owner, size = line_features(texts)
        n = np.bincount(owner, minlength=len(texts))
        if not len(own):
            return np.full(len(texts), np.nan), n
        good, _, _ = chain(with_neighbours(own, owner) @ self.weights, self.move, owner)
        weight = np.bincount(owner, size, len(texts))
        total = np.bincount(owner, size * good, len(texts))
        return np.where(n > 0, total / np.maximum(weight, 1.0), np.nan), n

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        quality, n = self.qualities(texts)
        if not self.slope:
            return np.full(len(texts), self.prior), n
        logit = self.slope * quality + self.offset
        return np.where(np.isnan(quality), self.prior, 1 / (1 + np.exp(-np.clip(logit, -40, 40)))), n


def fit(texts: list[bytes], labels: np.ndarray, rounds: int = 120, ridge: float = 1e-3) -> Crf:
    """Maximum conditional likelihood by gradient ascent with per-weight step sizes (Adam), then Platt scaling."""
    if not len(labels):
        return Crf()
    prior = float(np.clip(labels.mean(), 0.01, 0.99))
    if labels.min() == labels.max():
        return Crf(prior)
    own, owner, _ = line_features(texts)
    x = with_neighbours(own, owner)
    y = labels[owner].astype(np.float64)
    inner = np.flatnonzero(owner[1:] == owner[:-1])
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[inner].astype(int), y[inner + 1].astype(int)), 1.0)
    model = Crf(prior)
    w = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        move = w[-4:].reshape(2, 2)
        good, steps, _ = chain(x @ w[:-4], move, owner)
        g = np.concatenate([x.T @ (y - good), (seen - steps).ravel()]) / len(y) - ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w + 0.2 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    model.weights, model.move = w[:-4], w[-4:].reshape(2, 2)
    quality, _ = model.qualities(texts)
    ok = ~np.isnan(quality)
    a, b, q, z = 5.0, -2.5, quality[ok], labels[ok].astype(np.float64)
    for _ in range(50):  # Newton steps for the two calibration weights
        p = 1 / (1 + np.exp(-np.clip(a * q + b, -40, 40)))
        r, s = p - z, p * (1 - p) + 1e-9
        grad = np.array([(r * q).sum() + 1e-2 * a, r.sum() + 1e-2 * b])
        hess = np.array([[(s * q * q).sum() + 1e-2, (s * q).sum()], [(s * q).sum(), s.sum() + 1e-2]])
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
    model.slope, model.offset = (float(a), float(b)) if a > 0 else (0.0, 0.0)
    return model


def sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, sample_docs: int) -> list[tuple[bytes, object]]:
    """(text, label) of the kept labelled documents with the smallest id hash. Ids are chosen without
    texts; the chosen ids (at most ``sample_docs``) are broadcast to read their texts."""
    known = labels.where(F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).alias("_label"))
    chosen = known.where(keep).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "_label").agg(F.min("_text").alias("_text"))
    return [(r["_text"].encode(), r["_label"]) for r in rows.orderBy("doc_id").collect()]


def train(docs: DataFrame, labels: DataFrame, keep: Column, sample_docs: int = 2000) -> Crf:
    rows = sample(docs, labels, "quality", keep, sample_docs)
    return fit([t for t, _ in rows], np.array([int(y) for _, y in rows], np.int64))


def score(docs: DataFrame, model: Crf, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score, n_lines for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches, 2 << 20):
            s, n = model.scores(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(s), pa.array(n.astype(np.int64))], ["doc_id", "score", "n_lines"]
            )

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, SCHEMA)


def op3_quality_crf(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    fold = crc_mod(F.col("doc_id"), 5)
    model = train(docs, read_table(spark, sf_dir, "labels"), fold != 0)
    out = score(docs, model).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
    return out.withColumn("held_out", F.coalesce(fold == 0, F.lit(True)))  # a row without an id teaches nothing
