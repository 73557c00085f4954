"""Mixing to target weights with soft domain membership.

A softmax classifier, fitted on a bounded sample of the labelled table, gives every document a posterior
over the domains. Its features are the presence of the sample's most telling words (by chi-square, named
by 64-bit hash) and a few shapes of the text. Document rates r >= 0 start at one and are fitted so that the
expected tokens of each domain, sum over documents of r * tokens * posterior, meet the targets in least
squares. The iteration is a projected gradient step in its lazy form: gradients are collected in one
number for each domain, and the rates are the projection max(0, 1 - posterior . collected), so a step is
one distributed aggregate of as many sums as there are domains, and no state is kept for a document.
Tokens weigh a document's change of rate, which keeps rates alike for documents of like posterior. A
step is scaled by the current Gram matrix of the documents with a positive rate (at least its diagonal);
targets that stay unmet are warned of.

Defined cases: a null or empty text has no tokens, the prior as posterior, and the rate its posterior
gives; without labelled rows there is one domain ``unlabelled``; targets that cannot be met (a domain
without tokens) are met as nearly as the rates allow; repeated rows are documents of their own; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import read_table, small_batches, stage, unused
from tierwise.llm.textarrays import slices, word_arrays

SHAPES = 8


@dataclass
class Domains:
    """Softmax over word presence (``words``: ascending names) and shape features (the last weights)."""

    names: list[str]
    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    prior: np.ndarray = field(default_factory=lambda: np.ones(1))

    def posteriors(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(posterior of each text, tokens of each text)."""
        shapes, owner, hashes, n = features(texts)
        if len(self.names) == 1:
            return np.ones((len(texts), 1)), n
        rows, columns = present(owner, hashes, self.words)
        logits = shapes @ self.weights[len(self.words) :]
        for k in range(len(self.names)):
            logits[:, k] += np.bincount(rows, self.weights[columns, k], len(texts))
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        return np.where((n > 0)[:, None], p, self.prior), n


_PUNCT = np.zeros(256, np.int64)
for _i, _chars in enumerate(("!", "%*#$&|<>", "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ".,;:?", "'\"()/-@=_+")):
    for _c in _chars:
        _PUNCT[ord(_c)] = _i + 1


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(shapes of each text, text of each word, name of each word, words of each text)."""
    hashes, n = word_arrays(texts)
    owner = np.repeat(np.arange(len(texts)), n)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    data = np.frombuffer(b"".join(texts), np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    of_byte = np.repeat(np.arange(len(texts)), size)
    kinds = np.bincount(of_byte * 7 + _PUNCT[data], minlength=7 * len(texts)).reshape(-1, 7) / np.maximum(size, 1)[:, None]
    repeats = np.sqrt(np.bincount(owner, again, len(texts)) / np.maximum(n, 1))
    return np.column_stack([np.sqrt(kinds[:, 1:]), repeats, np.ones(len(texts))]), owner, hashes, n


def present(owner: np.ndarray, hashes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, index in ``words``) of the words that are there."""
    if not len(words) or not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
    hit = words[at] == hashes
    cell = np.unique(owner[hit] * np.int64(len(words)) + at[hit])
    return cell // len(words), cell % len(words)


def telling_words(owner: np.ndarray, hashes: np.ndarray, y: np.ndarray, most: int, least_docs: int = 5) -> np.ndarray:
    """Ascending names of the ``most`` words whose presence depends most on the domain (chi-square)."""
    words, at = np.unique(hashes, return_inverse=True)
    rows, columns = present(owner, hashes, words)
    seen = np.stack([np.bincount(columns, y[rows, k], len(words)) for k in range(y.shape[1])], 1)
    total = seen.sum(1, keepdims=True)
    share = y.mean(0)
    chi = ((seen - total * share) ** 2 / np.maximum(total * share, 1e-9)).sum(1)
    chi[total[:, 0] < least_docs] = 0
    best = np.argsort(-chi, kind="stable")[:most]
    return words[np.sort(best[chi[best] > 0])]


def fit(texts: list[bytes], labels: list[str], rounds: int = 300, ridge: float = 1e-4, most: int = 1024) -> Domains:
    names = sorted(set(labels))
    if len(names) < 2:
        return Domains(names or ["unlabelled"])
    y = np.zeros((len(texts), len(names)))
    y[np.arange(len(texts)), [names.index(x) for x in labels]] = 1.0
    portions = [features(texts[a : a + 200]) for a in range(0, len(texts), 200)]  # bounds the working arrays
    shapes = np.concatenate([p[0] for p in portions])
    owner = np.concatenate([p[1] + 200 * i for i, p in enumerate(portions)])
    hashes = np.concatenate([p[2] for p in portions])
    del portions
    words = telling_words(owner, hashes, y, most)
    rows, columns = present(owner, hashes, words)
    del owner, hashes
    w = np.zeros((len(words) + SHAPES, len(names)))
    seen = np.zeros_like(w)
    for _ in range(rounds):  # gradient ascent with a step size for each weight
        logits = shapes @ w[len(words) :]
        for k in range(len(names)):
            logits[:, k] += np.bincount(rows, w[columns, k], len(texts))
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        miss = (y - p) / len(texts)
        g = np.stack([np.bincount(columns, miss[rows, k], len(words)) for k in range(len(names))], 1)
        g = np.vstack([g, shapes.T @ miss]) - ridge * w
        seen += g * g
        w += 0.5 * g / (np.sqrt(seen) + 1e-8)
    return Domains(names, words, w, y.mean(0))


def sample(docs: DataFrame, labels: DataFrame, domain: Column, sample_docs: int) -> list[tuple[bytes, str]]:
    """(text, domain) of the labelled documents with the smallest id hash, at most ``sample_docs``."""
    known = labels.select("doc_id", domain.cast("string").alias("_domain")).where("_domain IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.max("_domain").alias("_domain"))
    chosen = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "_domain").agg(F.min("_text").alias("_text"))
    return [(r["_text"].encode(), r["_domain"]) for r in rows.orderBy("doc_id").collect()]


def train(docs: DataFrame, labels: DataFrame, domain: Column, sample_docs: int = 2000) -> Domains:
    rows = sample(docs, labels, domain, sample_docs)
    return fit([t for t, _ in rows], [d for _, d in rows])


def posteriors(docs: DataFrame, model: Domains, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: doc_id, tokens, p (array of posteriors by domain)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches, 2 << 20):
            p, n = shared.value.posteriors(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n.astype(np.int64)), pa.array(list(p), pa.list_(pa.float64()))],
                ["doc_id", "tokens", "p"],
            )

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, "doc_id long, tokens long, p array<double>")


def rate_of(collected: np.ndarray, p: str = "p") -> Column:
    drop = sum((F.get(F.col(p), F.lit(k)) * F.lit(float(x)) for k, x in enumerate(collected)), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.lit(1.0) - drop)


def fit_rates(docs: DataFrame, targets: np.ndarray, rounds: int = 60, tolerance: float = 1e-9):
    """(collected, expected): the domains' collected gradients and expected tokens for staged posteriors.

    ``targets`` are tokens by domain. Every round is one pass over (tokens, p); it ends when no domain is
    off by more than ``tolerance`` of all targets, or when the rates cannot come nearer."""
    k = len(targets)
    p = [F.get("p", F.lit(i)) for i in range(k)]

    def sums(collected: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rate = rate_of(collected)
        live = F.when(rate > 0, F.col("tokens")).otherwise(0)
        out = [F.sum(rate * F.col("tokens") * p[i]) for i in range(k)]
        out += [F.sum(live * p[i] * p[j]) for i in range(k) for j in range(i, k)]
        row = [float(x or 0.0) for x in docs.agg(*out).first()]
        gram = np.zeros((k, k))
        upper = iter(row[k:])
        for i in range(k):
            for j in range(i, k):
                gram[i, j] = gram[j, i] = next(upper)
        return np.array(row[:k]), gram

    collected = np.zeros(k)
    expected, gram = sums(collected)
    scale = max(1.0, float(np.abs(targets).sum()))
    for _ in range(rounds):
        miss = expected - targets
        if np.abs(miss).max() <= tolerance * scale:
            break
        ridge = 1e-9 * max(1.0, float(np.trace(gram)))
        step = np.linalg.solve(gram + ridge * np.eye(k), miss)
        length, gained = 1.0, False
        for _ in range(12):  # shorten a step that does not come nearer
            trial = collected + length * step
            now, now_gram = sums(trial)
            if ((now - targets) ** 2).sum() < (miss**2).sum():
                collected, expected, gram, gained = trial, now, now_gram, True
                break
            length /= 2
        if not gained:
            break
    return collected, expected


def mix(docs: DataFrame, model: Domains, shares: dict[str, float], total: float = 1.0) -> tuple[DataFrame, dict[str, dict[str, float]]]:
    """(one row per row: doc_id, tokens, p, rate; {domain: natural, target, expected tokens}).

    ``shares``: wanted tokens of a domain as a multiple of its natural expected tokens; domains not named
    keep theirs. ``total`` multiplies all targets."""
    scored = stage(posteriors(docs, model), "mixing")
    collected, targets, expected = fitted(scored, model, shares, total)
    report = {
        name: {"natural": float(a), "target": float(b), "expected": float(c)}
        for name, a, b, c in zip(model.names, natural_tokens(scored, model), targets, expected, strict=True)
    }
    return scored.withColumn("rate", rate_of(collected)), report


def natural_tokens(scored: DataFrame, model: Domains) -> np.ndarray:
    row = scored.agg(*[F.sum(F.col("tokens") * F.get("p", F.lit(i))) for i in range(len(model.names))]).first()
    return np.array([float(x or 0.0) for x in row])


def fitted(scored: DataFrame, model: Domains, shares: dict[str, float], total: float):
    """(collected, targets, expected) for staged posteriors. Targets that no rates can meet are warned of; the rates
    are then the nearest found."""
    targets = natural_tokens(scored, model) * total * np.array([shares.get(name, 1.0) for name in model.names])
    collected, expected = fit_rates(scored, targets)
    if np.abs(expected - targets).max(initial=0.0) > 1e-6 * max(1.0, float(np.abs(targets).sum())):
        off = {n: (float(e), float(t)) for n, e, t in zip(model.names, expected, targets, strict=True)}
        warnings.warn(f"mixing: expected tokens are not the targets (expected, target): {off}", stacklevel=2)
    return collected, targets, expected


def draw_of(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A fixed number of each row for rounding, by its id and text (equal rows have the same)."""
    return F.xxhash64(F.lit("mixing"), F.col(doc_id).cast("long"), F.col(text))


def copies_of(rates: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """floor(rate), and one more where the draw, as a share of its range, is below the rest: rate copies on average."""
    whole = np.floor(rates)
    share = (draws.astype(np.int64).view(np.uint64) >> np.uint64(11)) / float(1 << 53)
    return (whole + (share < rates - whole)).astype(np.int64)


def apply_rates(docs: DataFrame, model: Domains, shares: dict[str, float], total: float = 1.0) -> DataFrame:
    """The rows of ``docs`` (all columns), each as many times as its fitted rate, rounded up or down by a
    fixed hash of the row: the tokens of a domain are its target but for the scatter of the draws.

    The rate is a function of the posterior, so texts are scored again where they lie: nothing is exchanged."""
    small_batches(docs.sparkSession)
    scored = stage(posteriors(docs, model), "mixing")
    collected, _, _ = fitted(scored, model, shares, total)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")
    n_columns = len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rates = np.zeros(batch.num_rows)
            rows = pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows)), batch.column(place)], ["i", "text"])
            for at, texts in slices([rows], 2 << 20):
                p, _ = shared.value.posteriors(texts)
                rates[at] = np.maximum(0.0, 1.0 - p @ collected)
            copies = copies_of(rates, batch.column(n_columns).to_numpy(zero_copy_only=False))
            kept = batch.select(list(range(n_columns)))
            yield kept.take(pa.array(np.repeat(np.arange(batch.num_rows), copies)))

    return docs.select("*", draw_of().alias(unused("draw", docs.columns))).mapInArrow(run, docs.schema)


def domain_of_label() -> Column:
    """Domains of the labelled table: toxic, low (quality 0), clean."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "clean")


#: Production targets: the clean domain keeps its tokens, low quality a quarter, toxic a tenth (rates near 0.1).
SHARES = {"clean": 1.0, "low": 0.25, "toxic": 0.1}


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs, read_table(spark, sf_dir, "labels"), domain_of_label())
    out, _ = mix(docs, model, SHARES)
    names = [F.round(F.get("p", F.lit(i)), 9).alias(f"p_{name}") for i, name in enumerate(model.names)]
    return out.select("doc_id", "tokens", *names, "rate")
