"""Secret scan (DataFrame functions only): fixed patterns plus sliding-window character entropy.

Pattern spans: credential assignments, access keys and long hex strings, leftmost and
non-overlapping per kind. Entropy spans: candidate strings (runs of one character class) whose
Shannon entropy inside some window of ``window`` characters reaches the class limit. The window
slides one character at a time; its counts change by one in, one out. Candidates on the allow-list
(letters of one case or in words, no letter, UUIDs, dates and number runs; a parameter) are suppressed:
random letters of one case cannot be told from words, and strings under 20 characters are no candidates. Pattern spans, which are
already reported, are cut out of the candidates; each piece left of ``window`` characters or more is a
candidate of its own.

Defined cases: a null text counts as empty and has no spans; repeated rows are scanned and returned
each; an empty table gives no rows; positions are code points, end exclusive; other input columns
are ignored, so their names cannot clash. Texts are read whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import let, read_table

# The pattern kinds in listed order.
ASSIGN = "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ASSIGN_HINT = "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]"
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

#: Runs of the whole base64 alphabet that hold both cases.
_MIXED = "(?<![A-Za-z0-9+/_-])(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{20,}"
#: Two letters of mixed case that are a word in a name like ``sizeOfList``.
_SHORT = "Am|An|As|At|Be|By|Do|Go|He|Id|If|In|Is|It|Me|My|No|Of|On|Or|So|To|Up|Us|We"

#: Character classes of candidate strings: pattern of a run, entropy limit in bits for a window. Of random
#: strings of 20 characters 1 to 3 in 100 lie below the limit of their class (README has the recall).
CLASSES = {
    "base64": ("[A-Za-z0-9+/_-]{20,}", 3.9),
    "hex": ("[0-9A-Fa-f]{20,}", 2.9),
    "mixed": (_MIXED, 3.65),
    "lower": ("[a-z0-9]{20,}", 3.44),
    "upper": ("[A-Z0-9]{20,}", 3.4),
}
#: Strings that are never secrets, as whole-candidate patterns: letters of one case or in words (no lower-case
#: letter alone after a capital, but for short words); no letter; UUID; date or number runs.
ALLOWED = (
    "[a-z+/_-]+", "[A-Z+/_-]+", f"(?![A-Za-z+/_-]*[A-Z][a-z](?<!{_SHORT})(?![a-z]))[A-Za-z+/_-]+",
    "[^A-Za-z]+", "[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", "[0-9T_:/-]+Z?",
)

_SPAN = "array<struct<start:int,end:int,kind:int,value:string>>"


def _nothing() -> Column:
    return F.array().cast(_SPAN)


def found(text: Column, pattern: str, kind: int, value_group: int = 0, min_value: int = 1) -> Column:
    """All leftmost non-overlapping matches as spans. Positions come from the pieces between matches:
    a match starts after all earlier pieces and matches. ``min_value``: matches whose
    ``value_group`` is shorter are dropped (after matching)."""
    hit = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    rows = F.arrays_zip(hit.alias("hit"), value.alias("value"), F.split(text, pattern, -1).alias("gap"))
    start = F.struct(F.lit(0).alias("at"), _nothing().alias("spans"))

    def step(acc: Column, row: Column) -> Column:
        begin = acc["at"] + F.length(row["gap"])
        end = begin + F.coalesce(F.length(row["hit"]), F.lit(0))
        span = F.struct(
            begin.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), row["value"].alias("value")
        )
        keep = row["hit"].isNotNull() & (F.length(row["value"]) >= min_value)
        more = F.when(keep, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(end.alias("at"), more.cast(_SPAN).alias("spans"))

    return F.aggregate(rows, start, step, lambda acc: acc["spans"])


def window_entropy(value: Column, window: int = 20) -> Column:
    """Largest Shannon entropy (bits) of a window of ``window`` characters sliding over an ASCII string.

    The state holds 128 counts and the sum of c*log2(c); a step adds one character, drops one, and
    changes only their two terms. H = log2(window) - sum / window."""
    chars = F.split(value, "", -1)
    codes = F.transform(F.filter(chars, lambda c: c != ""), lambda c: F.ascii(c))
    term = F.array(*[F.lit(0.0 if c < 2 else c * math.log2(c)) for c in range(window + 2)])

    def add(counts: Column, code: Column, by: int) -> Column:
        return F.transform(counts, lambda c, i: F.when(i == code, c + by).otherwise(c))

    def slide(code: Column) -> Column:
        first = F.struct(
            F.array_repeat(F.lit(0), 128).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best")
        )

        def step(acc: Column, i: Column) -> Column:
            gone = F.when(i >= window, F.get(code, i - window)).otherwise(F.lit(-1))
            came = F.get(code, i)

            def dropped(state: Column) -> Column:
                n = F.coalesce(F.get(state["counts"], gone), F.lit(0))
                less = F.when(gone >= 0, F.get(term, n) - F.get(term, n - 1)).otherwise(F.lit(0.0))
                counts = F.when(gone >= 0, add(state["counts"], gone, -1)).otherwise(state["counts"])
                return F.struct(counts.alias("counts"), (state["sum"] - less).alias("sum"), state["best"].alias("best"))

            def added(state: Column) -> Column:
                n = F.get(state["counts"], came)
                total = state["sum"] + F.get(term, n + 1) - F.get(term, n)
                entropy = F.lit(math.log2(window)) - total / window
                best = F.when(i >= window - 1, F.greatest(state["best"], entropy)).otherwise(state["best"])
                return F.struct(add(state["counts"], came, 1).alias("counts"), total.alias("sum"), best.alias("best"))

            return let(let(acc, dropped), added)

        return F.aggregate(F.sequence(F.lit(0), F.size(code) - 1), first, step, lambda acc: acc["best"])

    return F.when(F.length(value) >= window, let(codes, slide)).otherwise(F.lit(0.0))


def _suspect(allowed: str, window: int, limit: float):
    return lambda s: ~s["value"].rlike(f"^(?:{allowed})$") & (window_entropy(s["value"], window) >= limit)


def _clear_pieces(span: Column, others: Column, window: int) -> Column:
    """The parts of a span that no span of ``others`` (sorted by start) covers, if ``window`` long or longer."""

    def grown(acc: Column, end: Column) -> Column:
        value = F.substring(span["value"], acc["at"] - span["start"] + 1, end - acc["at"])
        part = F.struct(acc["at"].alias("start"), end.alias("end"), span["kind"].alias("kind"), value.alias("value"))
        return F.when(end - acc["at"] >= window, F.concat(acc["spans"], F.array(part))).otherwise(acc["spans"])

    def step(acc: Column, o: Column) -> Column:
        return F.struct(F.greatest(acc["at"], o["end"]).alias("at"), grown(acc, o["start"]).cast(_SPAN).alias("spans"))

    touching = F.filter(others, lambda o: (span["start"] < o["end"]) & (o["start"] < span["end"]))
    first = F.struct(span["start"].alias("at"), _nothing().alias("spans"))
    return F.aggregate(touching, first, step, lambda acc: grown(acc, span["end"]).cast(_SPAN))


def entropy_spans(text: Column, window: int, allowed: tuple[str, ...], base: Column) -> Column:
    out = _nothing()
    for pattern, limit in CLASSES.values():
        spans = F.flatten(F.transform(found(text, pattern, len(KINDS) - 1), lambda s: _clear_pieces(s, base, window)))
        suspect = _suspect("|".join(f"(?:{a})" for a in allowed), window, limit)
        spans = F.filter(spans, suspect)
        out = F.concat(out, F.when(text.rlike(pattern), spans).otherwise(_nothing()))
    return out


def secret_spans(text: Column, window: int = 20, allowed: tuple[str, ...] = ALLOWED) -> Column:
    """struct(base, extra): pattern spans and entropy spans of a non-null text, each sorted by start, then kind."""

    def with_base(base: Column) -> Column:
        extra = entropy_spans(text, window, allowed, base)

        def merged(e: Column) -> Column:  # a hex run inside a base64 run: keep the longest of those that overlap
            return F.filter(
                e,
                lambda s: ~F.exists(
                    e,
                    lambda o: (s["start"] < o["end"])
                    & (o["start"] < s["end"])
                    & (
                        (o["end"] - o["start"] > s["end"] - s["start"])
                        | ((o["end"] - o["start"] == s["end"] - s["start"]) & (o["start"] < s["start"]))
                    ),
                ),
            )

        ordered = F.array_sort(F.array_distinct(let(extra, merged)))
        return F.struct(base.alias("base"), ordered.alias("extra"))

    def guarded(pattern: str, hint: str, *args) -> Column:
        return F.when(text.rlike(hint), found(text, pattern, *args)).otherwise(_nothing())

    base = F.concat(
        guarded(ASSIGN, ASSIGN_HINT, 0, 2, 6), guarded(ACCESS, ACCESS, 1), guarded(HEX, HEX, 2)
    )
    ordered = F.array_sort(
        base,
        lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["kind"] - b["kind"]),
    )
    return let(ordered, with_base)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 20) -> DataFrame:
    """One row per input row: doc_id, base and extra span arrays (start, end, kind index, value).

    A text without any long run or credential word cannot have a span; one regular expression finds
    that out before the span expressions run."""
    t = F.coalesce(F.col(text), F.lit(""))
    hint = f"{ASSIGN_HINT}|[A-Za-z0-9+/_-]{{20,}}"
    empty = F.struct(_nothing().alias("base"), _nothing().alias("extra"))
    found_ = docs.select(F.col(doc_id).alias("doc_id"), F.when(t.rlike(hint), secret_spans(t, window)).otherwise(empty).alias("s"))
    return found_.select("doc_id", F.col("s.base").alias("base"), F.col("s.extra").alias("extra"))


def redact(docs: DataFrame, mark: str = "<SECRET>", window: int = 20) -> DataFrame:
    """The documents with every span's text replaced by ``mark``; other columns stay, ``n_chars``
    (if there) follows the new text. Overlapping spans are replaced together."""
    t = F.coalesce(F.col("text"), F.lit(""))
    hint = f"{ASSIGN_HINT}|[A-Za-z0-9+/_-]{{20,}}"

    def rebuilt(s: Column) -> Column:
        spans = F.array_sort(F.transform(F.concat(s["base"], s["extra"]), lambda x: F.struct(x["start"], x["end"])))
        first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

        def step(acc: Column, x: Column) -> Column:
            gap = F.substring(t, acc["at"] + 1, F.greatest(x["start"] - acc["at"], F.lit(0)))
            put = F.when(x["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"])
            return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), put.alias("out"))

        return F.aggregate(
            spans, first, step, lambda acc: F.concat(acc["out"], F.substring(t, acc["at"] + 1, F.length(t)))
        )

    hit = t.rlike(hint)
    out = docs.withColumn("text", F.when(hit, let(secret_spans(t, window), rebuilt)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    parts = F.transform(
        spans,
        lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(parts, ",")


def op7_secret_scan(spark, sf_dir: str) -> DataFrame:
    spans = scan(read_table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        n = F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind)))
        return n.cast("long").alias(f"n_{kind}")

    by_start = F.array_sort(
        F.concat("base", "extra"),
        lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["kind"] - b["kind"]),
    )
    return spans.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(by_start).alias("spans"),
        F.size("extra").cast("long").alias("n_entropy"),
    )
