"""License scan (DataFrame functions only): MinHash bands over overlapping windows, then exact containment.

A text is read as alphanumeric tokens, lower-cased, in shingles of three, cut into blocks of four. A
window of a level is a run of blocks at least twice as long as the level's templates, and windows overlap
by half, so an unbroken copy of a template lies whole in some window. Each window has one minimum for each
of ``bands`` random orders (bands of one row): the least of its blocks' minima, which all levels share. A
template is retrieved where any band agrees; a whole copy makes up at least three tenths of its window, so
it is retrieved with probability at least 1 - 0.7^bands, 0.9967 for 16. Retrieved windows are verified: the
share of the template's shingles that occur in the window must reach ``containment``.

The order of a band is the XOR distance of the shingle hash to a fixed random word. The templates are a
short list in the program (``TEMPLATES``, or the caller's); their band values are literals of the plan.

Defined cases: a null text counts as empty; a text without tokens has no license; texts are scanned
whole; repeated rows are scanned and returned each; an empty table gives no rows; a template with fewer
than three tokens is one shingle; other input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import let, read_table

# Names and texts of the notices looked for.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "Apache-2.0-header": (
        "you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files"
    ),
    "GPL-redistribute": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation"
    ),
    "LGPL-library": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the "
        "GNU Lesser General Public License"
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
        "If a copy of the MPL was not distributed with this file"
    ),
    "ISC-permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted"
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "BSD-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met"
    ),
}
SIZE = 3
#: Shingles of a block, and the window lengths of the levels in blocks (even: half a window is a step). A
#: template belongs to the smallest window that is at least twice as long.
BLOCK = 4
WINDOWS = (2, 4, 6, 14, 30, 62)


def band_seeds(bands: int) -> list[int]:
    """Fixed random signed 64-bit words (a multiplicative sequence)."""
    out, x = [], 0x2545F4914F6CDD1D
    for _ in range(bands):
        x = (x * 0x5851F42D4C957F2D + 0x14057B7EF767814F) % (1 << 64)
        y = x ^ (x >> 29)
        out.append(y - (1 << 64) if y >> 63 else y)
    return out


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def shingles(text: Column) -> Column:
    def hashes(hs: Column) -> Column:
        n = F.size(hs)
        return (
            F.when(n == 0, F.array().cast("array<bigint>"))
            .when(n < SIZE, F.array(F.xxhash64(hs)))
            .otherwise(
                F.transform(F.sequence(F.lit(0), n - SIZE), lambda i: F.xxhash64(*[F.get(hs, i + j) for j in range(SIZE)]))
            )
        )

    return let(F.transform(tokens(text), lambda w: F.xxhash64(w)), hashes)


def _xored(window: Column, seed: int) -> Column:
    return F.transform(window, lambda h: h.bitwiseXOR(F.lit(seed)))


def block_minima(s: Column, seed: int) -> Column:
    """The least XOR distance in each block of the shingles ``s``."""
    starts = F.sequence(F.lit(0), F.size(s) - 1, F.lit(BLOCK))
    least = F.transform(
        starts, lambda at: F.least(*[F.get(s, at + j).bitwiseXOR(F.lit(seed)) for j in range(BLOCK)])
    )
    return F.when(F.size(s) > 0, least).otherwise(F.array().cast("array<bigint>"))


class Templates:
    """Shingles and band values of the templates, computed by Spark's own expressions, by window length."""

    def __init__(self, spark, templates: dict[str, str], bands: int):
        self.seeds = band_seeds(bands)
        rows = spark.createDataFrame(list(templates.items()), "name string, text string")
        rows = rows.select("name", shingles(F.col("text")).alias("s")).where(F.size("s") > 0)
        least = F.array(*[F.array_min(_xored(F.col("s"), seed)) for seed in self.seeds])
        self.levels: dict[int, list] = {}
        for r in rows.select("name", "s", least.alias("least")).collect():
            n = len(r["s"])
            blocks = next((w for w in WINDOWS if w * BLOCK >= 2 * n), 2 * -(-n // BLOCK))
            self.levels.setdefault(blocks, []).append((r["name"], r["s"], r["least"]))


def _longs(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<bigint>")


def hit_blocks(bound: Column, levels: dict[int, list], bands: int) -> Column:
    """Blocks whose minimum for some band is some template's minimum for it. A window agrees with a template
    only if it has such a block, so the other windows need not be looked at."""

    def hit(k: Column) -> Column:
        found = F.lit(False)
        for band in range(bands):
            keys = sorted({t[2][band] for templates in levels.values() for t in templates})
            found = found | F.get(bound[f"b{band}"], k).isin(keys)
        return found

    n = F.size(bound["b0"])
    none = F.array().cast("array<int>")
    return F.when(n > 0, F.filter(F.sequence(F.lit(0), n - 1), hit)).otherwise(none)


def level_hits(bound: Column, hits: Column, blocks: int, templates: list, bands: int, containment: float) -> Column:
    """array<struct<name, at>>: verified templates of one level. ``bound``: struct of the shingles s and the
    block minima b0, b1, ...; ``hits``: the blocks worth looking at; ``at``: the window's first shingle."""
    step = blocks // 2

    def two_windows(k: Column) -> Column:
        first = (F.floor(k / F.lit(step)) * step).cast("int")
        return F.array(first, first - step)

    starts = F.array_distinct(F.flatten(F.transform(hits, two_windows)))

    def least(at: Column, band: int) -> Column:
        return F.least(*[F.get(bound[f"b{band}"], at + j) for j in range(blocks)])

    def retrieved(at: Column) -> Column:
        agree = F.lit(False)
        for band in range(bands):
            agree = agree | F.coalesce(least(at, band).isin([t[2][band] for t in templates]), F.lit(False))
        return agree & (at >= 0)

    def verified(at: Column) -> Column:
        window = F.slice(bound["s"], at * BLOCK + 1, F.lit(blocks * BLOCK))
        names = []
        for name, own, mins in templates:
            agree = F.lit(False)
            for band in range(bands):
                agree = agree | F.coalesce(least(at, band) == F.lit(mins[band]), F.lit(False))
            shared = F.size(F.array_intersect(_longs(own), window))
            names.append(F.when(agree & (shared >= containment * len(set(own))), F.lit(name)))
        return F.transform(F.array_compact(F.array(*names)), _named(at * BLOCK))

    none = F.array().cast("array<struct<name:string,at:int>>")
    return F.coalesce(F.flatten(F.transform(F.filter(starts, retrieved), verified)), none)


def _named(at: Column):
    return lambda name: F.struct(name.alias("name"), at.alias("at"))


def scan(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    bands: int = 16,
    containment: float = 1.0,
) -> DataFrame:
    """doc_id and hits (array of name, at) of each row; a license found in two overlapping windows is
    listed for both."""
    known = Templates(docs.sparkSession, TEMPLATES if templates is None else templates, bands)

    def with_minima(s: Column) -> Column:
        return F.struct(s.alias("s"), *[block_minima(s, seed).alias(f"b{i}") for i, seed in enumerate(known.seeds)])

    def all_levels(bound: Column) -> Column:
        none = F.array().cast("array<struct<name:string,at:int>>")

        def from_blocks(hits: Column) -> Column:
            each = [level_hits(bound, hits, w, t, bands, containment) for w, t in sorted(known.levels.items())]
            return F.when(F.size(hits) > 0, F.concat(none, *each)).otherwise(none)

        return let(hit_blocks(bound, known.levels, bands), from_blocks)

    s = shingles(F.coalesce(F.col(text), F.lit("")))
    return docs.select(F.col(doc_id).alias("doc_id"), let(let(s, with_minima), all_levels).alias("hits"))


def op8_license_scan(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_licenses (distinct names), licenses (their names in order, comma-joined)."""
    hits = scan(read_table(spark, sf_dir, "documents"))
    names = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["name"])))
    return hits.select("doc_id", F.size(names).cast("long").alias("n_licenses"), F.array_join(names, ",").alias("licenses"))
