"""License scan against plain containment of token shingles."""

import random
import re

from tierwise.llm import license_scan


def brute(text, templates):
    def grams(t):
        w = [x for x in re.split(r"[^\w]+|_", t.lower()) if x]
        return [tuple(w[i : i + 3]) for i in range(len(w) - 2)] or ([tuple(w)] if w else [])

    g = grams(text or "")
    found = set()
    for name, t in templates.items():
        own = set(grams(t))
        n = len(grams(t))
        if any(own <= set(g[i : i + n]) for i in range(len(g))):
            found.add(name)
    return found


def test_every_planted_license_is_found_and_nothing_else(spark):
    rng = random.Random(4)
    word = lambda: "w" + str(rng.randrange(500))
    rows = [(0, None), (1, ""), (2, "!!! ..."), (3, "MIT License"), (4, "x" * 20000)]
    for name, text in license_scan.TEMPLATES.items():
        for _ in range(12):
            before, after = (" ".join(word() for _ in range(rng.randrange(70))) for _ in range(2))
            rows.append((len(rows), f"{before}\n{text.upper() if rng.random() < 0.3 else text}\n{after}"))
        cut = text.split()
        rows.append((len(rows), " ".join(cut[: len(cut) // 2] + [word()] + cut[len(cut) // 2 :])))
    rows.append(rows[-1])
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, hits string").repartition(4)
    got = {}
    for r in license_scan.scan(docs).collect():
        got.setdefault(r["doc_id"], set()).update(h["name"] for h in r["hits"])
    want = {i: brute(t, license_scan.TEMPLATES) for i, t in rows}
    assert set(got) == set(want)
    extra = [i for i in want if got[i] - want[i]]
    # a window may also hold a template whose shingles are all there but spread: none is planted
    assert not extra
    missed = sum(len(want[i] - got[i]) for i in want)
    assert missed <= 0.01 * sum(map(len, want.values()))


def test_no_rows_and_no_templates(spark):
    docs = spark.createDataFrame([(1, "All rights reserved.")], "doc_id long, text string")
    assert license_scan.scan(docs.limit(0)).count() == 0
    assert license_scan.scan(docs, {}).first()["hits"] == []
    assert [h["name"] for h in license_scan.scan(docs, {"r": "all rights"}).first()["hits"]] == []
    assert [h["name"] for h in license_scan.scan(docs, {"r": "rights reserved all rights"}).first()["hits"]] == []
    assert {h["name"] for h in license_scan.scan(docs, {"r": "all rights RESERVED"}).first()["hits"]} == {"r"}
