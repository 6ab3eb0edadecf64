"""Ranked search against brute force, and its bounds against scores."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesloom.llm import ranked_search
from salesloom.llm.common import table

SF = "/root/testdata/sf0.001"
DOCS, ITEMS = "doc_id long, text string, lang string", "item_id long, text string"


def terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, k=20):
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    rows, words = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in {(i, t) for i, t in items if t is not None}:
        scored = []
        for doc_id, c in held:
            m = 75 + 25 * c.total() * rows // words
            score = sum(math.floor(1000 * math.log((2 * rows + 2) / (2 * df[t] + 1)))
                        * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if score:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


ODD_DOCS = [
    (1, "Some words, that make a text"), (1, "Some words, that make a text"), (None, "some WORDS that make a text"),
    (2, "other words\x7fin a_text"), (3, None), (4, ""), (5, " .,\n"), (6, "long " * 60_000), (7, "x" * 200_000),
    (8, "é中𝄞 É words 12a\x0012a"), (-5, "some words that make a text"), (None, "some WORDS that make a text"),
] + [(100 + i, f"filler {i} text") for i in range(60)]
ODD_ITEMS = [
    (1, "some words"), (1, "some words"), (1, "another text of the same item"), (2, None), (3, ""), (4, "unheardof"),
    (None, "é 中𝄞 words words words"), (5, "text"), (6, "long long x"), (7, "filler " * 5_000), (8, "12A a?"),
]


@pytest.mark.parametrize("width, per_block", [(2048, 500), (4, 5)])  # of 4 coordinates, everything collides
def test_odd_rows(spark, monkeypatch, width, per_block):
    monkeypatch.setattr(ranked_search, "ITEMS_PER_BLOCK", per_block)
    docs = spark.createDataFrame([(*d, "en") for d in ODD_DOCS], DOCS).repartition(5).withColumns(
        {c: F.lit(1) for c in ("n", "sketch", "terms", "counts", "q", "score", "rank", "term", "df")})
    items = spark.createDataFrame(ODD_ITEMS, ITEMS).withColumn("q", F.lit(1))
    for k in (20, 3):
        got = ranked_search.search(ranked_search.build_index(docs, width), items, k)
        assert sorted(map(tuple, got.collect()), key=str) == brute(ODD_DOCS, ODD_ITEMS, k)


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b", "en")], DOCS)
    items = spark.createDataFrame([(1, "a")], ITEMS)
    assert ranked_search.search(ranked_search.build_index(none), items).count() == 0
    assert ranked_search.search(ranked_search.build_index(some), items.where("false")).count() == 0
    assert ranked_search.search(ranked_search.build_index(some), items).collect() == [(1, 1, 1, _one())]


def _one():
    return math.floor(1000 * math.log(4 / 3)) * (10 ** 9 // (1000 + 12 * (75 + 25)))


def test_bounds_hold_and_prune(spark):
    docs = [r["text"] for r in table(spark, SF, "documents").select("text").collect()]
    items = [r["text"] for r in table(spark, SF, "benchmark").select("text").limit(20).collect()]
    held = [Counter(terms(t)) for t in docs if terms(t)]
    queries = ranked_search.Queries(items, len(held), sum(c.total() for c in held), 2048).weigh({})
    below = total = 0
    for c in held:
        names = [t.encode() for t in c]
        sketch = np.zeros(2048, np.uint8)
        np.maximum.at(sketch, ranked_search.coordinates(names, 2048), np.minimum(list(c.values()), 255).astype(np.uint8))
        bounds = queries.bounds(sketch[None, :], np.array([c.total()]))[0]
        shares = queries.shares(b"\n".join(names), list(c.values()), c.total())
        for q in range(len(items)):
            score = queries.score(q, shares)
            assert bounds[q] >= score
            below += bounds[q] <= 2 * score
            total += score > 0
    assert below > 0.5 * total
