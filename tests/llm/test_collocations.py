"""Transducers against dictionaries, collocations against brute force."""

import bisect
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesloom.llm import collocations, transducer as fsa

WORDS = [b"a", b"b", b"c", b"dd", "é".encode(), b"e"]
PIECES = st.lists(st.tuples(st.sampled_from([b"de", b"en"]), st.lists(st.sampled_from(WORDS), min_size=1, max_size=7)),
                  max_size=12)
SCHEMA = "doc_id long, text string, lang string"


def paths_of(pieces):
    block, counts = collocations.Block(), Counter()
    for lang, words in pieces:
        block.add(lang.decode(), b" ".join(words).decode())
        for i in range(len(words)):
            for k in range(min(3, len(words) - i) + 1):
                counts[(lang, *words[i:i + k])] += 1
    return block.paths(), counts


def dump(paths):
    return {fsa.phrase(paths, level, i): int(w) for level in range(fsa.DEPTH)
            for i, w in enumerate(paths.levels[level][2])}


@settings(max_examples=60, deadline=None)
@given(PIECES, PIECES, st.lists(st.lists(st.sampled_from([*WORDS, b"zz"]), max_size=3), max_size=4))
def test_transducers_are_dictionaries(one, two, bounds):
    a, in_a = paths_of(one)
    b, in_b = paths_of(two)
    both = in_a + in_b
    assert dump(fsa.unpacked(fsa.packed(a))) == in_a
    joined = fsa.union([a, b])
    assert dump(fsa.unpacked(fsa.packed(joined))) == both
    assert {k: v for k, v in dump(fsa.pruned(joined, 3)).items() if v > 2} == {k: v for k, v in both.items() if v > 2}
    assert dump(fsa.composed(a, b)) == {k: in_b[k] for k in in_a}
    edges = sorted((b"en", *words) for words in bounds)
    found = Counter()
    for k, part in fsa.cut(joined, edges):
        own = {p: n for p, n in dump(part).items() if n}
        assert all(bisect.bisect_right(edges, p) == k for p in own)
        found.update(own)
    assert found == both


def test_equal_ends_are_shared():
    starts = [f"w{i}".encode() for i in range(1000)]
    paths, counts = paths_of([(b"en", [w, b"same", b"end"]) for w in starts])
    apart, _ = paths_of([(b"en", [w, b"x" + w, b"end"]) for w in starts])
    assert dump(fsa.unpacked(fsa.packed(paths))) == counts
    assert len(fsa.packed(paths)) < len(fsa.packed(apart)) / 2


def brute(rows, least=10, per_language=2000):
    f = {}
    for _, text, lang in rows:
        c = f.setdefault("und" if lang is None else lang, Counter())
        lowered = "".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                c.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, c in f.items():
        n = sum(v for g, v in c.items() if len(g) == 1)
        some = {g: a for g, a in c.items() if len(g) > 1 and a >= least}
        gone = {g[i:i + 2] for g, a in some.items() if len(g) == 3 for i in (0, 1) if 100 * a >= 50 * c[g[i:i + 2]]}
        scored = []
        for g, a in some.items():
            if g not in gone:
                score, k = min((10 ** 6 * a * a // (c[g[:k]] * c[g[k:]]), k) for k in range(1, len(g)))
                scored.append((-score, -a, " ".join(g).encode(), c[g[:k]], c[g[k:]]))
        for rank, (s, a, g, left, right) in enumerate(sorted(scored)[:per_language], 1):
            out.append((lang, rank, g.decode(), -a, left, right, n, -s))
    return sorted(out)


ODD = [
    (1, "A b c. a B c, a b c\td; x\x0by " * 9, "en"), (1, "A b c. a B c, a b c\td; x\x0by " * 9, "en"),
    (2, "a b", None), (3, None, "en"), (4, "", None), (5, " \n\t..", "en"), (None, "a b c " * 7, None),
    (6, "x " * 30_000, "de"), (7, "y" * 100_000, "de"), (8, "É é\x00\x1c \x85 　é\x00\x1c " * 40, "fr"), (9, "a b c " * 12, "und"),
    (10, "p q " * 10 + ". p r" * 10, ""),
]


@pytest.mark.parametrize("ranges", [1 << 20, 16])
def test_odd_rows(spark, monkeypatch, ranges):
    monkeypatch.setattr(collocations, "PATHS_PER_RANGE", ranges)
    if ranges == 16:
        monkeypatch.setattr(collocations, "PATHS_PER_KEY", 2)
        monkeypatch.setattr(collocations, "WORDS_PER_BLOCK", 100)
        monkeypatch.setattr(collocations, "PATHS_PER_SHARD", 40)
    docs = spark.createDataFrame(ODD, SCHEMA).repartition(3).withColumns(
        {c: F.lit(1) for c in ("blob", "part", "kind", "keys", "rank", "score", "n", "a")})
    assert sorted(map(tuple, collocations.collocations(docs).collect())) == brute(ODD)
    few = collocations.collocations(docs, least_count=3, per_language=2)
    assert sorted(map(tuple, few.collect())) == brute(ODD, 3, 2)


def test_no_documents(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("parts", [1, 3, 64])
def test_languages_are_cut_in_parts_before_they_are_ranked(spark, monkeypatch, parts):
    monkeypatch.setattr(collocations, "RANKED_PARTS", parts, raising=False)
    docs = spark.createDataFrame(ODD, SCHEMA)
    plan = collocations.collocations(docs)._jdf.queryExecution().optimizedPlan().toString()
    windows = re.findall(r"Window \[.*\], \[([^\]]*)\], \[[^\]]*\]", plan)  # what they are partitioned by
    assert [re.sub(r"#\d+L?", "", w) for w in windows] == ["lang", "lang, share"]
    for few in (1, 2, 1500):
        assert sorted(map(tuple, collocations.collocations(docs, 3, 50, few).collect())) == brute(ODD, 3, few)


def test_scores_are_exact(spark):
    """Products beyond 64 bits: counts set by hand in a range's transducer."""
    paths, _ = paths_of([(b"en", [b"a", b"b"])] * 12)
    big = 3_000_000_019
    paths.levels[1][2][:] = (big, big + 4)
    paths.levels[2][2][:] = big - 7
    rows = iter([(collocations.COUNTS, 0, fsa.packed(paths)), (collocations.ANSWER, 0, fsa.packed(paths))])
    batch, = collocations.scores(10, 50)(0, rows)
    assert batch.column("score").to_pylist() == [10 ** 6 * (big - 7) ** 2 // (big * (big + 4))]
    assert np.array_equal(batch.column("l").to_pylist(), [big])


def small(monkeypatch, **more):
    for name, value in {"PATHS_PER_RANGE": 16, "PATHS_PER_KEY": 2, "WORDS_PER_BLOCK": 100, "PATHS_PER_SHARD": 40, **more}.items():
        monkeypatch.setattr(collocations, name, value, raising=False)


@pytest.mark.parametrize("at_once, runs, kept", [(1, 1, 1), (2, 3, 1), (2, 3, 12), (256, 128, 1), (256, 128, 1 << 18)])
def test_runs_of_ranges(spark, monkeypatch, at_once, runs, kept):
    """Shards cut by runs and then by ranges, and ranges that ask alone or with others, give the same phrases."""
    small(monkeypatch, RANGES_AT_ONCE=at_once, RUNS=runs, KEPT_PER_RANGE=kept)
    docs = spark.createDataFrame(ODD, SCHEMA).repartition(3)
    made = collocations.stored(collocations.shards(docs))
    bounds = collocations.bounds_of(made)
    assert len(bounds) >= 3
    assert sorted(map(tuple, collocations.collocations(docs).collect())) == brute(ODD)
    assert sorted(map(tuple, collocations.collocations(docs, 3, 50, 2).collect())) == brute(ODD, 3, 2)


def test_more_shards_and_ranges_make_no_square_of_cuts(spark, monkeypatch):
    """What goes to the ranges is joined in runs first, and few paths that are left ask together."""
    small(monkeypatch, PATHS_PER_RANGE=200, RANGES_AT_ONCE=8, RUNS=4)
    docs = spark.createDataFrame([(i, " ".join(f"w{i * k * 37 % 101} v{i % 7}" for k in range(60)), "en")
                                  for i in range(120)], SCHEMA).repartition(2)
    made = collocations.stored(collocations.shards(docs))
    monkeypatch.setattr(collocations, "PATHS_PER_SHARD", 4000)  # of what a run joins
    bounds = collocations.bounds_of(made)
    ranges, n_shards = len(bounds) + 1, made.count()
    assert ranges > 16 and n_shards > 16
    whole = made.select(F.lit(0).cast("long").alias("part"), "blob")
    cuts = collocations.by_run(whole, bounds, 4)
    assert cuts.count() < n_shards * ranges / 3
    counts = collocations.stored(collocations.counts_by_range(made, bounds, 1))
    total = Counter()
    for row in counts.collect():
        total.update({k: v for k, v in dump(fsa.unpacked(row["blob"])).items() if v})
    direct = fsa.union([fsa.unpacked(r["blob"]) for r in made.collect()])
    assert +total == +Counter(dump(direct))
    few, left = collocations.fewer(counts, bounds)
    assert few.count() == 1 and left == []
    assert +Counter(dump(fsa.unpacked(few.first()["blob"]))) == +total


@settings(max_examples=60, deadline=None)
@given(PIECES)
def test_plain_bytes_hold_all_paths(pieces):
    paths, counts = paths_of(pieces)
    assert dump(fsa.unpacked(fsa.plain(paths))) == dump(paths) == counts
    for _, part in fsa.cut(paths, fsa.every(paths, 3)):
        assert dump(fsa.unpacked(fsa.plain(part))) == dump(fsa.unpacked(fsa.packed(part)))
