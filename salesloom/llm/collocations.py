"""Collocations: phrases whose words come together far more often than apart.

Counts are weighted acyclic automata (``transducer``).  Each task extends the
transducer of its shard by the sorted phrases of some documents at a time.  The
shards are cut by ranges of prefixes, a shuffle brings the cuts of a range together,
and their union sums the weights.  Paths below the least count go; what is left of
a range asks the ranges of its phrases' parts: the parts, a transducer themselves, are
composed with the counts there, and the answers come back.  A range asks for a part
once, however many phrases hold it, so a frequent word is no hot key; and an asked part
that is a phrase of two words learns how often the longest phrase around it occurs.

Bounds of ranges are places in the phrases of all shards (every ``PATHS_PER_KEY``-th
path of each), so ranges are of like size whatever a single word weighs.  They go
to every task, one for about ``PATHS_PER_RANGE`` paths.

Shards and ranges both grow with the input.  Beyond ``RANGES_AT_ONCE`` ranges a shard is
cut by runs of ranges only; the cuts of a run are joined to pieces as large as a shard, and
those are cut by its ranges.  Ranges that have few paths left after the least count are
joined to their neighbours before they ask, so questions are as few as what is left allows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom.llm import transducer as fsa
from salesloom.llm.common import column, ship, stored, table

LEAST_COUNT = 10
CONTAINED_PERCENT = 50  # a phrase goes if a longer one has this share of its occurrences
PER_LANGUAGE = 2000
RANKED_PARTS = 64  # parts of a language, by hash of the phrase, that are cut to its first phrases side by side
NO_LANGUAGE = "und"
WORDS_PER_BLOCK = 1 << 19  # words that extend a shard's transducer at a time
PATHS_PER_SHARD = 1 << 20  # a larger transducer is given out, and its task begins another
PATHS_PER_KEY = 1 << 12
PATHS_PER_RANGE = 1 << 20
RANGES_AT_ONCE = 256
RUNS = 128  # of ranges, at least, where there are more
KEPT_PER_RANGE = 1 << 18  # paths of the least count that ask together

# What ends a piece becomes a full stop, a tab a space, A-Z lower case.
_STOP = b"."
_PLAIN = bytes(_STOP[0] if chr(c) in ".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c
               for c in range(256))

MAPPED = "part long, kind int, source long, blob binary"
COUNTS, ASKED, ANSWER, AROUND = range(4)


class Block:
    """The words of some texts, with a stop (number 0) after every piece."""

    def __init__(self) -> None:
        self.langs: dict[bytes, int] = {}
        self.ids: dict[bytes, int] = _Numbers({_STOP: 0})
        self.words: list[int] = []
        self.sizes: list[int] = []  # of the texts
        self.of: list[int] = []  # their languages

    def add(self, lang: str | None, text: str | None) -> None:
        name = (NO_LANGUAGE if lang is None else lang).encode()
        before = len(self.words)
        plain = (text or "").encode().translate(_PLAIN).replace(_STOP, b" . ")
        self.words.extend(map(self.ids.__getitem__, plain.split()))
        if len(self.words) > before:
            self.words.append(0)
            self.of.append(self.langs.setdefault(name, len(self.langs)))
            self.sizes.append(len(self.words) - before)

    def paths(self) -> fsa.Paths:
        held = np.array(self.words, np.int64)
        lang = np.repeat(np.array(self.of, np.int64), np.array(self.sizes, np.int64))
        stops = np.flatnonzero(held == 0)
        left = np.repeat(stops, np.diff(stops, prepend=-1)) - np.arange(len(held))
        words = held > 0
        return fsa.counted(list(self.langs), list(self.ids)[1:], lang[words], held[words] - 1, left[words])


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def shards(docs: DataFrame) -> DataFrame:
    """blob, n_paths, keys: the transducers of all shards, with some of their paths in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, whole = Block(), []

        def given() -> pa.RecordBatch:
            paths = fsa.union(whole)
            whole.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([fsa.packed(paths)], pa.binary()), pa.array([len(paths)], pa.int64()),
                 pa.array([[list(k) for k in fsa.every(paths, PATHS_PER_KEY)]], pa.list_(pa.list_(pa.binary())))],
                ["blob", "n_paths", "keys"])

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                block.add(lang.as_py(), text.as_py())
                if len(block.words) >= WORDS_PER_BLOCK:
                    whole[:] = [fsa.union([*whole, block.paths()])]
                    block = Block()
                    if len(whole[0]) >= PATHS_PER_SHARD:
                        yield given()
        if block.words:
            whole.append(block.paths())
        if whole:
            yield given()

    return docs.select(
        column(docs, "lang", "string").alias("lang"), column(docs, "text", "string").alias("text")
    ).mapInArrow(run, "blob binary, n_paths long, keys array<array<binary>>")


def bounds_of(made: DataFrame) -> list[tuple[bytes, ...]]:
    """Bounds of ranges, each of about ``PATHS_PER_RANGE`` paths of all shards."""
    total = made.agg(F.sum("n_paths")).first()[0] or 0
    ranges = math.ceil(total / PATHS_PER_RANGE)
    if ranges < 2:
        return []
    keys = made.select(F.explode("keys").alias("key")).repartitionByRange(ranges, "key")
    first = keys.groupBy(F.spark_partition_id().alias("part")).agg(F.min("key").alias("key"))
    return sorted(tuple(map(bytes, r["key"])) for r in first.collect())[1:]


Row = tuple[int, int, int, bytes]


def _rows(rows: Iterable[Row]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [(), (), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
         pa.array(cols[3], pa.binary())], ["part", "kind", "source", "blob"])


def each(df: DataFrame, make: Callable[[int, bytes], Iterable[Row]]) -> DataFrame:
    """Rows that ``make`` gives for the transducer of every row, without a shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield _rows(make(part, blob.as_py()))

    return df.mapInArrow(run, MAPPED)


def by_range(df: DataFrame, make: Callable[[int, Iterator[tuple[int, int, bytes]]], Iterator[pa.RecordBatch]],
             schema: str) -> DataFrame:
    """``make`` for each range, with an iterator over its (kind, source, blob) by kind."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((part, kind, source, blob.as_py()) for batch in batches for part, kind, source, blob in zip(
            *(batch.column(k).to_pylist() for k in range(3)), batch.column(3)))
        ahead = next(rows, None)
        while ahead is not None:
            now = ahead[0]

            def of_range() -> Iterator[tuple[int, int, bytes]]:
                nonlocal ahead
                while ahead is not None and ahead[0] == now:
                    yield ahead[1:]
                    ahead = next(rows, None)

            mine = of_range()
            yield from make(now, mine)
            for _ in mine:
                pass

    return df.repartition("part").sortWithinPartitions("part", "kind", "source").mapInArrow(run, schema)


def summed(cuts: Iterator[tuple[int, int, bytes]], most: bool = False) -> fsa.Paths:
    """Union of transducers as they come, some at a time."""
    held: list[fsa.Paths] = []
    for _, _, blob in cuts:
        held.append(fsa.unpacked(blob))
        if sum(map(len, held[1:])) > PATHS_PER_RANGE // 2:
            held = [fsa.union(held, most)]
    return fsa.union(held, most) if held else fsa.Paths([], [], [(np.empty(0, np.int64),) * 3] * fsa.DEPTH)


def by_run(made: DataFrame, bounds: list[tuple[bytes, ...]], step: int) -> DataFrame:
    """part, kind, source, blob: the shards cut by runs of ``step`` ranges, then what is joined of a run by its ranges."""
    def runs(_: int, blob: bytes) -> Iterable[Row]:
        return ((k, COUNTS, 0, fsa.plain(p)) for k, p in fsa.cut(fsa.unpacked(blob), bounds[step - 1::step]))

    def ranges(run: int, cuts: Iterator[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
        first = run * step
        own, held, size = bounds[first:first + step - 1], [], 0

        def given() -> pa.RecordBatch:
            joined = fsa.union(held)
            held.clear()
            return _rows([(first + k, COUNTS, 0, fsa.plain(p)) for k, p in fsa.cut(joined, own)])

        for _, _, blob in cuts:
            held.append(fsa.unpacked(blob))
            size += len(held[-1])
            if size >= PATHS_PER_SHARD:
                yield given()
                size = 0
        if held:
            yield given()

    return by_range(each(made, runs), ranges, MAPPED)


def counts_by_range(made: DataFrame, bounds: list[tuple[bytes, ...]], least: int) -> DataFrame:
    """part, kind, source, blob, n_paths: the paths of each range with at least ``least`` occurrences."""
    def slices(_: int, blob: bytes) -> Iterable[Row]:
        return ((k, COUNTS, 0, fsa.plain(p)) for k, p in fsa.cut(fsa.unpacked(blob), bounds))

    def join(part: int, cuts: Iterator[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
        paths = fsa.pruned(summed(cuts), least)
        yield _rows([(part, COUNTS, 0, fsa.packed(paths))]).append_column("n_paths", pa.array([len(paths)], pa.int64()))

    whole = made.select(F.lit(0).cast("long").alias("part"), "blob")
    ranges = len(bounds) + 1
    if ranges > RANGES_AT_ONCE:
        dealt = by_run(whole, bounds, math.ceil(ranges / max(RUNS, math.isqrt(ranges))))
    else:
        dealt = each(whole, slices)
    return by_range(dealt, join, f"{MAPPED}, n_paths long")


def fewer(counts: DataFrame, bounds: list[tuple[bytes, ...]]) -> tuple[DataFrame, list[tuple[bytes, ...]]]:
    """The counts of neighbouring ranges that have ``KEPT_PER_RANGE`` paths or less together as one; with the bounds left."""
    sizes = dict(counts.select("part", "n_paths").collect())
    kept, group, held = [], {}, 0
    for part in range(len(bounds) + 1):
        size = sizes.get(part, 0)
        if part and held + size > KEPT_PER_RANGE:
            kept.append(bounds[part - 1])
            held = 0
        held += size
        group[part] = len(kept)
    if len(kept) == len(bounds):
        return counts.select("part", "kind", "source", "blob"), bounds

    def moved(part: int, blob: bytes) -> Iterable[Row]:
        return [(group[part], COUNTS, part, fsa.plain(fsa.unpacked(blob)))]

    def join(part: int, cuts: Iterator[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
        yield _rows([(part, COUNTS, 0, fsa.packed(summed(cuts)))])

    return stored(by_range(each(counts.select("part", "blob"), moved), join, MAPPED)), kept


def phrases(paths: fsa.Paths, least: int) -> Iterator[tuple[tuple[np.ndarray, ...], np.ndarray]]:
    """The candidates of a range: labels, an array for each place, and counts; by number of words."""
    for level in range(2, fsa.DEPTH):
        own = paths.levels[level][2] >= least
        yield tuple(c[own] for c in fsa.columns(paths, level)), paths.levels[level][2][own]


def parts_of(row: tuple[np.ndarray, ...]) -> Iterator[tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]]:
    """First part and rest at each cut."""
    for k in range(2, len(row)):
        yield row[:k], (row[0], *row[k:])


def requests(bounds: list[tuple[bytes, ...]], least: int) -> Callable[[int, bytes], Iterable[Row]]:
    """What the candidates of a range ask the ranges of their parts, and of their language's total.

    An asked path weighs one more than the most frequent candidate of three words around it.
    """
    def make(part: int, blob: bytes) -> Iterable[Row]:
        paths = fsa.unpacked(blob)
        rows, weights = [], []
        for row, a in phrases(paths, least):
            rows.append(row[:1])
            weights.append(np.ones(len(a), np.int64))
            for sides in parts_of(row):
                for side in sides:
                    rows.append(side)
                    weights.append(a + 1 if len(side) > 2 else np.ones(len(a), np.int64))
        asked = fsa.terminal(paths, rows, weights)
        return ((k, ASKED, part, fsa.plain(p)) for k, p in fsa.cut(asked, bounds))

    return make


def answers(part: int, rows: Iterator[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    """The weights of what was asked, to those who asked; and the longest phrases around, to the range itself."""
    kind, _, blob = next(rows)
    counts = fsa.unpacked(blob) if kind == COUNTS else None
    if counts is None:
        raise ValueError(f"range {part} was asked for parts and has no counts")
    around: list[fsa.Paths] = []
    for _, source, blob in rows:
        asked = fsa.unpacked(blob)
        yield _rows([(source, ANSWER, part, fsa.plain(fsa.composed(asked, counts)))])
        around.append(asked)
        if sum(map(len, around[1:])) > PATHS_PER_RANGE // 2:
            around = [fsa.union(around, most=True)]
    if around:
        yield _rows([(part, AROUND, part, fsa.plain(fsa.pruned(fsa.union(around, most=True), 2)))])


SCORED = "lang binary, phrase binary, a long, l long, r long, n long, score long"


def scores(least: int, contained_percent: int) -> Callable[[int, Iterator[tuple[int, int, bytes]]], Iterator[pa.RecordBatch]]:
    def make(part: int, rows: Iterator[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
        paths, known, around = None, [], None
        for kind, _, blob in rows:
            if kind == COUNTS:
                paths = fsa.unpacked(blob)
            elif kind == ANSWER:
                known.append(fsa.unpacked(blob))
                if sum(map(len, known[1:])) > PATHS_PER_RANGE // 2:
                    known = [fsa.union(known)]
            else:
                around = fsa.unpacked(blob)
        if paths is None or not known:
            return
        counts = fsa.union(known)
        for row, a in phrases(paths, least):
            if around is not None:
                longer = fsa.weights(around, paths, row) - 1
                kept = 100 * longer < contained_percent * a
                row, a = tuple(c[kept] for c in row), a[kept]
            if not len(a):
                continue
            sides = [[fsa.weights(counts, paths, side).tolist() for side in cut] for cut in parts_of(row)]
            totals = fsa.weights(counts, paths, row[:1]).tolist()
            out = []
            for i, (labels, times) in enumerate(zip(zip(*(c.tolist() for c in row)), a.tolist())):
                # whole numbers of any size
                best = min((1_000_000 * times * times // (l[i] * r[i]), k, l[i], r[i])
                           for k, (l, r) in enumerate(sides))
                out.append((paths.langs[labels[0]], b" ".join(paths.words[w] for w in labels[1:]), times,
                            best[2], best[3], totals[i], best[0]))
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, [pa.binary(), pa.binary(), *[pa.int64()] * 5])],
                ["lang", "phrase", "a", "l", "r", "n", "score"])

    return make


def collocations(docs: DataFrame, least_count: int = LEAST_COUNT, contained_percent: int = CONTAINED_PERCENT,
                 per_language: int = PER_LANGUAGE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first phrases of two and three words of each language.

    A NULL language counts as ``und``; NULL and empty texts have no phrase, and repeated
    rows count each.  Equal scores go by the larger count, then by phrase in byte
    order.  Other columns are ignored; an empty table gives no row.
    """
    ship(docs.sparkSession)
    made = stored(shards(docs))
    bounds = bounds_of(made)
    counts, bounds = fewer(stored(counts_by_range(made, bounds, least_count)), bounds)
    asked = each(counts.select("part", "blob"), requests(bounds, least_count))
    answered = stored(by_range(counts.unionByName(asked), answers, MAPPED))
    scored = by_range(counts.unionByName(answered), scores(least_count, contained_percent), SCORED).select(
        F.col("lang").cast("string").alias("lang"), F.col("phrase").cast("string").alias("phrase"),
        "a", "l", "r", "n", "score")
    # Spark infers no group limit of 2000 rows: without the parts all phrases of a language meet in one task
    scored = scored.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(RANKED_PARTS)))
    for by in (["lang", "share"], ["lang"]):
        order = Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"), "phrase")
        scored = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(
            F.col("rank") <= per_language)
    return scored.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language over all of ``documents``."""
    return collocations(table(spark, sf_dir, "documents"))
