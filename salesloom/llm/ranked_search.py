"""Ranked lexical search with hashed max-sketches.

``build_index`` keeps for every document its length, its terms with their counts, and
a sketch: terms are hashed to coordinates, and each coordinate holds the largest count
of a term in it.  A term's share of a score grows with its count, so the sketch at the
document's length bounds what any term adds, and a batch of queries gets its upper
bounds by one product of matrices.  ``search`` finds the exact scores of the documents
with the highest bounds first, takes from them the score that the last place needs,
and then rescores, by descending bound, the documents whose bound still reaches it.
Nothing else can be among the first, so the result is exact whatever collides.

The index holds nothing of the queries; they go to the tasks in blocks.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom.llm.common import column, ship, stored, table
from salesloom.llm.decontaminate import terms_of

PER_ITEM = 20
COORDINATES = 2048  # of a sketch
MOST_COUNT = 255  # stands for any larger count
ITEMS_PER_BLOCK = 500
ROWS_PER_STEP = 256
SLACK = 1.001  # bounds are added up in single precision

INDEX = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary()),
                   ("terms", pa.binary()), ("counts", pa.list_(pa.int32()))])


def coordinates(terms: Sequence[bytes], width: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, terms), np.int64, len(terms)) % width


def build_index(docs: DataFrame, width: int = COORDINATES) -> DataFrame:
    """doc_id, n, sketch of ``width`` coordinates, terms, counts of every row with a term; no shuffle.

    Terms are lower-cased (A-Z) runs of letters, digits and characters beyond ASCII.
    NULL and empty texts have none and are left out: nothing finds them.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lengths, sketches, terms, counts = [], [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = terms_of(text.as_py())
                if not words:
                    continue
                held = Counter(words)
                sketch = np.zeros(width, np.uint8)
                times = np.fromiter(held.values(), np.int64, len(held))
                np.maximum.at(sketch, coordinates(list(held), width), np.minimum(times, MOST_COUNT).astype(np.uint8))
                ids.append(doc_id)
                lengths.append(len(words))
                sketches.append(sketch.tobytes())
                terms.append(b"\n".join(held))
                counts.append(times)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip((ids, lengths, sketches, terms, counts), INDEX)], schema=INDEX)

    return docs.select(
        column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text")
    ).mapInArrow(run, "doc_id long, n long, sketch binary, terms binary, counts array<int>")


class Queries:
    """A block of items: their terms, weights and places in the sketch."""

    def __init__(self, texts: Sequence[str], rows: int, words: int, width: int):
        self.rows, self.words, self.width = rows, words, width
        self.terms: dict[bytes, int] = {}
        self.items: list[tuple[np.ndarray, np.ndarray]] = []
        for text in texts:
            held = Counter(terms_of(text))
            ids = np.array([self.terms.setdefault(t, len(self.terms)) for t in held], np.int64)
            self.items.append((ids, np.array(list(held.values()), np.int64)))

    def weigh(self, df: dict[int, int]) -> Queries:
        """Set the weights, given in how many documents each term is."""
        weight = np.array([math.floor(1000 * math.log((2 * self.rows + 2) / (2 * df.get(t, 0) + 1)))
                           for t in range(len(self.terms))], np.int64)
        at = coordinates(list(self.terms), self.width)
        self.items = [(ids, times * weight[ids]) for ids, times in self.items]
        self.bound = np.zeros((self.width, len(self.items)), np.float32)
        for q, (ids, weights) in enumerate(self.items):
            np.add.at(self.bound[:, q], at[ids], weights.astype(np.float32))
        return self

    def length(self, n: np.ndarray | int) -> np.ndarray | int:
        """m of documents of n terms."""
        return 75 + (25 * n * self.rows) // self.words

    def bounds(self, sketches: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores, a row for each document and a column for each item."""
        count = sketches.astype(np.float32)
        share = 1e9 * count / (1000 * count + np.float32(12) * self.length(n).astype(np.float32)[:, None])
        share[sketches == MOST_COUNT] = 1e6
        return share @ self.bound * np.float32(SLACK)

    def shares(self, terms: bytes, counts: Sequence[int], n: int) -> np.ndarray:
        """What each term of the block has in a document, before its weight."""
        out = np.zeros(len(self.terms), np.int64)
        m, find = int(self.length(int(n))), self.terms.get
        for k, term in enumerate(terms.split(b"\n")):
            t = find(term)
            if t is not None:
                tf = int(counts[k])
                out[t] = 1_000_000_000 * tf // (1000 * tf + 12 * m)
        return out

    def score(self, q: int, shares: np.ndarray) -> int:
        ids, weights = self.items[q]
        return int((weights * shares[ids]).sum())


class _Best:
    """The first ``k`` of each item, as (score, doc_id with its sign changed; NULL below all)."""

    def __init__(self, items: int, k: int, needed: Sequence[int]):
        self.k, self.needed = k, list(needed)
        self.heaps: list[list[tuple]] = [[] for _ in range(items)]

    def add(self, q: int, score: int, doc_id: int | None) -> None:
        if score < self.needed[q]:
            return
        heap, entry = self.heaps[q], (score, -math.inf if doc_id is None else -doc_id)
        if len(heap) < self.k:
            heapq.heappush(heap, entry)
        elif entry > heap[0]:
            heapq.heapreplace(heap, entry)
        if len(heap) == self.k:
            self.needed[q] = max(self.needed[q], heap[0][0])


def _steps(batches: Iterator[pa.RecordBatch], queries: Queries) -> Iterator[tuple]:
    """Some documents at a time: ids, lengths, a function for their shares, and bounds."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_PER_STEP):
            ids, n, sketch, terms, counts = batch.slice(start, ROWS_PER_STEP).columns
            lengths = n.to_numpy(zero_copy_only=False)
            stacked = np.frombuffer(b"".join(sketch.to_pylist()), np.uint8).reshape(-1, queries.width)

            def shares(row: int, terms=terms, counts=counts, lengths=lengths) -> np.ndarray:
                return queries.shares(terms[row].as_py(), counts[row].values.to_numpy(), lengths[row])

            yield ids.to_pylist(), shares, queries.bounds(stacked, lengths)


def first_scores(batches: Iterator[pa.RecordBatch], queries: Queries, k: int) -> Iterator[pa.RecordBatch]:
    """q, score: exact scores of the k documents of this task with the highest bounds of each item."""
    held = np.full((k, len(queries.items)), -1.0, np.float32)  # bounds
    scores = np.zeros((k, len(queries.items)), np.int64)
    for _, shares, bounds in _steps(batches, queries):
        known: dict[int, np.ndarray] = {}
        for q in np.flatnonzero(bounds.max(0) > held.min(0)):
            for row in np.argsort(-bounds[:, q], kind="stable")[:k]:
                place = int(held[:, q].argmin())
                if bounds[row, q] <= held[place, q]:
                    break
                if row not in known:
                    known[row] = shares(row)
                held[place, q], scores[place, q] = bounds[row, q], queries.score(q, known[row])
    place, q = np.nonzero(scores)
    yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(scores[place, q], pa.int64())], ["q", "score"])


def rescored(batches: Iterator[pa.RecordBatch], queries: Queries, k: int,
             needed: Sequence[int]) -> Iterator[pa.RecordBatch]:
    """q, doc_id, score: the first k of this task, by descending bound until none can reach them."""
    best = _Best(len(queries.items), k, needed)
    for ids, shares, bounds in _steps(batches, queries):
        known: dict[int, np.ndarray] = {}
        for q in np.flatnonzero(bounds.max(0) >= np.array(best.needed)):
            column_ = bounds[:, q]
            rows = np.flatnonzero(column_ >= best.needed[q])
            for row in rows[np.argsort(-column_[rows], kind="stable")].tolist():
                if column_[row] < best.needed[q]:
                    break
                if row not in known:
                    known[row] = shares(row)
                best.add(int(q), queries.score(q, known[row]), ids[row])
    rows = [(q, None if turned == -math.inf else -turned, score)
            for q, heap in enumerate(best.heaps) for score, turned in heap]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
        list(zip(*rows)) or [(), (), ()], (pa.int32(), pa.int64(), pa.int64()))], ["q", "doc_id", "score"])


def search(index: DataFrame, items: DataFrame, per_item: int = PER_ITEM) -> DataFrame:
    """item_id, rank, doc_id, score: the ``per_item`` documents of each item that score highest.

    ``index`` is what ``build_index`` gives, best stored.  Equal scores go by doc_id, NULL
    last; rows that repeat a doc_id are ranked each.  An item_id with several texts is
    several items; equal rows are one.  NULL and empty items, and items without a common term
    with any document, give no row; neither do empty tables.
    """
    spark = index.sparkSession
    ship(spark)
    size = index.agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("words"),
                     F.max(F.octet_length("sketch")).alias("width")).first()
    asked = stored(items.select(column(items, "item_id", "long").alias("item_id"),
                                column(items, "text", "string").alias("text"))
                   .where("text is not null").distinct())
    blocks = math.ceil(asked.count() / ITEMS_PER_BLOCK)
    empty = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    if not size["rows"] or not blocks:
        return empty
    out = None
    for block in range(blocks):
        mine = [tuple(r) for r in asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
                .orderBy("item_id", "text").collect()]
        if not mine:
            continue
        found = _search_block(index, Queries([t for _, t in mine], *size), per_item)
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(mine)], "q int, item_id long")
        part = found.join(F.broadcast(names), "q").select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else empty


def _search_block(index: DataFrame, plain: Queries, k: int) -> DataFrame:
    context = index.sparkSession.sparkContext
    terms = context.broadcast(plain.terms)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, counts = terms.value.get, Counter()
        for batch in batches:
            for held in batch.column(0):
                counts.update(map(find, held.as_py().split(b"\n")))
        counts.pop(None, None)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())], ["term", "df"])

    df = index.select("terms").mapInArrow(spread, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    queries = context.broadcast(plain.weigh({r["term"]: r["df"] for r in df.collect()}))
    held = index.select("doc_id", "n", "sketch", "terms", "counts")

    # what the last place needs: any k exact scores bound it from below
    order = Window.partitionBy("q").orderBy(F.desc("score"))
    first = held.mapInArrow(lambda b: first_scores(b, queries.value, k), "q int, score long")
    last = {r["q"]: r["score"] for r in first.withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k).groupBy("q").agg(
                F.min("score").alias("score"), F.count(F.lit(1)).alias("held"))
            .where(F.col("held") == k).collect()}
    needed = [last.get(q, 1) for q in range(len(plain.items))]
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return held.mapInArrow(lambda b: rescored(b, queries.value, k, needed), "q int, doc_id long, score long").withColumn(
        "rank", F.row_number().over(order)).where(F.col("rank") <= k)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 first documents of all for every benchmark item."""
    return search(stored(build_index(table(spark, sf_dir, "documents"))), table(spark, sf_dir, "benchmark"))
