"""Training passages that hold benchmark items: BM25 with block-max WAND.

The items are indexed, every passage of every document is a query.  Weights are
BM25 contributions divided by what the item scores against itself, so a score is
the weighted share of an item that a passage holds and one threshold serves all.
Bounds come in three steps: contributions of essential terms (those without
which no item reaches the threshold) are added for all passages of a document at
once; passages that can reach it run block-max WAND; what it retrieves is
verified on the words that question and answer have in order with a stretch of the
passage, which a few changed words do not undo, or on runs of their words anywhere
in the text.

The index is built in Spark and broadcast in blocks of at most about
``POSTINGS_PER_BLOCK`` postings; a larger benchmark makes more blocks, each of
which meets all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.common import column, ship, stored, table

THRESHOLD = 0.6
QUESTION_SHARE = 0.7
ANSWER_SHARE = 0.5
ORDERED_SHARE = 0.7  # of all words of an item, if they are held in order
ORDERED_PART = 0.5  # of its answer, then, and of its question, if that lacks more than a word
RUN = 5  # words of a run that question and answer must share with the text
LEAST_WORDS = 5  # shorter items share too little to be scored: the text has to hold them word for word
POSTINGS_PER_BLOCK = 2_000_000
ITEMS_PER_STEP = 16  # items that share one upper bound in a posting list
K1, B = 1.2, 0.75
ESSENTIAL = 0.75  # share of an item's weight held by its essential terms

_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else 32 if c < 128 and not chr(c).isalnum() else c for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Lower-cased words (A-Z); all other ASCII but letters and digits separates them."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The answer is what follows the last question mark, line end or sentence end inside the text."""
    body = text.rstrip()
    for mark in ("?", "\n", ". "):
        at = body.rfind(mark, 0, len(body) - 1)
        if at >= 0 and terms_of(body[at + 1:]) and terms_of(body[:at]):
            return terms_of(body[:at + 1]), terms_of(body[at + 1:])
    return terms_of(body), []


def share_of_runs(words: Sequence[bytes], line: bytes) -> float:
    """Share of the runs of ``RUN`` words (or of all words, if fewer) that stand in ``line``."""
    if not words:
        return 1.0
    n = min(RUN, len(words))
    runs = {b" %s " % b" ".join(words[k:k + n]) for k in range(len(words) - n + 1)}
    return sum(r in line for r in runs) / len(runs)


def positions(words: Sequence[bytes]) -> dict[bytes, int]:
    """A bit for each place of every word."""
    out: dict[bytes, int] = {}
    for k, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << k
    return out


def shares_in_order(bits: dict[bytes, int], sizes: tuple[int, int],
                    words: Sequence[bytes]) -> tuple[float, float]:
    """Shares of question and answer in the longest common subsequence with the best stretch.

    Stretches have twice the item's words and start every half of them, so that one
    holds the item with up to half as many words put in.  What the answer adds to the
    subsequence of the question counts for the answer: it has to follow.
    """
    n = sum(sizes)
    every = (1 << n) - 1
    best = (-1, 0.0, 0.0)
    for start in range(0, max(1, len(words) - n), max(1, n // 2)):
        row = every  # a bit is 0 where one more word of the item is matched
        for w in words[start:start + 2 * n]:
            hit = row & bits.get(w, 0)
            if hit:
                row = ((row + hit) | (row - hit)) & every
        missed = (row & ((1 << sizes[0]) - 1)).bit_count()
        absent = row.bit_count() - missed
        best = max(best, (n - missed - absent, 1 - missed / sizes[0] if sizes[0] else 1.0,
                          1 - absent / sizes[1] if sizes[1] else 1.0))
    return best[1:]


class Index:
    """One block of items: impacts, essential terms and block maxima."""

    def __init__(self, items: Sequence[tuple[int, str]], weights: Sequence[tuple[int, bytes, float]],
                 threshold: float):
        self.threshold = threshold
        # a short item stands in a text as a whole or not at all: by its first word
        self.short: dict[bytes, list[tuple[list[bytes], int]]] = {}
        for number, text in items:
            if 0 < len(terms := terms_of(text)) < LEAST_WORDS:
                self.short.setdefault(terms[0], []).append((terms, number))
        items = [(i, t) for i, t in items if len(terms_of(t)) >= LEAST_WORDS]
        self.items = [i for i, _ in items]
        self.parts = [question_and_answer(t) for _, t in items]
        self.bits = [positions(question + answer) for question, answer in self.parts]
        self.reach = max((len(terms_of(t)) for _, t in items), default=1) or 1
        place = {i: k for k, i in enumerate(self.items)}
        self.terms: dict[bytes, int] = {}
        lists: list[list[tuple[int, float]]] = []
        for item, term, weight in weights:
            t = self.terms.setdefault(term, len(lists))
            if t == len(lists):
                lists.append([])
            lists[t].append((place[item], weight))
        self.lists = []
        for entries in lists:
            entries.sort()
            at = np.array([e[0] for e in entries], np.int64)
            impact = np.array([e[1] for e in entries])
            steps = range(0, len(at), ITEMS_PER_STEP)
            self.lists.append((
                at.tolist(), impact.tolist(), impact.max(),
                [int(at[min(s + ITEMS_PER_STEP, len(at)) - 1]) for s in steps],
                [float(impact[s:s + ITEMS_PER_STEP].max()) for s in steps]))
        # essential terms of each item: its weightiest, up to ESSENTIAL of its weight
        by_item: list[list[tuple[float, int]]] = [[] for _ in self.items]
        for t, entries in enumerate(lists):
            for i, w in entries:
                by_item[i].append((w, t))
        self.need = np.full(len(self.items), np.inf)
        flat: list[list[tuple[int, float]]] = [[] for _ in lists]
        for i, held in enumerate(by_item):
            total = 0.0
            for w, t in sorted(held, reverse=True):
                if total >= ESSENTIAL:
                    break
                flat[t].append((i, w))
                total += w
            self.need[i] = threshold - (1.0 - total) - 1e-9
        counts = np.array([len(e) for e in flat] + [0], np.int64)
        self.first = np.concatenate(([0], np.cumsum(counts)))[:-1]
        self.count = counts  # the last entry stands for terms outside the index
        self.item = np.array([i for e in flat for i, _ in e], np.int64)
        self.impact = np.array([w for e in flat for _, w in e])

    def passages(self, ids: np.ndarray) -> list[int]:
        """Starts of the passages (2 * reach words, every reach words) that may reach the threshold."""
        at = np.flatnonzero(self.count[ids])
        if not len(at):
            return []
        size = len(self.count)
        chunk = at // self.reach
        # a passage spans its chunk and the next; a term counts once in it
        key = np.unique(np.concatenate([chunk * size + ids[at], (chunk - 1) * size + ids[at]]))
        passage, term = np.divmod(key, size)
        n = self.count[term]
        spread = np.repeat(self.first[term] - np.concatenate(([0], np.cumsum(n)[:-1])), n)
        entry = spread + np.arange(len(spread))
        pair = np.repeat(passage + 1, n) * len(self.items) + self.item[entry]
        keys, inverse = np.unique(pair, return_inverse=True)
        sums = np.bincount(inverse, self.impact[entry])
        good = keys[sums >= self.need[keys % len(self.items)]]
        return [max(0, int(p - 1)) * self.reach for p in np.unique(good // len(self.items))]

    def search(self, terms: Sequence[int]) -> dict[int, float]:
        """Block-max WAND: all items that score at least the threshold, with their scores."""
        found: dict[int, float] = {}
        # cursor: [item, position in the list, list]
        cursors = [[self.lists[t][0][0], 0, self.lists[t]] for t in terms]
        while True:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                bound += c[2][2]
                if bound >= self.threshold - 1e-9:
                    pivot = k
                    break
            if pivot < 0:
                return found
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            ahead = cursors[:pivot + 1]
            tight, until = 0.0, None
            for c in ahead:
                step = c[1] // ITEMS_PER_STEP
                ends, best = c[2][3], c[2][4]
                while ends[step] < item:
                    step += 1
                    if step == len(ends):
                        break
                if step < len(ends):
                    tight += best[step]
                    until = ends[step] if until is None else min(until, ends[step])
            if tight >= self.threshold - 1e-9:
                if cursors[0][0] == item:
                    score = sum(c[2][1][c[1]] for c in ahead)
                    if score >= self.threshold - 1e-9:
                        found[item] = score
                    target = item + 1
                else:
                    target = item
            else:
                # no item up to the nearest end of a step, or to the next cursor, can do it
                target = item + 1 if until is None else until + 1
                if pivot + 1 < len(cursors):
                    target = min(target, cursors[pivot + 1][0])
                target = max(target, item + 1)
            for c in ahead:
                at, k = c[2][0], c[1]
                while k < len(at) and at[k] < target:
                    k += 1
                c[1] = k
                c[0] = at[k] if k < len(at) else None
            cursors = [c for c in cursors if c[0] is not None]
            if not cursors:
                return found

    def short_items(self, words: Sequence[bytes]) -> list[tuple[int, float, float, float]]:
        """The items of fewer than ``LEAST_WORDS`` words that stand in a text."""
        found = {number for k, w in enumerate(words) if w in self.short
                 for terms, number in self.short[w] if words[k:k + len(terms)] == terms}
        return [(number, 1.0, 1.0, 1.0) for number in sorted(found)]

    def held_items(self, text: str | None) -> list[tuple[int, float, float, float]]:
        """(item, score, share of question, share of answer) of every item a text holds."""
        words = terms_of(text)
        out = self.short_items(words) if self.short else []
        if not self.items:
            return out
        get = self.terms.get
        outside = len(self.count) - 1
        ids = np.fromiter((get(w, outside) for w in words), np.int64, len(words))
        best: dict[int, float] = {}
        ordered: dict[int, tuple[float, float, float]] = {}
        for start in self.passages(ids):
            end = start + 2 * self.reach
            window = np.unique(ids[start:end])
            for item, score in self.search([int(t) for t in window if t != outside]).items():
                best[item] = max(score, best.get(item, 0.0))
                if ordered.get(item, (0.0,))[0] < 1.0:
                    question, answer = (len(p) for p in self.parts[item])
                    shares = shares_in_order(self.bits[item], (question, answer), words[start:end])
                    whole = (question * shares[0] + answer * shares[1]) / (question + answer)
                    ordered[item] = max(ordered.get(item, (0.0, 0.0, 0.0)), (whole, *shares))
        if not best:
            return out
        line = b" %s " % b" ".join(words)
        for item, score in sorted(best.items()):
            question, answer = (share_of_runs(p, line) for p in self.parts[item])
            whole, *shares = ordered[item]
            if question < QUESTION_SHARE or answer < ANSWER_SHARE:
                lacks = (1 - shares[0]) * len(self.parts[item][0])
                if (whole < ORDERED_SHARE or shares[1] < ORDERED_PART
                        or shares[0] < ORDERED_PART and lacks > 1.5):
                    continue
                question, answer = shares
            out.append((self.items[item], min(score, 1.0), question, answer))
        return out


def item_weights(items: DataFrame) -> DataFrame:
    """(item_id, term, weight): BM25 weights over all items; those of an item sum to 1."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, terms = [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = terms_of(text)
                ids += [i] * len(found)
                terms += found
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(terms, pa.binary())], ["item_id", "term"])

    counted = stored(items.select("item_id", "text").mapInArrow(
        split, "item_id long, term binary").groupBy("item_id", "term").agg(
        F.count(F.lit(1)).alias("tf")))
    lengths = counted.groupBy("item_id").agg(F.sum("tf").alias("length"))
    spread = counted.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    size = lengths.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean")).first()
    idf = F.log(1 + (size["n"] - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = K1 * (1 - B + B * F.col("length") / (size["mean"] or 1.0))
    raw = counted.join(lengths, "item_id").join(spread, "term").select(
        "item_id", "term", "length", (idf * F.col("tf") * (K1 + 1) / (F.col("tf") + norm)).alias("w"))
    own = raw.groupBy("item_id").agg(F.sum("w").alias("own"))
    return raw.join(own, "item_id").where(F.col("length") >= LEAST_WORDS).select(
        "item_id", "term", (F.col("w") / F.col("own")).alias("weight"))


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, score, question_share, answer_share): documents that hold items.

    NULL and empty texts hold nothing, nor do NULL items and those without a word;
    items of fewer than ``LEAST_WORDS`` words count where a text holds all their words in a row.
    Rows of the benchmark without item_id are left out.  An item_id with several texts is
    found by any of them and reported once, with the best score, as are rows that
    repeat a doc_id.  Other columns are ignored; empty tables give no row.
    """
    spark = docs.sparkSession
    ship(spark)
    # texts are indexed under numbers of their own
    items = stored(stored(benchmark.select(
        column(benchmark, "item_id", "long").alias("of_item"),
        column(benchmark, "text", "string").alias("text"),
    ).where("of_item is not null and text is not null").distinct()).withColumn(
        "item_id", F.monotonically_increasing_id()))
    weights = stored(item_weights(items))
    blocks = max(1, math.ceil(weights.count() / POSTINGS_PER_BLOCK))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    texts = docs.select(column(docs, "doc_id", "long").alias("doc_id"),
                        column(docs, "text", "string").alias("text"))
    found = None
    for k in range(blocks):
        held = weights.where(block == k)
        index = Index(
            [tuple(r) for r in items.where(block == k).select("item_id", "text").orderBy("item_id").collect()],
            [(r[0], bytes(r[1]), r[2]) for r in held.orderBy("term", "item_id").collect()], threshold)
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, rows = [], []
                for i, text in zip(batch.column(0), batch.column(1)):
                    for row in shared.value.held_items(text.as_py()):
                        ids.append(i.as_py())
                        rows.append(row)
                cols = list(zip(*rows)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(cols[0], pa.int64()),
                     *[pa.array(c, pa.float64()) for c in cols[1:]]],
                    ["doc_id", "item_id", "score", "question_share", "answer_share"])

        part = texts.mapInArrow(run, "doc_id long, item_id long, score double, "
                                     "question_share double, answer_share double")
        found = part if found is None else found.unionByName(part)
    return found.join(items.select("item_id", "of_item"), "item_id").select(
        "doc_id", F.col("of_item").alias("item_id"), "score", "question_share", "answer_share"
    ).groupBy("doc_id", "item_id").agg(
        *[F.max(c).alias(c) for c in ("score", "question_share", "answer_share")])


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, one row per document and item."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
