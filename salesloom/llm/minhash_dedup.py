"""Near-duplicate documents by a MinHash signature-coordinate inverted join.

Every distinct shingle set posts its (coordinate, value) pairs.  Two sets whose
signatures agree in at least ``matches`` of ``size`` coordinates share a pair
among the ``size - matches + 1`` rarest of either (prefix rule), and a pair
posted by one set alone can be skipped, so most documents post nothing.

Linking all pairs of a posting list would square large groups.  Instead the
sets that meet in posting lists agree on a centre, are compared with it, and
hold what differs from it (``diff``).  With d(x) the size of that difference, a
link between x and y that the centre does not already give needs

    common differences >= (d(x) + d(y) - t * (|x| + |y|)) / 2,   t = (1-s)/(1+s)

(the symmetric difference of x and y is d(x) + d(y) - 2 * common, and J >= s
says that it is at most t * (|x| + |y|)).  If y is not linked with the centre c,
d(y) > t * (|y| + |c|), hence x shares more than (d(x) + t * (|c| - |x|)) / 2
differences with y, and one of them is among the rarest of x once that many are
set aside (prefix rule again).  Only these are joined with the differences of
unlinked sets; for most sets none is left.  Besides, differences of x that no
other set shares count in full against each link of x, so more of them than
(1-s)/s * |x| settle it.  Sets far from their centre, or with
other centres, meet over their posting lists in the plain way.
Nothing is dropped: every pair that agrees in ``matches`` coordinates is either
implied, excluded by the bound, or confirmed on full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom.llm.common import column, ship, stored, table
from salesloom.llm.components import components
from salesloom.llm.shingles import MinHash, WordHashes, mixed, shingle_set

SIZE = 64
# a pair of similarity 0.85 agrees in 54.4 +- 2.9 of 64 coordinates; 40 is five deviations below
MATCHES = 40
PERCENT = 85
FAR = 1.2  # differences beyond this multiple of a set's size are not held


def signatures(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, n_shingles, two hashes that name the set, and its signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, minhash = WordHashes(), MinHash(size)
        for batch in batches:
            n, one, two, rows, offsets = [], [], [], [], [0]
            for text in batch.column(1):
                s = shingle_set(text.as_py(), hashes)
                n.append(len(s))
                again = mixed(s)
                one.append(int(again.sum(dtype=np.uint64).view(np.int64)))
                two.append(int(mixed(again * again[::-1] + s).sum(dtype=np.uint64).view(np.int64)))
                if len(s):
                    rows.append(minhash.signature(s))
                offsets.append(len(rows) * size)
            values = np.concatenate(rows) if rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(one, pa.int64()),
                 pa.array(two, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))],
                ["doc_id", "n_shingles", "one", "two", "signature"],
            )

    return docs.select(
        column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text")
    ).mapInArrow(
        run, "doc_id long, n_shingles long, one long, two long, signature array<long>")


def postings(sets: DataFrame, size: int = SIZE, matches: int = MATCHES) -> DataFrame:
    """(token, node): the part of each signature's rarest pairs that others share."""
    tokens = sets.select("node", F.explode("signature").alias("token"))
    frequency = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("frequency")).where(
        "frequency > 1")
    shared = tokens.join(frequency, "token")
    own = Window.partitionBy("node")  # at most `size` rows
    rest = matches - 1  # the commonest pairs of a set, which need no posting
    return shared.withColumn(
        "place", F.row_number().over(own.orderBy("frequency", "token"))
    ).withColumn("held", F.count(F.lit(1)).over(own)).where(
        F.col("place") <= F.col("held") - rest
    ).select("token", "node")


def centres(posted: DataFrame, rounds: int = 2) -> DataFrame:
    """(node, centre): sets that meet in posting lists agree on one of them.

    First the least node of each list is proposed; then, by turns, nodes take
    the proposal most of their lists make and lists the one most of their nodes take.
    """
    proposals = posted.groupBy("token").agg(F.min("node").alias("centre"))

    def mode(df: DataFrame, key: str) -> DataFrame:
        votes = df.groupBy(key, "centre").agg(F.count(F.lit(1)).alias("votes"))
        return votes.groupBy(key).agg(
            F.max(F.struct("votes", (-F.col("centre")).alias("first"))).alias("best")
        ).select(key, (-F.col("best.first")).alias("centre"))

    chosen = mode(posted.join(proposals, "token"), "node")
    for _ in range(rounds):
        proposals = mode(stored(posted.join(chosen, "node")), "token")
        chosen = stored(mode(posted.join(proposals, "token"), "node"))
    return chosen


def set_table(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, n, members) with the full shingle set of each listed document, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(t.as_py(), hashes) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary())],
                ["node", "n", "members"],
            )

    named = docs.select(column(docs, "doc_id", "long").alias("doc_id"),
                        column(docs, "text", "string").alias("text"))
    return named.join(nodes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi").mapInArrow(
        run, "node long, n long, members binary"
    ).dropDuplicates(["node", "n", "members"])


def compared(pairs: DataFrame, sets: DataFrame, percent: int, hold: bool) -> DataFrame:
    """Confirm (a, b) on full sets: a, b, sizes, linked, and what differs if ``hold``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, nb, linked, d, diffs = [], [], [], [], [], [], []
            for k in range(batch.num_rows):
                x = np.frombuffer(batch.column(2)[k].as_py(), np.uint64)
                y = np.frombuffer(batch.column(3)[k].as_py(), np.uint64)
                differ = np.setxor1d(x, y, assume_unique=True)
                union = (len(x) + len(y) + len(differ)) // 2
                a.append(batch.column(0)[k].as_py())
                b.append(batch.column(1)[k].as_py())
                na.append(len(x))
                nb.append(len(y))
                d.append(len(differ))
                linked.append(100 * (union - len(differ)) >= percent * union)
                near = hold and len(differ) <= FAR * len(x)
                diffs.append(differ.view(np.int64) if near else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(na, pa.int64()),
                 pa.array(nb, pa.int64()), pa.array(d, pa.int64()), pa.array(linked, pa.bool_()),
                 pa.array(diffs, pa.list_(pa.int64()))],
                ["a", "b", "na", "nb", "d", "linked", "diff"],
            )

    left = sets.select(F.col("node").alias("a"), F.col("members").alias("members_a"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("members_b"))
    return pairs.join(left, "a").join(right, "b").select(
        "a", "b", "members_a", "members_b"
    ).mapInArrow(
        run, "a long, b long, na long, nb long, d long, linked boolean, diff array<long>")


def agreeing(pairs: DataFrame, sets: DataFrame, matches: int) -> DataFrame:
    """Pairs whose signatures agree in at least ``matches`` coordinates."""
    left = sets.select(F.col("node").alias("a"), F.col("signature").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("signature").alias("sb"))
    same = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda x: x))
    return pairs.join(left, "a").join(right, "b").where(same >= matches).select("a", "b")


def links(docs: DataFrame, sets: DataFrame, percent: int = PERCENT,
          size: int = SIZE, matches: int = MATCHES) -> DataFrame:
    """(a, b) links that connect all sets of similarity ``percent``, confirmed on full sets.

    Links that others imply may be missing; components are complete.
    """
    posted = stored(postings(sets, size, matches))
    chosen = centres(posted)
    full = stored(set_table(docs, posted.select("node").distinct()))
    star = chosen.where("node <> centre").select(
        F.col("node").alias("a"), F.col("centre").alias("b"))
    around = stored(compared(star, full, percent, hold=True))
    settled = stored(components(around.where("linked")))

    # sets that hold their difference from the centre; whole numbers keep the bounds exact
    less, more = 100 - percent, 100 + percent
    held = around.where(F.col("diff").isNotNull())
    elements = stored(held.select(
        F.col("a").alias("node"), F.col("b").alias("centre"), "na", "nb", "d", "linked",
        F.explode("diff").alias("element")))
    known = elements.groupBy("centre", "element").agg(F.count(F.lit(1)).alias("holders")).where(
        "holders > 1")
    own = Window.partitionBy("node")  # at most FAR of the size of one set
    needed = F.floor((more * F.col("d") + less * (F.col("nb") - F.col("na"))) / (2 * more)) + 1
    # differences that nobody shares keep a set from all others: too many settle it
    common = stored(elements.join(known, ["centre", "element"]).withColumn(
        "shared", F.count(F.lit(1)).over(own)
    ).where(less * F.col("na") >= percent * (F.col("d") - F.col("shared"))))
    one = common.withColumn("place", F.row_number().over(own.orderBy("holders", "element"))).where(
        F.col("place") <= F.col("shared") - needed + 1
    ).select(F.col("node").alias("a"), "centre", "element")
    two = common.where("not linked").select(F.col("node").alias("b"), "centre", "element")
    by_difference = one.join(two, ["centre", "element"]).where("a <> b").select("a", "b").distinct()

    # the rest meets over posting lists, where the centre says nothing about a pair
    place = posted.join(chosen, "node").join(
        held.select(F.col("a").alias("node"), F.lit(True).alias("near")), "node", "left"
    ).join(settled, "node", "left").join(sets.select("node", "n_shingles"), "node").select(
        "token", "node", "centre",
        (F.coalesce("near", F.lit(False)) | (F.col("node") == F.col("centre"))).alias("near"),
        F.coalesce("component", "node").alias("component"), "n_shingles")
    place = stored(place)
    # lists on which all is said need no second look
    open_lists = place.groupBy("token").agg(
        F.min("component").alias("c0"), F.max("component").alias("c1"),
        F.min("centre").alias("m0"), F.max("centre").alias("m1"), F.min("near").alias("all_near"),
    ).where("c0 < c1 and (m0 < m1 or not all_near)").select("token")
    rest = place.join(open_lists, "token", "left_semi")
    x = rest.select("token", *[F.col(c).alias(f"x_{c}") for c in rest.columns if c != "token"])
    y = rest.select("token", *[F.col(c).alias(f"y_{c}") for c in rest.columns if c != "token"])
    by_list = x.join(y, "token").where(
        (F.col("x_node") < F.col("y_node")) & (F.col("x_component") != F.col("y_component"))
        & ~(F.col("x_near") & F.col("y_near") & (F.col("x_centre") == F.col("y_centre")))
        & (100 * F.least("x_n_shingles", "y_n_shingles")
           >= percent * F.greatest("x_n_shingles", "y_n_shingles"))
    ).groupBy(F.col("x_node").alias("a"), F.col("y_node").alias("b")).agg(
        F.count(F.lit(1)).alias("collisions")).select("a", "b")

    labels = settled.select("node", "component")
    apart = by_difference.union(by_list).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(
        labels.toDF("a", "ca"), "a", "left").join(labels.toDF("b", "cb"), "b", "left").where(
        F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    more = compared(stored(agreeing(apart, sets, matches)), full, percent, hold=False)
    return stored(around.where("linked").select("a", "b").union(
        more.where("linked").select("a", "b")))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, size: int = SIZE,
                    matches: int = MATCHES) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    A row without words or with NULL text has no shingle and is a component of
    its own.  Rows that repeat a doc_id are one document: what is linked with
    either is linked with both, and all are kept or none.  Rows without doc_id
    take no part in links and are kept, with NULL component.  Ties go to the
    smallest doc_id.  Other columns are ignored; an empty table gives no row.
    """
    ship(docs.sparkSession)
    signed = stored(signatures(docs, size))
    # equal sets are one node, named by the smallest doc_id
    nodes = stored(signed.where("n_shingles > 0 and doc_id is not null").groupBy(
        "one", "two", "n_shingles").agg(
        F.min("doc_id").alias("node"), F.min_by("signature", "doc_id").alias("signature")))
    found = links(docs, nodes, percent, size, matches)
    # a doc_id on rows of different texts joins their sets
    repeated = signed.where("n_shingles > 0 and doc_id is not null").join(
        nodes.select("one", "two", "n_shingles", "node"), ["one", "two", "n_shingles"])
    named = stored(repeated.groupBy("doc_id").agg(
        F.min("node").alias("node"), F.max("node").alias("other")))
    all_links = found.union(named.where("node <> other").select("node", "other"))
    labels = components(all_links)
    placed = named.join(labels, "node", "left").select(
        "doc_id", F.coalesce("component", "node").alias("component_id"))
    return signed.select("doc_id", "n_shingles").join(placed, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True))
        .alias("kept"))


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
