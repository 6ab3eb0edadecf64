"""Documents dealt into shards by balanced label propagation.

Rows start in shards whose counts are at most one apart.  In each round linked
rows learn from a join over the links how many of their neighbours each shard
holds, and ask to move to the fullest one that has room; rows whose shard is full
stay.  Between each two shards only as many move as keep the linked rows of every
shard within its quota, an even share of all rows.  Who moves is settled by
counts of hash buckets, group by group, so no task ranks a shard as a whole.  At
the end the counts are brought back to at most one apart, unlinked rows first.
Links are given as (row, hub): the rows of a hub are neighbours of each other, so
a group of n copies takes n rows, not n * n.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom.llm.common import column, stored, table

SHARDS = 8
ROUNDS = 10  # at most; a round without a move ends it
ROWS_PER_BUCKET = 50_000
BUCKETS = 4096  # least number of buckets of the rows that ask to move from one shard to another
HUB_BUCKETS = 64  # buckets that hubs are dealt to; each is cut by row as the count of rows asks for
HOT_SHARE = 1000


def numbered(df: DataFrame, by: Sequence[str], buckets: int, order: str, name: str) -> DataFrame:
    """Number the rows of each ``by`` from 0 without a gap, bucket by bucket of ``order``'s hash."""
    placed = df.withColumn("_bucket", F.pmod(F.xxhash64(order), F.lit(buckets)))
    sizes = placed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*by, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0))
                           .alias("_before"))
    within = Window.partitionBy(*by, "_bucket").orderBy(order)
    return placed.join(offsets, [*by, "_bucket"]).withColumn(
        name, F.col("_before") + F.row_number().over(within) - 1).drop("_bucket", "_before")


def first_rows(wishes: DataFrame, quotas: dict[tuple[int, int], int]) -> DataFrame:
    """Exactly ``quotas[shard, wish]`` of the rows (row, shard, wish, bucket), least buckets first.

    Adds ``place``, the number of a row within its (shard, wish).
    """
    spark = wishes.sparkSession
    wanted = spark.createDataFrame(
        [(a, b, n) for (a, b), n in quotas.items()] or [(-1, -1, 0)],
        "shard int, wish int, quota long")
    sizes = wishes.groupBy("shard", "wish", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard", "wish").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    open_buckets = sizes.withColumn(
        "before", F.coalesce(F.sum("n").over(before), F.lit(0))
    ).join(F.broadcast(wanted), ["shard", "wish"]).where("before < quota")
    within = Window.partitionBy("shard", "wish", "bucket").orderBy("row")
    return wishes.join(
        open_buckets.select("shard", "wish", "bucket", "before", "quota"),
        ["shard", "wish", "bucket"]
    ).withColumn("place", F.col("before") + F.row_number().over(within) - 1).where(
        "place < quota").select("row", "shard", "wish", "place")


def accepted(sizes: dict[int, int], wanted: dict[tuple[int, int], int], cap: int
             ) -> dict[tuple[int, int], int]:
    """The moves of ``wanted`` that leave no shard above ``cap``; shards x shards numbers."""
    flow = dict(wanted)
    while True:
        over = {}
        for s in sizes:
            arrive = sum(n for (_, b), n in flow.items() if b == s)
            leave = sum(n for (a, _), n in flow.items() if a == s)
            if arrive and sizes[s] + arrive - leave > cap:
                over[s] = (max(0, cap - sizes[s] + leave), arrive)
        if not over:
            return {k: n for k, n in flow.items() if n}
        s, (room, arrive) = max(over.items(), key=lambda x: x[1][1] - x[1][0])
        left = room
        for key in sorted(k for k in flow if k[1] == s):
            flow[key] = min(left, flow[key])
            left -= flow[key]


def levelling(sizes: dict[int, int], shards: int) -> dict[int, list[tuple[int, int]]]:
    """For each shard with too many rows, (target, number) that make counts at most one apart."""
    total = sum(sizes.values())
    order = sorted(range(shards), key=lambda s: (-sizes.get(s, 0), s))
    goal = {s: total // shards + (k < total % shards) for k, s in enumerate(order)}
    room = [[s, goal[s] - sizes.get(s, 0)] for s in range(shards) if goal[s] > sizes.get(s, 0)]
    out: dict[int, list[tuple[int, int]]] = {}
    for s in range(shards):
        extra = sizes.get(s, 0) - goal[s]
        while extra > 0:
            n = min(extra, room[0][1])
            out.setdefault(s, []).append((room[0][0], n))
            room[0][1] -= n
            extra -= n
            if not room[0][1]:
                room.pop(0)
    return out


def propagate(rows: DataFrame, links: DataFrame, shards: int = SHARDS,
              rounds: int = ROUNDS) -> DataFrame:
    """(row, shard): ``rows(row)`` dealt evenly, rows of a hub of ``links(row, hub)`` kept together.

    ``row`` must be unique in ``rows``, and in ``links``.
    """
    total = rows.count()
    buckets = max(shards, math.ceil(total / ROWS_PER_BUCKET))
    placed = stored(numbered(rows.select("row"), [], buckets, "row", "number").select(
        "row", (F.col("number") % shards).cast("int").alias("shard")))
    linked = stored(links.join(placed, "row").select("row", "hub", "shard"))
    cap = math.ceil(total / shards)
    # a hub may hold most rows: its part of the buckets has to be enough for all of them
    parts = max(BUCKETS // HUB_BUCKETS, math.ceil(total / ROWS_PER_BUCKET))

    def sizes(df: DataFrame) -> dict[int, int]:
        return {s: 0 for s in range(shards)} | {
            r["shard"]: r["count"] for r in df.groupBy("shard").count().collect()}

    def moved(df: DataFrame, moves: DataFrame) -> DataFrame:
        return stored(df.join(moves.select("row", F.col("wish").alias("to")), "row", "left").withColumn(
            "shard", F.coalesce("to", "shard")).drop("to"))

    for _ in range(rounds):
        held = sizes(linked)
        free = [s for s, n in held.items() if n < cap]
        around = linked.where(F.col("shard").isin(free)).groupBy("hub", "shard").agg(
            F.count(F.lit(1)).alias("n"))
        best = around.groupBy("hub").agg(
            F.max(F.struct("n", (-F.col("shard")).alias("least"))).alias("best")
        ).select("hub", (-F.col("best.least")).alias("wish"))
        wishes = stored(linked.where(F.col("shard").isin(free)).join(best, "hub").where(
            F.col("shard") != F.col("wish")
        ).select("row", "shard", "wish", (
            F.pmod(F.xxhash64("hub"), F.lit(HUB_BUCKETS)) * parts
            + F.pmod(F.xxhash64("row"), F.lit(parts))).alias("bucket")))
        wanted = {(r["shard"], r["wish"]): r["count"]
                  for r in wishes.groupBy("shard", "wish").count().collect()}
        flow = accepted(held, wanted, cap)
        if not flow:
            break
        linked = moved(linked, first_rows(wishes, flow))
    placed = stored(placed.join(
        linked.select("row", F.col("shard").alias("to"), F.lit(1).alias("linked")), "row", "left"
    ).select("row", F.coalesce("to", "shard").alias("shard"),
             F.coalesce("linked", F.lit(0)).alias("linked")))

    plan = levelling(sizes(placed), shards)
    if plan:
        surplus = placed.where(F.col("shard").isin(*plan)).select(
            "row", "shard", F.lit(-1).alias("wish"),
            (F.col("linked") * HUB_BUCKETS * parts + F.pmod(F.xxhash64("row"), F.lit(HUB_BUCKETS * parts)))
            .alias("bucket"))
        leaving = first_rows(surplus, {(s, -1): sum(n for _, n in to) for s, to in plan.items()})
        target = F.lit(None).cast("int")
        for s, to in plan.items():
            start = 0
            for t, n in to:
                here = (F.col("shard") == s) & F.col("place").between(start, start + n - 1)
                target = F.when(here, F.lit(t)).otherwise(target)
                start += n
        placed = moved(placed, leaving.withColumn("wish", target))
    return placed.select("row", "shard")


def equal_text_links(rows: DataFrame) -> DataFrame:
    """(row, hub): every row of a text that occurs more than once, with the first of them.

    Texts with more than one in ``HOT_SHARE`` of the rows, of which there are fewer than that,
    go to the rows; only the rows of the others are shuffled.
    """
    first = stored(rows.groupBy("digest").agg(
        F.min("row").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    hot = F.col("n") > rows.count() / HOT_SHARE
    large = F.broadcast(first.where(hot).select("digest", "hub"))
    rest = rows.join(large, "digest", "left_anti").join(first.where(~hot).select("digest", "hub"), "digest")
    return rows.join(large, "digest").select("row", "hub").unionByName(rest.select("row", "hub"))


def assign_shards(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row of ``docs``.

    Counts of shards are at most one apart; rows of equal texts meet in a shard
    as far as that allows.  NULL texts count as empty.  Repeated rows, and rows
    without doc_id, are rows like others.  Slots number a shard from 0 without a
    gap.  Other columns are ignored; an empty table gives no row.
    """
    text = F.coalesce(column(docs, "text", "string"), F.lit(""))
    rows = stored(docs.select(
        column(docs, "doc_id", "long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.sha2(text, 256).alias("digest"),
    ).withColumn("row", F.monotonically_increasing_id()))
    links = stored(equal_text_links(rows))
    placed = propagate(rows, links, shards, rounds)
    buckets = max(1, math.ceil(rows.count() / shards / ROWS_PER_BUCKET))
    slots = numbered(placed, ["shard"], buckets, "row", "slot")
    return rows.join(slots, "row").select(
        "doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` in one of eight shards whose counts are at most one apart."""
    return assign_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
