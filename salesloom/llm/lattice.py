"""SentencePiece encoding and decoding over a relational lattice.

Distinct pre-tokens are exploded into substrings of bounded length, which an
equi-join with the piece table turns into edges; edges are grouped by pre-token
and ``aggregate`` folds the Viterbi recurrence over their ends.  The pre-tokens
encoded so are the commonest ones, up to ``DICTIONARY`` entries, which is the
proven bound of what tasks receive; the rest of the words, rare ones, is folded
by the same recurrence where it occurs, since joining it back would shuffle
every text (figures in the README).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.common import column, ship, stored, table
from salesloom.llm.pieces import MODEL, PRE_TOKEN, REMEMBERED_LENGTH, Pieces, load

DICTIONARY = 200_000
REMEMBERED = 100_000  # rare pre-tokens a task keeps; only for speed
ROWS = 500  # of a batch taken at a time, so that memory follows neither batches nor tables


def piece_table(spark: SparkSession, pieces: Pieces) -> DataFrame:
    return spark.createDataFrame(
        [(p, i, w) for p, (i, w) in pieces.table.items()], "piece string, id int, weight long")


def byte_ids(char: Column, pieces: Pieces) -> Column:
    """The byte tokens of a character, as an array."""
    code = F.hex(F.encode(char, "utf-8"))
    table_of_ids = F.array(*[F.lit(i) for i in pieces.byte_ids])
    return F.transform(F.sequence(F.lit(1), F.length(code), F.lit(2)), lambda k: F.get(
        table_of_ids, F.conv(F.substring(code, k, F.lit(2)), 16, 10).cast("int")))


def lattice(words: DataFrame, pieces: Pieces) -> DataFrame:
    """(word, edges): edges (end, start, id, weight) of every distinct ``words.word``, by end.

    A character that is no piece of its own gets an edge of byte tokens, id -1.
    """
    spark = words.sparkSession
    size = F.length("word")
    edges = words.select("word", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(1), size), lambda s: F.transform(
            F.sequence(F.lit(1), F.least(F.lit(pieces.longest), size - s + 1)), lambda n: F.struct(
                (s - 1).alias("start"), (s + n - 1).alias("end"),
                F.substring("word", s, n).alias("piece")))))).alias("e"))
    edges = edges.select("word", "e.start", "e.end", "e.piece")
    joined = edges.join(F.broadcast(piece_table(spark, pieces)), "piece", "left").where(
        F.col("id").isNotNull() | (F.col("end") == F.col("start") + 1))
    of_bytes = F.octet_length("piece").cast("long") * pieces.byte_weight
    return joined.groupBy("word").agg(F.sort_array(F.collect_list(F.struct(
        "end", "start", F.coalesce("id", F.lit(-1)).alias("id"),
        F.coalesce("weight", of_bytes).alias("weight")))).alias("edges"))


def viterbi(words: DataFrame, pieces: Pieces) -> DataFrame:
    """(word, ids): the best path of each distinct word; ties take the longer last piece."""
    zero = F.struct(F.lit(0).cast("long").alias("weight"), F.lit(0).alias("start"),
                    F.lit(-2).alias("id"))

    def forward(reached: Column, end: Column) -> Column:
        into = F.filter("edges", lambda e: e["end"] == end)
        return F.array_append(reached, F.array_min(F.transform(into, lambda e: F.struct(
            (F.get(reached, e["start"])["weight"] + e["weight"]).alias("weight"),
            e["start"].alias("start"), e["id"].alias("id")))))

    def back(state: Column, k: Column) -> Column:
        step = F.get("reached", state["at"])
        return F.when(state["at"] > 0, F.struct(
            step["start"].alias("at"), F.array_append(state["path"], F.struct(
                step["start"].alias("start"), step["id"].alias("id"))).alias("path"))
        ).otherwise(state)

    size = F.length("word")
    reached = lattice(words, pieces).withColumn("reached", F.aggregate(
        F.sequence(F.lit(1), size), F.array(zero), forward))
    empty = F.array().cast("array<struct<start:int,id:int>>")
    path = reached.withColumn("path", F.reverse(F.aggregate(
        F.sequence(F.lit(1), size), F.struct(size.alias("at"), empty.alias("path")), back,
        lambda s: s["path"])))
    return path.select("word", F.flatten(F.transform("path", lambda p: F.when(
        p["id"] >= 0, F.array(p["id"])
    ).otherwise(byte_ids(F.substring("word", p["start"] + 1, F.lit(1)), pieces)))).alias("ids"))


def best_path(word: str, pieces: Pieces) -> list[int]:
    """The same recurrence for one word, from each start over what can still become a piece."""
    find = pieces.prefixes.get
    size = len(word)
    weights: list[int | None] = [0] + [None] * size
    starts, ids = [0] * (size + 1), [-2] * (size + 1)
    for start in range(size):
        here = weights[start]
        for end in range(start + 1, size + 1):
            piece = find(word[start:end])
            if end == start + 1 and (piece is None or piece[0] < 0):
                weight, i = here + pieces.weight_of_bytes(word[start]), -1
            elif piece is None:
                break
            elif piece[0] < 0:
                continue
            else:
                weight, i = here + piece[1], piece[0]
            known = weights[end]
            if known is None or weight < known:  # on a tie the smaller start came first
                weights[end], starts[end], ids[end] = weight, start, i
            if piece is None:
                break
    out: list[int] = []
    end = size
    while end:
        start = starts[end]
        if ids[end] >= 0:
            out.append(ids[end])
        else:
            out += [pieces.byte_ids[b] for b in
                    reversed(word[start].encode("utf-8", "surrogatepass"))]
        end = start
    return out[::-1]


def common_words(docs: DataFrame, most: int) -> DataFrame:
    """The distinct pre-tokens with the highest counts: at most ``most`` of them, ties left out.

    Those beyond ``REMEMBERED_LENGTH`` characters are never among them, which bounds the
    lattice of a word and what tasks receive; they are encoded whole where they stand.
    """
    text = F.coalesce(column(docs, "text", "string"), F.lit(""))
    counts = stored(docs.select(F.explode(F.regexp_extract_all(
        text, F.lit(PRE_TOKEN), F.lit(0))).alias("word")).where(
        F.length("word") <= REMEMBERED_LENGTH).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).where("n > 1"))
    # from counts of counts: the least count at which the dictionary still fits
    levels = counts.groupBy(F.least("n", F.lit(1_000_000)).alias("n")).agg(
        F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).collect()
    total, least = 0, None
    for level in levels:
        total += level["words"]
        if total > most:
            break
        least = level["n"]
    return counts.where(F.lit(False) if least is None else F.col("n") >= least).select("word")


def encode(docs: DataFrame, model: str = MODEL, dictionary: int = DICTIONARY) -> DataFrame:
    """doc_id, text, ids of every row of ``docs``.

    NULL texts have NULL ids, empty ones an empty array.  Texts are taken as they
    are, words whole, so that decoding gives them back byte for byte.  Repeated rows are
    encoded each; other columns are ignored; an empty table gives no row.
    """
    pieces = load(model)
    spark = docs.sparkSession
    ship(spark)
    known = viterbi(common_words(docs, dictionary), pieces).toArrow()
    ready = {w: np.array(i, np.int32).tobytes()
             for w, i in zip(known.column(0).to_pylist(), known.column(1).to_pylist())}
    shared = spark.sparkContext.broadcast((pieces, ready))
    split = re.compile(PRE_TOKEN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, common = shared.value
        find, rare = common.get, WordIds(own)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                ends, parts, total, missing = [0], [], 0, []
                for text in batch.column(1).to_pylist():
                    missing.append(text is None)
                    if text:
                        ids = b"".join([find(w) or rare[w] for w in split.findall(text)])
                        parts.append(ids)
                        total += len(ids) // 4
                        rare.trim()
                    ends.append(total)
                lists = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(parts), np.int32)),
                    mask=pa.array(missing, pa.bool_()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), lists], ["doc_id", "text", "ids"])

    return docs.select(
        column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text")
    ).mapInArrow(run, "doc_id long, text string, ids array<int>")


class WordIds(dict):
    """Ids of rare pre-tokens as bytes, as they turn up; long ones are not kept."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces

    def __missing__(self, word: str) -> bytes:
        ids = np.array(best_path(word, self.pieces), np.int32).tobytes()
        if len(word) <= REMEMBERED_LENGTH:
            self[word] = ids
        return ids

    def trim(self) -> None:
        if len(self) > REMEMBERED:
            self.clear()


class Strings:
    """The bytes of every id, side by side, for decoding many ids at once."""

    def __init__(self, pieces: Pieces):
        size = 1 + max(max(pieces.byte_ids), *(i for i, _ in pieces.table.values()))
        strings = [b""] * size
        for piece, (i, _) in pieces.table.items():
            strings[i] = piece.encode()
        for value, i in enumerate(pieces.byte_ids):
            strings[i] = bytes([value])
        self.bytes = np.frombuffer(b"".join(strings), np.uint8)
        self.length = np.array([len(x) for x in strings], np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.length)[:-1]))

    def decode(self, ids: np.ndarray) -> str:
        n = self.length[ids]
        before = np.cumsum(n) - n
        at = np.repeat(self.first[ids] - before, n) + np.arange(int(n.sum()))
        return self.bytes[at].tobytes().decode("utf-8", "replace")


def _rows(batch: pa.RecordBatch, name: str) -> Iterator[np.ndarray | None]:
    """The ids of each row, a view of the batch."""
    lists = batch.column(batch.schema.get_field_index(name))
    values = lists.values.to_numpy(zero_copy_only=False)
    ends = lists.offsets.to_numpy()
    for k, valid in enumerate(lists.is_valid().to_pylist()):
        yield values[ends[k]:ends[k + 1]] if valid else None


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, decoded) of ``encoded(doc_id, ids)``: the text the ids stand for; NULL for NULL."""
    ship(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(Strings(load(model)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                texts = [None if x is None else shared.value.decode(x) for x in _rows(batch, "ids")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(texts, pa.string())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded string")


def digest(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 (of the ids as little-endian 32-bit numbers), round_trip.

    Decodes every row of ``encode``'s result and compares it with its text.
    """
    ship(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(Strings(load(model)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, sums, same = [], [], []
            for text, ids in zip(batch.column(1), _rows(batch, "ids")):
                sizes.append(0 if ids is None else len(ids))
                sums.append(zlib.crc32(b"" if ids is None else ids.astype("<i4").tobytes()))
                same.append((None if ids is None else shared.value.decode(ids)) == text.as_py())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()),
                 pa.array(same, pa.bool_())], ["doc_id", "n_pieces", "ids_crc32", "round_trip"])

    return encoded.select("doc_id", "text", "ids").mapInArrow(
        run, "doc_id long, n_pieces long, ids_crc32 long, round_trip boolean")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` encoded and decoded."""
    return digest(encode(table(spark, sf_dir, "documents")))
