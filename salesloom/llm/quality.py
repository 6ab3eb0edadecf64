"""Quality rules for texts, with DataFrame functions only.

Base rules fail texts with under 50 words, or with more than half of their words
in three-word windows that occur twice or more.  The method compares two
histograms of a text, its character classes and its commonest words, with those
of its language by Jensen-Shannon distance.  The references are the mean
histograms of the language over all rows, so the table is read once for counts
and the rest works on a few numbers a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.common import WHITE, column, stored, table

LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
MOST_CLASS_DISTANCE = 0.32
MOST_WORD_DISTANCE = 0.37
GUARD_WORDS = 50  # shorter texts have too few common words for their histogram

CLASSES = ("upper", "digit", "mark", "symbol", "white", "rest")
# Fixed lists: frequent function words of the languages that have a word histogram.
COMMON_WORDS = {
    "en": "the of and to in is that for it was on as with be by at this are from or".split(),
    "de": "der die und das in den von zu mit ist des nicht ein eine im auf für als auch dem".split(),
    "fr": "de la le et les des en un une du que est pour dans qui par sur au pas plus".split(),
    "es": "de la que el en y los se del las un por con una su para es al lo no".split(),
}
SIGNS = "| # * - + = / < > & % $ • – — ·".split()  # counted together, as one more word
WORD_SLOTS = 20 + 1


def repeated_window_words(words: Column, windows: Column) -> Column:
    """Words inside three-word windows whose hash occurs twice or more in ``windows``."""
    ordered = F.sort_array(F.transform(
        windows, lambda h, i: F.struct(h.alias("hash"), i.alias("at"))))

    def starts(s: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(s) - 1)
        same = F.filter(places, lambda k: (
            F.when(k > 0, F.get(s, k - 1)["hash"] == F.get(s, k)["hash"]).otherwise(F.lit(False))
            | F.coalesce(F.get(s, k + 1)["hash"] == F.get(s, k)["hash"], F.lit(False))))
        return F.transform(same, lambda k: F.get(s, k)["at"])

    # a one-element array lets the sorted windows be named in the expression
    covered = F.flatten(F.transform(F.array(ordered), lambda s: F.flatten(F.transform(
        starts(s), lambda i: F.array(i, i + 1, i + 2)))))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows),
                  F.size(F.array_distinct(covered))).otherwise(F.lit(0)).cast("long")


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, the base counts and both histograms of every row's whole text.

    NULL texts count as empty; a table without ``lang``, or a NULL or other
    language, has no word histogram.
    """
    text = F.coalesce(column(docs, "text", "string"), F.lit(""))
    df = docs.select(
        column(docs, "doc_id", "long").alias("doc_id"), column(docs, "lang", "string").alias("lang"),
        text.alias("text"), F.btrim(text, F.lit(" \t\n\x0b\f\r")).alias("trimmed"))
    df = df.withColumn("words", F.when(
        F.col("trimmed") == "", F.array().cast("array<string>")
    ).otherwise(F.split("trimmed", WHITE + "+", -1)))
    df = df.withColumn("n", F.size("words"))
    df = df.withColumns({
        "windows": F.when(F.col("n") >= 3, F.transform(
            F.sequence(F.lit(0), F.col("n") - 3),
            lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)),
        )).otherwise(F.array().cast("array<bigint>")),
        "lines": F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "common": F.filter("words", lambda w: w.isin(
            *sorted({w for ws in COMMON_WORDS.values() for w in ws} | set(SIGNS)))),
    })
    listed = F.element_at(F.create_map(*[x for k, ws in COMMON_WORDS.items() for x in (
        F.lit(k), F.array(*[F.lit(w) for w in ws]))]), F.coalesce("lang", F.lit("")))
    total = F.length("text").cast("long")

    def outside(pattern: str) -> Column:
        return total - F.length(F.regexp_replace("text", pattern, ""))

    df = df.select(
        "doc_id", "lang", F.col("n").cast("long").alias("n_words"), "word_chars",
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_window_words(F.col("words"), F.col("windows")).alias("n_repeat_words"),
        total.alias("chars"), outside(r"\p{Lu}+").alias("upper"), outside("[0-9]+").alias("digit"),
        outside(r"[.,;:!?'\"()\[\]-]+").alias("mark"),
        F.coalesce(F.array_append(
            F.transform(listed, lambda w: F.size(F.filter("common", lambda x: x == w))),
            F.size(F.filter("common", lambda x: x.isin(*SIGNS)))),
            F.array().cast("array<int>")).alias("word_counts"),
    )
    white = F.col("chars") - F.col("word_chars")
    rest = F.col("word_chars") - F.col("upper") - F.col("digit") - F.col("mark") - F.col("n_symbols")
    return df.select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.array("upper", "digit", "mark", "n_symbols", white, F.greatest(rest, F.lit(0)))
        .alias("class_counts"),
        F.when(F.size("word_counts") > 0, F.array_append(
            F.col("word_counts").cast("array<bigint>"),
            F.col("n_words") - F.aggregate("word_counts", F.lit(0), lambda a, x: a + x))
        ).alias("word_counts"),
    )


def shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.when(total > 0, F.transform(counts, lambda x: x / total))


def references(counted: DataFrame) -> DataFrame:
    """The mean histograms of each language over all rows with enough words."""
    able = counted.where(F.col("n_words") >= LEAST_WORDS).select(
        F.coalesce("lang", F.lit("")).alias("language"), shares(F.col("class_counts")).alias("c"),
        shares(F.col("word_counts")).alias("w"))
    means = [F.avg(F.get("c", F.lit(i))).alias(f"c{i}") for i in range(len(CLASSES))] + [
        F.avg(F.get("w", F.lit(i))).alias(f"w{i}") for i in range(WORD_SLOTS + 1)]
    return able.groupBy("language").agg(*means).select(
        "language", F.array(*[f"c{i}" for i in range(len(CLASSES))]).alias("class_reference"),
        F.array(*[f"w{i}" for i in range(WORD_SLOTS + 1)]).alias("word_reference"))


def jensen_shannon(p: Column, q: Column) -> Column:
    """Distance in 0..1 between two histograms of equal length."""
    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda x, y: (part(x, (x + y) / 2) + part(y, (x + y) / 2)) / 2)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x), F.lit(0.0)))


def judge(docs: DataFrame, language_references: DataFrame | None = None) -> DataFrame:
    """The base counts, both distances and the verdict of every row of ``docs``.

    ``language_references`` has (language, class_reference, word_reference); by
    default they are learned from ``docs``.  NULL and empty texts fail the base
    rules.  Repeated rows are judged each; other columns are ignored; an empty
    table gives no row.
    """
    counted = stored(text_counts(docs))
    known = stored(references(counted)) if language_references is None else language_references
    base_failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return counted.join(
        known, F.coalesce(counted["lang"], F.lit("")) == known["language"], "left"
    ).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"),
        jensen_shannon(shares(F.col("class_counts")), F.col("class_reference"))
        .alias("class_distance"),
        F.when(F.col("n_words") >= GUARD_WORDS, jensen_shannon(
            shares(F.col("word_counts")), F.col("word_reference"))).alias("word_distance"),
    ).withColumn("kept", ~F.col("base_failed") & ~(
        (F.coalesce("class_distance", F.lit(0.0)) > MOST_CLASS_DISTANCE)
        | (F.coalesce("word_distance", F.lit(0.0)) > MOST_WORD_DISTANCE)))


OUTPUT: Sequence[str] = (
    "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
    "kept", "class_distance", "word_distance")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict on every whole text of ``documents``."""
    return judge(table(spark, sf_dir, "documents")).select(
        *OUTPUT[:-2], *[F.round(c, 6).alias(c) for c in OUTPUT[-2:]])
