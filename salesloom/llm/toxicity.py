"""Toxicity scores: gradient-boosted trees over dense features, isotonic calibration.

The features are densities of lexicon words and stems, second-person words near
them, capitals, punctuation and obfuscation.  The lexicons are learned from the
labels: words and four-letter stems whose documents are toxic far more often
than chance allows.  The lexicon of one half of the training rows describes the
other half, so that trees don't see a row that named its own words.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.common import column, held_out, ship, stored, table

TRAINING_ROWS = 15_000  # about as many labelled rows are learned from, by hash of doc_id
LEXICON = 3_000  # entries of a lexicon at most, the most telling ones
STEM = 4
NEARBY = 5  # words between a second-person word and a lexicon word
TREES, DEPTH = 20, 3
CUT = 0.3
FOLDS = 5  # the last fold calibrates

# Fixed list: second-person words of the languages.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen ihr euch sie tu te toi ton ta tes "
    "vous votre vos tú ti tus usted ustedes vosotros".split())
# Fixed list: words that insult by themselves; every lexicon starts from it.
INSULTS = {w: 3.0 for w in (
    "idiot idiots moron morons stupid loser losers pathetic scum scumbag worthless disgusting dumbass "
    "imbecile retard retarded bastard bitch asshole arschloch trottel dummkopf wichser connard salaud "
    "idiota imbécil estúpido cabrón").split()}
# Fixed table: characters written for letters.
LOOKALIKE = str.maketrans("013457@$!", "oieastasi")
WORD = re.compile(r"\w+")
SPACED = re.compile(r"(?<!\w)(?:\w[ .\-_*]){3,}\w(?!\w)")
FEATURES = (
    "word_density", "word_count", "word_weight", "stem_density", "stem_count", "stem_weight",
    "aimed_density", "second_person", "capital_words", "exclamations", "questions", "odd_words",
    "obfuscated", "length")

Lexicon = dict[str, float]  # a word, or a stem with "+" before it: log odds


def terms(text: str | None) -> set[str]:
    words = set(WORD.findall((text or "").lower()))
    return words | {"+" + w[:STEM] for w in words if len(w) > STEM}


class Featurizer:
    REMEMBERED = 150_000  # words a task keeps; only for speed
    AT_ONCE = 50_000  # words looked up at a time

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.known: dict[str, int] = {}
        self.rows = np.zeros((self.REMEMBERED + self.AT_ONCE, 4), np.float32)

    def _learn(self, word: str) -> None:
        n = self.known[word] = len(self.known)
        low = word.lower()
        stem = self.lexicon.get("+" + low[:STEM], 0.0) if len(low) > STEM else 0.0
        self.rows[n] = (self.lexicon.get(low, 0.0), stem, low in SECOND_PERSON,
                        len(word) > 1 and word.isupper())

    def _described(self, words: list[str]) -> np.ndarray:
        """Weight as a word, weight of its stem, second person, capitals: for each word."""
        out = []
        for start in range(0, len(words), self.AT_ONCE):
            part = words[start:start + self.AT_ONCE]
            if len(self.known) >= self.REMEMBERED:
                self.known.clear()
            for w in set(part).difference(self.known):
                self._learn(w)
            out.append(self.rows[np.fromiter(map(self.known.__getitem__, part), int, len(part))])
        return np.concatenate(out) if out else np.zeros((0, 4), np.float32)

    def _hidden(self, text: str) -> tuple[int, int]:
        """Words written with digits or signs for letters, or letter by letter; and how many
        of them are in the lexicon once they are written out.  Strings beyond 64 characters
        are no words."""
        odd = []
        if any(c in text for c in "@$*!0134578"):
            odd = [w for w in text.split() if len(w) <= 64 and any(c in "@$*!0134578" for c in w[:-1])
                   and any(c.isalpha() for c in w)]
        plain = [w.strip(".,;:!?*").lower().translate(LOOKALIKE).replace("*", "") for w in odd]
        plain += [re.sub(r"[\W_]", "", s).lower() for s in SPACED.findall(text)]
        return len(odd), sum(w in self.lexicon or (len(w) > STEM and "+" + w[:STEM] in self.lexicon)
                             for w in plain)

    def __call__(self, text: str | None) -> list[float]:
        text = text or ""
        words = WORD.findall(text)
        n, size = max(1, len(words)), max(1, len(text))
        word, stem, second, capital = self._described(words).T
        hit = (word > 0) | (stem > 0)
        aimed = 0
        if hit.any() and second.any():
            near = np.concatenate(([0], np.cumsum(second)))
            at = np.flatnonzero(hit)
            aimed = int((near[np.minimum(len(words), at + NEARBY + 1)]
                         > near[np.maximum(0, at - NEARBY)]).sum())
        n_word, n_stem = float((word > 0).sum()), float((stem > 0).sum())
        odd, hidden = self._hidden(text)
        return [
            n_word / n, math.log1p(n_word), float(word.max(initial=0.0)),
            n_stem / n, math.log1p(n_stem), float(stem.max(initial=0.0)),
            aimed / n, float(second.sum()) / n, float(capital.sum()) / n, text.count("!") / size,
            text.count("?") / size, odd / n, hidden / n, math.log1p(len(text))]


def features(rows: DataFrame, lexicons: Sequence[Lexicon]) -> DataFrame:
    """``rows(doc_id, text, which, label)`` with dense features by lexicon number ``which``."""
    shared = rows.sparkSession.sparkContext.broadcast(list(lexicons))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        makers = [Featurizer(x) for x in shared.value]
        for batch in batches:
            made = [makers[w](t.as_py()) for t, w in zip(batch.column(1), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(3), pa.array(made, pa.list_(pa.float64()))],
                ["doc_id", "label", "values"])

    return rows.select("doc_id", "text", F.col("which").cast("int"), F.col("label").cast("int")
                       ).mapInArrow(run, "doc_id long, label int, values array<double>")


def learn_lexicons(rows: DataFrame) -> list[Lexicon]:
    """The lexicons of half 0, half 1 and both halves of ``rows(text, half, label)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, halves, labels = [], [], []
            for text, half, label in zip(batch.column(0), batch.column(1).to_pylist(),
                                         batch.column(2).to_pylist()):
                own = sorted(terms(text.as_py()))
                found += own
                halves += [half] * len(own)
                labels += [label] * len(own)
                if len(found) > 200_000:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found, pa.string()), pa.array(halves, pa.int32()),
                         pa.array(labels, pa.int32())], ["term", "half", "label"])
                    found, halves, labels = [], [], []
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.string()), pa.array(halves, pa.int32()),
                 pa.array(labels, pa.int32())], ["term", "half", "label"])

    sizes = {(r["half"], r["label"]): r["count"]
             for r in rows.groupBy("half", "label").count().collect()}
    one = F.lit(1)
    counts = stored(rows.select("text", F.col("half").cast("int"), F.col("label").cast("int")).mapInArrow(
        run, "term string, half int, label int").groupBy("term").agg(*[
            F.count(F.when((F.col("half") == h) & (F.col("label") == k), one)).alias(f"n{h}{k}")
            for h in (0, 1) for k in (0, 1)]).where("n01 + n11 > 1"))
    vocabulary = max(2, counts.count())
    out = []
    for halves in ((0,), (1,), (0, 1)):
        toxic = sum(sizes.get((h, 1), 0) for h in halves)
        clean = sum(sizes.get((h, 0), 0) for h in halves)
        if not toxic or not clean:
            out.append(dict(INSULTS))
            continue
        t = sum((F.col(f"n{h}1") for h in halves[1:]), F.col(f"n{halves[0]}1"))
        c = sum((F.col(f"n{h}0") for h in halves[1:]), F.col(f"n{halves[0]}0"))
        share = toxic / (toxic + clean)

        def part(n: Column, of: float) -> Column:
            return F.when(n > 0, n * F.log(n / ((t + c) * of))).otherwise(F.lit(0.0))

        told = 2 * (part(t, share) + part(c, 1 - share))
        odds = F.log(((t + 0.5) / (toxic + 1)) / ((c + 0.5) / (clean + 1)))
        found = counts.select("term", F.round(odds, 6).alias("odds"), told.alias("told")).where(
            (F.col("odds") > 2) & (F.col("told") >= 2 * math.log(vocabulary))
        ).orderBy(F.desc("told"), "term").limit(LEXICON).collect()
        out.append(INSULTS | {r["term"]: r["odds"] for r in found})
    return out


def training_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(doc_id, text, label, half, fold) of about ``most`` labelled rows that aren't held out."""
    known = labels.select(column(labels, "doc_id", "long").alias("doc_id"),
                          column(labels, "toxic", "int").alias("toxic")).where(
        F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))
    ).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("label"))
    known = stored(known)
    share = min(1.0, most / max(1, known.count()))
    taken = stored(known.where(
        F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) < round(1_000_000 * share)))
    texts = docs.select(column(docs, "doc_id", "long").alias("doc_id"),
                        column(docs, "text", "string").alias("text"))
    return texts.join(taken, "doc_id").withColumns({
        "half": F.pmod(F.xxhash64("text"), F.lit(2)).cast("int"),
        "fold": F.pmod(F.xxhash64("text", F.lit("fold")), F.lit(FOLDS)).cast("int")})


class Model:
    """Lexicon, trees and calibration; ``base`` is the score where nothing could be learned."""

    def __init__(self, lexicon: Lexicon, trees, calibration, base: float):
        self.lexicon, self.trees, self.calibration, self.base = lexicon, trees, calibration, base

    def score(self, docs: DataFrame) -> DataFrame:
        """(doc_id, score) of every row."""
        ship(docs.sparkSession)
        rows = docs.select(
            column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text"),
            F.lit(0).alias("which"), F.lit(0).alias("label"))
        if self.trees is None:
            return rows.select("doc_id", F.lit(self.base).alias("score"))
        raw = raw_scores(self.trees, features(rows, [self.lexicon]))
        if self.calibration is not None:
            raw = self.calibration.setPredictionCol("calibrated").transform(raw)
        else:
            raw = raw.withColumn("calibrated", F.col("raw"))
        # the calibration is a step function; a little of the raw score orders what it ties
        blend = 0.98 * F.col("calibrated") + 0.02 * F.col("raw")
        return raw.select("doc_id", F.least(F.lit(1.0), F.greatest(F.lit(0.0), blend)).alias("score"))


def raw_scores(trees, rows: DataFrame) -> DataFrame:
    return trees.transform(rows.withColumn("features", array_to_vector("values"))).select(
        "doc_id", "label", F.get(vector_to_array("probability"), F.lit(1)).alias("raw"))


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS, trees: int = TREES,
        depth: int = DEPTH) -> Model:
    """Learn from labelled rows that aren't held out; with one class only, a constant."""
    ship(docs.sparkSession)
    rows = stored(training_rows(docs, labels, most))
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    base = sizes.get(1, 0) / max(1, sum(sizes.values()))
    if len(sizes) < 2:
        return Model({}, None, None, base)
    first, second, both = learn_lexicons(rows)
    described = stored(features(
        rows.withColumn("which", 1 - F.col("half")).where(F.col("fold") < FOLDS - 1), [first, second]
    ).withColumn("features", array_to_vector("values")).select("doc_id", "label", "values"))
    usable = described.withColumn("features", array_to_vector("values"))
    if usable.select("label").distinct().count() < 2:
        return Model({}, None, None, base)
    model = GBTClassifier(
        labelCol="label", featuresCol="features", maxIter=trees, maxDepth=depth, stepSize=0.2,
        seed=7, maxBins=64).fit(usable)
    kept = stored(raw_scores(model, features(
        rows.withColumn("which", 1 - F.col("half")).where(F.col("fold") == FOLDS - 1),
        [first, second])))
    calibration = None
    if kept.select("label").distinct().count() == 2:
        calibration = IsotonicRegression(
            labelCol="label", featuresCol="raw").fit(kept.withColumn("label", F.col("label").cast("double")))
    return Model(both, model, calibration, base)


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``.

    NULL and empty texts are scored as texts without words.  Rows without doc_id
    are scored and not held out.  Labels that are NULL teach nothing; of several
    for a document the toxic one counts.  Repeated rows are scored each; other
    columns are ignored; an empty table gives no row, empty labels score 0.
    """
    return fit(docs, labels).score(docs).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text of ``documents``."""
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
