"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns; the pipeline."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from salesloom.llm import decontaminate, html_text, lattice, minhash_dedup, pii, quality
from salesloom.llm import queries, secrets, sharding, token_counts, toxicity
from salesloom.llm.common import table

SF = "/root/testdata/sf0.001"
CLASHING = (
    "node token a b members signature found row shard slot score label half fold which values ids word "
    "words n lines piece path host component_id kept block item_id language digest centre near _bucket "
    "raw features probability prediction toxic quality decoded window").split()
ROWS = [
    (1, "Some words that make a text of several words here", "en", "s", 49),
    (1, "Some words that make a text of several words here", "en", "s", 49),
    (2, "some words that make a text of several words here", None, None, None),
    (2, "another text under the same number as the one before it", "xx", "s", 3),
    (None, "Some words that make a text of several words here", "en", "s", 1),
    (None, None, None, None, None),
    (3, None, "de", "s", 0), (4, "", "fr", "s", 0), (5, " \n\t ", "es", "s", 4),
    (6, "long " * 60_000, "en", "s", 300_000), (7, "x" * 200_000, "en", "s", 200_000),
    (8, "é中𝄞\x00▁", "en", "s", 5),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumns({c: F.lit(1) for c in CLASHING})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark):
    return table(spark, SF, "labels")


def bench(spark):
    return spark.createDataFrame(
        [(1, "some words that make a text of several words", 1), (1, "other", 2), (None, "x", 3), (2, None, 4)],
        "item_id long, text string, doc_id long")


BY_ROW = {
    "op1": lambda s, d: minhash_dedup.near_duplicates(d),
    "op2": lambda s, d: pii.find_personal_data(d),
    "op3": lambda s, d: secrets.find_secrets(d),
    "op3_mask": lambda s, d: secrets.mask_secrets(d),
    "op4": lambda s, d: quality.judge(d),
    "op5": lambda s, d: token_counts.count_tokens(d),
    "op6": lambda s, d: sharding.assign_shards(d),
    "op9": lambda s, d: lattice.digest(lattice.encode(d)),
    "op10": lambda s, d: toxicity.score_toxicity(d, labels(s)),
}


@pytest.mark.parametrize("name", BY_ROW)
def test_one_row_for_each_row(spark, odd, empty, name):
    found = BY_ROW[name](spark, odd).collect()
    assert len(found) == len(ROWS)
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in ROWS)
    assert BY_ROW[name](spark, empty).count() == 0


def test_linked_rows(spark, odd):
    found = minhash_dedup.near_duplicates(odd).collect()
    assert {r.component_id for r in found if r.doc_id in (1, 2)} == {1}
    assert all(r.kept and r.component_id is None for r in found if r.doc_id is None)
    assert all(r.kept for r in found if r.doc_id not in (2,))


def test_contamination_of_odd_tables(spark, odd, empty):
    found = decontaminate.contaminated(odd, bench(spark)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (2, 1), (None, 1)}  # by either text
    items = bench(spark).where("text <> 'other'")
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(odd, items).collect()} == {
        (1, 1), (2, 1), (None, 1)}
    assert decontaminate.contaminated(empty, items).count() == 0
    assert decontaminate.contaminated(odd, items.limit(0)).count() == 0


def test_pages_of_odd_tables(spark):
    rows = [(1, None, "<p>a</p>"), (1, None, "<p>a</p>"), (None, "x", None), (2, "http://h/", ""),
            (3, "http://h/", "<body>" + "<p>long</p>" * 20_000), (4, "//h", "<" * 50_000),
            (5, "//h", "<div " + "a='" * 20_000), (6, "//h", "<div>" * 3_000 + "deep")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {c: F.lit(1) for c in ("path", "host", "score", "text", "best")})
    found = html_text.extract(pages).collect()
    assert len(found) == len(rows)
    assert {r.page_id: len(r.text) for r in found if r.page_id == 3} == {3: 20_000 * 5 - 1}
    assert html_text.extract(pages.limit(0)).count() == 0


def test_no_labels_give_no_score_and_one_class_a_constant(spark, odd):
    known = labels(spark)
    assert {r.score for r in toxicity.score_toxicity(odd, known.limit(0)).collect()} == {0.0}
    clean = spark.createDataFrame([(1, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score_toxicity(odd, clean).collect()} == {0.0}


def test_pipeline_stages(spark, tmp_path):
    docs = table(spark, SF, "documents")
    before = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{tmp_path}/{k}"
        stage(spark, before, SF).write.parquet(path)
        after = spark.read.parquet(path)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.dtypes == docs.dtypes
        gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()}
        if name == "toxicity":
            want = {r.doc_id for r in toxicity.score_toxicity(before, labels(spark)).collect()
                    if r.predicted}
        elif name == "near_duplicates":
            want = {r.doc_id for r in minhash_dedup.near_duplicates(
                before, percent=80, matches=34).collect() if not r.kept}
            assert want
        elif name == "decontamination":
            want = {r.doc_id for r in decontaminate.contaminated(
                before, table(spark, SF, "benchmark")).collect()}
        else:
            want = set()
        assert gone == want
        before = after
    assert {r.doc_id: r.n_pieces for r in corpus_pipeline.run(spark, SF).collect()} == {
        r.doc_id: r.n_pieces for r in before.collect()}


def test_pipeline_of_odd_tables(spark, odd, empty):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        docs.count()


def test_rows_without_a_number_are_judged(spark):
    words = [f"word{k}" for k in range(104)]
    near = words[:20] + ["x"] + words[21:]
    item = table(spark, SF, "benchmark").where("length(text) > 100").first().text
    docs = spark.createDataFrame(
        [(1, " ".join(words)), (2, " ".join(near)), (None, " ".join(words)), (None, "only this one here"),
         (None, None), (3, "another text of its own"), (None, f"so it is said {item} and no more")],
        "doc_id long, text string")
    left = corpus_pipeline.near_duplicate(spark, docs, SF)
    assert left.dtypes == docs.dtypes
    assert sorted(str(r.doc_id) for r in left.collect()) == ["1", "3", "None", "None", "None"]
    left = corpus_pipeline.decontamination(spark, docs, SF).collect()
    assert len(left) == 6 and not any(item in (r.text or "") for r in left)
    top = docs.withColumn("doc_id", F.col("doc_id") + (2 ** 63 - 4))  # no room above the greatest
    assert corpus_pipeline.near_duplicate(spark, top, SF).count() == 5


def test_registered():
    numbers = [n.split("_")[0] for n in queries.QUERIES]
    assert numbers == [f"op{k}" for k in range(1, 11)] + ["pipeline"]
    assert [n for n, _ in corpus_pipeline.STAGES][1] == "near_duplicates"
