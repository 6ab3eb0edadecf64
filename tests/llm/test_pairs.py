"""Near duplicates, sharding and decontamination."""

import random

import pytest

from salesloom.llm import decontaminate as D
from salesloom.llm import sharding as S
from salesloom.llm.common import table
from salesloom.llm.components import components
from salesloom.llm.minhash_dedup import near_duplicates
from salesloom.llm.sharding import assign_shards
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def dedup(spark, rows):
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in found}


def test_near_duplicates_of_the_table(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert dedup(spark, rows) == brute.near_duplicates(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_of_edited_copies(spark, seed):
    """Groups around a base by replacing, dropping, adding words and by cutting; chains too."""
    rng = random.Random(seed)
    texts = []
    for _ in range(4):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([14, 60, 150]))]
        texts.append(base)
        for _ in range(28):
            w = list(rng.choice(texts[-3:]) if rng.random() < 0.3 else base)
            for _ in range(rng.randrange(5)):
                at = rng.randrange(len(w))
                kind = rng.randrange(4)
                if kind == 0:
                    w[at] = rng.choice(["x", "y", f"w{rng.randrange(10**6)}"])
                elif kind == 1:
                    del w[at]
                elif kind == 2:
                    w.insert(at, rng.choice(["x", "y", "z"]))
                elif len(w) > 12:
                    w = w[:max(10, len(w) - rng.randrange(12))]
            texts.append(w)
    rng.shuffle(texts)
    rows = [(k, " ".join(w).upper() if k % 5 == 0 else "\n".join(w)) for k, w in enumerate(texts)]
    assert dedup(spark, rows) == brute.near_duplicates(rows)


def test_components_of_a_chain_and_a_hub(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)]
    found = dict(components(spark.createDataFrame(links, "a long, b long")).select(
        "node", "component").collect())
    assert found == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)}


def test_shards_are_level_and_keep_groups(spark):
    docs = table(spark, SF, "documents")
    found = assign_shards(docs).collect()
    check_shards(found, docs.count())
    texts = dict(docs.select("doc_id", "text").collect())
    together = {}
    for r in found:
        together.setdefault(texts[r.doc_id], set()).add(r.shard)
    groups = [x for x, n in brute.Counter(texts.values()).items() if n > 1]
    assert groups and sum(len(together[g]) == 1 for g in groups) >= 0.8 * len(groups)


def check_shards(found, total):
    assert len(found) == total
    sizes = [sum(r.shard == s for r in found) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(8):
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sizes[s]))


def test_a_group_of_a_third_is_split_over_level_shards(spark):
    rows = [(k, "same" if k % 3 == 0 else f"text {k}") for k in range(400)]
    found = assign_shards(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check_shards(found, 400)
    assert len({r.shard for r in found if r.doc_id % 3 == 0}) <= 4


def test_decontamination_finds_what_all_scores_find(spark):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    found = {(r.doc_id, r.item_id) for r in D.contaminated(docs, items).collect()}
    texts = {r.item_id: D.terms_of(r.text) for r in items.collect()}
    want = set()
    for r in docs.collect():
        line = b" " + b" ".join(D.terms_of(r.text)) + b" "
        for i, w in texts.items():
            if len(w) >= D.LEAST_WORDS and b" " + b" ".join(w) + b" " in line:
                want.add((r.doc_id, i))
    assert want and found == want


def test_wand_equals_scoring_everything():
    rng = random.Random(3)
    vocabulary = [f"t{k}".encode() for k in range(60)]
    items = {k: [rng.choice(vocabulary[:rng.choice([8, 60])]) for _ in range(rng.randrange(5, 25))]
             for k in range(90)}
    rows = []
    for i, shares in {i: brute.bm25_shares(items, {t}, D.K1, D.B) for i, t in
                      enumerate(vocabulary)}.items():
        rows += [(item, vocabulary[i], w) for item, w in shares.items() if w > 0]
    index = D.Index([(i, b" ".join(w).decode()) for i, w in items.items()], rows, 0.6)
    for _ in range(300):
        passage = set(rng.sample(vocabulary, rng.randrange(1, 45)))
        if rng.random() < 0.6:
            passage |= set(items[rng.randrange(90)])
        got = index.search([index.terms[t] for t in passage if t in index.terms])
        want = {i: s for i, s in brute.bm25_shares(items, passage, D.K1, D.B).items() if s >= 0.6}
        assert got.keys() == want.keys()
        assert all(abs(got[i] - want[i]) < 1e-9 for i in got)


def test_a_partly_held_item_is_not_reported(spark):
    item = "what is the tallest of all the hills in the northern land ? the grey hill by the lake"
    docs = [(1, f"one two three {item.upper()} four five"),
            (2, "what is the tallest of all the hills in the northern land ? nobody knows that yet"),
            (3, "grey lake hills northern tallest land what is the of all by in"), (4, None), (5, "")]
    found = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                           spark.createDataFrame([(7, item), (8, None), (9, "the")],
                                                 "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id) for r in found] == [(1, 7)]


def test_lightly_edited_items_are_found_and_clean_passages_are_not(spark):
    items = [tuple(r) for r in table(spark, "/root/testdata/sf0.01", "benchmark").select(
        "item_id", "text").collect()]
    rng = random.Random(11)
    pool = [w for r in table(spark, SF, "documents").select("text").limit(50).collect()
            for w in (r.text or "").split()]
    docs, want = [], set()
    for k, text in items:
        words = text.split()
        for edits in range(5):
            changed = list(words)
            for at in rng.sample(range(len(words)), edits):
                changed[at] = rng.choice(pool)
            around = [[rng.choice(pool) for _ in range(rng.randrange(1, 90))] for _ in range(2)]
            docs.append((len(docs), " ".join(around[0] + changed + around[1])))
            want.add((docs[-1][0], k))
        mixed = rng.sample(words, len(words))
        docs.append((-1, " ".join(mixed)))
    docs.append((-2, " ".join(pool)))
    found = {(r.doc_id, r.item_id) for r in D.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert len(want - found) <= 0.01 * len(want)
    assert not [x for x in found if x[0] == -1]


def test_an_edited_question_without_its_answer_is_not_reported(spark):
    question = "which of the two long rivers of the east runs past the old mill at the ford ?"
    item = f"{question} the slow brown one with five stone bridges"
    edited = question.replace("rivers", "streams").replace("mill", "barn")
    docs = [(1, f"a b c {edited} the slow green one with five stone bridges d e f"),
            (2, f"a b c {edited} nobody ever told them anything about it d e f")]
    found = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                           spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id) for r in found] == [(1, 7)]


def test_every_text_of_an_item_and_short_items_are_found(spark):
    one = "the first wording of a question that a benchmark might ask of us"
    two = "quite another set of words under that same number of the list"
    items = [(1, one), (1, two), (2, "Four words, no more"), (3, "ox"), (4, "..."), (5, None), (None, "Four words")]
    docs = [(1, f"so {one} it was"), (2, f"and {two} too"), (3, "he wrote four WORDS no more than that"),
            (4, "four words and no more"), (5, "the ox."), (6, "oxen four"), (7, f"{one} {two} four words no more ox")]
    found = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                           spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [
        (1, 1), (2, 1), (3, 2), (5, 3), (7, 1), (7, 2), (7, 3)]


def test_links_of_frequent_and_rare_texts_against_grouping(spark, monkeypatch):
    rows = [(i, "hot" if i % 3 else f"text {i // 30}") for i in range(3000)]
    first: dict[str, int] = {}
    count: dict[str, int] = {}
    for i, text in rows:
        first[text] = min(first.get(text, i), i)
        count[text] = count.get(text, 0) + 1
    want = {(i, first[text]) for i, text in rows if count[text] > 1}
    df = spark.createDataFrame(rows, "row long, digest string")
    for share in (1, 4, 1000):  # no hot text, one, all
        monkeypatch.setattr(S, "HOT_SHARE", share)
        found = S.equal_text_links(df).collect()
        assert len(found) == len(want) and {tuple(r) for r in found} == want
