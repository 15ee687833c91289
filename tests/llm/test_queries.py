"""Registered queries and the pipeline on the smallest tables."""

import random
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from machpulse.llm import mixing, queries, quality
from pyspark.sql import functions as F
from tests.compare import compare, sql_tables
from tests.llm.cases import documents, messy, prose, words
from tests.llm.test_operators import plain_components

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return sql_tables(SF_DIR)


def test_all_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.all_queries())
    assert numbers == list(range(1, 14))
    assert set(queries.all_queries()) | {"pipeline"} <= set(entry.queries())
    assert set(queries.all_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.all_sql()))
def test_equals_sql(spark, con, name):
    equal, message, _, _ = compare(spark, con, SF_DIR, name)
    assert equal, message


def test_stages_hold_their_promises(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    before, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.stored(stage(spark, before, SF_DIR), f"test-{name}")
        assert sorted(after.columns) == sorted(columns)
        rows, old = after.collect(), before.collect()
        texts = {r.doc_id: r.text for r in old}
        if name == "quality_rules":
            kept = {r.doc_id for r in quality.judge(before, labels).filter("kept").collect()}
            assert {r.doc_id for r in rows} == kept
            bad = {r.doc_id for r in labels.filter("quality = 0").collect()}
            assert not bad & {r.doc_id for r in rows}
        elif name == "near_duplicates":
            want, _ = plain_components([(r.doc_id, r.text, "") for r in old], 5)
            assert sorted(r.doc_id for r in rows) == sorted(i for i, c in want.items() if i == c)
        elif name == "substring_dedup":
            assert {r.doc_id for r in rows} == set(texts)
            assert all(r.n_chars == len(r.text) and len(r.text) <= len(texts[r.doc_id]) for r in rows)
        else:
            total = sum(len(words(t)) for t in texts.values())
            taken = sum(len(words(r.text)) for r in rows)
            assert all(r.text == texts[r.doc_id] for r in rows) and 0.98 * total <= taken <= total
        before = after
    coded = corpus_pipeline.STAGES[-1][1](spark, before, SF_DIR)
    joined = coded.groupBy("doc_id", "decoded_sha256").count().collect()
    want = before.groupBy("doc_id", F.sha2("text", 256).alias("decoded_sha256")).count().collect()
    assert sorted(map(tuple, joined)) == sorted(map(tuple, want))


@pytest.mark.parametrize("clash", [False, True])
def test_stages_bear_messy_rows(spark, clash):
    rng = random.Random(9)
    rows = messy() + [(400 + i, rng.choice(messy())[1], None) for i in range(10)]
    docs = documents(spark, rows, clash=clash)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR), f"messy-{name}")
        docs.count()
    empty = documents(spark, rows, clash=False).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0


def test_near_duplicates_keep_unlike_texts_of_one_id(spark):
    rng = random.Random(4)
    first, second, third = (prose(rng, 80) for _ in range(3))
    rows = [(1, first, "s"), (1, second, "s"), (2, first + " more", "s")]
    rows += [(None, third, "s"), (None, third, "s"), (None, third, "t"), (5, third, "s"), (None, second + " and", "s")]
    rows += [(7, "", "s"), (7, None, "s"), (8, first, "u")] + [(9, prose(rng, 40), "v")] * 3
    kept = corpus_pipeline.near_duplicates(spark, documents(spark, rows), SF_DIR).collect()
    found = sorted(((r.doc_id, r.text, r.source) for r in kept), key=str)
    assert found == sorted([(1, first, "s"), (1, second, "s"), (5, third, "s"), next(r for r in found if r[0] == 7), rows[-1]], key=str)
    again = corpus_pipeline.near_duplicates(spark, documents(spark, rows[::-1]), SF_DIR).collect()
    assert sorted(((r.doc_id, r.text, r.source) for r in again), key=str) == found


def test_mix_takes_rows_of_one_id_and_text_apart(spark):
    rng = random.Random(5)
    shared = prose(rng, 50)
    rows = [(i, prose(rng, rng.randint(20, 60)), f"s{i % 3}") for i in range(40)]
    rows += [(100, shared, f"s{k % 3}") for k in range(6)] + [(None, shared, "s0")] * 2 + [(101, None, "s1"), (101, "", "s1")]
    docs = documents(spark, rows)
    taken = Counter((r.doc_id, r.text, r.source) for r in corpus_pipeline.mix(spark, docs, SF_DIR).collect())
    plain = Counter()
    for r in mixing.mix(docs.withColumn("t", F.col("text")).withColumn("s", F.col("source")), carry=("t", "s")).collect():
        plain[r.doc_id, r.t, r.s] += r.copies
    assert taken == +plain
