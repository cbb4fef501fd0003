"""Keyword tables against the chain of ``contains`` and against brute force."""

import random
import time

import pytest
from pyspark.sql import functions as F

from procurelytics import constants as K
from procurelytics.functions import text as tx
from procurelytics.operators import keywords

TABLE = "priority int, keyword string, label string"


def brute(text, table, otherwise=None):
    text = (text or "").lower()
    hits = [(p is None, p or 0, w.lower(), label) for p, w, label in table if w is not None and w.lower() in text]
    return min(hits)[2:] if hits else (None, otherwise)


def run(spark, texts, table, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    out = keywords.first_keyword(df, "t", spark.createDataFrame(table, TABLE), **options)
    assert out.columns[:2] == ["id", "t"]
    rows = sorted(out.collect())
    assert [r["t"] for r in rows] == list(texts)
    return [(r["keyword"], r["label"]) for r in rows]


def test_equals_brute_force(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abAé") for _ in range(n))
    table = [(rng.choice([None, 1, 2, 3]), word(rng.randint(1, 5)), str(i)) for i in range(60)]
    table = list({w.lower(): (p, w, label) for p, w, label in table}.values())
    texts = [None, "", *[word(rng.randint(0, 12)) for _ in range(300)], word(20_000)]
    assert run(spark, texts, table, otherwise="none") == [brute(t, table, "none") for t in texts]


def test_equals_the_chain_on_the_present_lists(spark):
    words = [w for ws, _ in K.EVENT_RULES for w in ws] + list(K.COUNTRY_NAMES) + ["urban", "neutral", "plain"]
    rng = random.Random(4)
    texts = [None, "", *[" ".join(rng.sample(words, rng.randint(1, 4))) for _ in range(300)]]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    df = df.withColumn("want", tx.label_by_keywords(F.col("t"), K.EVENT_RULES, K.DEFAULT_EVENT_TYPE))
    df = df.withColumn("name", tx.first_name_in(F.col("t"), K.COUNTRY_NAMES))
    out = keywords.first_keyword(df, "t", keywords.rule_table(spark, K.EVENT_RULES), otherwise=K.DEFAULT_EVENT_TYPE)
    names = keywords.rule_table(spark, [([name], name) for name in K.COUNTRY_NAMES])
    out = keywords.first_keyword(out, "t", names, into=("found", "same"))
    rows = out.collect()
    assert len(rows) == len(texts) and len({r["want"] for r in rows}) > 3
    assert all(r["label"] == r["want"] and r["found"] == r["name"] == r["same"] for r in rows)


def test_order_case_and_repeats(spark):
    table = [(2, "Ban", "late"), (1, "ban", "early"), (None, "urban", "last"), (1, "AXE", "tie"), (0, None, "null")]
    assert run(spark, ["URBAN", "an axe, a ban", "x"], table) == [("ban", "early"), ("axe", "tie"), (None, None)]


def test_whole_words(spark):
    table = [(1, "ban", "b"), (2, "a", "a")]
    texts = ["urban a", "a ban.", "ban", "ban_ banner", "urban ban"]
    want = [("a", "a"), ("ban", "b"), ("ban", "b"), (None, None), ("ban", "b")]
    assert run(spark, texts, table, word_boundary=True) == want


def test_empty_keyword_and_empty_tables(spark):
    assert run(spark, ["x", None, "k"], [(2, "", "any"), (1, "k", "k")]) == [("", "any"), ("", "any"), ("k", "k")]
    assert run(spark, ["x"], [], otherwise="o") == [(None, "o")]
    empty = spark.createDataFrame([], "t string")
    assert keywords.first_keyword(empty, "t", spark.createDataFrame([], TABLE)).count() == 0


def test_clashing_names_and_bounds(spark, monkeypatch):
    df = spark.createDataFrame([("a", "b")], "t string, label string")
    table = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], TABLE)
    with pytest.raises(ValueError):
        keywords.first_keyword(df, "t", table)
    assert keywords.first_keyword(df, "t", table, into=("k", "l")).first() == ("a", "b", "a", "x")
    monkeypatch.setattr(keywords, "MAX_KEYWORDS", 1)
    with pytest.raises(ValueError):
        keywords.first_keyword(df, "t", table, into=("k", "l"))


def test_many_keywords_take_about_the_time_of_few(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(8))
    texts = spark.createDataFrame([(" ".join(word() for _ in range(300)),) for _ in range(2000)], "t string").repartition(4)

    def seconds(n):
        table = spark.createDataFrame([(i, word(), "x") for i in range(n)], TABLE)
        out = keywords.first_keyword(texts, "t", table).where("keyword IS NOT NULL")
        out.count()
        start = time.time()
        out.count()
        return time.time() - start

    few, many = seconds(50), seconds(10_000)
    assert many < 5 * few + 1


def test_python_holds_few_texts_at_once(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)

    def rows_of_each(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_pydict({"id": [batch.num_rows]})

    spark.conf.set(key, "10000")
    try:
        df = spark.range(3000).selectExpr("id", "repeat('some words ', 20) AS t").coalesce(1)
        out = keywords.first_keyword(df, "t", spark.createDataFrame([(1, "words", "x")], TABLE))
        sizes = out.mapInArrow(rows_of_each, "id long")
        assert max(r["id"] for r in sizes.collect()) <= keywords.BATCH_ROWS and out.where("keyword = 'words'").count() == 3000
    finally:
        spark.conf.set(key, before)
