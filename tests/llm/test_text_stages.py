"""Quality rules, language and the pipeline."""

import os
import random

import pytest

import corpus_pipeline
from procurelytics.llm import language, quality
from procurelytics.llm.queries import ORACLES, QUERIES
from procurelytics.session import shared_folder

import oracle

SCHEMA = "doc_id long, text string, lang string, kept string, n_chars long"
FOLDER = f"{oracle.TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    problem, *_ = oracle.compare(spark, con, FOLDER, name, QUERIES[name], ORACLES[name])
    assert problem is None


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def brute(text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 5)}
    return len(words), len(hit)


def test_repeats_on_odd_texts(spark):
    rng = random.Random(2)
    texts = [None, "", " \n\t", "one", "a b c d e a b c d e", "x " * 30, "a b c d e f a b c d e f a b c d e", "   "] + [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 60))) for _ in range(60)]
    got = {r["doc_id"]: (r["n_words"], r["n_repeat_words"]) for r in quality.quality_rows(spark.createDataFrame([(i, t, "", "own", 0) for i, t in enumerate(texts)], SCHEMA)).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_failing_lines_go_and_poor_documents_too(spark):
    good = "This is a plain sentence with quite enough words in it to stay. "
    rows = [(1, good + "\nHome | About | Contact\n" + "And a second line of prose ends here.\nAll rights reserved.", "en", "own", 9),
            (2, "Home | About | Contact\nBUY NOW CHEAP STUFF\nlogin here\n" * 3 + good, "en", "own", 9), (3, None, "en", None, None), (4, "", None, "own", 0)]
    out = quality.clean_documents(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "lang", "kept", "n_chars"]
    kept = out.collect()
    assert [(r["doc_id"], r["text"], r["kept"], r["n_chars"]) for r in kept] == [(1, good + "\nAnd a second line of prose ends here.", "own", len(good) + 38)]
    assert quality.quality_rows(spark.createDataFrame([], SCHEMA)).count() == 0 and quality.clean_documents(spark.createDataFrame(rows + rows[:1], SCHEMA)).count() == 2


def test_language_on_held_out_rows(spark):
    df = spark.read.parquet(f"{oracle.TESTDATA}/sf0.01/documents.parquet")
    rows = language.language_rows(df).join(df.select("doc_id", "lang", "text"), "doc_id").where("held_out").collect()
    right = [r["lang"] == r["lang_pred"] for r in rows if len(r["text"].split()) >= 10]
    assert sum(right) / len(right) > 0.98 and all(0 <= r["score"] <= 1 for r in rows)


def test_language_on_odd_rows(spark):
    rng = random.Random(3)
    prose = {"aa": "the and of with that", "bb": "und der die mit nicht"}
    rows = [(i, " ".join(rng.choice(prose[k].split()) for _ in range(80)), k, "own", 1) for i, k in enumerate(["aa", "bb"] * 20)]
    odd = [(100, None, "aa", "", 1), (101, "", "bb", "", 1), (102, "12 34 !!", None, "", 1), (103, "the and of with " * 50000, None, None, None), (None, "und der die mit nicht " * 9, None, "", 1), (103, "the and of " * 9, None, "", 1)]
    df = spark.createDataFrame(rows + odd, SCHEMA)
    got = [(r["doc_id"], r["lang_pred"]) for r in language.language_rows(df).collect()]
    assert len(got) == 46 and set(got) >= {(100, "und"), (101, "und"), (102, "und"), (103, "aa"), (None, "bb")} and all(p == rows[i][2] for i, p in got if i is not None and i < 40)
    assert {r["lang_pred"] for r in language.language_rows(spark.createDataFrame(odd, SCHEMA).where("lang is null")).collect()} == {"und"}
    assert language.language_rows(spark.createDataFrame([], SCHEMA)).count() == 0
    own = language.keep_identified(df.withColumnRenamed("kept", "score"))
    assert own.columns == ["doc_id", "text", "lang", "score", "n_chars"] and own.count() == 43


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen.append(docs)
    assert all(d.columns == columns for d in seen[:-1])
    whole = {tuple(r)[:6] for r in seen[-1].drop("sequence_id").collect()}
    assert {tuple(r)[:6] for r in corpus_pipeline.run(spark, FOLDER).drop("sequence_id").collect()} == whole
    # every stage works on all its predecessor kept, and the last packs every id of it once
    ids = [{r[0] for r in d.select("doc_id").collect()} for d in seen]
    assert ids[0] >= ids[1] >= ids[2] >= ids[3] == ids[4] and len(ids[2]) < len(ids[0])
    assert seen[-1].groupBy("doc_id", "doc_tokens").agg({"length": "sum"}).where("doc_tokens <> `sum(length)`").count() == 0


def test_pipeline_keeps_only_what_is_still_read(spark):
    folder = shared_folder(spark).split(":")[-1]
    before = set(os.listdir(folder))
    out = corpus_pipeline.run(spark, FOLDER)
    assert len(set(os.listdir(folder)) - before) == 1  # the texts to pack
    assert out.count()


def test_pipeline_on_odd_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() == 0
