"""Streams with state against one batch over all rows."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F, types as T

from procurelytics.sources.payloads import dedupe_first
from procurelytics.streaming import stateful

SCHEMA = "key string, page int, day date, amount double"


def land(spark, rows, folder):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def source(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def kind(text):
    return T._parse_datatype_string(text)


@pytest.fixture
def files():
    rng = random.Random(3)
    rows = [(rng.choice([None, "a", "b", "c", "d"]), p, date(2024, rng.randint(1, 4), rng.randint(1, 28)), float(rng.randint(0, 9))) for p in range(120)]
    rng.shuffle(rows)
    return [rows[i : i + 30] for i in range(0, 120, 30)]


def test_first_occurrence_of_late_and_repeated_files(spark, tmp_path, files):
    landing, out, mark = (f"{tmp_path}/{n}" for n in ("in", "out", "mark"))
    for part in [files[2], files[0], files[0], files[3], files[1]]:  # late and repeated
        land(spark, part, landing)
        stateful.first_occurrences(source(spark, landing), ["key"], ["page"], out, mark).awaitTermination()
    got = stateful.current(spark, out, kind(SCHEMA), ["key"])
    want = dedupe_first(spark.createDataFrame(sum(files, []), SCHEMA), ["key"], ["page"])
    assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    # a run without new files changes nothing
    stateful.first_occurrences(source(spark, landing), ["key"], ["page"], out, mark).awaitTermination()
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_a_batch_writes_only_its_keys_and_nothing_landed_gives_no_rows(spark, tmp_path):
    landing, out, mark = (f"{tmp_path}/{n}" for n in ("in", "out", "mark"))
    assert stateful.current(spark, out, kind(SCHEMA), ["key"]).count() == 0
    for part in ([("a", 2, None, 1.0), ("b", 1, None, 1.0)], [("a", 1, None, 3.0)]):
        land(spark, part, landing)
        stateful.first_occurrences(source(spark, landing), ["key"], "page", out, mark).awaitTermination()
    assert spark.read.parquet(out).count() == 3
    assert {(r["key"], r["page"]) for r in stateful.current(spark, out, kind(SCHEMA), ["key"]).collect()} == {("a", 1), ("b", 1)}
    with pytest.raises(ValueError):
        stateful.first_occurrences(source(spark, landing).withColumn(stateful.BATCH, F.lit(1)), ["key"], "page", out, mark)


def test_monthly_totals_with_late_files(spark, tmp_path, files):
    totals = {"n": F.count("*"), "total": F.sum("amount")}
    schema = "month timestamp, key string, n long, total double"
    want = spark.createDataFrame(sum(files, []), SCHEMA).groupBy(F.date_trunc("month", "day").alias("month"), "key").agg(F.count("*").alias("n"), F.sum("amount").alias("total"))
    for name, delay in (("whole", None), ("bounded", "150 days")):
        landing, out, mark = (f"{tmp_path}/{name}/{n}" for n in ("in", "out", "mark"))
        for part in reversed(files):
            land(spark, part, landing)
            stateful.monthly_totals(source(spark, landing), "day", totals, out, mark, by=["key"], delay=delay).awaitTermination()
        got = stateful.current(spark, out, kind(schema), ["month", "key"])
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_rows_beyond_the_delay_are_left_out_and_counted(spark, tmp_path):
    landing, out, mark = (f"{tmp_path}/{n}" for n in ("in", "out", "mark"))
    run = lambda: stateful.monthly_totals(source(spark, landing), "day", {"n": F.count("*")}, out, mark, delay="40 days")
    land(spark, [("a", 1, date(2024, 1, 5), 1.0)], landing)
    run().awaitTermination()
    land(spark, [("a", 1, date(2024, 9, 5), 1.0)], landing)
    run().awaitTermination()
    land(spark, [("a", 1, date(2024, 1, 6), 1.0), ("a", 2, date(2024, 8, 6), 1.0)], landing)
    late = run()
    late.awaitTermination()
    dropped = sum(s.numRowsDroppedByWatermark for p in late.recentProgress for s in p.stateOperators)
    got = {(r["month"].month, r["n"]) for r in stateful.current(spark, out, kind("month timestamp, n long"), ["month"]).collect()}
    assert got == {(1, 1), (8, 1), (9, 1)} and dropped == 1
