"""Sources, sinks, upsert, de-duplication, ranking and search."""

import datetime
import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from procurelytics import constants as K
from procurelytics.functions import dates
from procurelytics.operators import ranking, rollups, search
from procurelytics.plans import flow
from procurelytics.sinks import layers
from procurelytics.sources import payloads, schemas, tables
from procurelytics.streaming.landing import merge_landed

DAY = datetime.date


def write(folder, name, text):
    path = f"{folder}/{name}"
    with open(path, "w") as f:
        f.write(text)
    return path


def test_award_page_from_file(spark, folder):
    path = write(folder, "page.json", json.dumps({"results": [
        {"Award ID": "A1", "Recipient Name": "X", "Start Date": "2023-10-02T00:00:00", "Award Amount": 5, "Total Obligation": 2.5},
        {"Award ID": "A2", "Start Date": "soon"}, {"Award ID": "A3"}]}))
    out = payloads.normalize_awards(spark.read.schema(schemas.page_of(schemas.AWARD_RESULT)).json(path)).orderBy("award_id_piid").collect()
    assert [r.fiscal_year for r in out] == [2024, None, None]
    assert out[0].total_dollars_obligated == 2.5 and out[1].recipient_name is None
    assert len(out[0]) == 18 + 3 + len(K.AWARD_NULL_FIELDS)
    contracts = payloads.normalize_contracts(spark.read.schema(schemas.page_of(schemas.CONTRACT_RESULT)).json(path))
    assert contracts.columns == [*K.CONTRACT_FIELDS, "fiscal_year"] and contracts.where("obligated_amount = 2.5").count() == 1


def test_contract_export_renames_all(spark):
    frame = spark.range(1).select(*[F.lit(1).alias(c) for c in K.CONTRACT_EXPORT_RENAMES])
    assert payloads.rename_contract_export(frame).columns == [*K.CONTRACT_FIELDS, "fiscal_year"]


def test_subsystem_lookup_is_optional(spark, folder):
    path = write(folder, "sub.json", json.dumps({"results": [{"Sub-Award ID": "S", "Sub-Awardee Name": "Eaton Corporation", "Sub-Award Date": "2024-01-01"}]}))
    pages = spark.read.schema(schemas.page_of(schemas.SUBAWARD_RESULT)).json(path)
    plain = payloads.normalize_subawards(pages).first()
    named = payloads.normalize_subawards(pages, {"EATON CORPORATION": "HYDRAULICS"}).first()
    assert plain.subsystem_category is None and named.subsystem_category == "HYDRAULICS" and len(plain) == 35


def test_country_indicator_payload(spark):
    record = {"country": {"id": "US"}, "countryiso3code": "", "date": "2020", "value": 1.5, "unit": " ", "indicator": {"id": "I", "value": "Name"}}
    records = [record, {**record, "value": None}, {**record, "date": ""}, {**record, "date": "2020M1"}, {**record, "countryiso3code": "USA", "unit": "kg"}, {**record, "country": None}]
    texts = [json.dumps([{"page": 1}, records]), json.dumps({"message": "down"}), "not json", None]
    rows = spark.createDataFrame([(t,) for t in texts], "p string")
    out = payloads.normalize_country_indicators(rows, "p", "src", ingested_at="2024-01-01 00:00:00")
    assert out.columns == [f.name for f in schemas.INDICATOR]
    got = sorted((r.country_code, r.value, r.unit, str(r.as_of_date), json.loads(r.raw_payload)["date"]) for r in out.collect())
    assert got == [("", 1.5, None, "2020-01-01", "2020"), ("US", 1.5, None, "2020-01-01", "2020"), ("USA", 1.5, "kg", "2020-01-01", "2020")]


def test_index_file_spellings(spark, folder):
    tab = write(folder, "a.tsv", "date\tgscpi\tnote\n2024-1\t0.5\tx\n\t1\t\n2024/02\tbad\t\n2024-03\t\t\n")
    rows = payloads.read_delimited(spark, tab)
    assert rows.columns == ["date", "gscpi", "note"]
    out = payloads.normalize_index_file(rows, source="s", code="GSCPI", name="n").collect()
    assert [(str(r.as_of_date), r.value, r.country_code) for r in out] == [("2024-01-01", 0.5, "")]
    comma = write(folder, "b.csv", "Period,Barometer\n2024Q2,101\n")
    quarter = payloads.normalize_quarterly_index(payloads.read_delimited(spark, comma), source="w", code="B", name="n").first()
    assert str(quarter.as_of_date) == "2024-04-01" and quarter.value == 101
    price = write(folder, "c.csv", "Period,Commodity,Value\n202402,OIL,7\n202403,,8\n")
    out = payloads.normalize_price_file(payloads.read_delimited(spark, price), source="p").orderBy("as_of_date").collect()
    assert [(r.indicator_code, r.indicator_name, str(r.as_of_date)) for r in out] == [("OIL", "OIL", "2024-02-01"), ("UNKNOWN", "Commodity", "2024-03-01")]


def test_notices_first_occurrence_wins_and_text_is_whole(spark, folder):
    doc = {"document_number": "D1", "title": "meeting", "abstract": "x " * 4000 + "China 8703", "type": "Rule", "publication_date": "2024-05-06", "agencies": []}
    pages = [{"term_position": 2, "page": 1, "results": [{**doc, "title": "embargo"}]}, {"term_position": 1, "page": 3, "results": [doc, {"title": "no number"}]}]
    path = write(folder, "n.json", "\n".join(json.dumps(p) for p in pages))
    (row,) = payloads.normalize_notices(spark.read.schema(schemas.NOTICE_PAGE).json(path)).collect()
    assert (row.event_id, row.event_type, row.country_code, row.hts_code, row.severity, row.source) == ("FR-D1", "TRADE_NOTICE", "CN", "8703", "HIGH", "UNKNOWN")
    assert row.description.endswith("China 8703") and row.affected_value_usd is None and row.rate_change_pct == 0


def test_missing_table_is_empty_with_schema(spark, folder):
    assert tables.load(spark, "nothing", "a int, b string", folder=folder).columns == ["a", "b"]
    with pytest.raises(PySparkException):
        tables.load(spark, "nothing", folder=folder)


def indicators(spark, rows):
    return spark.createDataFrame([("s", c, "", DAY(2024, m, 1), float(v)) for c, m, v in rows],
                                 "source string, indicator_code string, country_code string, as_of_date date, value double")


def test_upsert(spark):
    target = indicators(spark, [("A", 1, 1), ("A", 2, 2)])
    source = indicators(spark, [("A", 2, 20), ("B", 1, 5)])
    once = layers.upsert(target, source, schemas.INDICATOR_KEYS)
    twice = layers.upsert(once, source, schemas.INDICATOR_KEYS)
    want = [("A", 1, 1.0), ("A", 2, 20.0), ("B", 1, 5.0)]
    for df in (once, twice):
        assert sorted((r.indicator_code, r.as_of_date.month, r.value) for r in df.collect()) == want
    double = source.unionByName(source)
    with pytest.raises(PySparkException, match="several source rows"):
        layers.upsert(target, double, schemas.INDICATOR_KEYS).count()


def test_upsert_table_keeps_versions(spark, folder):
    layers.upsert_table(spark, folder, indicators(spark, [("A", 1, 1)]), schemas.INDICATOR_KEYS)
    layers.upsert_table(spark, folder, indicators(spark, [("A", 1, 2), ("B", 1, 3)]), schemas.INDICATOR_KEYS)
    with pytest.raises(PySparkException):
        layers.upsert_table(spark, folder, indicators(spark, [("A", 1, 9), ("A", 1, 8)]), schemas.INDICATOR_KEYS)
    assert sorted((r.indicator_code, r.value) for r in layers.read_upserted(spark, folder).collect()) == [("A", 2.0), ("B", 3.0)]


def test_upsert_rewrites_only_touched_partitions(spark, folder):
    base = f"{folder}/t"
    layers.upsert_partitions(spark, base, indicators(spark, [("A", 1, 1), ("A", 2, 2), ("B", 2, 3)]), schemas.INDICATOR_KEYS, "as_of_date")
    before = {p: os.path.getmtime(f"{base}/{p}") for p in os.listdir(base) if p.startswith("as_of")}
    out = layers.upsert_partitions(spark, base, indicators(spark, [("A", 2, 20), ("C", 3, 9)]), schemas.INDICATOR_KEYS, "as_of_date")
    got = sorted((r.indicator_code, r.as_of_date.month, r.value) for r in out.collect())
    assert got == [("A", 1, 1.0), ("A", 2, 20.0), ("B", 2, 3.0), ("C", 3, 9.0)]
    assert os.path.getmtime(f"{base}/as_of_date=2024-01-01") == before["as_of_date=2024-01-01"]


def test_landing_merges_incrementally(spark, folder):
    base, landing, mark = (f"{folder}/{n}" for n in ("base", "landing", "mark"))
    for rows in ([("A", 1, 1), ("A", 1, 4)], [("A", 1, 7), ("C", 1, 2)]):
        indicators(spark, rows).withColumn("ingested", F.col("value")).coalesce(1).write.mode("append").parquet(landing)
        schema = spark.read.parquet(landing).schema
        merge_landed(spark, landing, schema, base, schemas.INDICATOR_KEYS, newest_by="ingested", checkpoint=mark).awaitTermination()
    assert sorted((r.indicator_code, r.value) for r in layers.read_upserted(spark, base).collect()) == [("A", 7.0), ("C", 2.0)]


def test_history_grows_columns(spark, folder):
    path = f"{folder}/h"
    layers.append_history(spark.createDataFrame([(1,)], "a int"), path)
    out = layers.append_history(spark.createDataFrame([(2, "x")], "a int, b string"), path)
    assert sorted((r.a, r.b) for r in out.collect()) == [(1, None), (2, "x")]


def test_layers_and_audit(spark, folder):
    layers.ensure_layers(spark, ["silver"])
    assert spark.catalog.databaseExists("silver")
    out = layers.write_layer(layers.with_audit(spark.range(2), "src"), f"{folder}/t")
    assert out.where("source_system = 'src' AND data_quality_flag = 'VALID' AND ingestion_timestamp IS NOT NULL").count() == 2


def test_dedupe_and_latest(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, None), ("b", 6, "z")], "k string, o int, v string")
    assert sorted((r.k, r.v) for r in payloads.dedupe_first(rows, ["k"], "o").collect()) == [("a", "y"), ("b", None)]
    assert sorted((r.k, r.o) for r in ranking.latest_per(rows, "k", "o").collect()) == [("a", 2), ("b", 6)]
    assert ranking.latest_per(rows, "k", "o", n=2).count() == 4


def test_tails_and_periods(spark):
    rows = spark.createDataFrame([(DAY(2024, m, 1), m) for m in range(1, 9)], "month date, v int")
    assert sorted(r.v for r in ranking.tail_n(rows, 3).collect()) == [6, 7, 8]
    assert sorted(r.v for r in ranking.tail_n(rows, 3, skip=3).collect()) == [3, 4, 5]
    assert [r.v for r in ranking.latest_period(rows, "month").collect()] == [8]
    assert ranking.latest_period(rows, "month", F.col("v") == 1).count() == 0
    as_of = F.lit("2024-06-15").cast("date")
    assert sorted(r.v for r in ranking.last_months(rows, "month", 2, as_of).collect()) == [5, 6, 7, 8]
    assert [r.v for r in ranking.future_head(rows, 1, as_of).collect()] == [7]


def test_month_end_last_breaks_ties(spark):
    rows = spark.createDataFrame([("A", DAY(2024, 2, 3), 1, 5.0), ("A", DAY(2024, 2, 3), 2, 6.0), ("A", DAY(2024, 2, 1), 9, 7.0)], "k string, d date, t int, v double")
    out = payloads.month_end_last(rows, ["k"], "d", "v", ties=["t"]).first()
    assert (str(out.as_of_date), out.value) == ("2024-02-29", 6.0)


def test_pivot_adds_up_and_keeps_null(spark):
    rows = spark.createDataFrame([("2024-01-05", "X", 1.0), ("2024-01-06", None, 2.0), ("2024-02-01", "X", 4.0)], "d string, c string, a double")
    out = rollups.pivot_monthly(rows, "d", "c", "a", ["X", None]).orderBy("month").collect()
    assert [(r.subsystem_x_usd, r.subsystem_null_usd) for r in out] == [(1.0, 2.0), (4.0, None)]


def test_sketch_counts_are_close(spark):
    rows = spark.range(5000).select(F.col("id").alias("award_id_piid"), F.lit("2024-01-05").alias("action_date"), F.lit(1.0).alias("federal_action_obligation"))
    exact, sketch = (rollups.prime_monthly(rows, approx=a).first().unique_awards for a in (False, True))
    assert exact == 5000 and abs(sketch - exact) < 500


def test_search_is_literal_and_counts_all(spark):
    rows = spark.createDataFrame([(f"L3 (US) {i}", f"u{i}", "WI", "ARMOR", "SMALL", "EUROPE") for i in range(5)] + [("L3 US", "z", "wi", None, None, None)],
                                 "supplier_name string, uei string, state string, subsystem_category string, company_size string, region_group string")
    found = search.search_suppliers(rows, name="l3 (us)", top_n=2).collect()
    assert len(found) == 2 and {r.total_matches for r in found} == {5}
    assert search.supplier_filter(rows, name="l3 (us)", regex=True).count() == 1
    assert search.supplier_filter(rows, state="wi").count() == 6 and search.supplier_filter(rows, size="small").count() == 5
    cells = {(r.facet, r.value): r.suppliers for r in search.supplier_summary(rows).collect()}
    assert cells == {("size", "SMALL"): 5, ("size", "UNKNOWN"): 1, ("region", "EUROPE"): 5, ("region", "UNKNOWN"): 1}


def test_contract_amounts_as_text(spark):
    rows = spark.createDataFrame([("a", "V", "23A", "100", 2024), ("b", "V", "23B", "bad", 2024), ("c", "W", "25", "300", 2023)],
                                 "contract_id string, vendor_name string, psc_code string, obligated_amount string, fiscal_year int")
    assert [r.contract_id for r in search.search_contracts(rows).collect()] == ["c", "a", "b"]
    one = search.search_contracts(rows, psc="23", min_amount=50).collect()
    assert [(r.contract_id, r.total_matches, r.value_shown) for r in one] == [("a", 1, 100.0)]


def test_flow_with_missing_sources(spark, folder):
    awards = spark.createDataFrame([("A", DAY(2024, 2, 3), 10.0), ("B", DAY(2030, 1, 1), 5.0)], "award_id_piid string, action_date date, federal_action_obligation double")
    out = flow.build(spark, {"awards": awards}, start="2024-01-01", end="2024-03-01", root=folder)
    assert [r.total_obligations_usd for r in out["demand_signals"].orderBy("month").collect()] == [0.0, 10.0, 0.0]
    assert out["inventory_metrics"].count() == 3
    plan = flow.in_range(awards, "action_date", "2024-01-01", "2024-03-01")
    assert plan.count() == 1


def test_spine_bounds(spark):
    assert dates.month_spine(spark, "2010-01-15", "2010-12-31").count() == 12


def test_partition_upsert_loses_nothing(spark, folder):
    base, keys = f"{folder}/t", ["k", "p"]
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    layers.upsert_partitions(spark, base, make([("a", "1", 1.0), ("b", "1", 2.0), ("c", "2", 3.0), ("n", None, 4.0)], "k string, p string, v double"), keys, "p")
    # a new column, and a NULL partition value
    layers.upsert_partitions(spark, base, make([("a", "1", 10.0, "x"), ("m", None, 5.0, "y")], "k string, p string, v double, extra string"), keys, "p")
    # a column that the source lacks
    out = layers.upsert_partitions(spark, base, make([("b", "1", 20.0)], "k string, p string, v double"), keys, "p")
    rows = {(r["k"], r["p"] if r["p"] is None else str(r["p"])): (r["v"], r["extra"]) for r in out.collect()}
    assert rows == {("a", "1"): (10.0, "x"), ("b", "1"): (20.0, None), ("c", "2"): (3.0, None), ("n", None): (4.0, None), ("m", None): (5.0, "y")}


def test_unreadable_table_is_no_missing_table(spark, folder):
    os.makedirs(f"{folder}/bad.parquet")
    with open(f"{folder}/bad.parquet/part-0.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        tables.load(spark, "bad", spark.range(0).schema, folder).collect()


def test_old_versions_are_deleted(spark, folder):
    base = f"{folder}/v"
    for i in range(4):
        layers.upsert_table(spark, base, spark.createDataFrame([(i, i)], "k int, v int"), ["k"])
    assert sorted(n for n in os.listdir(base) if n.startswith("v")) == ["v000000003", "v000000004"]
    assert layers.read_upserted(spark, base).count() == 4


def test_files_of_a_folder_have_their_own_delimiter(spark, folder):
    write(folder, "a b.csv", "Date,GSCPI\n2024-01,1\n2024-02,2\n")
    write(folder, "b.tsv", "\ndate\tgscpi\tnote\n2024-03\t3\tx, y\n")
    write(folder, "c.csv", "GSCPI,Date\n4,2024-04\n")
    write(folder, "d{1}.csv", "")
    rows = payloads.read_delimited(spark, folder)
    out = payloads.normalize_index_file(rows, source="s", code="GSCPI", name="n").orderBy("as_of_date").collect()
    assert [(str(r.as_of_date), r.value) for r in out] == [(f"2024-0{k}-01", float(k)) for k in (1, 2, 3, 4)]


def test_upsert_query_covers_its_whole_table(spark):
    from procurelytics.plans import bindings
    from procurelytics.plans.catalog import QUERIES

    folder = "/root/testdata/sf0.001"
    assert QUERIES["upsert_indicators_whole"](spark, folder).count() == bindings.price_indicators(spark, folder).count() > QUERIES["upsert_indicators"](spark, folder).count()
