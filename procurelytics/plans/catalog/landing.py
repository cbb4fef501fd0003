"""Landed payloads, periods, de-duplication, sinks and upsert."""

from pyspark.sql import functions as F, types as T

from procurelytics import constants as K
from procurelytics.functions import dates
from procurelytics.functions.bands import choose
from procurelytics.operators import ranking, rollups, search
from procurelytics.plans import bindings as B
from procurelytics.plans.catalog import views as V
from procurelytics.plans.registry import query, shown, sql
from procurelytics.session import delete_at_end, scratch_path
from procurelytics.sinks import layers
from procurelytics.sources import payloads, schemas, tables
from procurelytics.streaming import stateful


# --- scans ---------------------------------------------------------------------------
@query("load_missing_safe", sql("suppliers", "SELECT region_group, count(*) AS supplier_count FROM suppliers GROUP BY 1", ints="supplier_count"))
def load_missing_safe(spark, d):
    absent = tables.load(spark, "no_such_table", schemas.SUPPLIER_LOCATION, folder=d)
    rows = B.supplier_locations(spark, d).unionByName(absent, allowMissingColumns=True)
    return shown(rollups.group_summary(rows, "region_group", {"supplier_count": F.count("*")}))


@query("scan_limit", sql("contracts", "SELECT * FROM contracts ORDER BY obligated_amount DESC, contract_id LIMIT 100",
                         ints="contract_id fiscal_year", doubles="obligated_amount"))
def scan_limit(spark, d):
    return shown(tables.scan_sql(spark, B.contracts(spark, d), 100, "obligated_amount DESC, contract_id"))


# --- payload pages --------------------------------------------------------------------
def award_pages(spark, d):
    """Contract rows as JSON pages of one result each."""
    rows = B.contracts(spark, d)
    result = F.struct(
        F.col("contract_id").cast("string").alias("Award ID"), F.col("vendor_name").alias("Recipient Name"),
        F.col("effective_date").cast("string").alias("Start Date"), F.date_add("effective_date", 365).cast("string").alias("End Date"),
        F.col("obligated_amount").alias("Award Amount"), (F.col("obligated_amount") / 2).alias("Total Obligation"),
        F.col("psc_code").alias("Product/Service Code"),
    )
    return rows.select(F.to_json(F.struct(F.array(result).alias("results"))).alias("page"))


def landed(pages, page_schema):
    """The pages as files of a landing folder, read back under the declared schema; only the
    fields a query uses are parsed."""
    spark = pages.sparkSession
    path = scratch_path(spark, "landed")
    pages.write.text(path)
    return spark.read.schema(page_schema).json(path)


@query("normalize_awards", sql("contracts", """
SELECT CAST(contract_id AS VARCHAR) AS award_id_piid, vendor_name AS recipient_name, CAST(effective_date AS VARCHAR) AS action_date,
       obligated_amount AS current_total_value_of_award, obligated_amount / 2 AS federal_action_obligation,
       obligated_amount / 2 AS total_dollars_obligated, psc_code AS product_or_service_code, CAST(NULL AS VARCHAR) AS naics_code, fiscal_year
FROM contracts""", ints="fiscal_year", doubles="current_total_value_of_award federal_action_obligation total_dollars_obligated"))
def normalize_awards(spark, d):
    out = payloads.normalize_awards(landed(award_pages(spark, d), schemas.page_of(schemas.AWARD_RESULT)))
    return shown(out, "award_id_piid", "recipient_name", "action_date", "current_total_value_of_award", "federal_action_obligation",
                 "total_dollars_obligated", "product_or_service_code", "naics_code", "fiscal_year")


@query("normalize_contracts", sql("contracts", """
SELECT CAST(contract_id AS VARCHAR) AS contract_id, vendor_name, CAST(effective_date AS VARCHAR) AS signed_date, CAST(effective_date AS VARCHAR) AS effective_date,
       CAST(CAST(effective_date + 365 AS DATE) AS VARCHAR) AS ultimate_completion_date, obligated_amount / 2 AS obligated_amount,
       obligated_amount AS base_and_all_options_value, psc_code, CAST(NULL AS VARCHAR) AS vendor_uei, fiscal_year FROM contracts""",
                                  ints="fiscal_year", doubles="obligated_amount base_and_all_options_value"))
def normalize_contracts(spark, d):
    out = payloads.normalize_contracts(landed(award_pages(spark, d), schemas.page_of(schemas.CONTRACT_RESULT)))
    return shown(out, "contract_id", "vendor_name", "signed_date", "effective_date", "ultimate_completion_date", "obligated_amount",
                 "base_and_all_options_value", "psc_code", "vendor_uei", "fiscal_year")


@query("normalize_subawards", sql("subawards", f"""
SELECT CAST(prime_award_id AS VARCHAR) AS prime_award_id, sub_awardee_name, CAST(subaward_action_date AS VARCHAR) AS subaward_action_date, subaward_amount,
       CAST(NULL AS VARCHAR) AS subsystem_category, {V.fy('subaward_action_date')} AS subaward_action_date_fiscal_year FROM subawards""",
                                  ints="subaward_action_date_fiscal_year", doubles="subaward_amount"))
def normalize_subawards(spark, d):
    rows = B.subawards(spark, d, supplier=True, category=False)
    result = F.struct(
        F.col("prime_award_id").cast("string").alias("Prime Award ID"), F.col("sub_awardee_name").alias("Sub-Awardee Name"),
        F.col("subaward_action_date").cast("string").alias("Sub-Award Date"), F.col("subaward_amount").alias("Sub-Award Amount"),
    )
    pages = rows.select(F.to_json(F.struct(F.array(result).alias("results"))).alias("page"))
    out = payloads.normalize_subawards(landed(pages, schemas.page_of(schemas.SUBAWARD_RESULT)))
    return shown(out, "prime_award_id", "sub_awardee_name", "subaward_action_date", "subaward_amount", "subsystem_category",
                 "subaward_action_date_fiscal_year")


NAICS = ["336120", "336211", "336992", "336999", "332994", "999999"]


@query("flatten_entities", sql("suppliers", f"""
SELECT uei, supplier_name AS legal_business_name, state AS physical_address_state_or_province, country AS physical_address_country_code,
       'For Profit, ' || upper(company_size[1:1]) || lower(company_size[2:]) || ' Business' AS business_type,
       naics_code_primary, {V.mapped('naics_code_primary', K.NAICS_SUBSYSTEM, "'OTHER'")} AS subsystem_category, company_size
FROM (SELECT *, {V.pick([V.text(n) for n in NAICS], 'supplier_key')} AS naics_code_primary FROM suppliers)"""))
def flatten_entities(spark, d):
    """Suppliers as nested entity pages; each shows up on two pages, the first counts."""
    s = B.supplier_locations(spark, d)
    entity = F.struct(
        F.struct(F.col("uei").alias("ueiSAM"), F.col("supplier_name").alias("legalBusinessName"),
                 F.array(F.lit("For Profit"), F.concat(F.initcap("company_size"), F.lit(" Business"))).alias("businessTypes")).alias("entityRegistration"),
        F.struct(F.struct(F.col("state").alias("stateOrProvinceCode"), F.col("country").alias("countryCode")).alias("physicalAddress"),
                 F.struct(choose(NAICS, F.col("supplier_key")).alias("primaryNaics")).alias("entityInformation")).alias("coreData"),
    )
    again = F.explode(F.array(F.lit(1), F.lit(2))).alias("page")
    text = s.select("supplier_key", entity.alias("e")).select("e", again).select(
        F.to_json(F.struct(F.lit("336120").alias("naics"), F.col("page"), F.array("e").alias("entityData"))).alias("page_text"))
    return payloads.flatten_entities(landed(text, schemas.ENTITY_PAGE)).select(
        "uei", "legal_business_name", "physical_address_state_or_province", "physical_address_country_code", "business_type",
        "naics_code_primary", "subsystem_category", "company_size")


@query("normalize_country_indicators", sql("", """
SELECT 'country_wdi' AS source, make_date(CAST(year(ts) AS INTEGER), 1, 1) AS as_of_date,
       CASE WHEN user_id % 2 = 0 THEN 'CT' ELSE 'C' END || CAST(user_id % 7 AS VARCHAR) AS country_code, event_type AS indicator_code,
       'Indicator ' || event_type AS indicator_name, 'annual' AS frequency, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'pct' END AS unit,
       count(*) AS n, sum(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS total FROM events GROUP BY 1, 2, 3, 4, 5, 6, 7""", ints="n", doubles="total"))
def normalize_country_indicators(spark, d):
    rows = payloads.normalize_country_indicators(B.country_payloads(spark, d), "payload", "country_wdi")
    return shown(rows.groupBy("source", "as_of_date", "country_code", "indicator_code", "indicator_name", "frequency", "unit").agg(
        F.count("*").alias("n"), F.sum("value").alias("total")))


@query("normalize_index_file", sql("", """
SELECT 'GSCPI' AS indicator_code, '' AS country_code, CAST(date_trunc('month', o_orderdate) AS DATE) AS as_of_date, count(*) AS n, sum(o_totalprice) AS total
FROM orders GROUP BY 1, 2, 3""", ints="n", doubles="total"))
def normalize_index_file(spark, d):
    """Orders as an index file under the second spelling of each header, months without zero."""
    day = dates.as_date(F.col("o_orderdate"))
    rows = B.read_parquet(spark, d, "orders").select(
        F.concat(F.year(day).cast("string"), F.lit("/"), F.month(day).cast("string")).alias("Month"),
        F.when(F.pmod("o_orderkey", F.lit(2)) == 0, F.col("o_totalprice").cast("string")).alias("gscpi"),
        F.when(F.pmod("o_orderkey", F.lit(2)) == 1, F.col("o_totalprice").cast("string")).alias("Value"),
    )
    out = payloads.normalize_index_file(rows, source="pressure_index", code="GSCPI", name="Global Supply Chain Pressure Index")
    return shown(out.groupBy("indicator_code", "country_code", "as_of_date").agg(F.count("*").alias("n"), F.sum("value").alias("total")))


@query("read_delimited", sql("", """
SELECT o_orderkey AS order_key, CAST(date_trunc('month', o_orderdate) AS DATE) AS as_of_date, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS gscpi,
       CASE WHEN o_orderkey % 2 = 1 THEN o_totalprice END AS value FROM orders""", ints="order_key", doubles="gscpi value"))
def read_delimited(spark, d):
    """Orders as a folder of index files, even keys with commas, odd keys with tabs and other columns."""
    rows = B.read_parquet(spark, d, "orders").select("o_orderkey", F.date_format(dates.as_date(F.col("o_orderdate")), "yyyy-MM").alias("Month"), "o_totalprice")
    path = scratch_path(spark, "delimited")
    even = F.pmod("o_orderkey", F.lit(2)) == 0
    rows.where(even).select("Month", F.col("o_orderkey").alias("Key"), F.col("o_totalprice").alias("gscpi")).write.csv(path, header=True)
    rows.where(~even).select(F.col("o_orderkey").alias("Key"), "Month", F.col("o_totalprice").alias("Value")).write.mode("append").csv(path, header=True, sep="\t")
    out = payloads.read_delimited(spark, path)
    return shown(out.select(F.col("Key").cast("bigint").alias("order_key"), dates.parse_index_date(F.col("Month")).alias("as_of_date"),
                            F.col("gscpi").cast("double").alias("gscpi"), F.col("Value").cast("double").alias("value")))


@query("parse_period", sql("", """
SELECT CAST(year(o_orderdate) AS VARCHAR) || 'q' || CAST(quarter(o_orderdate) AS VARCHAR) AS period, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS as_of_date,
       count(*) AS n FROM orders GROUP BY 1, 2""", ints="n"))
def parse_period(spark, d):
    day = dates.as_date(F.col("o_orderdate"))
    period = F.concat(F.year(day).cast("string"), F.lit("q"), F.quarter(day).cast("string"))
    rows = B.read_parquet(spark, d, "orders").groupBy(period.alias("period")).agg(F.count("*").alias("n"))
    return shown(rows, "period", dates.parse_quarter_period(F.col("period")).alias("as_of_date"), "n")


@query("parse_compact_period", sql("", """
SELECT period, CAST(strptime(CASE WHEN length(period) = 6 THEN period ELSE period || '01' END, '%Y%m') AS DATE) AS as_of_date, count(*) AS n FROM (
SELECT CASE WHEN o_orderkey % 5 = 0 THEN CAST(year(o_orderdate) AS VARCHAR) ELSE strftime(o_orderdate, '%Y%m') END AS period FROM orders) GROUP BY 1, 2""", ints="n"))
def parse_compact_period(spark, d):
    day = dates.as_date(F.col("o_orderdate"))
    period = F.when(F.pmod("o_orderkey", F.lit(5)) == 0, F.year(day).cast("string")).otherwise(F.date_format(day, "yyyyMM"))
    rows = B.read_parquet(spark, d, "orders").groupBy(period.alias("period")).agg(F.count("*").alias("n"))
    return shown(rows, "period", dates.parse_compact_period(F.col("period")).alias("as_of_date"), "n")


@query("normalize_weather", sql("weather_obs", """
SELECT month, location_id, 'Site ' || location_id AS location_name, location_type, tavg, tmin, tmax, prcp, snow, wspd FROM weather_obs""",
                                doubles="tavg tmin tmax prcp snow wspd"))
def normalize_weather(spark, d):
    obs = B.weather_obs(spark, d)
    places = obs.groupBy("location_id", "location_type").agg(F.count("*").alias("_n")).select(
        "location_id", F.concat(F.lit("Site "), "location_id").alias("location_name"), F.lit("City").alias("city"), F.lit("WI").alias("state"),
        F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"), "location_type")
    readings = obs.drop("location_type").withColumns({"wdir": F.lit(0.0), "pres": F.lit(0.0)})
    out = payloads.normalize_weather(readings, places)
    return shown(out, "month", "location_id", "location_name", "location_type", "tavg", "tmin", "tmax", "prcp", "snow", "wspd")


@query("dedupe_first", sql("", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) = 1""",
                           ints="l_orderkey l_linenumber l_partkey", doubles="l_extendedprice"))
def dedupe_first(spark, d):
    rows = B.read_parquet(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    out = payloads.dedupe_first(rows, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"])
    return shown(out, "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


def in_two_runs(rows, early, start):
    """Lands the rows that are not ``early``, runs the stream, lands the others and runs it again;
    returns where the stream wrote."""
    spark = rows.sparkSession
    landing, out, mark = (scratch_path(spark, n) for n in ("stream-in", "stream-out", "stream-mark"))
    for part in (rows.where(~early), rows.where(early)):
        part.write.mode("append").parquet(landing)
        start(spark.readStream.schema(rows.schema).parquet(landing), out, mark).awaitTermination()
    delete_at_end(spark, landing, out, mark)
    return out


@query("stream_first_occurrence", sql("", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) = 1""",
                                      ints="l_orderkey l_linenumber l_partkey", doubles="l_extendedprice"))
def stream_first_occurrence(spark, d):
    """Later lines land first, so the second run replaces what the first one kept."""
    rows = B.read_parquet(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    out = in_two_runs(rows, F.coalesce(F.col("l_linenumber") == 1, F.lit(False)),
                      lambda stream, out, mark: stateful.first_occurrences(stream, ["l_orderkey"], order, out, mark))
    return shown(stateful.current(spark, out, rows.schema, ["l_orderkey"]), "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("stream_monthly_totals", sql("", """
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_returnflag, count(*) AS shipments, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2""",
                                    ints="shipments", doubles="quantity"))
def stream_monthly_totals(spark, d):
    """Half of the rows of every month land late."""
    rows = B.read_parquet(spark, d, "lineitem").select("l_linenumber", "l_shipdate", "l_returnflag", "l_quantity")
    totals = {"shipments": F.count("*"), "quantity": F.sum("l_quantity")}
    out = in_two_runs(rows, F.coalesce(F.col("l_linenumber") % 2 == 0, F.lit(False)),
                      lambda stream, out, mark: stateful.monthly_totals(stream, "l_shipdate", totals, out, mark, by=["l_returnflag"]))
    schema = T.StructType([T.StructField("month", T.TimestampType()), rows.schema["l_returnflag"], T.StructField("shipments", T.LongType()), T.StructField("quantity", T.DoubleType())])
    return shown(stateful.current(spark, out, schema, ["month", "l_returnflag"]))


# --- sinks ---------------------------------------------------------------------------------
@query("write_layer", sql("contracts", "SELECT contract_id, vendor_name, obligated_amount, fiscal_year FROM contracts",
                          ints="contract_id fiscal_year", doubles="obligated_amount"))
def write_layer(spark, d):
    rows = B.contracts(spark, d).select("contract_id", "vendor_name", "obligated_amount", "fiscal_year")
    return shown(layers.write_layer(rows, scratch_path(spark, "layer"), partition_by=["fiscal_year"]), *rows.columns)


@query("append_history", sql("contracts", """
SELECT contract_id, obligated_amount, NULL AS psc_code FROM contracts WHERE fiscal_year < 1999
UNION ALL SELECT contract_id, obligated_amount, psc_code FROM contracts WHERE fiscal_year >= 1999""", ints="contract_id", doubles="obligated_amount"))
def append_history(spark, d):
    """Two runs appended; the second brings a column that the first lacks."""
    rows, path = B.contracts(spark, d), scratch_path(spark, "history")
    layers.append_history(rows.where("fiscal_year < 1999").select("contract_id", "obligated_amount"), path)
    return shown(layers.append_history(rows.where("fiscal_year >= 1999").select("contract_id", "obligated_amount", "psc_code"), path),
                 "contract_id", "obligated_amount", "psc_code")


@query("upsert_indicators", sql("price_ind", """
SELECT indicator_code, as_of_date, CASE WHEN quarter(as_of_date) = 4 THEN value * 2 ELSE value END AS value FROM price_ind
WHERE NOT (year(as_of_date) = 2001 AND quarter(as_of_date) <> 4)""", doubles="value"))
def upsert_indicators(spark, d):
    """Target: all years but 2001.  Source: every fourth quarter, with new values."""
    rows = B.price_indicators(spark, d)
    target = rows.where(F.year("as_of_date") < 2001)
    source = rows.where(F.quarter("as_of_date") == 4).withColumn("value", F.col("value") * 2)
    return shown(layers.upsert(target, source, schemas.INDICATOR_KEYS), "indicator_code", "as_of_date", "value")


@query("upsert_indicators_whole", sql("price_ind", """
SELECT indicator_code, as_of_date, CASE WHEN quarter(as_of_date) = 4 THEN value * 2 ELSE value END AS value FROM price_ind""", doubles="value"))
def upsert_indicators_whole(spark, d):
    """Target: all rows but the fourth quarters of 2001.  Source: every fourth quarter, with new values;
    it brings back those the target lacks, so no row of the table is in neither."""
    rows = B.price_indicators(spark, d)
    fourth = F.quarter("as_of_date") == 4
    target = rows.where(~(fourth & (F.year("as_of_date") == 2001)))
    source = rows.where(fourth).withColumn("value", F.col("value") * 2)
    return shown(layers.upsert(target, source, schemas.INDICATOR_KEYS), "indicator_code", "as_of_date", "value")


@query("with_audit", sql("contracts", "SELECT contract_id, vendor_name, 'orders' AS source_system, 'VALID' AS data_quality_flag FROM contracts", ints="contract_id"))
def with_audit(spark, d):
    return shown(layers.with_audit(B.contracts(spark, d), "orders"), "contract_id", "vendor_name", "source_system", "data_quality_flag")
