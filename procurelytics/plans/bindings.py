"""Domain views over the driver's test tables.

Each view reads whole tables and selects only the columns it maps, so pruning
reaches the parquet scan; dimension joins are added only where a query asks for
their columns.  No size is assumed for any dimension: the join strategy is left to
Spark's size checks and AQE."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from procurelytics import constants as K
from procurelytics.functions.bands import choose, lookup
from procurelytics.functions.dates import as_date, fiscal_year, month_of
from procurelytics.operators import inventory, prices, risk, rollups, signals, weather
from procurelytics.operators.series import series_spine
from procurelytics.session import cut_lineage
from procurelytics.sources import payloads
from procurelytics.sources.schemas import TEST_TABLES
from procurelytics.sources.tables import literal_rows, read_parquet as _read_parquet

AS_OF = "2001-08-01"
WEATHER_START = "1999-03-01"
EVENTS_START = "2024-01-01"
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
REGION_NAMES = {
    "AMERICA": "AMERICAS", "EUROPE": "EUROPE", "ASIA": "INDO_PACIFIC", "MIDDLE EAST": "MIDEAST", "AFRICA": "AFRICA",
}
SUBSYSTEMS = ["POWERTRAIN", "ARMOR", "ELECTRONICS", "TIRES", "HYDRAULICS", "OTHER"]
SEGMENT_CODES = {
    "AUTOMOBILE": "8703", "BUILDING": "7308", "FURNITURE": "4011", "HOUSEHOLD": "8471", "MACHINERY": "8701",
}
NOTICE_PHRASES = [
    "raise tariff on China goods 8701", "lower tariff Germany 7601", "new tariff Mexico", "exemption 8517 Japan",
    "restricted trade Iran", "export control Russia 9306", "embargo Cuba", "agreement with Canada 4011",
    "OFAC update Syria", "meeting notice 1234", "urban planning 7208 Brazil", "",
]
NOTICE_TYPES = ["RULE", "Proposed Rule", "Notice"]


def read_parquet(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A test table under its declared schema, so that no job reads footers first."""
    return _read_parquet(spark, d, name, TEST_TABLES[name])


def as_of() -> Column:
    return F.lit(AS_OF).cast("date")


# --- spend -----------------------------------------------------------------------
def award_actions(spark: SparkSession, d: str, vendor=False, psc=False) -> DataFrame:
    """One row per order line: the order is the award."""
    lines = read_parquet(spark, d, "lineitem")
    orders = read_parquet(spark, d, "orders")
    rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    columns = [
        F.col("o_orderkey").alias("award_id_piid"),
        as_date(F.col("o_orderdate")).alias("action_date"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("federal_action_obligation"),
        "l_suppkey",
    ]
    if vendor:
        rows = rows.join(read_parquet(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        columns.append(F.col("s_name").alias("recipient_name"))
    if psc:
        rows = rows.join(read_parquet(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
        columns.append(F.col("p_brand").alias("product_or_service_code"))
    return rows.select(*columns)


def contracts(spark: SparkSession, d: str) -> DataFrame:
    orders, customers = read_parquet(spark, d, "orders"), read_parquet(spark, d, "customer")
    rows = orders.join(customers, orders.o_custkey == customers.c_custkey)
    day = as_date(F.col("o_orderdate"))
    return rows.select(
        F.col("o_orderkey").alias("contract_id"), F.col("c_name").alias("vendor_name"),
        F.col("o_totalprice").alias("obligated_amount"), day.alias("effective_date"),
        F.col("c_mktsegment").alias("psc_code"), fiscal_year(day).alias("fiscal_year"),
    )


def subawards(spark: SparkSession, d: str, supplier=False, place=False, category=True) -> DataFrame:
    rows = read_parquet(spark, d, "lineitem")
    columns = [
        F.col("l_orderkey").alias("prime_award_id"), F.col("l_suppkey").alias("sub_awardee_key"),
        F.col("l_extendedprice").alias("subaward_amount"),
        as_date(F.col("l_shipdate")).alias("subaward_action_date"),
    ]
    if category:
        rows = rows.join(read_parquet(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
        columns.append(F.col("p_type").alias("subsystem_category"))
    if supplier or place:
        rows = rows.join(read_parquet(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        columns.append(F.col("s_name").alias("sub_awardee_name"))
    if place:
        nations = read_parquet(spark, d, "nation").join(
            read_parquet(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        rows = rows.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        columns += [F.col("n_name").alias("sub_awardee_state"), F.col("r_name").alias("sub_awardee_country")]
    return rows.select(*columns)


def supplier_locations(spark: SparkSession, d: str) -> DataFrame:
    nations = read_parquet(spark, d, "nation").join(
        read_parquet(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = read_parquet(spark, d, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    key = F.col("s_suppkey")
    balance = F.col("s_acctbal")
    located = rows.select(
        key.alias("supplier_key"), F.col("s_name").alias("supplier_name"),
        F.concat(F.lit("UEI"), key.cast("string")).alias("uei"),
        F.col("n_name").alias("state"), F.col("r_name").alias("country"),
        (F.pmod(key * 37, F.lit(120)) - 60).cast("double").alias("lat"),
        (F.pmod(key * 53, F.lit(360)) - 180).cast("double").alias("lon"),
        lookup(F.col("r_name"), REGION_NAMES, "OTHER").alias("region_group"),
        choose(SUBSYSTEMS, key).alias("subsystem_category"),
        F.when(balance < 3000, "SMALL").when(balance < 7000, "MEDIUM").otherwise("LARGE").alias("company_size"),
    )
    return risk.distance_to(located)


def customer_locations(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey")
    return read_parquet(spark, d, "customer").select(
        key.alias("customer_key"), (F.pmod(key * 7919, F.lit(17000)) / 100.0 - 84.9963).alias("lat"),
        (F.pmod(key * 104729, F.lit(36000)) / 100.0 - 179.9987).alias("lon"))


# --- trade, geography, prices, weather ----------------------------------------------
def trade_events(spark: SparkSession, d: str) -> DataFrame:
    orders, customers = read_parquet(spark, d, "orders"), read_parquet(spark, d, "customer")
    rows = orders.join(customers, orders.o_custkey == customers.c_custkey)
    group = F.pmod("o_custkey", F.lit(10))
    code = lookup(F.col("c_mktsegment"), SEGMENT_CODES, K.HTS_FALLBACK)
    return rows.select(
        F.col("o_orderkey").alias("event_id"), F.col("o_orderdate").alias("event_date"),
        lookup(F.col("o_orderstatus"), {"F": "SANCTION", "O": "TARIFF_EXEMPTION", "P": "TRADE_NOTICE"}).alias("event_type"),
        F.col("c_nationkey").cast("string").alias("country_code"),
        F.concat(F.lit("COUNTRY "), F.col("c_nationkey").cast("string")).alias("country_name"),
        code.alias("hts_code"), lookup(code, K.HTS_DESCRIPTIONS, "").alias("hts_description"),
        F.lit(0.0).alias("rate_change_pct"), F.col("o_orderdate").alias("effective_date"),
        F.when((F.col("o_orderpriority") == "1-URGENT") & (group == 0), "CRITICAL")
        .when((F.col("o_orderpriority") == "2-HIGH") & (group == 1), "HIGH").otherwise("MODERATE").alias("severity"),
        F.pmod("o_totalprice", F.lit(100.0)).alias("impact_score"), F.col("o_totalprice").alias("affected_value_usd"),
    )


def trade_silver(spark: SparkSession, d: str) -> DataFrame:
    return risk.trade_events_silver(trade_events(spark, d))


def geo_risk(spark: SparkSession, d: str) -> DataFrame:
    orders = read_parquet(spark, d, "orders")
    return orders.groupBy(month_of(F.col("o_orderdate")).alias("month")).agg(
        F.avg(F.pmod("o_totalprice", F.lit(100.0))).alias("composite_risk_index"),
        F.count("*").alias("event_count"),
        F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)).alias("critical_events"),
    )


def price_indicators(spark: SparkSession, d: str) -> DataFrame:
    """Indicator rows: the last unit price of each part type and month."""
    lines = read_parquet(spark, d, "lineitem").join(
        read_parquet(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    quotes = lines.select(
        F.col("p_type").alias("indicator_code"), as_date(F.col("l_shipdate")).alias("day"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), "l_orderkey", "l_linenumber", "l_partkey",
    )
    last = payloads.month_end_last(quotes, ["indicator_code"], "day", "price", ties=("l_orderkey", "l_linenumber", "l_partkey", "price"))
    return last.select(*payloads.indicator_row(
        source="price_series", ingested_at="2024-01-01 00:00:00", as_of_date=F.col("as_of_date"),
        indicator_code=F.col("indicator_code"), indicator_name=F.initcap("indicator_code"), value=F.col("value"),
        unit="USD/unit", frequency="monthly",
    ))


PRICE_METADATA = [
    ("ECONOMY", "ENERGY", "Fuel"), ("LARGE", "INDUSTRIAL_METALS", "Frames"), ("MEDIUM", "INDUSTRIAL_METALS", "Armor"),
    ("PROMO", "RUBBER", "Tires"), ("SMALL", "PRECIOUS_METALS", "Connectors"),
]


def price_table(spark: SparkSession, d: str) -> DataFrame:
    metadata = literal_rows(spark, PRICE_METADATA, ["ticker", "category", "defense_use"])
    return prices.commodity_enriched(price_indicators(spark, d), metadata, source="price_series")


def weather_obs(spark: SparkSession, d: str) -> DataFrame:
    """One row per location and period; day n of the event log stands for month n."""
    events = read_parquet(spark, d, "events")
    period = F.datediff(as_date(F.col("ts")), F.lit(EVENTS_START).cast("date"))
    daily = events.groupBy(F.pmod("user_id", F.lit(11)).alias("loc"), period.alias("period")).agg(
        (F.max("value") / 10).alias("tmax"), (F.min("value") * -10).alias("tmin"),
        F.pmod(F.sum(F.round(F.col("value") * 100).cast("bigint")), F.lit(130)).cast("double").alias("prcp"),
        (F.avg("value") / 3).alias("wspd"), F.avg("value").alias("tavg"),
        (F.count_if(F.col("event_type") == "error") * 8).cast("double").alias("snow"),
    )
    month = F.add_months(F.lit(WEATHER_START).cast("date"), F.col("period"))
    return daily.select(
        month.alias("month"), F.concat(F.lit("LOC"), F.col("loc").cast("string")).alias("location_id"),
        choose(["PLANT", "PORT", "SUPPLIER_HUB"], F.col("loc")).alias("location_type"),
        "tavg", "tmin", "tmax", "prcp", "snow", "wspd",
    )


def weather_table(spark: SparkSession, d: str) -> DataFrame:
    return weather.weather_index(weather_obs(spark, d))


def country_payloads(spark: SparkSession, d: str) -> DataFrame:
    """One ``[meta, [record]]`` text per event."""
    events = read_parquet(spark, d, "events")
    record = F.to_json(F.struct(
        F.struct(F.concat(F.lit("C"), F.pmod("user_id", F.lit(7)).cast("string")).alias("id")).alias("country"),
        F.when(F.pmod("user_id", F.lit(2)) == 0, F.concat(F.lit("CT"), F.pmod("user_id", F.lit(7)).cast("string")))
        .otherwise("").alias("countryiso3code"),
        F.year(as_date(F.col("ts"))).cast("string").alias("date"),
        F.struct(F.col("event_type").alias("id"), F.concat(F.lit("Indicator "), "event_type").alias("value")).alias("indicator"),
        F.when(F.pmod("event_id", F.lit(3)) == 0, "  ").otherwise(" pct ").alias("unit"),
        F.get_json_object("props", "$.k").alias("value"),
    ))
    return events.select("event_id", F.concat(F.lit('[{"page":1},['), record, F.lit("]]")).alias("payload"))


# --- monthly tables --------------------------------------------------------------------
def demand_signals(spark: SparkSession, d: str, with_pivot=False) -> DataFrame:
    return signals.unified_demand_signals(
        prime=rollups.prime_monthly(award_actions(spark, d)),
        sub=rollups.subaward_monthly(
            subawards(spark, d, category=with_pivot).withColumn("sub_awardee_name", F.col("sub_awardee_key"))
            if with_pivot else
            subawards(spark, d, category=False).withColumns(
                {"sub_awardee_name": F.col("sub_awardee_key"), "subsystem_category": F.lit(None).cast("string")}),
            categories=PART_TYPES if with_pivot else (),
        ),
        geo=rollups.geo_risk_monthly(geo_risk(spark, d)),
        trade=signals.trade_signal(risk.trade_risk_index(trade_silver(spark, d))),
        commodity=rollups.commodity_pressure_monthly(price_table(spark, d)),
        weather=rollups.weather_monthly(weather_table(spark, d)),
    )


def stored_signals(spark: SparkSession, d: str) -> DataFrame:
    """The signal table written once, for queries that read it several times: the facts
    are then scanned once, as they are when a gold table is served."""
    return cut_lineage(demand_signals(spark, d))


def inventory_gold(signal_table: DataFrame) -> DataFrame:
    return inventory.inventory_table(signal_table)


def vendor_demand(spark: SparkSession, d: str) -> DataFrame:
    """Monthly spend per supplier with a risk index: many series at once."""
    awards = award_actions(spark, d)
    monthly = awards.groupBy(F.col("l_suppkey").alias("series"), month_of(F.col("action_date")).alias("month")).agg(
        F.sum("federal_action_obligation").alias("total_obligations_usd"), F.count("*").alias("actions"),
    )
    monthly = series_spine(monthly, series="series", zero=("total_obligations_usd", "actions"))
    return monthly.withColumns({
        "combined_risk_index": F.pmod("series", F.lit(60)).cast("double"),
        "risk_level": F.lit("MODERATE"),
        "fiscal_year": fiscal_year(F.col("month")),
        "fiscal_quarter": F.lit("Q1"),
    })


def type_demand(spark: SparkSession, d: str) -> DataFrame:
    """Monthly spend per part type with two exogenous columns."""
    lines = read_parquet(spark, d, "lineitem").join(
        read_parquet(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    monthly = lines.groupBy(F.col("p_type").alias("series"), month_of(F.col("l_shipdate")).alias("month")).agg(
        F.sum("l_extendedprice").alias("total_obligations_usd"),
        (F.avg("l_discount") * 100).alias("tariff_risk_index"),
        (F.avg("l_tax") * 100).alias("geo_risk_index"),
    )
    return series_spine(monthly, series="series", zero=("total_obligations_usd", "tariff_risk_index", "geo_risk_index"))


def forecasts(signal_table: DataFrame) -> dict:
    """Three deterministic forecast tables: the signals of a year before, scaled."""
    def table(factor, name):
        value = F.col("total_obligations_usd") * factor
        return signal_table.select(
            F.add_months("month", 12).alias("month"), value.alias("forecast_demand_usd"),
            (value * 0.85).alias("forecast_lower"), (value * 1.15).alias("forecast_upper"),
            F.lit(name).alias("model_type"),
        )
    return {"prophet": table(1.00, "PROPHET"), "arima": table(1.02, "SARIMAX"), "random_forest": table(0.97, "RANDOM_FOREST")}


def pressure_index(spark: SparkSession, d: str) -> DataFrame:
    """A monthly index between about -2 and 2 from order values."""
    orders = read_parquet(spark, d, "orders")
    monthly = orders.groupBy(month_of(F.col("o_orderdate")).alias("as_of_date")).agg(F.avg("o_totalprice").alias("v"))
    return monthly.select(F.lit("GSCPI").alias("indicator_code"), "as_of_date", (F.col("v") / 100000 - 2.5).alias("value"))


def macro_indicators(spark: SparkSession, d: str) -> DataFrame:
    """The pressure index, and mean order values per country of the customer, by month."""
    orders, customers = read_parquet(spark, d, "orders"), read_parquet(spark, d, "customer")
    by_country = orders.join(customers, orders.o_custkey == customers.c_custkey).groupBy(
        F.col("c_nationkey").cast("string").alias("country_code"), month_of(F.col("o_orderdate")).alias("as_of_date"),
    ).agg(F.avg("o_totalprice").alias("value")).select(F.lit("ORDERS").alias("indicator_code"), "country_code", "as_of_date", "value")
    return by_country.unionByName(pressure_index(spark, d).withColumn("country_code", F.lit("")))


def feature_importance(spark: SparkSession, d: str) -> DataFrame:
    """Importance per feature name; two names are unknown to the label table."""
    names = [*K.FEATURE_LABELS, "vendor_count_x", "award_rate"]
    parts = read_parquet(spark, d, "part")
    name = choose(names, F.col("p_partkey"))
    sums = parts.groupBy(name.alias("feature")).agg(F.sum(F.col("p_retailprice") * F.col("p_size")).alias("w"))
    total = sums.agg(F.sum("w")).scalar()
    return sums.select("feature", (F.col("w") / total).alias("importance"))


# --- text ---------------------------------------------------------------------------------
def notices(spark: SparkSession, d: str) -> DataFrame:
    """Documents as notices: the whole text, headed by a phrase per document."""
    docs = read_parquet(spark, d, "documents")
    phrase, kind = choose(NOTICE_PHRASES, F.col("doc_id")), choose(NOTICE_TYPES, F.col("doc_id"))
    return docs.select("doc_id", F.concat_ws(" ", phrase, "text").alias("title"), kind.alias("doc_type"))


def phrase_table(spark: SparkSession, d: str) -> DataFrame:
    """Keyword table: every two neighbouring words of the benchmark's items, long ones first, labelled by item."""
    items = read_parquet(spark, d, "benchmark").select("item_id", F.split(F.lower("text"), " ").alias("w"))
    pairs = F.transform(F.slice("w", 1, F.size("w") - 1), lambda word, i: F.concat(word, F.lit(" "), F.get("w", i + 1)))
    phrases = items.where(F.size("w") > 1).select("item_id", F.explode(pairs).alias("keyword"))
    return phrases.select((-F.length("keyword")).alias("priority"), "keyword", F.col("item_id").cast("string").alias("label"))


EXPECTED_TOOLS = [[], ["get_demand_forecast"], ["query_suppliers", "search_contracts"], ["detect_anomalies", "detect_trends"]]
ACTUAL_TOOLS = [["query_suppliers", "detect_trends"], ["get_demand_forecast", "query_suppliers"], []]
CATEGORIES = ["forecasting", "analysis", "scenarios", "intelligence", "executive", "multi-tool", "hallucination"]
DIFFICULTIES = ["easy", "medium", "hard"]
SPECIALS = ["should_express_uncertainty", "should_not_name_person", "", "", ""]


def evaluation_log(spark: SparkSession, d: str) -> DataFrame:
    """Each assistant turn with the user turn before it.  The self-join is on
    (conversation, turn), which is unique, so one huge conversation spreads out."""
    turns = read_parquet(spark, d, "conversations")
    said = turns.where(F.col("role") == "assistant").alias("a")
    asked = turns.where(F.col("role") == "user").alias("u")
    pairs = said.join(asked, (F.col("a.conv_id") == F.col("u.conv_id")) & (F.col("a.turn") == F.col("u.turn") + 1))
    conv, turn = F.col("a.conv_id"), F.col("a.turn")

    amount = (conv + 1) * 1000
    shown = F.when(F.pmod(conv, F.lit(3)) == 0, (amount * 11 / 10).cast("bigint")).otherwise(amount)
    actual = choose(ACTUAL_TOOLS, F.length("a.text"))
    tool_text = F.concat(F.col("u.text"), F.lit(" $"), amount.cast("string"))
    return pairs.select(
        F.concat(F.lit("run-"), turn.cast("string")).alias("run_id"),
        F.concat_ws("-", conv.cast("string"), turn.cast("string")).alias("prompt_id"),
        choose(CATEGORIES, conv).alias("category"), choose(DIFFICULTIES, conv).alias("difficulty"),
        F.col("u.text").alias("prompt"),
        F.concat(F.col("a.text"), F.lit(" $"), shown.cast("string")).alias("response"),
        choose(EXPECTED_TOOLS, conv).alias("expected_tools"), actual.alias("actual_tools"),
        F.when(F.size(actual) > 0, F.array(tool_text)).otherwise(F.array().cast("array<string>")).alias("tool_outputs"),
        F.slice(F.split("u.text", " "), 1, 2).alias("required_keywords"),
        F.array(F.lit("tion"), F.lit("xyzzy")).alias("banned_phrases"),
        choose(SPECIALS, conv).alias("special"),
        (F.length("a.text") / 100.0).alias("latency_seconds"),
        F.date_add(F.lit(EVENTS_START).cast("date"), turn.cast("int")).cast("timestamp").alias("timestamp"),
    )
