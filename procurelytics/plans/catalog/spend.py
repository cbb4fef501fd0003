"""Spend roll-ups, search and top lists."""

from pyspark.sql import functions as F

from procurelytics.operators import ordering, ranking, rollups, search
from procurelytics.plans import bindings as B
from procurelytics.plans.catalog import views as V
from procurelytics.plans.registry import query, shown, sql
from procurelytics.functions import dates



@query("prime_monthly", sql("prime_m", "SELECT * FROM prime_m", ints="prime_action_count unique_awards",
                            doubles="prime_obligations_usd avg_obligation_per_action"))
def prime_monthly(spark, d):
    return shown(rollups.prime_monthly(B.award_actions(spark, d)))


@query("subaward_monthly", sql("sub_m", "SELECT month, subaward_obligations_usd, subaward_count, unique_suppliers FROM sub_m",
                               ints="subaward_count unique_suppliers", doubles="subaward_obligations_usd"))
def subaward_monthly(spark, d):
    return shown(rollups.subaward_monthly(B.subawards(spark, d, supplier=True, category=False)))


PIVOT = " ".join(f"subsystem_{t.lower()}_usd" for t in B.PART_TYPES)


@query("subaward_pivot", sql("sub_m", f"SELECT month, {', '.join(PIVOT.split())} FROM sub_m", doubles=PIVOT))
def subaward_pivot(spark, d):
    rows = B.subawards(spark, d)
    return shown(rollups.pivot_monthly(rows, "subaward_action_date", "subsystem_category", "subaward_amount", B.PART_TYPES))


@query("by_fiscal_year", sql("award_actions", f"""
SELECT {V.fy('action_date')} AS fiscal_year, count(*) AS record_count, sum(federal_action_obligation) AS total_obligations,
       avg(federal_action_obligation) AS avg_obligation FROM award_actions GROUP BY 1""",
                             ints="fiscal_year record_count", doubles="total_obligations avg_obligation", total_obligations=2))
def by_fiscal_year(spark, d):
    rows = B.award_actions(spark, d).withColumn("fiscal_year", dates.fiscal_year(F.col("action_date")))
    amount = F.col("federal_action_obligation")
    out = rollups.group_summary(rows, "fiscal_year", {
        "record_count": F.count("*"), "total_obligations": F.sum(amount), "avg_obligation": F.avg(amount),
    }, order=["fiscal_year"])
    return shown(out, total_obligations=2)


@query("top_vendors", sql("contracts", """
SELECT vendor_name, count(*) AS contract_count, sum(obligated_amount) AS total_obligated, avg(obligated_amount) AS avg_obligated
FROM contracts GROUP BY 1 ORDER BY total_obligated DESC, vendor_name LIMIT 15""",
                          ints="contract_count", doubles="total_obligated avg_obligated"))
def top_vendors(spark, d):
    amount = F.col("obligated_amount")
    return shown(rollups.group_summary(B.contracts(spark, d), "vendor_name", {
        "contract_count": F.count("*"), "total_obligated": F.sum(amount), "avg_obligated": F.avg(amount),
    }, order=[F.col("total_obligated").desc(), "vendor_name"], limit=15))


@query("top_psc", sql("award_actions", """
SELECT product_or_service_code, count(*) AS record_count, sum(federal_action_obligation) AS total_obligations
FROM award_actions GROUP BY 1 ORDER BY total_obligations DESC, product_or_service_code LIMIT 10""",
                      ints="record_count", doubles="total_obligations", digits=2))
def top_psc(spark, d):
    out = rollups.group_summary(B.award_actions(spark, d, psc=True), "product_or_service_code", {
        "record_count": F.count("*"), "total_obligations": F.sum("federal_action_obligation"),
    }, order=[F.col("total_obligations").desc(), "product_or_service_code"], limit=10)
    return shown(out, digits=2)


@query("top_suppliers", sql("subawards", """
SELECT sub_awardee_name, subsystem_category, count(*) AS subaward_count, sum(subaward_amount) AS total_subaward_amount,
       avg(subaward_amount) AS avg_subaward_amount FROM subawards GROUP BY 1, 2
ORDER BY total_subaward_amount DESC, sub_awardee_name, subsystem_category LIMIT 20""",
                            ints="subaward_count", doubles="total_subaward_amount avg_subaward_amount"))
def top_suppliers(spark, d):
    amount = F.col("subaward_amount")
    return shown(rollups.group_summary(B.subawards(spark, d, supplier=True), ["sub_awardee_name", "subsystem_category"], {
        "subaward_count": F.count("*"), "total_subaward_amount": F.sum(amount), "avg_subaward_amount": F.avg(amount),
    }, order=[F.col("total_subaward_amount").desc(), "sub_awardee_name", "subsystem_category"], limit=20))


@query("by_subsystem", sql("subawards", """
SELECT subsystem_category, count(*) AS subaward_count, sum(subaward_amount) AS total_amount,
       count(DISTINCT sub_awardee_name) AS unique_suppliers FROM subawards GROUP BY 1""",
                           ints="subaward_count unique_suppliers", doubles="total_amount", digits=2))
def by_subsystem(spark, d):
    out = rollups.group_summary(B.subawards(spark, d, supplier=True), "subsystem_category", {
        "subaward_count": F.count("*"), "total_amount": F.sum("subaward_amount"), "unique_suppliers": F.count_distinct("sub_awardee_name"),
    }, order=[F.col("total_amount").desc(), "subsystem_category"])
    return shown(out, digits=2)


@query("geo_distribution", sql("subawards", """
SELECT sub_awardee_state, sub_awardee_country, count(*) AS subaward_count, sum(subaward_amount) AS total_amount,
       count(DISTINCT sub_awardee_name) AS unique_suppliers FROM subawards GROUP BY 1, 2
ORDER BY total_amount DESC, sub_awardee_state, sub_awardee_country LIMIT 15""",
                               ints="subaward_count unique_suppliers", doubles="total_amount", digits=2))
def geo_distribution(spark, d):
    out = rollups.group_summary(
        B.subawards(spark, d, supplier=True, place=True, category=False), ["sub_awardee_state", "sub_awardee_country"], {
            "subaward_count": F.count("*"), "total_amount": F.sum("subaward_amount"), "unique_suppliers": F.count_distinct("sub_awardee_name"),
        }, order=[F.col("total_amount").desc(), "sub_awardee_state", "sub_awardee_country"], limit=15)
    return shown(out, digits=2)


# --- search ----------------------------------------------------------------------------
@query("filter_name_variants", sql("award_actions", """
SELECT recipient_name, count(*) AS record_count, sum(federal_action_obligation) AS total_obligations FROM award_actions
WHERE regexp_matches(lower(recipient_name), '0{6}7|00[12]$|#0+4') GROUP BY 1""",
                                   ints="record_count", doubles="total_obligations", digits=2))
def filter_name_variants(spark, d):
    rows = search.filter_name_variants(B.award_actions(spark, d, vendor=True), "recipient_name", ["0{6}7", "00[12]$", "#0+4"], regex=True)
    out = rollups.group_summary(rows, "recipient_name", {"record_count": F.count("*"), "total_obligations": F.sum("federal_action_obligation")})
    return shown(out, digits=2)


@query("search_suppliers", sql("suppliers", """
SELECT supplier_name, uei, state, subsystem_category, company_size, distance_to_hq_km, total_matches FROM (
SELECT *, count(*) OVER () AS total_matches FROM suppliers
WHERE contains(lower(supplier_name), 'supplier#0000') AND contains(lower(subsystem_category), 'arm') AND contains(lower(company_size), 'small'))
ORDER BY supplier_name, uei LIMIT 15""", ints="total_matches", doubles="distance_to_hq_km"))
def search_suppliers(spark, d):
    out = search.search_suppliers(B.supplier_locations(spark, d), name="SUPPLIER#0000", subsystem="arm", size="small")
    return shown(out, "supplier_name", "uei", "state", "subsystem_category", "company_size", "distance_to_hq_km", "total_matches")


@query("supplier_summary", sql("suppliers", """
SELECT facet, value, suppliers, total_matches, small * 100.0 / total_matches AS small_business_pct, region_count FROM (
  SELECT 'size' AS facet, company_size AS value, count(*) AS suppliers FROM suppliers GROUP BY 2
  UNION ALL SELECT 'region', region_group, count(*) FROM suppliers GROUP BY 2)
CROSS JOIN (SELECT count(*) AS total_matches, sum(CASE WHEN company_size = 'SMALL' THEN 1 ELSE 0 END) AS small,
                   count(DISTINCT region_group) AS region_count FROM suppliers)""",
                               ints="suppliers total_matches region_count", doubles="small_business_pct"))
def supplier_summary(spark, d):
    return shown(search.supplier_summary(B.supplier_locations(spark, d)))


@query("search_contracts", sql("contracts", """
SELECT *, sum(obligated_amount) OVER () AS value_shown FROM (
SELECT *, count(*) OVER () AS total_matches FROM contracts
WHERE contains(lower(vendor_name), 'customer') AND starts_with(psc_code, 'MA') AND fiscal_year = 1998 AND obligated_amount >= 100000
ORDER BY obligated_amount DESC, contract_id LIMIT 15)""",
                               ints="contract_id fiscal_year total_matches", doubles="obligated_amount value_shown"))
def search_contracts(spark, d):
    rows = B.contracts(spark, d).withColumn("obligated_amount", F.col("obligated_amount").cast("string"))
    return shown(search.search_contracts(rows, vendor="customer", psc="MA", fiscal_year=1998, min_amount=100000))


@query("latest_period", sql("contracts", """
SELECT * FROM contracts WHERE fiscal_year = (SELECT max(fiscal_year) FROM contracts) AND psc_code = 'MACHINERY'""",
                            ints="contract_id fiscal_year", doubles="obligated_amount"))
def latest_period(spark, d):
    return shown(ranking.latest_period(B.contracts(spark, d), "fiscal_year", F.col("psc_code") == "MACHINERY"))


@query("last_months", sql("contracts", """
SELECT psc_code, count(*) AS contract_count, sum(obligated_amount) AS total_obligated FROM contracts
WHERE effective_date >= DATE '2000-08-01' GROUP BY 1""", ints="contract_count", doubles="total_obligated"))
def last_months(spark, d):
    rows = ranking.last_months(B.contracts(spark, d), "effective_date", 12, B.as_of())
    return shown(rollups.group_summary(rows, "psc_code", {"contract_count": F.count("*"), "total_obligated": F.sum("obligated_amount")}))


# --- places in the order of the whole table ---------------------------------------------
@query("award_percent_rank", sql("contracts", """
SELECT contract_id, obligated_amount, rank() OVER w AS rank, percent_rank() OVER w * 25 AS rank_points
FROM contracts WINDOW w AS (ORDER BY obligated_amount)""", ints="rank", doubles="obligated_amount rank_points"))
def award_percent_rank(spark, d):
    rows = ordering.in_order(B.contracts(spark, d).select("contract_id", "obligated_amount"), "obligated_amount")
    return shown(rows.withColumn("rank_points", ordering.percent_rank(rows) * 25), "contract_id", "obligated_amount", "rank", "rank_points")


@query("award_running_share", sql("contracts", """
SELECT contract_id, psc_code, row_number() OVER w AS position, sum(obligated_amount) OVER (w ROWS UNBOUNDED PRECEDING) / sum(obligated_amount) OVER (PARTITION BY psc_code) * 100 AS cumulative_pct
FROM contracts WINDOW w AS (PARTITION BY psc_code ORDER BY obligated_amount DESC, contract_id)""", ints="position", doubles="cumulative_pct"))
def award_running_share(spark, d):
    rows = B.contracts(spark, d).select("contract_id", "psc_code", "obligated_amount")
    out = ordering.in_order(rows, [F.col("obligated_amount").desc(), F.col("contract_id")], by="psc_code", running=["obligated_amount"])
    share = F.try_divide(F.col("running_obligated_amount"), F.col("total_obligated_amount")) * 100
    return shown(out.withColumn("cumulative_pct", share), "contract_id", "psc_code", "position", "cumulative_pct")
