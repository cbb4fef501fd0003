"""Landed payloads (JSON pages, delimited files) to typed rows."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, functions as F

from procurelytics import constants as K
from procurelytics.functions import dates, text as tx
from procurelytics.functions.bands import ladder, lookup
from procurelytics.sources import schemas


# --- spending pages -----------------------------------------------------------
def _results(pages: DataFrame) -> DataFrame:
    return pages.select(F.explode("results").alias("r"))


def _null_column(name: str) -> Column:
    return F.lit(None).cast("double" if name in K.NUMERIC_COLUMNS else "string").alias(name)


def _by_field_table(pages: DataFrame, fields: dict) -> list[Column]:
    return [
        _null_column(column) if field is None else F.col("r").getField(field).alias(column)
        for column, field in fields.items()
    ]


def normalize_awards(pages: DataFrame) -> DataFrame:
    """Award pages to award rows.  The action date is the start date; the fiscal
    year follows from its first ten characters; fields the pages lack are NULL."""
    start = F.col("r").getField("Start Date")
    return _results(pages).select(
        *[F.col("r").getField(field).alias(column) for field, column in K.AWARD_FIELDS.items()],
        start.alias("action_date"),
        F.col("r").getField("Total Obligation").alias("total_dollars_obligated"),
        dates.fiscal_year(F.substring(start, 1, 10)).alias("fiscal_year"),
        *[_null_column(name) for name in K.AWARD_NULL_FIELDS],
    )


def normalize_contracts(pages: DataFrame) -> DataFrame:
    """Award pages to contract rows under the contract column names."""
    return _results(pages).select(
        *_by_field_table(pages, K.CONTRACT_FIELDS),
        dates.fiscal_year(F.col("r").getField("Start Date")).alias("fiscal_year"),
    )


def rename_contract_export(export: DataFrame) -> DataFrame:
    """Rename the columns of a contract export file in one projection."""
    return export.withColumnsRenamed(K.CONTRACT_EXPORT_RENAMES)


def normalize_subawards(pages: DataFrame, supplier_subsystem: dict | None = None) -> DataFrame:
    """Sub-award pages to sub-award rows.  The pages carry no subsystem, so it is
    NULL unless a ``supplier name -> subsystem`` table is given."""
    rows = _results(pages).select(
        *_by_field_table(pages, K.SUBAWARD_FIELDS),
        dates.fiscal_year(F.col("r").getField("Sub-Award Date")).alias("subaward_action_date_fiscal_year"),
    )
    if not supplier_subsystem:
        return rows
    return rows.withColumn("subsystem_category", lookup(F.upper("sub_awardee_name"), supplier_subsystem))


# --- entities -------------------------------------------------------------------
def company_size(business_types: Column) -> Column:
    """SMALL before LARGE, else MEDIUM; NULL or empty stays NULL."""
    lowered = F.lower(business_types)
    size = ladder([(lowered.contains("small"), "SMALL"), (lowered.contains("large"), "LARGE")], "MEDIUM")
    return F.when(F.length(business_types) > 0, size)


def flatten_entities(pages: DataFrame) -> DataFrame:
    """Entity pages (three levels of nesting) to one row per entity; the first
    page that shows an entity wins."""
    rows = pages.select("naics", "page", F.posexplode("entityData").alias("position", "e"))
    reg, core = F.col("e.entityRegistration"), F.col("e.coreData")
    address, info = core["physicalAddress"], core["entityInformation"]
    naics = F.coalesce(info["primaryNaics"], F.col("naics"))
    types = F.array_join(reg["businessTypes"], ", ")
    flat = rows.select(
        reg["ueiSAM"].alias("uei"),
        reg["cageCode"].alias("cage_code"),
        reg["legalBusinessName"].alias("legal_business_name"),
        reg["dbaName"].alias("dba_name"),
        address["addressLine1"].alias("physical_address_line_1"),
        address["city"].alias("physical_address_city"),
        address["stateOrProvinceCode"].alias("physical_address_state_or_province"),
        address["zipCode"].alias("physical_address_zip_postal_code"),
        address["countryCode"].alias("physical_address_country_code"),
        reg["registrationDate"].alias("entity_start_date"),
        reg["registrationExpirationDate"].alias("entity_expiration_date"),
        reg["activationDate"].alias("activation_date"),
        types.alias("business_type"),
        info["entityStructureDesc"].alias("entity_structure"),
        info["organizationStructureDesc"].alias("organization_type"),
        naics.alias("naics_code_primary"),
        lookup(naics, K.NAICS_SUBSYSTEM, "OTHER").alias("subsystem_category"),
        company_size(types).alias("company_size"),
        F.lit("A").alias("sam_extract_code"),
        "naics", "page", "position",
    )
    known = flat.where(F.length("uei") > 0)
    return dedupe_first(known, ["uei"], ["naics", "page", "position"]).drop("naics", "page", "position")


# --- indicators ------------------------------------------------------------------
def indicator_row(*, source, as_of_date, indicator_code, indicator_name, value, frequency,
                  country_code=None, unit=None, raw_payload=None, ingested_at=None) -> list[Column]:
    """The ten columns every indicator table shares.  A missing country is ``''``."""
    def col(v, kind="string"):
        return v if isinstance(v, Column) else F.lit(v).cast(kind)

    return [
        col(source).alias("source"),
        (F.current_timestamp() if ingested_at is None else col(ingested_at, "timestamp")).alias("ingested_at"),
        as_of_date.alias("as_of_date"),
        F.coalesce(col(country_code), F.lit("")).alias("country_code"),
        col(indicator_code).alias("indicator_code"),
        col(indicator_name).alias("indicator_name"),
        value.try_cast("double").alias("value"),
        col(unit).alias("unit"),
        col(frequency).alias("frequency"),
        col(raw_payload).alias("raw_payload"),
    ]


def _present(value: Column) -> Column:
    """Blank text counts as missing."""
    return F.when(F.length(F.trim(value)) > 0, value)


def normalize_country_indicators(payloads: DataFrame, payload_col: str, source: str, *, ingested_at=None) -> DataFrame:
    """``[meta, [record, ...]]`` texts, one per response, to indicator rows.  Records
    without a usable date or number are dropped; the record is kept as JSON."""
    data = F.get_json_object(payload_col, "$[1]")
    records = payloads.select(F.explode(F.from_json(data, "array<string>")).alias("raw"))
    rec = records.select("raw", F.from_json("raw", schemas.COUNTRY_RECORD).alias("r"))
    as_of = F.concat(F.col("r.date"), F.lit("-01-01")).try_cast("date")
    rows = rec.select(*indicator_row(
        source=source,
        ingested_at=ingested_at,
        as_of_date=as_of,
        country_code=F.coalesce(_present(F.col("r.countryiso3code")), _present(F.col("r.country.id"))),
        indicator_code=F.col("r.indicator.id"),
        indicator_name=F.col("r.indicator.value"),
        value=F.col("r.value"),
        unit=F.trim(_present(F.col("r.unit"))),
        frequency="annual",
        raw_payload=F.col("raw"),
    ))
    return rows.where(F.col("value").isNotNull() & F.col("as_of_date").isNotNull())


def first_present(df: DataFrame, names) -> Column:
    """The first non-blank of those columns of ``names`` that the file has."""
    found = [_present(F.col(f"`{n}`").cast("string")) for n in names if n in df.columns]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def sniff_delimiter(header: str) -> str:
    """Tab if the header line holds one, else comma."""
    return "\t" if "\t" in header else ","


def header_lines(lines: DataFrame) -> DataFrame:
    """(file, header): the first line with text of each file that has one."""
    first = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    first = first.withColumn("at", F.struct("start", F.monotonically_increasing_id().alias("row")))
    return first.where(F.length(F.trim("value")) > 0).groupBy("file").agg(F.min_by("value", "at").alias("header"))


def read_delimited(spark, path: str) -> DataFrame:
    """A delimited file, or a folder of them, with headers, every column as text.  Each file has the
    delimiter and the columns of its own header line; columns are joined by name."""
    lines = spark.read.text(path)
    # one row: the names of the files, which the driver lists anyway, by header line
    by_header = header_lines(lines).groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
    found = by_header.agg(F.sort_array(F.collect_list(F.struct("files", "header"))).alias("all")).head(1)[0]["all"]
    if not found:
        return spark.read.csv(path, header=True, inferSchema=False)
    groups = {g["header"]: [re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(f)) for f in g["files"]] for g in found}
    base = {"basePath": path} if len(lines.columns) > 1 else {}  # folders named column=value
    parts = [spark.read.options(**base).csv(files, header=True, sep=sniff_delimiter(header), inferSchema=False) for header, files in groups.items()]
    parts = [part.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in part.columns]) for part in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def normalize_index_file(rows: DataFrame, *, source: str, code: str, name: str, unit="index",
                         frequency="monthly", ingested_at=None,
                         date_names=("Date", "date", "Month"),
                         value_names=("GSCPI", "gscpi", "Value", "value"),
                         parse=dates.parse_index_date) -> DataFrame:
    """Rows of an index file whose headers vary by release, to indicator rows."""
    period, value = first_present(rows, date_names), first_present(rows, value_names)
    payload = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))
    out = rows.select(*indicator_row(
        source=source, ingested_at=ingested_at, as_of_date=parse(period), indicator_code=code,
        indicator_name=name, value=value, unit=unit, frequency=frequency, raw_payload=payload,
    ))
    return out.where(F.col("value").isNotNull() & F.col("as_of_date").isNotNull())


def normalize_quarterly_index(rows: DataFrame, *, source: str, code: str, name: str, ingested_at=None) -> DataFrame:
    """A quarterly barometer file: several header spellings, ``2024Q1`` periods."""
    return normalize_index_file(
        rows, source=source, code=code, name=name, frequency="quarterly", ingested_at=ingested_at,
        date_names=("Period", "period", "Date", "date", "Time Period"),
        value_names=("Value", "value", "Barometer", "barometer"),
        parse=dates.parse_quarter_period,
    )


def normalize_price_file(rows: DataFrame, *, source: str, ingested_at=None) -> DataFrame:
    """A commodity price file with one code per row and ``YYYYMM`` periods."""
    code = F.coalesce(first_present(rows, ("Commodity", "Indicator", "indicator")), F.lit("UNKNOWN"))
    label = F.coalesce(
        first_present(rows, ("Commodity Name", "Indicator Name", "indicator_name")),
        first_present(rows, ("Commodity", "Indicator", "indicator")), F.lit("Commodity"),
    )
    payload = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))
    out = rows.select(*indicator_row(
        source=source, ingested_at=ingested_at,
        as_of_date=dates.parse_compact_period(first_present(rows, ("Period", "Date", "date", "Time Period"))),
        indicator_code=code, indicator_name=label,
        value=first_present(rows, ("Value", "value")), unit=first_present(rows, ("Unit", "unit")),
        frequency="monthly", raw_payload=payload,
    ))
    return out.where(F.col("value").isNotNull() & F.col("as_of_date").isNotNull())


def month_end_last(df: DataFrame, keys, ts: str, value: str, ties=()) -> DataFrame:
    """Last value of each month per key, dated at the month's end.  ``ties`` orders
    rows of the same ``ts``.  One partial aggregate, so a hot key shrinks before
    the shuffle to one row per task and month."""
    day = dates.as_date(F.col(ts))
    order = F.struct(F.col(ts), *[F.col(t) for t in ties])
    return (
        df.groupBy(*keys, F.last_day(day).alias("as_of_date"))
        .agg(F.max_by(value, order).alias("value"))
    )


# --- weather, notices -------------------------------------------------------------
def normalize_weather(observations: DataFrame, locations: DataFrame) -> DataFrame:
    """Observations with the name, place and type of their location.  Catalyst
    broadcasts the location table if its size allows."""
    return observations.join(locations, "location_id", "inner").select(
        "month", "location_id", "location_name", "city", "state", "lat", "lon", "location_type",
        "tavg", "tmin", "tmax", "prcp", "snow", "wdir", "wspd", "pres",
    )


def dedupe_first(df: DataFrame, keys, order) -> DataFrame:
    """First row per key in ``order``.  ``min_by`` combines on the map side, so a key
    with a huge number of copies never gathers in one task."""
    order = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("first")
    return df.groupBy(*keys).agg(first).select(*keys, "first.*").select(*df.columns)


def extract_country(df: DataFrame, text_col: str, *, names=None, watched=None, word_boundary=False) -> DataFrame:
    """Adds ``country_code`` and ``country_name`` by the first listed name that the
    text holds; a watched country has its own name, any other the matched word."""
    names = K.COUNTRY_NAMES if names is None else names
    watched = K.WATCHED_COUNTRIES if watched is None else watched
    word = tx.first_name_in(F.col(text_col), names, word_boundary)
    found = df.withColumn("_word", word).withColumn("country_code", lookup(F.col("_word"), names))
    return found.withColumn(
        "country_name", F.coalesce(lookup(F.col("country_code"), watched), F.upper("_word"))
    ).drop("_word")


def extract_hts(df: DataFrame, text_col: str, *, codes=None) -> DataFrame:
    """Adds ``hts_code`` (first listed four-digit token, else ``0000``) and its description."""
    codes = K.HTS_DESCRIPTIONS if codes is None else codes
    found = df.withColumn("hts_code", tx.first_listed_code(F.col(text_col), list(codes), K.HTS_FALLBACK))
    return found.withColumn("hts_description", lookup(F.col("hts_code"), codes, ""))


def classify_events(df: DataFrame, title_col: str, *, rules=None, word_boundary=False) -> DataFrame:
    rules = K.EVENT_RULES if rules is None else rules
    return df.withColumn(
        "event_type", tx.label_by_keywords(F.col(title_col), rules, K.DEFAULT_EVENT_TYPE, word_boundary)
    )


def severity_score(df: DataFrame, type_col: str, *, jitter: float = 0.0, id_col: str | None = None) -> DataFrame:
    """Severity and impact by document type: RULE is HIGH 70, a proposed rule
    ELEVATED 50, any other MODERATE 30.  ``jitter`` spreads the impact by a hash of
    ``id_col``, so a rerun gives the same score."""
    kind = F.upper(F.coalesce(F.col(type_col), F.lit("")))
    impact = lookup(kind, K.NOTICE_IMPACT, 30).cast("double")
    if jitter:
        impact = impact + (F.pmod(F.xxhash64(id_col), F.lit(2001)) / 1000.0 - 1.0) * jitter
    return df.withColumns({
        "severity": lookup(kind, K.NOTICE_SEVERITY, "MODERATE"),
        "impact_score": F.round(impact, 2),
    })


def normalize_notices(pages: DataFrame, *, jitter=0.0, word_boundary=False) -> DataFrame:
    """Notice pages of several search terms to trade events, one per document: the
    first term and page that shows a document wins.  All rules read whole texts."""
    docs = pages.select("term_position", "page", F.posexplode("results").alias("position", "d"))
    docs = docs.where(F.length("d.document_number") > 0).select(
        F.col("d.document_number").alias("policy_reference"), "term_position", "page", "position", "d",
    )
    docs = dedupe_first(docs, ["policy_reference"], ["term_position", "page", "position"])
    flat = docs.select(
        "policy_reference",
        F.coalesce("d.title", F.lit("")).alias("title"),
        F.coalesce("d.abstract", F.lit("")).alias("abstract"),
        F.coalesce("d.type", F.lit("NOTICE")).alias("doc_type"),
        F.col("d.publication_date").alias("event_date"),
        F.coalesce(F.try_element_at("d.agencies", F.lit(1))["name"], F.lit("UNKNOWN")).alias("source"),
    ).withColumn("all_text", F.concat_ws(" ", "title", "abstract"))
    flat = classify_events(flat, "title", word_boundary=word_boundary)
    flat = extract_country(flat, "all_text", word_boundary=word_boundary)
    flat = extract_hts(flat, "all_text")
    flat = severity_score(flat, "doc_type", jitter=jitter, id_col="policy_reference")
    none = F.lit(None)
    return flat.select(
        F.concat(F.lit("FR-"), "policy_reference").alias("event_id"), "event_date", "event_type",
        "country_code", "country_name", "hts_code", "hts_description",
        none.cast("double").alias("previous_tariff_rate"), none.cast("double").alias("new_tariff_rate"),
        F.lit(0.0).alias("rate_change_pct"), F.col("event_date").alias("effective_date"),
        none.cast("string").alias("expiration_date"), "severity", "impact_score",
        none.cast("double").alias("affected_value_usd"), "source",
        F.coalesce(_present(F.col("abstract")), _present(F.col("title"))).alias("description"),
        "policy_reference",
    )
