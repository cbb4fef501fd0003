"""Declared schemas, as struct types or DDL text.  Nothing is inferred: a column that happens to be all NULL
in one landing keeps its type."""

from __future__ import annotations

from pyspark.sql import types as T

from procurelytics import constants as K


INDICATOR = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("ingested_at", T.TimestampType(), False),
    T.StructField("as_of_date", T.DateType(), False),
    T.StructField("country_code", T.StringType(), False),
    T.StructField("indicator_code", T.StringType(), False),
    T.StructField("indicator_name", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("unit", T.StringType(), True),
    T.StructField("frequency", T.StringType(), False),
    T.StructField("raw_payload", T.StringType(), True),
])
INDICATOR_KEYS = ["source", "indicator_code", "country_code", "as_of_date"]


def _payload(fields) -> T.StructType:
    names = list(dict.fromkeys(f for f in fields if f))
    return T.StructType([
        T.StructField(n, T.DoubleType() if n in K.NUMERIC_FIELDS else T.StringType()) for n in names
    ])


AWARD_RESULT = _payload(K.AWARD_FIELDS)
CONTRACT_RESULT = _payload(K.CONTRACT_FIELDS.values())
SUBAWARD_RESULT = _payload(K.SUBAWARD_FIELDS.values())


def page_of(result: T.StructType) -> T.StructType:
    """A landed response page: ``{"results": [ ... ]}``."""
    return T.StructType([T.StructField("results", T.ArrayType(result))])


ENTITY = (
    "entityRegistration:struct<ueiSAM:string,cageCode:string,legalBusinessName:string,dbaName:string,"
    "registrationDate:string,registrationExpirationDate:string,activationDate:string,businessTypes:array<string>>,"
    "coreData:struct<physicalAddress:struct<addressLine1:string,city:string,stateOrProvinceCode:string,"
    "zipCode:string,countryCode:string>,entityInformation:struct<primaryNaics:string,"
    "entityStructureDesc:string,organizationStructureDesc:string>>"
)
ENTITY_PAGE = "naics string, page int, entityData array<struct<" + ENTITY + ">>"
COUNTRY_RECORD = (
    "country struct<id:string,value:string>, countryiso3code string, date string, "
    "indicator struct<id:string,value:string>, unit string, value string"
)
NOTICE_PAGE = (
    "term_position int, page int, results array<struct<document_number:string,title:string,abstract:string,"
    "type:string,publication_date:string,agencies:array<struct<name:string>>>>"
)
WEATHER_OBSERVATION = (
    "month string, location_id string, tavg double, tmin double, tmax double, prcp double, "
    "snow double, wdir double, wspd double, pres double"
)
SUPPLIER_LOCATION = (
    "supplier_name string, uei string, cage_code string, city string, state string, country string, "
    "lat double, lon double, region_group string, distance_to_hq_km double, subsystem_category string, "
    "company_size string, naics_code_primary string"
)
EVALUATION_LOG = (
    "run_id string, prompt_id string, category string, difficulty string, prompt string, response string, "
    "expected_tools array<string>, actual_tools array<string>, tool_outputs array<string>, "
    "required_keywords array<string>, banned_phrases array<string>, special string, "
    "latency_seconds double, timestamp timestamp"
)

TEST_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "benchmark": "item_id bigint, text string",
}
