"""Stand-in views over the driver's tables.

No inspection data ships with the tests, so the inspection log, entity
attributes and requests are derived from the TPC-H-like tables (mapping in
DuckDB SQL CTE for the oracle.  Both read the whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REFERENCE_DATE = "2002-01-01"

TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Order of source rows: five lineitem columns make it unique (l_orderkey,
# l_linenumber alone is not).
RID_PARTS = ["o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def _lat(key):
    return F.lit(40.477) + ((key * F.lit(7919)) % F.lit(4429) + F.lit(0.5)) / F.lit(10000.0)


def _lng(key):
    return F.lit(-74.26) + ((key * F.lit(7927)) % F.lit(5609) + F.lit(0.5)) / F.lit(10000.0)


def entity_coordinates(key_col):
    """Synthetic but deterministic coordinates inside the city grid."""
    return _lat(key_col), _lng(key_col)


def inspection_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (order, line): a violation-level log keyed by customer.

    Every row of the joined tables is kept.  The ``o_orderkey % k``
    expressions below never filter rows: they deterministically blank a
    value (score, phone, street) so that missing-value handling is
    """
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_returnflag")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey",
                                                "c_mktsegment")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    log = (o.join(li, o.o_orderkey == li.l_orderkey, "left")
           .join(c, o.o_custkey == c.c_custkey, "left")
           .join(n, c.c_nationkey == n.n_nationkey, "left")
           .join(r, n.n_regionkey == r.r_regionkey, "left"))
    grade = (F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
             .otherwise(F.when(F.col("o_orderstatus") == "F", "A")
                        .when(F.col("o_orderstatus") == "O", "B")
                        .when(F.col("o_orderstatus") == "P", "C")))
    lat, lng = entity_coordinates(F.col("c_custkey"))
    idate = F.col("o_orderdate").cast("date")
    return log.select(
        F.col("o_custkey").alias("camis"),
        F.col("c_name").alias("dba"),
        F.initcap(F.col("r_name")).alias("boro"),
        F.col("o_orderkey").cast("string").alias("building"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(None))
         .otherwise(F.concat(F.lit("Street "), (F.col("o_orderkey") % 50).cast("string")))
         .alias("street"),
        (F.lit(10000) + F.col("c_nationkey")).cast("double").alias("zipcode"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(None))
         .otherwise(F.concat(F.lit("555-"), F.col("o_orderkey").cast("string"))).alias("phone"),
        F.initcap(F.col("c_mktsegment")).alias("cuisine"),
        idate.alias("inspection_date"),
        F.col("o_orderpriority").alias("action"),
        F.concat(F.col("l_returnflag"), F.col("l_linenumber").cast("string")).alias("violation_code"),
        F.concat(F.lit("flag "), F.col("l_returnflag")).alias("violation_description"),
        F.when(F.col("l_returnflag") == "A", "Critical")
         .when(F.col("l_returnflag") == "N", "Not Critical")
         .when(F.col("l_returnflag") == "R", "Not Applicable").alias("critical_flag"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit(None).cast("double"))
         .otherwise(F.floor(F.col("o_totalprice") / F.lit(10000.0)).cast("double")).alias("score"),
        grade.alias("grade"),
        F.when(grade.isNotNull(), idate).alias("grade_date"),
        F.concat(F.lit("Type "), F.col("o_orderstatus")).alias("inspection_type"),
        lat.alias("latitude"), lng.alias("longitude"),
        F.col("n_name").alias("nta"),
        F.col("c_nationkey").cast("double").alias("community_board"),
        F.col("n_regionkey").cast("double").alias("council_district"),
        F.concat(F.lit("POINT "), F.col("c_custkey").cast("string")).alias("location"),
        F.struct(*[F.col(p) for p in RID_PARTS]).alias("rid"),
    )


# --- the same view in DuckDB SQL --------------------------------------------

def _sql_lat(k: str) -> str:
    return (f"(CAST(40.477 AS DOUBLE) + (CAST(({k} * 7919) % 4429 AS DOUBLE) + CAST(0.5 AS DOUBLE))"
            f" / CAST(10000.0 AS DOUBLE))")


def _sql_lng(k: str) -> str:
    return (f"(CAST(-74.26 AS DOUBLE) + (CAST(({k} * 7927) % 5609 AS DOUBLE) + CAST(0.5 AS DOUBLE))"
            f" / CAST(10000.0 AS DOUBLE))")


INSPECTION_LOG_SQL = f"""
log AS (
  SELECT o.o_custkey AS camis,
         c.c_name AS dba,
         CASE WHEN r.r_name IS NULL THEN NULL
              ELSE upper(substr(r.r_name, 1, 1)) || lower(substr(r.r_name, 2)) END AS boro_raw,
         CAST(o.o_orderkey AS VARCHAR) AS building,
         CASE WHEN o.o_orderkey % 7 = 0 THEN NULL
              ELSE 'Street ' || CAST(o.o_orderkey % 50 AS VARCHAR) END AS street,
         CAST(10000 + c.c_nationkey AS DOUBLE) AS zipcode,
         CASE WHEN o.o_orderkey % 3 = 0 THEN NULL
              ELSE '555-' || CAST(o.o_orderkey AS VARCHAR) END AS phone,
         upper(substr(c.c_mktsegment, 1, 1)) || lower(substr(c.c_mktsegment, 2)) AS cuisine,
         CAST(o.o_orderdate AS DATE) AS inspection_date,
         o.o_orderpriority AS action,
         l.l_returnflag || CAST(l.l_linenumber AS VARCHAR) AS violation_code,
         'flag ' || l.l_returnflag AS violation_description,
         CASE l.l_returnflag WHEN 'A' THEN 'Critical' WHEN 'N' THEN 'Not Critical'
              WHEN 'R' THEN 'Not Applicable' END AS critical_flag,
         CASE WHEN o.o_orderkey % 11 = 0 THEN NULL
              ELSE CAST(floor(o.o_totalprice / CAST(10000.0 AS DOUBLE)) AS DOUBLE) END AS score,
         CASE WHEN o.o_orderpriority = '5-LOW' THEN NULL
              WHEN o.o_orderstatus = 'F' THEN 'A' WHEN o.o_orderstatus = 'O' THEN 'B'
              WHEN o.o_orderstatus = 'P' THEN 'C' END AS grade,
         CASE WHEN o.o_orderpriority = '5-LOW' OR o.o_orderstatus NOT IN ('F','O','P') THEN NULL
              ELSE CAST(o.o_orderdate AS DATE) END AS grade_date,
         'Type ' || o.o_orderstatus AS inspection_type,
         {_sql_lat('c.c_custkey')} AS latitude,
         {_sql_lng('c.c_custkey')} AS longitude,
         n.n_name AS nta,
         CAST(c.c_nationkey AS DOUBLE) AS community_board,
         CAST(n.n_regionkey AS DOUBLE) AS council_district,
         'POINT ' || CAST(c.c_custkey AS VARCHAR) AS location,
         o.o_orderkey AS r1, l.l_linenumber AS r2, l.l_partkey AS r3, l.l_suppkey AS r4,
         l.l_extendedprice AS r5
  FROM orders o
  LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
),
logx AS (
  SELECT * EXCLUDE (boro_raw),
         array_to_string(list_transform(string_split(boro_raw, ' '),
             lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ') AS boro
  FROM log
)"""

RID_ORDER_SQL = "r1, r2, r3, r4, r5"


# --- raw text version of the log (what the CSV scan would deliver) -------------

def raw_inspection_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as raw strings under all 27 headers, with padding, placeholders,
    bad values, and values holding quotes, commas and line breaks."""
    log = inspection_log(spark, sf_dir)
    k = F.col("rid.o_orderkey")
    text = lambda c: F.col(c).cast("string")
    day = lambda c: F.date_format(c, "M/d/yyyy")
    return log.select(
        F.when(F.col("camis") % 5 == 0, F.concat(F.lit(" "), text("camis"), F.lit(" "))).otherwise(text("camis")).alias("CAMIS"),
        F.when(k % 4 == 0, F.concat(F.lit("  "), F.col("dba"), F.lit("\t")))
         .when(k % 4 == 1, F.concat(F.col("dba"), F.lit(' "THE BEST", INC'))).otherwise(F.col("dba")).alias("DBA"),
        F.upper("boro").alias("BORO"),
        F.col("building").alias("BUILDING"),
        F.concat(F.lit(" "), F.col("street"), F.lit('\n, side "B"')).alias("STREET"),
        text("zipcode").alias("ZIPCODE"),
        F.coalesce("phone", F.lit("None")).alias("PHONE"),
        F.col("cuisine").alias("CUISINE DESCRIPTION"),
        F.when(k % 13 == 0, F.lit("01/01/1900")).when(k % 17 == 0, F.lit("not a date"))
         .otherwise(day("inspection_date")).alias("INSPECTION DATE"),
        F.col("action").alias("ACTION"),
        F.col("violation_code").alias("VIOLATION CODE"),
        F.col("violation_description").alias("VIOLATION DESCRIPTION"),
        F.coalesce(F.lower("critical_flag"), F.lit("")).alias("CRITICAL FLAG"),
        F.when(F.col("score").isNull(), F.lit("NA")).otherwise(text("score")).alias("SCORE"),
        F.coalesce(F.lower("grade"), F.lit(" ")).alias("GRADE"),
        F.coalesce(day("grade_date"), F.lit("n/a")).alias("GRADE DATE"),
        day(F.date_add("inspection_date", 30)).alias("RECORD DATE"),
        F.col("inspection_type").alias("INSPECTION TYPE"),
        F.when(k % 19 == 0, F.lit("n/a")).otherwise(text("latitude")).alias("Latitude"),
        text("longitude").alias("Longitude"),
        text("community_board").alias("Community Board"),
        text("council_district").alias("Council District"),
        (F.col("camis") * 7).cast("string").alias("Census Tract"),
        F.when(k % 5 == 0, F.lit("nan")).otherwise((F.col("camis") + 1000000).cast("string")).alias("BIN"),
        F.concat(F.lit("  "), text("camis"), F.lit(" ")).alias("BBL"),
        F.col("nta").alias("NTA"),
        F.col("location").alias("Location"),
        F.lit("x").alias("UNKNOWN EXTRA"),
        F.col("rid"),
    )


RAW_TEXT_SQL = INSPECTION_LOG_SQL + """,
raw AS (
  SELECT CASE WHEN camis % 5 = 0 THEN ' ' || CAST(camis AS VARCHAR) || ' '
              ELSE CAST(camis AS VARCHAR) END AS "CAMIS",
         CASE WHEN r1 % 4 = 0 THEN '  ' || dba || chr(9) WHEN r1 % 4 = 1 THEN dba || ' "THE BEST", INC'
              ELSE dba END AS "DBA",
         upper(boro) AS "BORO", building AS "BUILDING", ' ' || street || chr(10) || ', side "B"' AS "STREET",
         CAST(zipcode AS VARCHAR) AS "ZIPCODE", coalesce(phone, 'None') AS "PHONE", cuisine AS "CUISINE DESCRIPTION",
         CASE WHEN r1 % 13 = 0 THEN '01/01/1900' WHEN r1 % 17 = 0 THEN 'not a date'
              ELSE strftime(inspection_date, '%-m/%-d/%Y') END AS "INSPECTION DATE",
         action AS "ACTION", violation_description AS "VIOLATION DESCRIPTION",
         coalesce(lower(critical_flag), '') AS "CRITICAL FLAG",
         CASE WHEN score IS NULL THEN 'NA' ELSE CAST(score AS VARCHAR) END AS "SCORE",
         coalesce(lower(grade), ' ') AS "GRADE", coalesce(strftime(grade_date, '%-m/%-d/%Y'), 'n/a') AS "GRADE DATE",
         strftime(inspection_date + INTERVAL 30 DAY, '%-m/%-d/%Y') AS "RECORD DATE", inspection_type AS "INSPECTION TYPE",
         CASE WHEN r1 % 19 = 0 THEN 'n/a' ELSE CAST(latitude AS VARCHAR) END AS "Latitude",
         CAST(longitude AS VARCHAR) AS "Longitude", CAST(community_board AS VARCHAR) AS "Community Board",
         CAST(council_district AS VARCHAR) AS "Council District", CAST(camis * 7 AS VARCHAR) AS "Census Tract",
         CASE WHEN r1 % 5 = 0 THEN 'nan' ELSE CAST(camis + 1000000 AS VARCHAR) END AS "BIN",
         '  ' || CAST(camis AS VARCHAR) || ' ' AS "BBL", nta AS "NTA", location AS "Location",
         violation_code AS "VIOLATION CODE"
  FROM logx
)"""


# --- request table (batch of location / text requests) --------------------------

def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per supplier: position, free text, preset, strictness.

    The query kinds cycle over the supplier key: blank, free text with the
    supplier name, a full customer name (reference found by "name inside
    token"), label words, dish words (keyword rules) and the number in a customer
    name (reference found by "token inside name").
    """
    from plumbline.functions.constants import WALK_PRESETS
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    d = s.join(c, s.s_suppkey == c.c_custkey, "left")
    k = F.col("s_suppkey")
    m = k % 6
    q = (F.when(m == 0, F.lit(""))
         .when(m == 1, F.concat(F.lit("i want furniture near "), F.col("s_name")))
         .when(m == 2, F.concat(F.lit("ramen or pizza by "), F.lower("c_name")))
         .when(m == 3, F.lit("household machinery"))
         .when(m == 4, F.lit("sushi bbq tacos"))
         .otherwise(F.concat(F.lit("dinner at "), F.split_part(F.lower("c_name"), F.lit("#"), F.lit(2)))))
    preset = F.element_at(F.array(*[F.lit(p[0]) for p in WALK_PRESETS]), (k % 6 + 1).cast("int"))
    lat, lng = entity_coordinates(k * F.lit(13) + F.lit(5))
    return d.select(k.alias("req_id"), lat.alias("lat"), lng.alias("lng"), q.alias("query"),
                    preset.alias("preset"), ((k % 4).cast("double") * F.lit(0.25)).alias("importance"),
                    (k % 2 == 0).alias("danger_filter"))


def _presets_sql() -> str:
    from plumbline.functions.constants import WALK_PRESETS
    return "CASE s_suppkey % 6 " + " ".join(
        f"WHEN {i} THEN '{p[0]}'" for i, p in enumerate(WALK_PRESETS)) + " END"


REQUESTS_SQL = f"""
req AS (
  SELECT s_suppkey AS req_id, {_sql_lat('(s_suppkey * 13 + 5)')} AS lat,
         {_sql_lng('(s_suppkey * 13 + 5)')} AS lng,
         CASE s_suppkey % 6 WHEN 0 THEN ''
              WHEN 1 THEN 'i want furniture near ' || s_name
              WHEN 2 THEN 'ramen or pizza by ' || lower(c_name)
              WHEN 3 THEN 'household machinery'
              WHEN 4 THEN 'sushi bbq tacos'
              ELSE 'dinner at ' || split_part(lower(c_name), '#', 2) END AS query,
         {_presets_sql()} AS preset,
         CAST(s_suppkey % 4 AS DOUBLE) * CAST(0.25 AS DOUBLE) AS importance,
         s_suppkey % 2 = 0 AS danger_filter
  FROM supplier LEFT JOIN customer ON c_custkey = s_suppkey
)"""
