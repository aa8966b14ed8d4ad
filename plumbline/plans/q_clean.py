"""Queries for the scan + cleaning step (IO1, IO5, P1-P8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import constants as K
from plumbline.operators.clean import clean_raw, rename_known
from plumbline.plans.catalog import register
from plumbline.plans.standins import RAW_TEXT_SQL, raw_inspection_text
from plumbline.sources.files import preview

_NA = ", ".join("'" + s.replace("'", "''") + "'" for s in K.NA_STRINGS)


def _s(h: str) -> str:
    x = f'"{h}"'
    return (f"nullif(regexp_replace(CASE WHEN {x} IN ({_NA}) THEN NULL ELSE {x} END, "
            f"'^\\s+|\\s+$', '', 'g'), '')")


def _title(e: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({e}), ' '), "
            f"lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')")


def _dbl(e: str) -> str:
    return f"CASE WHEN isnan(TRY_CAST({e} AS DOUBLE)) THEN NULL ELSE TRY_CAST({e} AS DOUBLE) END"


def _clean(header: str, name: str) -> str:
    v = _s(header)
    if name == "camis":
        return f"TRY_CAST({_dbl(v)} AS BIGINT)"
    if name in K.DATE_COLUMNS:
        d = f"CAST(try_strptime({v}, '%m/%d/%Y') AS DATE)"
        return f"nullif({d}, DATE '1900-01-01')" if name == "inspection_date" else d
    if name in K.NUMERIC_COLUMNS:
        return _dbl(v)
    return _title(v) if name in ("boro", "critical_flag") else f"upper({v})" if name == "grade" else v


CLEAN_SQL = "WITH " + RAW_TEXT_SQL + ",\nclean AS (SELECT " + ", ".join(
    f"{_clean(h, n)} AS {n}" for h, n in K.COLUMN_RENAME.items()) + " FROM raw)"


@register("raw_clean", CLEAN_SQL + "\nSELECT * FROM clean")
def raw_clean(spark, sf_dir):
    return clean_raw(raw_inspection_text(spark, sf_dir))


@register("raw_rename_known", "WITH " + RAW_TEXT_SQL + "\nSELECT " + ", ".join(
    f'"{h}" AS {n}' for h, n in K.COLUMN_RENAME.items()) + " FROM raw")
def raw_rename_known(spark, sf_dir):
    return rename_known(raw_inspection_text(spark, sf_dir))


@register("raw_preview", "WITH " + RAW_TEXT_SQL.replace(
    "violation_code AS \"VIOLATION CODE\"", "violation_code AS \"VIOLATION CODE\", r1, r2, r3, r4, r5")
    + """
SELECT "CAMIS" AS camis_raw, "INSPECTION DATE" AS inspection_date_raw FROM raw
ORDER BY r1, r2, r3, r4, r5 LIMIT 200""")
def raw_preview(spark, sf_dir):
    raw = raw_inspection_text(spark, sf_dir)
    return preview(raw, 200, "rid").select(F.col("CAMIS").alias("camis_raw"),
                                           F.col("`INSPECTION DATE`").alias("inspection_date_raw"))

