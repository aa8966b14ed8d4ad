"""Violation log -> one row per entity.

Plan shape (checked with ``explain``): two aggregates with map-side partial
aggregation; the log is read and joined once.

1. ``groupBy(key, date)`` reduces every (entity, day) to one row: the first
   row of the day in source order (``min_by(..., rid)``) for every value the
   later steps need, plus per-day violation counts.  This is the W1
   "keep first per (entity, date)" step, done as an aggregate.
2. ``groupBy(key)`` picks the newest day per column with ``max_by`` and sums
   the counts.

A hot entity holding a third of all rows is split over its days by step 1
and arrives at step 2 as one partial row per map task, so no task ever holds
the whole group.  The distinct codes (A7) of a day travel with it, so the list
of an entity is bounded by its days and the code vocabulary, not by its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import constants as K
from plumbline.functions.columns import grade_encode


def _present(df: DataFrame, cols):
    return [c for c in cols if c in df.columns]


def latest_non_null(df: DataFrame, key: str, date: str, order: str, cols) -> DataFrame:
    """A1 on its own: each column's newest non-null value (undated rows last)."""
    day = df.groupBy(key, date).agg(*[
        F.expr(f"min_by({c}, {order}) FILTER (WHERE {c} IS NOT NULL)").alias(c) for c in cols])
    dkey = F.struct(F.col(date).isNotNull(), F.col(date))
    return day.groupBy(key).agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), dkey)).alias(c) for c in cols])


def latest_row(df: DataFrame, key: str, date: str, order: str, cols, prefix="latest_") -> DataFrame:
    """A2: values of the newest dated row; equal dates -> first in source order."""
    first = df.where(F.col(date).isNotNull()).groupBy(key, date).agg(
        F.min_by(F.struct(*[F.col(c) for c in cols]), F.col(order)).alias("_r"))
    out = first.groupBy(key).agg(F.max_by("_r", F.col(date)).alias("_r"),
                                 F.max(date).alias(prefix + date))
    return out.select(key, prefix + date, *[F.col("_r." + c).alias(prefix + c) for c in cols])


def most_common(df: DataFrame, key: str, c: str, alias: str | None = None) -> DataFrame:
    """Most frequent non-null value per key; ties -> smallest value.

    Values are counted per (key, value) first, so no task holds the rows or the
    value map of a key; the winner is picked from the counts."""
    counts = df.where(F.col(c).isNotNull()).groupBy(key, c).agg(F.count(F.lit(1)).alias("_n"))
    top = counts.groupBy(key).agg(F.max("_n").alias("_n"))
    return counts.join(top, [key, "_n"]).groupBy(key).agg(F.min(c).alias(alias or c))


def build_entity_table(
    log: DataFrame,
    reference_date: str,
    key: str = "camis",
    date: str = "inspection_date",
    order: str = "rid",
    identity_cols=None,
) -> DataFrame:
    """Entity point A: violation rows -> one row per entity.

    ``order`` is a sortable column (a struct is fine) giving source order;
    it breaks every tie.  ``reference_date`` (``yyyy-MM-dd``) is mandatory so
    that ``days_since_last_inspection`` is reproducible.
    """
    identity = _present(log, identity_cols or K.IDENTITY_COLUMNS)
    log = log.where(F.col(key).isNotNull())  # rows without a key belong to no entity
    has = set(log.columns)
    letter = F.col("grade").isin(*K.LETTER_GRADES) if "grade" in has else F.lit(False)
    code_ok = F.col("violation_code").isNotNull() if "violation_code" in has else F.lit(False)
    flag = F.col("critical_flag") if "critical_flag" in has else F.lit(None).cast("string")
    score = F.col("score") if "score" in has else F.lit(None).cast("double")
    o = F.col(order)

    def opt(c, t="string"):
        return F.col(c) if c in has else F.lit(None).cast(t)

    grade_row = F.struct(opt("grade").alias("g"), opt("grade_date", "date").alias("gd"))
    last_row = F.struct(score.alias("s"), opt("action").alias("a"),
                        opt("inspection_type").alias("t"))

    # Step 1: one row per (entity, day).  min_by with a NULL ordering skips the
    # row, which gives FILTER semantics with DataFrame functions only.
    day = log.groupBy(key, date).agg(
        *[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), o)).alias(c) for c in identity],
        F.min_by(last_row, o).alias("_last"),
        F.min_by(grade_row, F.when(letter, o)).alias("_graded"),
        F.min_by(grade_row, o).alias("_any"),
        F.min_by(score, F.when(score.isNotNull(), o)).alias("_score"),
        F.count_if(code_ok).alias("_nv"),
        F.count_if(code_ok & (flag == "Critical")).alias("_nc"),
        F.count_if(code_ok & (flag == "Not Critical")).alias("_nn"),
        F.collect_set(opt("violation_code")).alias("_codes"),
    )

    d = F.col(date)
    dated = d.isNotNull()
    dkey = F.struct(dated, d)
    ent = day.groupBy(key).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), dkey)).alias(c) for c in identity],
        F.max(d).alias("latest_inspection_date"),
        F.max_by("_last", F.when(dated, d)).alias("_last"),
        F.max_by("_graded", F.when(dated & F.col("_graded").isNotNull(), d)).alias("_graded"),
        F.max_by("_any", F.when(dated, d)).alias("_any"),
        F.count(d).cast("int").alias("inspection_count"),
        F.avg(F.when(dated, F.col("_score"))).alias("mean_score"),
        F.min(F.when(dated, F.col("_score"))).alias("min_score"),
        F.max(F.when(dated, F.col("_score"))).alias("max_score"),
        F.sum("_nv").cast("int").alias("total_violations"),
        F.sum("_nc").cast("int").alias("critical_violations"),
        F.sum("_nn").cast("int").alias("non_critical_violations"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("_codes")))).alias("_codes"),
    )

    grade_pick = F.coalesce(F.col("_graded"), F.col("_any"))
    ent = ent.select(
        key, *identity,
        grade_pick["g"].alias("latest_grade"),
        grade_pick["gd"].alias("latest_grade_date"),
        F.col("_last.s").alias("latest_score"),
        "latest_inspection_date",
        F.col("_last.a").alias("latest_action"),
        F.col("_last.t").alias("latest_inspection_type"),
        "inspection_count", "mean_score", "min_score", "max_score",
        F.datediff(F.lit(reference_date).cast("date"), F.col("latest_inspection_date"))
         .alias("days_since_last_inspection"),
        "total_violations", "critical_violations", "non_critical_violations",
        F.when(F.size("_codes") > 0, F.array_join("_codes", ",")).alias("unique_violation_codes"),
    ).withColumn("latest_grade_encoded", grade_encode("latest_grade"))

    ordered = [c for c in K.ENTITY_COLUMN_ORDER if c in ent.columns]
    return ent.select(key, *ordered)
