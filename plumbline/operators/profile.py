"""Filters, profiling and report queries (F1-F10, A9-A16, W7-W10, X1-X3,
P10, P16-P20).

All reports are single aggregates or small windows over aggregate results:
one-row values (histogram edges) are scalar subqueries, never collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import constants as K
from plumbline.operators import ranges as R
from plumbline.functions.columns import address, grade_colour, trim_all_space
from plumbline.session import cut_lineage


# --- filters ------------------------------------------------------------------

def regex_contains(c: str | Column, pattern: str, literal: bool = False) -> Column:
    """case-insensitive regex (or literal) contains; missing = no match."""
    cc = F.col(c) if isinstance(c, str) else c
    if literal:
        m = F.contains(F.lower(cc), F.lower(F.lit(pattern)))
    else:
        m = cc.rlike("(?i)" + pattern)
    return F.coalesce(m, F.lit(False))


def explorer_filter(df: DataFrame, boros=None, grades=None, include_no_grade=False,
                    labels=None, text: str | None = None, score_range=None,
                    literal_text: bool = False, area_col="boro", grade_col="latest_grade",
                    label_col="cuisine", score_col="latest_score") -> DataFrame:
    """F5 (with F1, F6, F7, F10): every given choice is ANDed; empty = no constraint."""
    cond = F.lit(True)
    if boros:
        cond = cond & F.col(area_col).isin(*boros)
    if grades or include_no_grade:
        g = F.col(grade_col).isin(*(grades or []))
        if include_no_grade:
            g = g | F.col(grade_col).isNull()
        cond = cond & F.coalesce(g, F.lit(False))
    if labels:
        cond = cond & F.col(label_col).isin(*labels)
    if text and text.strip():
        cond = cond & regex_contains(label_col, text.strip(), literal_text)
    if score_range is not None:
        lo, hi = score_range
        cond = cond & (F.col(score_col).isNull() | F.col(score_col).between(lo, hi))
    return df.where(cond)


def exclude_value(df: DataFrame, c: str, value) -> DataFrame:
    """drop a placeholder value (e.g. area "0")."""
    return df.where(F.col(c).isNull() | (F.col(c) != F.lit(value)))


def label_set_filter(df: DataFrame, c: str, labels=K.LETTER_GRADES) -> DataFrame:
    """F1."""
    return df.where(F.col(c).isin(*labels))


def complete_case(cols) -> Column:
    """all columns present (a mask, not a drop)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def rare_class_filter(df: DataFrame, label: str, min_count: int) -> DataFrame:
    """Keep rows whose class has >= min_count rows (left-semi join on
    the per-class counts; the count table is one row per class)."""
    keep = df.groupBy(label).count().where(F.col("count") >= min_count).select(label)
    return df.join(keep, label, "left_semi")


def exact_name_lookup(df: DataFrame, queries: DataFrame, name_col="dba", label_col="cuisine",
                      order_col="camis", q_col="query") -> DataFrame:
    """F8 (batch): lower(trim(name)) = query; the first matching row's label."""
    names = df.select(F.lower(trim_all_space(name_col)).alias("_n"), label_col, order_col)
    first = names.groupBy("_n").agg(
        F.min_by(F.col(label_col), F.col(order_col)).alias(label_col))
    return queries.join(first, F.lower(trim_all_space(q_col)) == F.col("_n"), "left").drop("_n")


# --- counts and summaries -----------------------------------------------------

def value_counts(df: DataFrame, c: str, missing_label: str | None = None) -> DataFrame:
    """(value, count) — missing values dropped, or labelled when asked."""
    v = F.col(c) if missing_label is None else F.coalesce(F.col(c), F.lit(missing_label))
    out = df.select(v.alias(c))
    if missing_label is None:
        out = out.where(F.col(c).isNotNull())
    return out.groupBy(c).agg(F.count(F.lit(1)).alias("n"))


def two_key_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """A10."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def dataset_summary(log: DataFrame, key="camis", date="inspection_date", grade="grade",
                    grades=K.LETTER_GRADES) -> DataFrame:
    """One aggregate pass."""
    return log.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(key).alias("n_entities"),
        F.lit(len(log.columns)).alias("n_columns"),
        F.min(date).alias("min_date"), F.max(date).alias("max_date"),
        *[F.count_if(F.col(grade) == g).alias(f"n_grade_{g}") for g in grades])


def missing_profile(df: DataFrame, cols=None, only_missing=True) -> DataFrame:
    """Null count and % (1 dp) per column in one pass, then unpivot."""
    cols = cols or df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m_{i}") for i, c in enumerate(cols)])
    stacked = agg.select("_n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"m_{i}").alias("n_missing"))
        for i, c in enumerate(cols)])).alias("s"))
    out = stacked.select(
        F.col("s.column").alias("column"), F.col("s.n_missing").alias("n_missing"),
        (F.col("_n") - F.col("s.n_missing")).alias("n_present"),
        F.round(F.lit(100.0) * F.col("s.n_missing") / F.col("_n"), 1).alias("pct_missing"))
    return out.where(F.col("n_missing") > 0) if only_missing else out


def describe(df: DataFrame, cols, digits: int = 2) -> DataFrame:
    """Count, mean, sample std, min, quartiles (exact, linear), max.

    The quartiles come from counts per distinct value and offsets between ranges
    of values (``ranges.quantiles``): no buffer holds a column's values.
    """
    cols = list(cols)
    parts = []
    for i, c in enumerate(cols):
        x = F.col(c)
        parts.append(F.struct(
            F.lit(i).alias("f"), F.lit(c).alias("column"), F.count(x).alias("count"),
            F.round(F.avg(x), digits).alias("mean"), F.round(F.stddev_samp(x), digits).alias("std"),
            F.round(F.min(x), digits).cast("double").alias("min"),
            F.round(F.max(x), digits).cast("double").alias("max")).alias(f"d_{i}"))
    agg = df.agg(*parts).select(F.explode(F.array(*[F.col(f"d_{i}") for i in range(len(cols))])).alias("d")).select("d.*")
    at = lambda q, name: F.round(F.max(F.when(F.col("q") == q, F.col("t"))), digits).alias(name)
    quart = R.quantiles(df, cols, [0.25, 0.5, 0.75]).groupBy("f").agg(at(0.25, "p25"), at(0.5, "p50"), at(0.75, "p75"))
    return agg.join(quart, "f", "left").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def histogram(df: DataFrame, c: str, bins: int, by: str | None = None) -> DataFrame:
    """Equal-width bins over the global [min, max]; optional per class.

    The two bounds are scalar subqueries (evaluated once, no join, no
    driver round trip).
    """
    lo = df.agg(F.min(F.col(c).cast("double"))).scalar()
    hi = df.agg(F.max(F.col(c).cast("double"))).scalar()
    width = F.when(hi != lo, (hi - lo) / F.lit(float(bins))).otherwise(F.lit(1.0))
    b = F.least(F.floor((F.col(c) - lo) / width).cast("int"), F.lit(bins - 1))
    keys = [b.alias("bin")] + ([F.col(by)] if by else [])
    out = df.where(F.col(c).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return out.select("bin", *([by] if by else []), (lo + F.col("bin") * width).alias("lo"),
                      (lo + (F.col("bin") + 1) * width).alias("hi"), "n")


def weighted_density(df: DataFrame, keys, weight: str, alias="weight") -> DataFrame:
    """Sum of a weight per location key."""
    return df.groupBy(*keys).agg(F.sum(weight).alias(alias))


def class_counts(df: DataFrame, label: str, classes=K.LETTER_GRADES) -> DataFrame:
    """Fixed class order with zero fill and share in %.

    The class list is a literal of fixed, small size; the count side is one
    row per class, so the window over it is tiny.
    """
    spark = df.sparkSession
    cls = spark.createDataFrame([(i, c) for i, c in enumerate(classes)], f"ord int, {label} string")
    cnt = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    out = cls.join(cnt, label, "left").select("ord", label, F.coalesce("n", F.lit(0)).alias("n"))
    tot = F.sum("n").over(Window.partitionBy())
    return out.select("ord", label, "n",
                      F.round(F.lit(100.0) * F.col("n") / F.greatest(tot, F.lit(1)), 1).alias("pct"))


# --- ordering, ranking ----------------------------------------------------------

def top_n(df: DataFrame, order_cols, n: int) -> DataFrame:
    """Global top-n (TakeOrderedAndProject; each task keeps only n rows)."""
    return df.orderBy(*order_cols).limit(n)


def grade_order(c: str) -> Column:
    """A, B, C, then anything else."""
    return (F.when(F.col(c) == "A", 0).when(F.col(c) == "B", 1).when(F.col(c) == "C", 2)
            .otherwise(3))


def ranked(df: DataFrame, order_cols, group=None) -> DataFrame:
    """``rank`` (1, 2, ...) and ``n_candidates`` in each group, or in the whole table.

    Rows are dealt to ranges of (group, order) and written once; a row's rank is
    its place in its range plus what its group has in the ranges before, from a
    table of one count per (group, range).  So neither a table without groups nor
    a group that holds most rows is one task's sort."""
    g = list(group or [])
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = cut_lineage(df.repartitionByRange(n, *g, *order_cols).withColumn("_range", F.spark_partition_id()))
    ranges = Window.partitionBy(*g).orderBy("_range")
    counts = d.groupBy(*g, "_range").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(g)], F.col("_range").alias("_of"),
                           F.coalesce(F.sum("_n").over(ranges.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
                           F.sum("_n").over(ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n_candidates"))
    same = F.col("_range") == F.col("_of")
    for i, c in enumerate(g):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    own = F.row_number().over(Window.partitionBy(*g, "_range").orderBy(*order_cols))
    return d.join(counts, same).withColumn("rank", (F.col("_before") + own).cast("int")) \
            .select(*df.columns, "rank", "n_candidates")


def ranked_with_position(df: DataFrame, order_cols, current: int = 0, group=None) -> DataFrame:
    """Rank, number of candidates, previous/next rank with clamping."""
    out = ranked(df, order_cols, group)
    cur = F.least(F.greatest(F.lit(current), F.lit(0)), F.col("n_candidates") - 1)
    return out.select("*", (cur + 1).alias("current_rank"),
                      F.greatest(cur, F.lit(1)).alias("prev_rank"),
                      F.least(cur + 2, F.col("n_candidates")).alias("next_rank"),
                      ((F.col("rank") - 1) == cur).alias("is_current"))


def random_row(df: DataFrame, id_col: str, seed: int = 42) -> DataFrame:
    """One pseudo-random row, reproducible (md5 of seed and id)."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))),
                      F.col(id_col)).limit(1)


def distinct_sorted(df: DataFrame, c: str, exclude=None) -> DataFrame:
    """X3."""
    out = df.select(c).where(F.col(c).isNotNull()).distinct()
    if exclude is not None:
        out = out.where(F.col(c) != F.lit(exclude))
    return out.orderBy(c)


# --- presentation attributes -------------------------------------------------------

def map_attributes(df: DataFrame, grade_col="latest_grade") -> DataFrame:
    """Filled grade text, address line, colour array."""
    return df.select(
        "*",
        F.coalesce(F.col(grade_col), F.lit(K.NO_GRADE_LABEL)).alias("grade_text"),
        address().alias("address"),
        grade_colour(grade_col).alias("color"))
