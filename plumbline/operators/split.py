"""Train/test splits (W2, W5, W6) and the skew-safe in-group rank they use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import constants as K
from plumbline.functions.columns import title_case, trim_all_space


def hash_key(seed: int, id_col: str) -> Column:
    """A reproducible pseudo-random bigint from (seed, id): the first 15 hex
    digits of md5 — the same value in Spark and DuckDB."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")


def rank_in_groups(df: DataFrame, group, key: str, tie: str, buckets: int = 64,
                   rank_col: str = "_rank") -> DataFrame:
    """Exact 1-based rank by (key, tie) inside each group, without putting a
    whole group in one task.

    Each group's key range is cut at approximate quantiles into ``buckets``
    pieces; rows are counted per (group, piece), the pieces' running offsets
    come from a window over that small count table, and the final
    ``row_number`` runs per (group, piece).  A group holding a third of all
    rows is therefore ranked by ``buckets`` tasks.  ``key`` must be numeric
    (dates: pass a day number).
    """
    g = list(group) if group else []
    qs = [i / buckets for i in range(1, buckets)]
    pa = F.percentile_approx(F.col(key).cast("double"), qs, 10000)
    if g:
        d = df.join(df.groupBy(*g).agg(pa.alias("_b")), g)
    else:  # one group: the bounds are a scalar subquery, and the group key a literal
        d = df.withColumn("_b", df.agg(pa).scalar()).withColumn("_g", F.lit(1))
        g = ["_g"]
    d = d.withColumn(
        "_bk", F.size(F.filter("_b", lambda b: b < F.col(key).cast("double")))).drop("_b")
    cnt = d.groupBy(*g, "_bk").agg(F.count(F.lit(1)).alias("_n"))
    off = cnt.select(*g, "_bk", F.coalesce(F.sum("_n").over(
        Window.partitionBy(*g).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_off"))
    d = d.join(off, g + ["_bk"])
    rn = F.row_number().over(Window.partitionBy(*g, "_bk").orderBy(key, tie))
    out = d.withColumn(rank_col, F.col("_off") + rn).drop("_bk", "_off")
    return out.drop("_g") if "_g" in out.columns else out


def temporal_split(df: DataFrame, date: str, id_col: str, test_fraction: float = 0.2,
                   clamp: bool = False, min_rows: int = 0):
    """Sort by (date, id); the first ``int(n*(1-f))`` rows train, the rest test.

    Returns ``(frame with a 'split' column, info)`` where ``info`` is a
    one-row frame (cutoff_date, n_train, n_test).  Everything stays lazy.
    Only the per-date count table (one row per distinct date) is windowed;
    it tells each date whether all its rows train, all test, or — for the
    one date the cut falls in — how many of its rows train.  Rows meet that
    table in an equi-join on the date, and the cut date alone is ranked with
    :func:`rank_in_groups` (skew-safe).  ``clamp`` keeps at least one row on
    each side; ``min_rows`` raises when fewer rows are available.
    """
    if not 0 < test_fraction < 1:
        raise ValueError("test_fraction must be between 0 and 1")
    per_date = df.groupBy(date).agg(F.count(F.lit(1)).alias("_n"))
    w_cum = Window.orderBy(date).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_all = Window.partitionBy()
    pd = per_date.select(date, "_n", F.sum("_n").over(w_cum).alias("_cum"),
                         F.sum("_n").over(w_all).alias("_tot"))
    cut = F.floor(F.col("_tot") * F.lit(1.0 - test_fraction)).cast("long")
    if clamp:
        cut = F.least(F.greatest(cut, F.lit(1)), F.col("_tot") - 1)
    pd = pd.withColumn("_cut", cut)
    before = F.col("_cum") - F.col("_n")
    pd = pd.select(date, "_cum", "_cut", "_tot",
                   F.when(F.col("_cum") <= F.col("_cut"), "train")
                    .when(before >= F.col("_cut"), "test").otherwise("cut").alias("_side"),
                   (F.col("_cut") - before).alias("_kin"))
    if min_rows > 0:
        n = df.count()
        if n < min_rows:
            raise ValueError("Not enough rows with complete features to split.")
    d = df.join(pd.select(date, "_side", "_kin"), date)
    rest = d.where(F.col("_side") != "cut").withColumn("split", F.col("_side"))
    on_cut = rank_in_groups(d.where(F.col("_side") == "cut"), [date], id_col, id_col)
    cut_rows = on_cut.withColumn("split", F.when(F.col("_rank") <= F.col("_kin"), "train")
                                 .otherwise("test")).drop("_rank")
    out = rest.unionByName(cut_rows).drop("_side", "_kin")
    info = pd.where(F.col("_cum") > F.col("_cut")).groupBy().agg(
        F.min(date).alias("cutoff_date"), F.first("_cut").alias("n_train"),
        F.first(F.col("_tot") - F.col("_cut")).alias("n_test"))
    return out, info


def stratified_split(df: DataFrame, label: str, id_col: str, test_fraction: float = 0.2,
                     seed: int = 42, min_class: int = 2) -> DataFrame:
    """Per class, the ``round(f * n_class)`` rows with the smallest
    md5(seed, id) are test; classes with fewer than ``min_class`` rows are
    dropped.  Exact shares per class (not Bernoulli sampling)."""
    sized = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc")).where(F.col("_nc") >= min_class)
    d = df.join(sized, label).withColumn("_h", hash_key(seed, id_col))
    r = rank_in_groups(d, [label], "_h", id_col)
    n_test = F.round(F.lit(test_fraction) * F.col("_nc"))
    return r.withColumn("split", F.when(F.col("_rank") <= n_test, "test").otherwise("train")) \
            .drop("_h", "_rank", "_nc")


def area_split(df: DataFrame, area: str, label: str, test_area: str,
               min_count: int = K.MIN_LABEL_COUNT) -> DataFrame:
    """One area is the test set (names trimmed + title-cased); classes
    with fewer than ``min_count`` train rows are removed from both sides."""
    def norm(c: Column) -> Column:
        return title_case(trim_all_space(c))

    d = df.withColumn("split", F.when(norm(F.col(area)) == norm(F.lit(test_area)), "test").otherwise("train"))
    keep = (d.where(F.col("split") == "train").groupBy(label).count()
            .where(F.col("count") >= min_count).select(label))
    return d.join(keep, label, "left_semi")
