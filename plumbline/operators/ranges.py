"""Running sums and exact quantiles in two levels.

A key's values are cut into ranges ("pieces") at approximate quantiles; sums
per piece and offsets between the pieces are small tables, so the running sum
inside a piece is all that a window ever holds: no task gets all values of a
column.  Approximate cuts only decide who works on what; results are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECES = 64


def cut_points(df: DataFrame, cols) -> list[list[float]]:
    """Ascending, distinct cuts of each column's rows into about PIECES equal
    ranges (PIECES - 1 numbers a column, read in one job)."""
    shares = [i / PIECES for i in range(1, PIECES)]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 1000).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    return [sorted(set(row[f"c{i}"] or [])) for i in range(len(cols))]


def piece_of(value: Column, which: Column, cuts: list[list[float]]) -> Column:
    """Piece of ``value`` by the cuts of column number ``which``."""
    held = F.array(*[F.array(*[F.lit(float(x)) for x in c]).cast("array<double>") for c in cuts])
    return F.size(F.filter(held[which], lambda b: b < value))


def running(counts: DataFrame, keys: list[str], value: str, sums: list[str]) -> DataFrame:
    """``counts`` (distinct keys and value, ``piece``, columns ``sums``) with, for each
    column s, ``upto_s`` (sum up to the value), ``total_s`` (of the key) and
    ``next_s`` (at the next value, 0 at the last), and ``next``, the next value."""
    first = F.min(F.struct(value, *sums)).alias("first")
    pieces = counts.groupBy(*keys, "piece").agg(*[F.sum(s).alias(s) for s in sums], first)
    order = Window.partitionBy(*keys).orderBy("piece")            # at most PIECES rows a key
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    pieces = pieces.select(*keys, "piece", *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"before_{s}") for s in sums],
                           *[F.sum(s).over(every).alias(f"total_{s}") for s in sums], F.lead("first").over(order).alias("after"))
    own = Window.partitionBy(*keys, "piece").orderBy(value)
    upto = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.join(pieces, [*keys, "piece"]).select(
        *keys, value, *sums, *[(F.col(f"before_{s}") + F.sum(s).over(upto)).alias(f"upto_{s}") for s in sums],
        *[f"total_{s}" for s in sums], F.coalesce(F.lead(value).over(own), F.col(f"after.{value}")).alias("next"),
        *[F.coalesce(F.lead(s).over(own), F.col(f"after.{s}"), F.lit(0)).alias(f"next_{s}") for s in sums])


def quantile_rows(run: DataFrame, value: str, here: Column, upto: Column, total: Column, shares: list[float]) -> DataFrame:
    """``run`` with, for every share q whose position ``q * (total - 1)`` begins at
    the row's value, ``q`` and the linear-interpolated quantile ``t``: the row whose
    running count covers the lower of the two ranks around the position yields
    it, with the next value at hand."""
    pos = lambda q: q * (total - 1)
    inside = F.filter(F.array(*[F.lit(float(q)) for q in shares]),
                      lambda q: (F.floor(pos(q)) >= upto - here) & (F.floor(pos(q)) < upto))
    c = run.withColumn("q", F.explode(inside))
    low, p = F.floor(pos(F.col("q"))).cast("double"), pos(F.col("q"))
    high = F.ceil(p).cast("double")
    other = F.when(high < upto, F.col(value)).otherwise(F.col("next"))
    return c.withColumn("t", F.when((high == low) | (other == F.col(value)), F.col(value)).otherwise(
        (high - p) * F.col(value) + (p - low) * other))


def quantiles(df: DataFrame, cols, shares: list[float]) -> DataFrame:
    """(column number ``f``, q, t): exact quantiles of numeric columns, missing
    values left out."""
    cuts = cut_points(df, cols)
    long = df.select(F.posexplode(F.array(*[F.col(c).cast("double") for c in cols])).alias("f", "v")).where(F.col("v").isNotNull())
    counts = long.groupBy("f", "v").agg(F.count(F.lit(1)).alias("n")).withColumn("piece", piece_of(F.col("v"), F.col("f"), cuts))
    run = running(counts, ["f"], "v", ["n"])
    return quantile_rows(run, "v", F.col("n"), F.col("upto_n"), F.col("total_n"), shares).select("f", "q", "t")


def number_rows(df: DataFrame, key: str, out: str) -> DataFrame:
    """``df`` with ``out``, 0, 1, ... without gaps over its distinct keys: numbered
    by hash pieces, with the pieces' offsets from a table of PIECES counts."""
    d = df.withColumn("_piece", F.pmod(F.xxhash64(key), F.lit(PIECES)))
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    off = d.groupBy("_piece").agg(F.count(F.lit(1)).alias("_n")).select("_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    own = F.row_number().over(Window.partitionBy("_piece").orderBy(key))
    return d.join(off, "_piece").withColumn(out, (F.col("_off") + own - 1).cast("int")).drop("_piece", "_off")
