"""Sources and sinks (IO1-IO7).

Scans never infer a schema: the raw log is read with every column as a
string (the header names the columns), the entity table with an explicit
schema.  Writers are plain ``DataFrameWriter`` calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import constants as K


#: Quotes inside a quoted value are doubled; a quoted value may hold commas and
#: line breaks.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "multiLine": True, "mode": "PERMISSIVE"}


#: Rows of a CSV file that is written, so that one task can read the file whole.
CSV_FILE_ROWS = 200_000

#: Endings of files that Spark reads in one piece whatever their size.
ONE_PIECE = (".gz", ".deflate", ".zst", ".lz4", ".snappy")


def source_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files in the order of their names; contents are not read."""
    rows = spark.read.format("binaryFile").load(path).select("_metadata.file_path", "_metadata.file_size").collect()
    return sorted((tuple(r) for r in rows), key=lambda r: r[0].encode())


def range_bytes(spark: SparkSession) -> int:
    """The size of the byte ranges that Spark cuts files into."""
    text = spark.conf.get("spark.sql.files.maxPartitionBytes").strip().lower().removesuffix("b")
    unit = {"k": 10, "m": 20, "g": 30, "t": 40}.get(text[-1:], 0)
    return int(text[:-1] if unit else text) << unit


def file_numbers(spark: SparkSession, files: list[tuple[str, int]]) -> DataFrame:
    """(_path, f): the files numbered in the order of their names, so that no row carries a
    path; the list, which the driver holds already, is broadcast."""
    return F.broadcast(spark.createDataFrame([(p, i) for i, (p, _size) in enumerate(files)], "_path string, f int"))


def csv_records(spark: SparkSession, path: str, files: list[tuple[str, int]]) -> DataFrame:
    """(f, i, record): the records of quoted CSV files, every file read by as many
    tasks as it has byte ranges; ``f`` is the file's number.

    A line break ends a record unless an odd number of quotes lies before it in
    the file.  Quotes are counted per line; a range's own parity comes from the
    counts of the ranges before it, one number each, and the lines of a range then
    fall into records by running counts.  Only what a record has beyond its
    range's end, one piece a range at most, is put together across ranges.  ``i``
    grows in file order; blank lines between records are dropped.  (Quotes must
    be balanced, as writers leave them.)
    """
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("block"), "value",
        F.monotonically_increasing_id().alias("at"),
        ((F.length("value") - F.length(F.replace("value", F.lit('"')))) % 2).alias("odd"))
    lines = lines.join(file_numbers(spark, files), "_path").drop("_path")
    in_file = Window.partitionBy("f").orderBy("block")                # one row a range
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    parity = lines.groupBy("f", "block").agg(F.sum("odd").alias("odd")).select(
        "f", "block", F.coalesce(F.sum("odd").over(before), F.lit(0)).alias("odd_before"))
    own = Window.partitionBy("f", "block").orderBy("at")
    so_far = own.rowsBetween(Window.unboundedPreceding, -1)
    starts = ((F.col("odd_before") + F.coalesce(F.sum("odd").over(so_far), F.lit(0))) % 2 == 0).cast("int")
    marked = lines.join(parity, ["f", "block"]).select(
        "f", "block", "value", starts.alias("starts"), (F.row_number().over(own) - 1).cast("long").alias("no"))
    marked = marked.withColumn("r", F.sum("starts").over(Window.partitionBy("f", "block").orderBy("no")))
    # pieces: r = 0 continues a record of an earlier range
    pieces = marked.groupBy("f", "block", "r").agg(
        F.min("no").alias("no"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("no", "value"))), lambda x: x["value"]), "\n")
        .alias("record"))
    last = F.max("r").over(Window.partitionBy("f", "block"))
    pieces = pieces.withColumn("last", F.col("r") == last)
    whole = pieces.where((F.col("r") > 0) & ~F.col("last"))
    # the ends of ranges: a last record and the pieces that continue it, in order
    ends = pieces.where((F.col("r") == 0) | F.col("last"))
    opened = F.sum((F.col("r") > 0).cast("int")).over(Window.partitionBy("f").orderBy("block", "no"))
    joined = ends.withColumn("of", opened).groupBy("f", "of").agg(
        F.array_sort(F.collect_list(F.struct("block", "no", "record"))).alias("p")).select(
        "f", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["no"].alias("no"),
        F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record"))
    both = whole.select("f", "block", "no", "record").unionByName(joined)
    text = F.regexp_replace("record", "\r$", "")
    # a range holds no more lines than bytes, so numbers of its lines stay below the next range's
    return both.select("f", (F.col("block") + F.col("no")).alias("i"), text.alias("record")).where(F.col("record") != "")


def read_raw_csv(spark: SparkSession, path: str, with_order: bool = True) -> DataFrame:
    """IO1: header row, all columns as strings, nothing inferred.

    ``rid`` (number of the file in name order, row position) keeps the source order
    used for "first row wins" ties.  The first record of every file is its header.
    Files that make one task each anyway are parsed where they are read and nothing
    travels; if one is larger, all are read by byte ranges.
    """
    names = raw_header(spark, path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    files, most = source_files(spark, path), range_bytes(spark)
    if all(size <= most or p.endswith(ONE_PIECE) for p, size in files):
        df = spark.read.schema(schema).options(**CSV_OPTIONS).csv(path).select(
            "*", F.col("_metadata.file_path").alias("_path"), F.monotonically_increasing_id().alias("_i"))
        df = df.join(file_numbers(spark, files), "_path")
        df = df.select(*[F.col(f"`{c}`") for c in names], F.struct("f", F.col("_i").alias("i")).alias("rid"))
        return df if with_order else df.drop("rid")
    rec = csv_records(spark, path, files)
    rec = rec.where(F.col("i") > 0)       # the header begins the file
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "emptyValue": "", "multiLine": "true"}
    df = rec.select(F.struct("f", "i").alias("rid"), F.from_csv("record", _ddl(schema), options).alias("c"))
    df = df.select(*[F.col("c").getField(c).alias(c) for c in names], "rid")
    return df if with_order else df.drop("rid")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def raw_header(spark: SparkSession, path: str) -> list[str]:
    """IO5 (header only): column names without reading the body."""
    return spark.read.options(**CSV_OPTIONS).csv(path).columns


def preview(df: DataFrame, n: int = 200, order: str = "rid") -> DataFrame:
    """IO5: first ``n`` rows in source order (TakeOrderedAndProject)."""
    return df.orderBy(order).limit(n)


ENTITY_SCHEMA = T.StructType([
    T.StructField("camis", T.LongType()),
    *[T.StructField(c, T.DoubleType() if c in ("zipcode", "latitude", "longitude",
                                               "community_board", "council_district")
                    else T.StringType()) for c in K.IDENTITY_COLUMNS],
    T.StructField("latest_grade", T.StringType()),
    T.StructField("latest_grade_encoded", T.DoubleType()),
    T.StructField("latest_grade_date", T.DateType()),
    T.StructField("latest_score", T.DoubleType()),
    T.StructField("latest_inspection_date", T.DateType()),
    T.StructField("latest_action", T.StringType()),
    T.StructField("latest_inspection_type", T.StringType()),
    T.StructField("inspection_count", T.IntegerType()),
    T.StructField("mean_score", T.DoubleType()),
    T.StructField("min_score", T.DoubleType()),
    T.StructField("max_score", T.DoubleType()),
    T.StructField("days_since_last_inspection", T.IntegerType()),
    T.StructField("total_violations", T.IntegerType()),
    T.StructField("critical_violations", T.IntegerType()),
    T.StructField("non_critical_violations", T.IntegerType()),
    T.StructField("unique_violation_codes", T.StringType()),
])


def read_entity_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """IO2: entity table with an explicit schema (dates typed, nothing inferred)."""
    if fmt == "csv":
        raw = spark.read.options(**CSV_OPTIONS).csv(path)
        cols = []
        for f in ENTITY_SCHEMA.fields:
            if f.name not in raw.columns:
                continue
            c = F.col(f.name)
            if isinstance(f.dataType, T.DateType):
                c = F.try_to_date(c)
            elif not isinstance(f.dataType, T.StringType):
                c = c.try_cast(f.dataType)
            cols.append(c.alias(f.name))
        return raw.select(*cols)
    return spark.read.schema(ENTITY_SCHEMA).parquet(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, compression: str = "none") -> None:
    """IO3: sink; CSV gets a header, files of bounded length and the given compression,
    parquet keeps types."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
                  maxRecordsPerFile=CSV_FILE_ROWS, compression=compression).csv(path)
    else:
        w.format(fmt).save(path)


def run_build_job(spark: SparkSession, in_path: str, out_path: str, reference_date: str,
                  out_fmt: str = "parquet") -> dict:
    """IO4: raw CSV -> cleaned log -> entity table -> sink; the counts are taken
    while the one job runs, so nothing is read twice."""
    from plumbline.operators.clean import clean_raw
    from plumbline.operators.entity import build_entity_table

    rows, entities = Observation("rows"), Observation("entities")
    count = F.count(F.lit(1)).alias("n")
    log = clean_raw(read_raw_csv(spark, in_path), keep=["rid"]).observe(rows, count)
    ent = build_entity_table(log, reference_date).observe(entities, count)
    write_table(ent, out_path, out_fmt)
    return {"rows": rows.get["n"], "entities": entities.get["n"], "written": entities.get["n"]}


# --- IO6: polygons -------------------------------------------------------------

GEOJSON_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("geometry", T.StructType([
            T.StructField("type", T.StringType()),
            # Polygon: ring[point[x,y]]; MultiPolygon: poly[ring[point]] -> read as text
            T.StructField("coordinates", T.StringType()),
        ])),
    ]))),
])


def read_polygon_edges(spark: SparkSession, path: str) -> DataFrame:
    """IO6: GeoJSON file -> edge table (feature, ring, i, x1, y1, x2, y2).

    Polygon and MultiPolygon are both read; only the outer ring of each
    polygon is used.  x = longitude, y = latitude.
    """
    doc = spark.read.option("multiLine", True).schema(GEOJSON_SCHEMA).json(path)
    feats = doc.select(F.posexplode("features").alias("feature", "f")).select(
        "feature", F.col("f.geometry.type").alias("gtype"),
        F.col("f.geometry.coordinates").alias("coords"))
    poly3 = "array<array<array<double>>>"
    poly4 = "array<array<array<array<double>>>>"
    polys = feats.select(
        "feature",
        F.when(F.col("gtype") == "MultiPolygon", F.from_json("coords", poly4))
         .otherwise(F.array(F.from_json("coords", poly3))).alias("polys"))
    rings = polys.select("feature", F.posexplode("polys").alias("ring", "p")).select(
        "feature", "ring", F.col("p")[0].alias("pts"))
    return edges_from_rings(rings)


def edges_from_rings(rings: DataFrame) -> DataFrame:
    """(feature, ring, pts array<array<double>>) -> one row per edge (j=i-1 wraps)."""
    e = rings.select("feature", "ring", "pts", F.posexplode("pts").alias("i", "pt"))
    n = F.size("pts")
    prev = F.element_at(F.col("pts"), F.when(F.col("i") == 0, n).otherwise(F.col("i")))
    return e.select("feature", "ring", "i",
                    F.col("pt")[0].alias("x1"), F.col("pt")[1].alias("y1"),
                    prev[0].alias("x2"), prev[1].alias("y2"))


# --- IO7: lookup tables -------------------------------------------------------------

def presets_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(K.WALK_PRESETS,
                                 "name string, walk_km double, gamma double, max_steps int, "
                                 "sigma_km double")


def places_table(spark: SparkSession) -> DataFrame:
    """The named places to start from."""
    return spark.createDataFrame(K.PLACES, "place string, lat double, lng double")


def at_places(requests: DataFrame, place: str = "place") -> DataFrame:
    """Requests that name a place instead of a position: the place's position, and
    the given one where no place, or an unknown one, is named."""
    p = places_table(requests.sparkSession).select(F.col("place").alias("_p"), F.col("lat").alias("_lat"), F.col("lng").alias("_lng"))
    j = requests.join(p, F.col(place) == F.col("_p"), "left")
    return j.withColumn("lat", F.coalesce("_lat", "lat")).withColumn("lng", F.coalesce("_lng", "lng")).drop("_p", "_lat", "_lng")
