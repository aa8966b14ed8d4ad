"""Queries over real files: the stand-in is written to the shared folder, read
back by the sources and compared with what was written (IO1-IO4, IO6)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from plumbline.operators import grid as G
from plumbline.operators.clean import clean_raw
from plumbline.plans.catalog import register
from plumbline.plans.q_clean import CLEAN_SQL
from plumbline.plans.q_entity import ENTITY_CTES, entity_table
from plumbline.plans.q_grid import POINT_IN_AREA_SQL
from plumbline.plans.standins import REFERENCE_DATE, entity_coordinates, raw_inspection_text, table
from plumbline.session import checkpoint_dir
from plumbline.sources.files import read_entity_table, read_polygon_edges, read_raw_csv, run_build_job, write_table


def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark)}/plumbline-files/{name}-{uuid.uuid4().hex}"


def _raw_csv(spark, sf_dir) -> str:
    path = _folder(spark, "raw")
    write_table(raw_inspection_text(spark, sf_dir).drop("rid"), path, "csv", compression="gzip")
    return path


@register("csv_scan_clean", CLEAN_SQL + "\nSELECT * FROM clean")
def csv_scan_clean(spark, sf_dir):
    """IO1: quoted commas, doubled quotes and line breaks survive the file."""
    return clean_raw(read_raw_csv(spark, _raw_csv(spark, sf_dir)))


@register("entity_csv_file", ENTITY_CTES + "SELECT * FROM ent")
def entity_csv_file(spark, sf_dir):
    """IO2 + IO3 through CSV."""
    path = _folder(spark, "entity-csv")
    write_table(entity_table(spark, sf_dir), path, "csv")
    return read_entity_table(spark, path, "csv")


@register("entity_parquet_file", ENTITY_CTES + "SELECT * FROM ent")
def entity_parquet_file(spark, sf_dir):
    """IO2 + IO3 through Parquet, partitioned by area."""
    path = _folder(spark, "entity-parquet")
    write_table(entity_table(spark, sf_dir), path, partition_by=["boro"])
    return read_entity_table(spark, path)


@register("build_job_counts", CLEAN_SQL + """
SELECT count(*) AS n_rows, count(DISTINCT camis) AS n_entities, count(DISTINCT camis) AS n_written FROM clean""")
def build_job_counts(spark, sf_dir):
    """IO4: the whole job from a CSV file to an entity file."""
    out = _folder(spark, "job")
    n = run_build_job(spark, _raw_csv(spark, sf_dir), out, REFERENCE_DATE)
    back = read_entity_table(spark, out).agg(F.count(F.lit(1)).alias("n_written"))
    return back.select(F.lit(n["rows"]).cast("long").alias("n_rows"), F.lit(n["entities"]).cast("long").alias("n_entities"),
                       "n_written")


@register("polygon_file", POINT_IN_AREA_SQL)
def polygon_file(spark, sf_dir):
    """IO6: areas written as a GeoJSON file, read back as edges, then J11."""
    n = table(spark, sf_dir, "nation")
    lat, lng = entity_coordinates(F.col("n_nationkey") * F.lit(31) + F.lit(7))
    rings = n.groupBy("n_regionkey").agg(F.transform(F.sort_array(F.collect_list(F.struct(
        "n_nationkey", F.array(lng, lat).alias("pt")))), lambda s: s["pt"]).alias("ring"))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.col("n_regionkey").cast("string").alias("name")).alias("properties"),
                       F.struct(F.lit("Polygon").alias("type"), F.array("ring").alias("coordinates")).alias("geometry"))
    doc = rings.agg(F.sort_array(F.collect_list(F.struct("n_regionkey", feature.alias("f")))).alias("fs")).select(
        F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.transform("fs", lambda x: x["f"]).alias("features"))).alias("value"))
    path = _folder(spark, "areas")
    doc.coalesce(1).write.text(path)
    return G.point_in_polygons(entity_table(spark, sf_dir), read_polygon_edges(spark, path), "camis", "latitude", "longitude")
