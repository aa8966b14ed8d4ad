"""Helpers shared by the operators of this folder.

* ``text_frame``: the two columns an operator reads, whatever else a table has.
* ``written``: cut lineage with a Parquet table in the shared checkpoint folder.
* ``slices``: walk an Arrow batch in pieces of bounded bytes, so that one batch
  of long texts never needs more working memory than one long text.
* ``groups``: walk key groups of a sorted stream of Arrow batches.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import checkpoint_dir

SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once per application: functions that run in
    tasks import it, wherever Spark was started from."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="plumbline-")) / "plumbline.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f"{top.name}/{f.relative_to(top)}")
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)


def in_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with the package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def text_frame(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of ``df``; every other column is left behind."""
    return df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as make it new to ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def fields(df: DataFrame) -> str:
    """The schema of ``df`` as a DDL string."""
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)


def own_columns(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


def remainder(doc_id: Column | str, m: int) -> Column:
    """crc32 of the id's decimal text modulo ``m`` (null for a null id)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % m


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: later
    plans start from the files, so a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/plumbline-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, col: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Zero-copy slices of ``batch`` holding at most ``limit`` bytes of ``col``
    (a single longer value makes a slice of its own)."""
    if batch.num_rows == 0:
        return
    size = pc.binary_length(batch.column(batch.schema.get_field_index(col)))
    ends = np.cumsum(size.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Key groups of a stream whose rows of one key follow each other."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)) for k in keys]
        new = np.zeros(n, bool)
        for c in cols:
            v = c.to_numpy(zero_copy_only=False)
            new[1:] |= v[1:] != v[:-1]
        cuts = np.flatnonzero(new).tolist()
        first = tuple(c[0].as_py() for c in cols)
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        at = 0
        for cut in cuts:
            held.append(batch.slice(at, cut - at))
            yield pa.Table.from_batches(held)
            held, at = [], cut
        held.append(batch.slice(at, n - at))
        last = tuple(c[n - 1].as_py() for c in cols)
    if held:
        yield pa.Table.from_batches(held)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing of an unsigned array (wraps modulo 2**64)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0xD1342543DE82EF95)
    return h ^ (h >> np.uint64(33))
