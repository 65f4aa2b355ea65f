"""Shared plumbing of the training-data operators: tables, lineage cuts, connected components."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

import loanlens
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.session import checkpoint_dir, cut_lineage

#: Frames of at most this many narrow rows (one or two numbers) may be broadcast; larger ones are
#: joined by shuffle.
BROADCAST_ROWS = 1_000_000
#: Bytes of an Arrow batch on its way to or from Python, unless the session says otherwise: a little
#: less than a packed chunk (``exchange.PACK_BYTES``), so that a batch is one chunk.
ARROW_BYTES = 6_000_000
_ARROW_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python once per application (``addPyFile``); bound Arrow batches."""
    sc = spark.sparkContext
    if spark.conf.get(_ARROW_CONF, None) is None:
        # 10,000 whole texts are held several times over, in the JVM and in each worker
        spark.conf.set(_ARROW_CONF, str(ARROW_BYTES))
    if getattr(sc, "_loanlens_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(loanlens.__file__))
    folder = tempfile.mkdtemp(prefix="loanlens-py-")
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "loanlens"), "zip", os.path.dirname(root), "loanlens"))
    sc._loanlens_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` (shared by driver and executors)."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def carried(keep, taken) -> list[str]:
    """Names under which kept columns come along: their own, or ``doc_<name>`` where a result has that name."""
    out: list[str] = []
    for name in keep:
        while name in taken or name in out:
            name = f"doc_{name}"
        out.append(name)
    return out


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage ends there."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows are within ``BROADCAST_ROWS``, else as it is."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)`` (long ids) -> ``(v, root)``, root the smallest id.

    Alternating large-star and small-star rounds over the edge list; every round is two
    aggregations with map-side combine, and lineage is cut by a reliable checkpoint. Only the
    count and a checksum of the edges reach the driver. Vertices without an edge are absent.
    """
    cur = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                                   F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = cur.union(cur.select("b", "a"))
        low = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.where("b > a").join(low, F.col("a") == F.col("u")).select(
            F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        joined = large.join(low, F.col("a") == F.col("u"))
        nxt = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            joined.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        nxt = cut_lineage(nxt)
        now = tuple(nxt.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state, cur = now, nxt
    return nxt.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("root")).union(
        nxt.select(F.col("b").alias("v"), F.col("b").alias("root")).distinct())
