"""Session helpers: shipping the package to executors and shared scratch tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

#: Spark writes no table of more buckets; a bucket may hold several keys.
MAX_BUCKETS = 100_000
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that functions pickled by reference import there."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="sigloom-"), "sigloom.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, dirs, names in os.walk(root):
            dirs[:] = [x for x in dirs if x != "__pycache__"]
            for n in names:
                if n.endswith(".py"):
                    p = os.path.join(d, n)
                    z.write(p, os.path.join("sigloom", os.path.relpath(p, root)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder every node shares, as the cluster names it in spark.checkpoint.dir; a local folder where it is unset (tests)."""
    sc = spark.sparkContext
    where = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if where:
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            sc.setCheckpointDir(where)
        return where.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all nodes share")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(os.path.join(tempfile.gettempdir(), "sigloom-checkpoints"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; its files go when the application ends."""
    path = f"{shared_dir(spark)}/sigloom-{name}-{uuid.uuid4().hex}"
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return path


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: lineage ends there and a lost executor loses nothing."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, columns: list[str], n: int, name: str = "table") -> DataFrame:
    """As materialise, in n buckets by columns: groups and joins on them read the table without a shuffle.

    The table's name leaves the catalogue at once; the DataFrame keeps its files and their layout.
    """
    spark, label = df.sparkSession, f"sigloom_{uuid.uuid4().hex}"
    df.write.bucketBy(max(1, min(n, MAX_BUCKETS)), *columns).format("parquet").option("path", scratch(spark, name)).saveAsTable(label)
    out = spark.table(label)
    spark.sql(f"DROP TABLE {label}")
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
