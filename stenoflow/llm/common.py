"""Shared Spark helpers of the training-data operators."""

from __future__ import annotations

import os
import re
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stenoflow.llm import bytesets as B

_ROOT = Path(__file__).resolve().parents[2]


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers that lack it on PYTHONPATH."""
    if str(_ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    sc = spark.sparkContext
    if getattr(sc, "_stenoflow_shipped", False):
        return
    path = Path(tempfile.mkdtemp(prefix="stenoflow-")) / "stenoflow_src.zip"
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted((_ROOT / "stenoflow").rglob("*.py")):
            z.write(p, p.relative_to(_ROOT))
    sc.addPyFile(str(path))
    # the driver keeps importing its own source tree
    sys.path[:] = [p for p in sys.path if not p.endswith("stenoflow_src.zip")]
    sc._stenoflow_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for cut lineage; only a session on this machine alone gets a folder of its own."""
    sc = spark.sparkContext
    place = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if place is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("a cluster needs a shared folder in spark.checkpoint.dir")
        place = tempfile.mkdtemp(prefix="spark-checkpoint-", dir="/tmp")
        sc.setCheckpointDir(place)
    return place.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared checkpoint folder, once, and go on from there."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/cut-{run_id(spark)}"
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


_written: list[str] = []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are cut inside are deleted at the end, when what was made of them is complete or has failed."""
    begun = len(_written)
    try:
        yield
    finally:
        paths = _written[begun:]
        del _written[begun:]
        for path in paths:
            remove(spark, path)
    release(spark)


def release(spark: SparkSession) -> None:
    """Give back memory of the driver that nothing refers to any more.

    Spark's cleaner deletes shuffles and broadcasts when the driver's garbage is collected, which
    is else due every 30 minutes.  Memory that the driver's JVM and Python have freed stays with the
    process until it is asked for; a JVM without that command keeps it.
    """
    jvm, array = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    jvm.System.gc()
    call = array(jvm.Object, 4)
    call[0] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
    call[1] = "systemTrimNativeHeap"
    server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
    methods = jvm.Class.forName("javax.management.MBeanServer").getMethods()
    try:
        next(m for m in methods if m.getName() == "invoke").invoke(server, call)
    except Py4JJavaError:
        pass
    B.give_back()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column | str, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; a null id counts as empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % parts


def unit_hash(*cols: Column | str) -> Column:
    """A number in [0, 1) that depends on the given columns alone."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def within_bytes(rows: int, row_bytes: int, limit: int = 64 << 20) -> bool:
    """Whether that many rows may be broadcast."""
    return rows * row_bytes <= limit


def look_up(rows: DataFrame, table: DataFrame, on: str, hot_rows: int) -> DataFrame:
    """rows, left-joined with a table that holds each key once.

    A small table is broadcast.  Beside a larger one, keys with more than hot_rows rows (so at
    most one for so many rows) are looked up by broadcast, and only the other rows are shuffled.
    """
    if within_bytes(table.count(), 64, 16 << 20):
        return rows.join(F.broadcast(table), on, "left")
    hot = F.broadcast(cut(rows.groupBy(on).count().where(F.col("count") > hot_rows).where(F.col(on).isNotNull()).select(on)))
    none = rows.where(F.col(on).isNull())
    some = rows.where(F.col(on).isNotNull())
    busy = some.join(hot, on, "left_semi").join(F.broadcast(table.join(hot, on, "left_semi")), on, "left")
    rest = some.join(hot, on, "left_anti").join(table, on, "left")
    return busy.unionByName(rest).unionByName(none, allowMissingColumns=True)


def known_labels(labels: DataFrame, key: str, label: str) -> DataFrame:
    """(k, label): keys with a label 0 or 1; a pair that is repeated counts once."""
    known = labels.select(F.col(f"`{key}`").alias("k"), F.col(f"`{label}`").cast("int").alias("label"))
    return known.where(F.col("label").isin(0, 1) & F.col("k").isNotNull()).distinct()


def drawn_rows(df: DataFrame, drawn: DataFrame, at_most: int, *, key: str, text: str) -> DataFrame:
    """(k, label, o, text): the rows of df whose key is among the drawn (k, label, o), at_most of them or about so many.

    More rows than that have a drawn key only if rows share their keys.  Then rows with equal key,
    label and text count once, and a share of them is taken by a hash of key and text.  The count that
    decides reads no text.
    """
    rows = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("string").alias("text"))
    if rows.select("k").join(F.broadcast(drawn), "k").count() <= at_most:
        return rows.join(F.broadcast(drawn), "k")
    met = rows.withColumn("h", F.xxhash64("text")).join(F.broadcast(drawn), "k")
    n = met.select("k", "label", "h").distinct().count()
    taken = met.where(unit_hash("k", "h", F.lit("shared")) < at_most / n)
    return taken.groupBy("k", "label", "o", "h").agg(F.any_value("text").alias("text")).drop("h")


def free_name(df: DataFrame, name: str) -> str:
    """name, or name with underscores added until df has no such column in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def replace_columns(df: DataFrame, struct: str, names: list[str]) -> DataFrame:
    """Spread the fields of a struct column over df; fields replace columns of the same name."""
    new = {n.lower() for n in names} | {struct.lower()}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in new]
    return df.select(*kept, *[F.col(f"`{struct}`.`{n}`").alias(n) for n in names])


def run_id(spark: SparkSession) -> str:
    """A name that no other run uses."""
    return f"{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:12]}"
