"""Session-level plumbing shared by all operators: reading tables, using idle
slots, and cutting lineage in a place every executor can reach."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings for a session of our own; a session given by the caller keeps its own.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(master: str = "local[8]", app: str = "lexmill", **conf: str) -> SparkSession:
    """A session for tests and benchmarks (a cluster brings its own)."""
    b = SparkSession.builder.master(master).appName(app)
    for k, v in {**DEFAULTS, **conf}.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data directory."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all slots for CPU-heavy work on few input splits.

    A scan of a large table has more splits than the cluster has slots and is
    returned untouched (no shuffle); only a small input is dealt out evenly.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor can reach: the one the cluster names in spark.checkpoint.dir.

    Where none is named, a session on one machine (tests) uses a folder there;
    on a cluster that is an error, as no executor could read another's files.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    own = sc._jsc.sc().getCheckpointDir()
    if named or own.isDefined():
        return (named or own.get()).rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a shared folder")
    return os.path.join(tempfile.gettempdir(), f"lexmill-{os.getpid()}")


_written: dict[str, DataFrame] = {}


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from there.

    Used where a result is read more than once or a loop would grow its
    lineage. A lost executor costs nothing: the files stay. Joins see the
    table's true size. ``release`` deletes it; what is left goes at exit.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._durable_path = path
    _written[path] = out
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables that ``durable`` wrote and nothing reads any more."""
    for t in tables:
        path = getattr(t, "_durable_path", None)
        if _written.pop(path, None) is not None:
            sc = t.sparkSession.sparkContext
            at = sc._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _release_all() -> None:
    for t in list(_written.values()):
        try:
            release(t)
        except Exception:  # noqa: BLE001 - the session may have ended before
            _written.clear()


def bounded_sample(df: DataFrame, by: list[str], rows: int) -> DataFrame:
    """The ``rows`` rows with the least hashes of ``by``: the same at every run.

    On a table much larger than the bound, rows whose hash is surely too great
    are left out where they are read, so that the tasks together send a few
    times ``rows`` rows, whatever their number.
    """
    key = F.xxhash64(*by)
    total = df.count()
    if total > 4 * rows:
        df = df.where(key < int(-(2**63) + 2**64 * (4 * rows / total)))
    return df.orderBy(key, *by).limit(rows)
