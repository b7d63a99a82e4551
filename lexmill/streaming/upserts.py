"""Keeping a table current from a stream of changed entries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexmill.sinks.writers import upsert

#: Parts of the table, and versions kept of each.
BUCKETS, KEEP = 64, 2


def stream_upserts(changes: DataFrame, path: str, checkpoint: str, ord_col: str = "rec_id", id_col: str = "id", buckets: int = BUCKETS, keep: int = KEEP) -> StreamingQuery:
    """Apply each micro-batch of ``changes`` to the Parquet table at ``path``.

    The table lies in parts by the hash of the id. A batch reads and writes the
    parts that it changes alone, as their next version (``path/v=<batch>/b=<part>``);
    readers take the newest version of each part (``latest``). A batch that runs
    again writes the same version. Of each part the last ``keep`` versions stay.
    """

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        placed = batch.withColumn("b", F.pmod(F.xxhash64(id_col), F.lit(buckets)).cast("int"))
        touched = {r.b for r in placed.select("b").distinct().collect()}  # ``buckets`` numbers at most
        if not touched:
            return
        now = latest(spark, path, number, touched)
        table = upsert(now if now is not None else batch.limit(0), batch, ord_col, id_col)
        out = table.withColumn("b", F.pmod(F.xxhash64(id_col), F.lit(buckets)).cast("int"))
        out.repartition("b").write.mode("overwrite").partitionBy("b").parquet(f"{path}/v={number}")
        fs, at = _file_system(spark, path)
        for b, versions in _versions(spark, path).items():
            for v in versions[keep:]:
                fs.delete(at(f"{path}/v={v}/b={b}"), True)

    return changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _file_system(spark: SparkSession, path: str) -> tuple:
    at = spark._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark._jsc.hadoopConfiguration()), at


def _versions(spark: SparkSession, path: str, before: int = 1 << 60) -> dict[int, list[int]]:
    """Part -> its finished versions under a batch number, the newest first."""
    fs, at = _file_system(spark, path)
    if not fs.exists(at(path)):
        return {}
    out: dict[int, list[int]] = {}
    names = [s.getPath().getName() for s in fs.listStatus(at(path))]
    for v in sorted((int(n[2:]) for n in names if n.startswith("v=")), reverse=True):
        if v < before and fs.exists(at(f"{path}/v={v}/_SUCCESS")):
            for s in fs.listStatus(at(f"{path}/v={v}")):
                if s.getPath().getName().startswith("b="):
                    out.setdefault(int(s.getPath().getName()[2:]), []).append(v)
    return out


def latest(spark: SparkSession, path: str, before: int = 1 << 60, parts: set[int] | None = None) -> DataFrame | None:
    """The newest version under a batch number of all parts or some; None if there is none."""
    found = [f"{path}/v={versions[0]}/b={b}" for b, versions in sorted(_versions(spark, path, before).items()) if parts is None or b in parts]
    return spark.read.parquet(*found) if found else None
