"""Compaction of a history that a stream appends to, one folder a batch (K7).

Batches that are complete are rewritten as days of few files, and published by a
manifest that is committed as a whole: it names the runs of compacted files and
the last batch that they cover. A reader takes the manifest's runs and the batch
folders after it, so it sees every row once, whatever happens to a compaction
that is under way or was broken off. The newest batch, the only one that a
restarted stream may write again, is never covered.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripflow import sinks

MANIFEST = "run string, upto long"


def _home(path: str) -> str:
    return path.rstrip("/") + "_compacted"


def manifest(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Published runs of compacted files with the last batch of each, oldest
    first."""
    schema = StructType.fromDDL(MANIFEST)
    return sorted(map(tuple, sinks.read_current(spark, f"{_home(path)}/manifest", schema).collect()), key=lambda r: r[1])


def batches(spark: SparkSession, path: str) -> list[int]:
    """Ids of the batch folders below ``path``."""
    fs, root = sinks._fs(spark, path)
    if not fs.exists(root):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(root) if st.isDirectory()]
    return sorted(int(n[len("batch_id="):]) for n in names if n.startswith("batch_id="))


def read_history(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows of the history, from compacted files and later batches."""
    done = manifest(spark, path)
    out = None
    if done:
        runs = [f"{_home(path)}/data/run={run}" for run, _ in done]
        out = spark.read.schema(schema).option("basePath", f"{_home(path)}/data").parquet(*runs) \
            .select(*schema.fieldNames())
    later = [b for b in batches(spark, path) if not done or b > done[-1][1]]
    if later:
        # a filter on the partition column: covered folders are not listed as files to read
        raw = spark.read.schema(schema).parquet(path).filter(F.col("batch_id") >= later[0]).select(*schema.fieldNames())
        out = raw if out is None else out.unionByName(raw)
    return spark.createDataFrame([], schema) if out is None else out


def compact(spark: SparkSession, path: str, schema: StructType, day: Column, rows_per_file: int = 200_000) -> int:
    """Rewrite the complete batches that no run covers yet, and publish them.
    A day of one run has at most ``rows / rows_per_file + 1`` files, each written
    by a task of its own. Returns the number of batches."""
    done = manifest(spark, path)
    new = [b for b in batches(spark, path)[:-1] if not done or b > done[-1][1]]
    if not new:
        return 0
    raw = spark.read.schema(schema).parquet(path).filter(F.col("batch_id").between(new[0], new[-1])) \
        .select(*schema.fieldNames()).withColumn("day", day)
    slots = raw.groupBy(F.col("day").alias("_day")).agg(F.expr(f"cast(count(1) div {rows_per_file} + 1 as int)").alias("slots"))
    # days and their sizes are few; a day's rows are dealt evenly to its files
    dealt = raw.join(slots, F.col("day").eqNullSafe(F.col("_day"))).drop("_day")
    dealt = dealt.withColumn("slot", F.pmod(F.xxhash64(*schema.fieldNames()), F.col("slots")))
    run = uuid.uuid4().hex
    # as many partitions as there are files, at most what the session shuffles to
    dealt.repartition("day", "slot").sortWithinPartitions("day", "slot").drop("slots").write \
        .partitionBy("day", "slot").parquet(f"{_home(path)}/data/run={run}")
    entries = spark.createDataFrame([*done, (run, new[-1])], MANIFEST)
    sinks.commit_version(entries.coalesce(1), f"{_home(path)}/manifest")
    return len(new)


def remove_covered(spark: SparkSession, path: str, keep_seconds: int = 7 * 86_400) -> int:
    """Delete batch folders that a manifest covers, and runs that none names
    (of broken compactions), once they have not been written to for
    ``keep_seconds``, so that running readers and compactions do not lose
    theirs. Returns the number of folders."""
    done = manifest(spark, path)
    if not done:
        return 0
    named, now = {run for run, _ in done}, spark.sparkContext._jvm.System.currentTimeMillis()
    gone = 0
    for folder, unused in ((path, lambda n: n.startswith("batch_id=") and int(n[9:]) <= done[-1][1]),
                           (f"{_home(path)}/data", lambda n: n.startswith("run=") and n[4:] not in named)):
        fs, root = sinks._fs(spark, folder)
        for st in fs.listStatus(root):
            if unused(st.getPath().getName()) and now - st.getModificationTime() >= keep_seconds * 1000:
                fs.delete(st.getPath(), True)
                gone += 1
    return gone
