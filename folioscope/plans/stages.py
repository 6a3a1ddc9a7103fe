"""Runs stages one after another and records what they read and wrote, so that fresh ones are skipped."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators import manifest

RECORD = "module string, updated_at timestamp, command string, notes string, kind_of string, path string, exists boolean, kind string, sha256 string"


def fingerprints(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, exists, kind, sha256, size_bytes and mtime of files and folders, hashed on the executors."""
    fs = spark._jvm.org.apache.hadoop.fs
    known = []
    for p in paths:
        at = fs.Path(p)
        system = at.getFileSystem(spark._jsc.hadoopConfiguration())
        there = system.exists(at)
        known.append((p, there, (("directory" if system.getFileStatus(at).isDirectory() else "file") if there else None)))
    base = spark.createDataFrame(known, "path string, exists boolean, kind string")
    parts = []
    for p, there, kind in known:
        if not there:
            continue
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(p)
        hashed = files.select(F.lit(p).alias("directory"), F.regexp_replace("path", r"^[^:]*:/*", "/").alias("full"), F.sha2("content", 256).alias("sha256"), "length", F.unix_micros("modificationTime").alias("mtime"))
        clean = "/" + p.split(":", 1)[-1].lstrip("/").rstrip("/")
        own = hashed.withColumn("rel_path", F.expr(f"substring(full, {len(clean) + 2})"))
        if kind == "file":
            parts.append(own.select(F.col("directory").alias("path"), "sha256", F.col("length").alias("size_bytes"), "mtime"))
        else:
            sums = own.groupBy("directory").agg(F.sum("length").alias("size_bytes"), F.max("mtime").alias("mtime"))
            parts.append(manifest.directory_hashes(own).join(sums, "directory").select(F.col("directory").alias("path"), "sha256", "size_bytes", "mtime"))
    out = base
    if parts:
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
        return out.join(found, "path", "left")
    return out.withColumn("sha256", F.lit(None).cast("string")).withColumn("size_bytes", F.lit(None).cast("long")).withColumn("mtime", F.lit(None).cast("long"))


class Manifest:
    """An append-only table of records in a folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def records(self) -> DataFrame:
        fs = self.spark._jvm.org.apache.hadoop.fs
        at = fs.Path(self.folder)
        there = at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)
        return self.spark.read.schema(RECORD).parquet(self.folder) if there else self.spark.createDataFrame([], RECORD)

    def latest(self) -> DataFrame:
        """All rows of each module's last record."""
        rows = self.records()
        last = rows.groupBy("module").agg(F.max("updated_at").alias("updated_at"))
        return rows.join(last, ["module", "updated_at"])

    def record(self, module: str, inputs: list[str], outputs: list[str], command: str = "", notes: str = "") -> None:
        prints = fingerprints(self.spark, list(dict.fromkeys([*inputs, *outputs])))
        sides = self.spark.createDataFrame([*[(p, "input") for p in inputs], *[(p, "output") for p in outputs]] or [], "path string, kind_of string")
        now = F.lit(datetime.now(timezone.utc).replace(tzinfo=None)).cast("timestamp")
        sides.join(prints, "path").select(F.lit(module).alias("module"), now.alias("updated_at"), F.lit(command).alias("command"), F.lit(notes).alias("notes"), "kind_of", "path", "exists", "kind", "sha256").coalesce(1).write.mode("append").parquet(self.folder)

    def check(self, module: str) -> dict:
        """recorded, fresh, changed and missing of one module."""
        own = self.latest().filter(F.col("module") == module)
        paths = [r["path"] for r in own.select("path").distinct().collect()]  # a record's own paths, a handful
        current = fingerprints(self.spark, paths) if paths else self.spark.createDataFrame([], "path string, exists boolean, kind string, sha256 string")
        row = manifest.freshness(own, current, self.spark.createDataFrame([(module,)], "module string")).first()
        return row.asDict()

    def run(self, module: str, stage: Callable[[], bool | None], inputs: list[str], outputs: list[str], force: bool = False) -> str:
        """Run a stage unless it is fresh; record it only if it doesn't fail. Returns fresh, done or failed."""
        if not force and self.check(module)["fresh"]:
            return "fresh"
        if stage() is False:
            return "failed"
        self.record(module, inputs, outputs, command=getattr(stage, "__name__", ""))
        return "done"
