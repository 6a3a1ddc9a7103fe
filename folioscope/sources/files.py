"""Project trees and text files as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.functions import paths

PNG = "89504E470D0A1A0A"


@F.pandas_udf(T.StringType())
def lenient(content):  # noqa: ANN001, ANN201
    """UTF-8 without a byte order mark; bytes that aren't UTF-8 become replacement characters."""
    return content.map(lambda b: b.decode("utf-8-sig", "replace"), na_action="ignore")


@F.pandas_udf(T.StringType())
def ignoring(content):  # noqa: ANN001, ANN201
    """UTF-8; bytes that aren't are left out."""
    return content.map(lambda b: b.decode("utf-8", "ignore"), na_action="ignore")


def png_size(content: Column) -> tuple[Column, Column]:
    """(width, height) of a PNG from its header, else null."""
    head = F.hex(F.substring(content, 1, 24))
    good = head.startswith(PNG) & (F.length(head) >= 48)
    number = lambda at: F.when(good, F.conv(F.substring(head, at, 8), 16, 10).cast("long"))
    return number(33), number(41)


def tree(spark: SparkSession, root: str, text_suffixes: tuple[str, ...], pattern: str | None = None, decode=lenient) -> DataFrame:  # noqa: ANN001
    """All files below ``root``, whose folders are projects: project, rel_path, size_bytes, sha256, width, height, text.

    Text is decoded for the given suffixes only, by :func:`lenient` or :func:`ignoring`; other content never reaches Python.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    raw = (reader.option("pathGlobFilter", pattern) if pattern else reader).load(root)
    inside = F.regexp_replace("path", r"^[^:]*:/*" + _quoted(root), "")
    raw = raw.withColumn("inside", inside).withColumn("project", F.substring_index("inside", "/", 1)).withColumn("rel_path", F.expr("substring(inside, length(project) + 2)"))
    width, height = png_size(F.col("content"))
    text = decode(F.when(paths.one_of(F.col("rel_path"), text_suffixes), F.col("content")))
    return raw.select("project", "rel_path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"), width.alias("width"), height.alias("height"), text.alias("text"))


def _quoted(root: str) -> str:
    import re

    return re.escape(re.sub(r"^[^:/]*:/*|^/+", "", root).rstrip("/")) + "/"


def texts(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, text) of each file, without bytes that aren't UTF-8."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return raw.select(F.col("path").alias("doc_id"), ignoring(F.col("content")).alias("text"))


def artifacts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON artifacts, one per file; a file that doesn't parse gives nulls and its text in ``_corrupt``."""
    return spark.read.schema(f"{schema}, _corrupt string").option("multiLine", "true").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def inline(spark: SparkSession, texts: list[str]) -> DataFrame:
    """Literal texts as documents."""
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
