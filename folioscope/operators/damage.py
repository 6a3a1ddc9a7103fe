"""Encoding damage: scores, issues and repair."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.functions.text import cjk, token_score

# What UTF-8 Chinese read as GBK tends to show. The first list is for extracted text, the second for project files.
EXTRACTED = ["瀹", "為", "獙", "鍥", "琛", "绗", "涓", "鎽", "瑕", "鍏", "抽敭", "璇", "傝", "枃", "鐚", "閿", "閻", "閼", "濡", "鐠", "锛", "鈥"]
PROJECT = ["锛", "鐨", "鑸", "垫", "浠", "妯", "绯", "璇", "鎺", "鍥", "琛", "寮", "瀛", "粨", "姘", "戣", "缂"]
RISKY = "胃"
ENCODINGS = ("gbk", "gb18030", "cp936")
LEAST_SCORE, LEAST_HITS, LEAST_RATIO, SAMPLE = 2, 10, 0.015, 160


def score(text: Column) -> Column:
    return token_score(text, EXTRACTED)


def project_hits(text: Column) -> Column:
    return token_score(text, PROJECT)


def project_damaged(text: Column) -> Column:
    """Whether a file has hits enough, and enough of them among its ideographs."""
    hits = project_hits(text)
    return (hits >= LEAST_HITS) & (hits / F.greatest(cjk(text), F.lit(1)) >= LEAST_RATIO)


def repaired(text: str | None) -> str | None:
    """The best reading of the text's bytes as UTF-8, if it is less damaged and keeps half of the ideographs."""
    if not text:
        return None
    damage = lambda t: sum(t.count(x) for x in EXTRACTED)
    ideographs = lambda t: sum("一" <= c <= "鿿" for c in t)
    before = damage(text)
    readings = []
    for encoding in ENCODINGS if before else ():
        try:
            reading = text.encode(encoding).decode("utf-8")
        except UnicodeError:
            continue
        if reading != text and reading not in readings:
            readings.append(reading)
    if not readings:
        return None
    best = min(readings, key=lambda t: (damage(t), -ideographs(t), len(t)))
    return best if damage(best) < before and ideographs(best) >= max(1, ideographs(text) // 2) else None


@F.pandas_udf(T.StringType())
def repair(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Rows that aren't damaged come in as null and cost nothing."""
    for series in texts:
        yield series.map(repaired, na_action="ignore")


def inspect(elements: DataFrame, repairing: bool = False) -> DataFrame:
    """Add damage, candidate and the text to go on with; nulls for tables. Only damaged texts reach Python."""
    out = elements.withColumn("damage", score(F.col("text")))
    out = out.withColumn("candidate", repair(F.when(F.col("damage") >= LEAST_SCORE, F.col("text"))))
    return out.withColumn("final_text", F.coalesce("candidate", "text") if repairing else F.col("text"))


def issue_array() -> Column:
    """The issues of an inspected element: issue_type, severity, sample, repaired_sample."""
    cut = lambda c: F.left(c, F.lit(SAMPLE))
    broken = F.when(F.col("damage") >= LEAST_SCORE, F.struct(F.lit("mojibake").alias("issue_type"), F.lit("warning").alias("severity"), cut(F.col("text")).alias("sample"), cut(F.col("candidate")).alias("repaired_sample")))
    risky = F.when(F.contains("final_text", F.lit(RISKY)), F.struct(F.lit("risky_symbol_mojibake").alias("issue_type"), F.lit("review").alias("severity"), cut(F.col("final_text")).alias("sample"), F.lit(None).cast("string").alias("repaired_sample")))
    return F.array_compact(F.array(broken, risky))


def issues(inspected: DataFrame) -> DataFrame:
    """One row for each issue."""
    return inspected.select("doc_id", "body_pos", F.explode(issue_array()).alias("i")).select("doc_id", "body_pos", "i.*")
