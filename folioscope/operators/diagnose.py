"""Counts and defects of whole documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.operators.damage import LEAST_SCORE, RISKY


def profile(annotated: DataFrame) -> DataFrame:
    """All counts of each document in one aggregation.

    Reads kind, role, citations, image_ids, nearby_caption, n_notes (of tables),
    has_math, damage, candidate and final_text of each element.
    """
    n = lambda c, name: F.count_if(c).alias(name)
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name)
    role, n_images = F.col("role"), F.coalesce(F.size("image_ids"), F.lit(0))
    damaged, risky = F.col("damage") >= LEAST_SCORE, F.contains("final_text", F.lit(RISKY))
    out = annotated.groupBy("doc_id").agg(
        n(F.col("kind") == "p", "paragraphs"), n(role.isin("heading", "heading_candidate"), "headings"), n(role == "heading_candidate", "heading_candidates"), n(F.col("kind") == "tbl", "tables"),
        n(F.size("citations") > 0, "citation_paragraphs"), n(role == "bibliography_heading", "bibliography_headings"), total(n_images, "images"), total(F.when(F.col("nearby_caption").isNull(), n_images), "captionless_images"),
        total(F.col("n_notes"), "table_notes"), n("has_math", "equations"), n(damaged, "mojibake"), n(damaged & F.col("candidate").isNotNull(), "repairable"), n(risky, "risky"),
    )
    return out.withColumn("text_issues", F.col("mojibake") + F.col("risky"))


def defects(flavor: Column) -> Column:
    """Messages of a profile row, in fixed order. Reads the columns that the counts above give."""
    n = lambda name: F.col(name).cast("string")
    return F.array_compact(
        F.array(
            F.when(flavor == "strict", F.lit("strict package: read with its own namespaces")).when(flavor == "unknown", F.lit("unknown package namespace: review the extraction")),
            F.when(F.col("heading_candidates") > 0, F.concat(F.lit("headings by number only: "), n("heading_candidates"))),
            F.when(F.col("captionless_images") > 0, F.concat(F.lit("images without a caption nearby: "), n("captionless_images"))),
            F.when(F.col("table_notes") > 0, F.concat(F.lit("table notes to review: "), n("table_notes"))),
            F.when(F.col("equations") > 0, F.concat(F.lit("equations to rebuild: "), n("equations"))),
            F.when(F.col("mojibake") > 0, F.concat(F.lit("damaged paragraphs: "), n("mojibake"), F.lit(", repairable: "), n("repairable"))),
            F.when(F.col("risky") > 0, F.concat(F.lit("paragraphs with risky symbols: "), n("risky"))),
            F.when((F.col("citation_paragraphs") > 0) & (F.col("bibliography_headings") == 0), F.lit("citations without a bibliography heading")),
        )
    )
