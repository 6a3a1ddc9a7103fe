"""From packages or lines to the whole semantic record of each document."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators import damage, diagnose, render
from folioscope.operators import elements as E
from folioscope.operators import tables as T
from folioscope.sources import docx


@dataclass
class SemanticIR:
    """Normalised tables, keyed by doc_id; each can be used, joined and written on its own.

    annotated: all elements with all that is known of each; counts: a row per
    document with its counts and defects.
    """

    packages: DataFrame
    annotated: DataFrame
    counts: DataFrame

    @property
    def paragraphs(self) -> DataFrame:
        return self.annotated.filter("kind = 'p'").drop("rows", "caption", "caption_paragraph_id", "quality_notes", "n_notes", "context")

    @property
    def tables(self) -> DataFrame:
        return self.annotated.filter("kind = 'tbl'").select("doc_id", "body_pos", "id", "rows", "caption", "caption_paragraph_id", "quality_notes")

    @property
    def images(self) -> DataFrame:
        return E.images(self.annotated, docx.relationships(self.packages))

    @property
    def equations(self) -> DataFrame:
        return docx.equations(self.annotated)

    @property
    def text_issues(self) -> DataFrame:
        return damage.issues(self.annotated)

    def nested(self) -> DataFrame:
        """One row per document with its counts, its defects and its elements as an array in order."""
        skip = ("doc_id", "body_pos", "context")
        entity = F.struct("body_pos", F.to_json(F.struct(*[c for c in self.annotated.columns if c not in skip])).alias("element"))
        return self.counts.join(self.annotated.groupBy("doc_id").agg(F.array_sort(F.collect_list(entity)).alias("elements")), "doc_id", "left")

    def summary(self) -> DataFrame:
        return render.ir_summary(self.annotated, self.counts)

    def brief(self) -> DataFrame:
        return render.brief(self.annotated, self.counts)


def annotate(elements: DataFrame, repair: bool = False) -> DataFrame:
    """All that is known of each element. Damage is repaired before roles are told; all windows share one exchange by doc_id."""
    inspected = damage.inspect(E.strip_text(elements), repair)
    own = inspected.withColumn("raw_text", F.coalesce("final_text", "raw_text"))
    out = E.with_context(E.with_images(E.with_captions(E.identify(E.classify(own)))))
    notes = F.when(F.col("kind") == "tbl", T.notes(F.col("rows")))
    return out.withColumn("quality_notes", notes).withColumn("n_notes", F.size("quality_notes"))


def build(packages: DataFrame, repair: bool = False) -> SemanticIR:
    """The record of packages as :func:`folioscope.sources.docx.read` gives them."""
    annotated = annotate(docx.elements(packages), repair)
    counts = diagnose.profile(annotated).join(packages.select("doc_id", "flavor"), "doc_id")
    counts = counts.withColumn("defects", diagnose.defects(F.col("flavor"))).drop("flavor")
    return SemanticIR(packages, annotated, counts.withColumn("n_defects", F.size("defects").cast("long")))


def from_path(spark: SparkSession, path: str, repair: bool = False) -> SemanticIR:
    return build(docx.read(spark, path), repair)
