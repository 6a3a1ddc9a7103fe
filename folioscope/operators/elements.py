"""Ordered elements of documents: lines, roles, citations, ids, captions and context.

Rows are (doc_id, body_pos, kind, style, raw_text); ``kind`` is "p" or "tbl".
A document is one group: windows partition by doc_id and sort by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions.text import EXACT, every, first, has, strip

# The patterns by which roles are told, in order of precedence.
STYLED_HEADING = r"(?:Heading|标题|Title)([1-6])"
NUMBERED_HEADING = r"^\s*(?:第[一二三四五六七八九十百]+[章节]|[0-9]+(?:\.[0-9]+){0,3})\s+"
NUMBERED_HEADING_LENGTH = 80
ABSTRACT = r"^\s*(摘要|摘\s*要|Abstract)\s*[:：]?"
KEYWORDS = r"^\s*(关键词|Key words|Keywords)\s*[:：]?"
REFERENCES = r"^\s*(参考文献|References)\s*$"
FIGURE = r"^\s*(?:图|Fig\.?|Figure)\s*([0-9]+(?:[-.]\d+)?)\s*[:：.\-\s]*(.+)?$"
TABLE = r"^\s*(?:表|Table)\s*([0-9]+(?:[-.]\d+)?)\s*[:：.\-\s]*(.+)?$"
CITATION = r"\[(?:\d+(?:[-,]\s*\d+)*)\]"


def lines(documents: DataFrame) -> DataFrame:
    """One paragraph for each line of a text: doc_id, body_pos (from 0), raw_text."""
    return documents.select("doc_id", F.posexplode(F.split("text", "\n"))).select("doc_id", F.col("pos").cast("long").alias("body_pos"), F.col("col").alias("raw_text"))


def style_level(style: Column) -> Column:
    """The heading level that a style's name gives."""
    last = F.when(F.lower(style).startswith("heading"), first(style, r"([1-6])$", 1, EXACT))
    return F.coalesce(first(style, STYLED_HEADING, 1), last).cast("int")


def numbered(text: Column) -> Column:
    return has(text, NUMBERED_HEADING, EXACT) & (F.length(text) <= NUMBERED_HEADING_LENGTH)


def role(text: Column, style: Column) -> Column:
    """The first role that fits."""
    return (
        F.when(style_level(style).isNotNull(), "heading")
        .when(numbered(text), "heading_candidate")
        .when(has(text, ABSTRACT), "abstract")
        .when(has(text, KEYWORDS), "keywords")
        .when(has(text, REFERENCES), "bibliography_heading")
        .when(has(text, FIGURE), "figure_caption")
        .when(has(text, TABLE), "table_caption")
        .when(has(text, rf"\A{CITATION}\z", EXACT), "citation_fragment")
        .otherwise("body")
    )


def level(text: Column, style: Column) -> Column:
    """Of headings by style; of candidates, one more than the dots of the whole text if it starts with a digit, else 1."""
    dots = F.length(text) - F.length(F.replace(text, F.lit("."), F.lit("")))
    return F.coalesce(style_level(style), F.when(numbered(text), F.when(has(text, r"^\s*\d", EXACT), dots + 1).otherwise(1))).cast("int")


def citations(text: Column) -> Column:
    """All bracketed markers in order."""
    return every(text, CITATION, 0, EXACT)


def strip_text(elements: DataFrame) -> DataFrame:
    return elements.withColumn("text", strip("raw_text"))


def classify(elements: DataFrame) -> DataFrame:
    """Add text, role, level and citations; tables keep a null role."""
    text, style = F.col("text"), F.col("style")
    paragraph = F.col("kind") == "p"
    return strip_text(elements).withColumns({"role": F.when(paragraph, role(text, style)), "level": F.when(paragraph, level(text, style)), "citations": F.when(paragraph, citations(text))})


def _so_far(kind: str) -> Column:
    """How many elements of a kind a document has up to this one."""
    return F.count(F.when(F.col("kind") == kind, 1)).over(Window.partitionBy("doc_id").orderBy("body_pos"))


def identify(elements: DataFrame) -> DataFrame:
    """Add the ordinal id of each element among those of its kind, and of paragraphs their position (from 0).

    All windows here and below partition by doc_id, so they share one exchange.
    """
    paragraph = F.col("kind") == "p"
    number = F.when(paragraph, F.format_string("p%05d", _so_far("p"))).otherwise(F.format_string("tab%04d", _so_far("tbl")))
    return elements.withColumns({"id": number, "para_pos": F.when(paragraph, (_so_far("p") - 1).cast("long"))})


def with_captions(identified: DataFrame, radius: int = 2) -> DataFrame:
    """Add nearby_caption to paragraphs and caption and caption_paragraph_id to tables.

    A paragraph takes the first figure caption among those up to ``radius``
    paragraphs around; a table the last table caption since the table before,
    which is then used up.
    """
    ordered = Window.partitionBy("doc_id").orderBy("body_pos")
    near = Window.partitionBy("doc_id", "kind").orderBy("body_pos").rowsBetween(-radius, radius)
    segment = F.coalesce(F.count(F.when(F.col("kind") == "tbl", 1)).over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    since = Window.partitionBy("doc_id", "segment").orderBy("body_pos").rowsBetween(Window.unboundedPreceding, -1)
    found = F.last(F.when(F.col("role") == "table_caption", F.struct("text", "id")), ignorenulls=True).over(since)
    out = identified.withColumn("segment", segment).withColumn("found", F.when(F.col("kind") == "tbl", found))
    out = out.withColumn("nearby_caption", F.when(F.col("kind") == "p", F.first(F.when(F.col("role") == "figure_caption", F.col("text")), ignorenulls=True).over(near)))
    return out.withColumns({"caption": F.col("found.text"), "caption_paragraph_id": F.col("found.id")}).drop("segment", "found")


def table_captions(identified: DataFrame) -> DataFrame:
    """Tables with their captions."""
    return with_captions(identified).filter("kind = 'tbl'").select("doc_id", "body_pos", "id", "caption", "caption_paragraph_id")


def figure_captions(identified: DataFrame, radius: int = 2) -> DataFrame:
    """Paragraphs with the figure caption nearby."""
    return with_captions(identified, radius).filter("kind = 'p'").select("doc_id", "para_pos", "id", "nearby_caption")


def with_images(captioned: DataFrame) -> DataFrame:
    """Add image_ids: the ids of a paragraph's embedded images (rel_ids), numbered through the document."""
    n = F.coalesce(F.size("rel_ids"), F.lit(0))
    before = F.coalesce(F.sum(n).over(Window.partitionBy("doc_id").orderBy("body_pos").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = captioned.withColumn("images_before", before)
    return out.withColumn("image_ids", F.transform(F.coalesce("rel_ids", F.array().cast("array<string>")), lambda _, i: F.format_string("img%04d", F.col("images_before") + i + 1))).drop("images_before")


def images(with_ids: DataFrame, relationships: DataFrame) -> DataFrame:
    """Images in order, with their target (null for a relationship that isn't there) and the caption nearby."""
    own = with_ids.select("doc_id", "para_pos", "nearby_caption", F.explode(F.arrays_zip("image_ids", "rel_ids")).alias("i"))
    own = own.select("doc_id", F.col("i.image_ids").alias("id"), "para_pos", F.col("i.rel_ids").alias("rel_id"), "nearby_caption")
    return own.join(relationships, ["doc_id", "rel_id"], "left").select("doc_id", "id", "para_pos", "rel_id", "target", "nearby_caption")


def with_context(identified: DataFrame, radius: int = 2) -> DataFrame:
    """Add context to paragraphs: those with text up to ``radius`` positions around, as (offset, role, text)."""
    near = Window.partitionBy("doc_id", "kind").orderBy("body_pos").rowsBetween(-radius, radius)
    around = F.collect_list(F.struct("para_pos", "role", "text")).over(near)
    own = F.transform(F.filter(around, lambda x: x["text"] != ""), lambda x: F.struct((x["para_pos"] - F.col("para_pos")).cast("long").alias("offset"), x["role"].alias("role"), x["text"].alias("text")))
    return identified.withColumn("context", F.when(F.col("kind") == "p", own))


def context(identified: DataFrame, anchor: Column, radius: int = 2) -> DataFrame:
    """The surroundings of each paragraph for which ``anchor`` holds, as rows."""
    own = with_context(identified, radius).filter(anchor & (F.col("kind") == "p"))
    return own.select("doc_id", F.col("para_pos").alias("anchor"), F.explode("context").alias("c")).select("doc_id", "anchor", "c.*")


def outline_line() -> Column:
    """The marked line of a heading; null for other elements."""
    marker = F.repeat(F.lit("#"), F.least(F.lit(6), F.coalesce("level", F.lit(1)) + 2))
    return F.when(F.col("role").isin("heading", "heading_candidate"), F.concat_ws(" ", marker, "text", F.when(F.col("role") == "heading_candidate", "(candidate)")))


def outline(classified: DataFrame) -> DataFrame:
    """Headings in order as marked lines."""
    return classified.select("doc_id", "body_pos", outline_line().alias("line")).filter("line IS NOT NULL")
