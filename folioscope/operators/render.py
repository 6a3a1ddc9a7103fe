"""Reports as ordered lines: each part gives rows (key, section, position, line), and one text is put together per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.text import bullets, ellipsis, recorded
from folioscope.operators.damage import issue_array
from folioscope.operators.elements import outline_line


def part(df: DataFrame, key: str, section: int, line: Column, *order: str) -> DataFrame:
    """Lines of a section; ``order`` names the columns (numbers or text) that sort them."""
    position = F.concat_ws("", *[F.lpad(F.col(c).cast("string"), 12, "0") for c in order]) if order else F.lit("")
    return df.select(F.col(key).alias("key"), F.lit(section).alias("section"), position.alias("position"), line.alias("line"))


def assemble(keys: DataFrame, key: str, titles: list[tuple[str, str | None]], parts: list[DataFrame]) -> DataFrame:
    """(key, text): each section's title, then its lines, or the note given for a section without any."""
    keys = keys.select(F.col(key).alias("key")).distinct()
    rows = reduce(DataFrame.unionByName, parts)
    per = rows.groupBy("key", "section").agg(F.array_sort(F.collect_list(F.struct("position", "line"))).alias("lines"))
    frame = keys.withColumn("s", F.explode(F.array(*[F.struct(F.lit(i).alias("section"), F.lit(t).alias("title"), F.lit(n).alias("note")) for i, (t, n) in enumerate(titles)]))).select("key", "s.*")
    own = frame.join(per, ["key", "section"], "left").withColumn("body", F.coalesce(F.array_join(F.col("lines.line"), "\n"), "note"))
    block = F.concat_ws("\n", F.col("title"), F.lit(""), F.col("body"))
    return own.groupBy("key").agg(F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("section", block.alias("block")))), lambda b: b["block"]), "\n\n"), F.lit("\n")).alias("text")).withColumnRenamed("key", key)


def lines(df: DataFrame, key: str, *found: tuple[int, Column, Column | None]) -> DataFrame:
    """Lines of several sections from one pass: (section, position, line or array of lines); null lines are left out."""
    as_array = lambda c: c if isinstance(c, list) else [c]
    parts = [F.array(*[F.struct(F.lit(s).alias("section"), F.lpad(p.cast("string"), 12, "0").alias("position"), x.alias("line")) for x in as_array(line)]) for s, p, line in found]
    own = df.select(F.col(key).alias("key"), F.explode(F.concat(*parts)).alias("l")).select("key", "l.*")
    return own.filter("line IS NOT NULL AND line <> ''")


def _listed(values: Column, line) -> Column:  # noqa: ANN001
    """The entries of an array as one text of lines; null if there are none."""
    return F.when(F.size(values) > 0, F.array_join(F.transform(values, line), "\n"))


def _count_lines(counts: DataFrame) -> Column:
    names = [c for c, t in counts.dtypes if t == "bigint" and c != "doc_id"]
    return F.array_join(F.array(*[F.concat(F.lit(f"- {c}: "), F.col(c).cast("string")) for c in names]), "\n")


def ir_summary(annotated: DataFrame, counts: DataFrame) -> DataFrame:
    """The review summary of each document: from its annotated elements (with captions, image ids and damage) and its counts with defects."""
    kept = F.col("role").isin("heading", "heading_candidate", "abstract", "keywords", "bibliography_heading")
    level = F.when(F.col("level").isNotNull(), F.concat(F.lit(" level "), F.col("level").cast("string"))).otherwise("")
    issue = lambda i: F.concat(F.lit("- "), i["issue_type"], F.lit(": "), F.left(i["sample"], F.lit(100)), F.coalesce(F.concat(F.lit("; could read: "), F.left(i["repaired_sample"], F.lit(80))), F.lit("")))
    at = F.col("body_pos")
    own = lines(
        annotated, "doc_id",
        (1, at, F.when(kept, F.concat(F.lit("- "), "id", F.lit(" "), "role", level, F.lit(": "), F.left("text", F.lit(120))))),
        (2, at, F.when(F.col("kind") == "tbl", F.concat(F.lit("- "), "id", F.lit(": "), F.coalesce("caption", F.lit("(no caption)"))))),
        (3, at, _listed(F.col("image_ids"), lambda i: F.concat(F.lit("- "), i, F.lit(": "), F.coalesce("nearby_caption", F.lit("(no caption nearby)"))))),
        (4, at, _listed(issue_array(), issue)),
    )
    whole = lines(counts, "doc_id", (0, F.lit(0), _count_lines(counts)), (5, F.lit(0), _listed(F.col("defects"), lambda d: F.concat(F.lit("- "), d))))
    titles = [("# Extraction summary", None), ("## Structure", "- none found"), ("## Tables", "- none found"), ("## Images", "- none found"), ("## Text issues", "- none found"), ("## Defects", "- none found")]
    return assemble(counts, "doc_id", titles, [own, whole])


def brief(annotated: DataFrame, counts: DataFrame) -> DataFrame:
    """The authoring brief of each document: defects, outline, figures with their surroundings, tables and formulas."""
    at = F.col("body_pos")
    near = _listed(F.col("context"), lambda c: F.concat(F.lit("  - ("), c["role"], F.lit("): "), ellipsis(c["text"], 160)))
    figure = _listed(F.col("image_ids"), lambda i: F.concat(F.lit("- "), i, F.lit(": "), F.coalesce("nearby_caption", F.lit("(no caption nearby)"))))
    own = lines(
        annotated, "doc_id",
        (2, at, ellipsis(outline_line(), 120)),
        (3, at, F.when(figure.isNotNull(), F.concat_ws("\n", figure, near))),
        (4, at, F.when(F.col("kind") == "tbl", F.concat(F.lit("- "), "id", F.lit(": "), F.coalesce("caption", F.lit("(no caption)"))))),
        (5, at, F.when(F.col("has_math"), F.concat(F.lit("- near "), "id", F.lit(": "), F.coalesce(F.nullif(ellipsis(F.col("text"), 120), F.lit("")), F.lit("(no text)"))))),
    )
    whole = lines(counts, "doc_id", (1, F.lit(0), _listed(F.col("defects"), lambda d: F.concat(F.lit("- "), d))))
    titles = [("# Authoring brief", "Source facts for authoring; uncertain parts stay marked for review."), ("## Defects", "- none found"), ("## Outline", "- no reliable headings"), ("## Figures", "- no images"), ("## Tables", "- no tables"), ("## Formulas", "- no formulas")]
    return assemble(counts, "doc_id", titles, [own, whole])


def _records(*pairs: tuple[str, str]) -> Column:
    return F.array_join(F.array(*[F.concat(F.lit(f"- {title}: "), recorded(F.col(c).cast("string"))) for title, c in pairs]), "\n")


def plan(artifacts: DataFrame, excerpt: int = 0) -> DataFrame:
    """An execution index from one row of optional artifact columns per document (counts, template, requirements as JSON, brief)."""
    text = [
        F.lit("# Authoring plan\n\n## Source"), _records(("Paragraphs", "paragraphs"), ("Headings", "headings"), ("Tables", "tables"), ("Images", "images"), ("Equations", "equations"), ("Citation paragraphs", "citation_paragraphs")),
        F.lit("\n## Template"), _records(("Main file", "main_file"), ("Document class", "documentclass"), ("Bibliography system", "bibliography_system"), ("Needs preprocessing", "needs_preprocessing")),
        F.lit("\n## Modules\n- [ ] front matter\n- [ ] structure\n- [ ] prose and formulas\n- [ ] tables\n- [ ] figures\n- [ ] bibliography\n- [ ] appendices\n- [ ] review notes"),
        F.concat(F.lit("\n## Requirements\n"), F.col("requirements")), *([F.concat(F.lit("\n## Brief\n"), F.left("brief", F.lit(excerpt)))] if excerpt else []),
    ]
    return artifacts.select("doc_id", F.concat(F.concat_ws("\n", *text), F.lit("\n")).alias("text"))


#: Metadata that the report's summary shows, so that the list of features leaves it out.
SUMMARISED = ("path", "name", "extension", "format")


def conversion_report(artifacts: DataFrame) -> DataFrame:
    """The report of each document from one row of optional artifact columns; ``metadata`` is a map of text."""
    features = F.transform(F.array_sort(F.map_entries(F.map_filter("metadata", lambda k, _: ~k.isin(*SUMMARISED)))), lambda e: F.concat(F.lit("- "), e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("null"))))
    given = lambda k: recorded(F.try_element_at("metadata", F.lit(k)))
    text = [
        F.lit("# Conversion report\n\n## Summary"), F.concat(F.lit("- Source: "), given("path")), F.concat(F.lit("- Format: "), given("format")), F.concat(F.lit("- Compile status: "), F.col("compile_status")),
        F.lit("\n## Sources"), bullets(F.col("sources")), F.lit("\n## Features"), F.array_join(features, "\n"),
        F.lit("\n## Template"), _records(("Main file", "main_file"), ("Document class", "documentclass"), ("Bibliography system", "bibliography_system"), ("Needs preprocessing", "needs_preprocessing")),
        F.lit("\n## Requirements"), F.coalesce("requirements", F.lit("{}")), F.lit("\n## Warnings"), bullets(F.col("warnings")),
        F.lit("\n## Quality gate"), _records(("Findings", "findings"), ("Errors", "errors"), ("Warnings", "gate_warnings")),
    ]
    return artifacts.select("doc_id", F.concat(F.concat_ws("\n", *text), F.lit("\n")).alias("text"))


def gate_markdown(found: DataFrame, summary: DataFrame) -> DataFrame:
    """The gate's report of each project."""
    measured = summary.select("project", F.posexplode(F.array(*[F.concat(F.lit(f"- {c}: "), F.col(c).cast("string")) for c in ("findings", "errors", "warnings")])))
    line = F.concat(F.lit("- ["), "severity", F.lit("] "), "check", F.lit(": "), F.col("n").cast("string"))
    return assemble(summary, "project", [("# Quality gate", None), ("## Findings", "- no findings")], [part(measured, "project", 0, F.col("col"), "pos"), part(found, "project", 1, line, "rule_ordinal", "n")])
