"""Every query over the given tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import markup
from folioscope.functions import text as X
from folioscope.operators import damage, diagnose, gate, lists, manifest, render, requirements, template
from folioscope.operators import elements as E
from folioscope.operators import tables as T
from folioscope.plans import overlay
from folioscope.plans.semantic_ir import annotate
from folioscope.sources import docx
from folioscope.sources import files as tree

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.classify(overlay.elements(documents(spark, sf_dir)))


def identified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.identify(classified(spark, sf_dir))


def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate(overlay.embedded(overlay.elements(documents(spark, sf_dir))))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlay.files(documents(spark, sf_dir))


# Elements


@query
def doc_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.lines(documents(spark, sf_dir)).select("doc_id", "body_pos", X.squeeze("raw_text").alias("text"))


@query
def doc_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(spark, sf_dir).select("doc_id", "body_pos", "kind", "role", F.col("level").cast("long").alias("level"))


@query
def doc_role_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(spark, sf_dir).filter("kind = 'p'").groupBy("doc_id", "role").agg(F.count("*").alias("n"), F.sum(F.col("level").cast("long")).alias("levels"))


@query
def doc_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(spark, sf_dir).filter("size(citations) > 0").select("doc_id", "body_pos", F.posexplode("citations").alias("idx", "citation")).withColumn("idx", F.col("idx").cast("long"))


@query
def doc_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identified(spark, sf_dir).select("doc_id", "body_pos", "id", "para_pos")


@query
def doc_table_caption(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.table_captions(identified(spark, sf_dir))


@query
def doc_figure_caption(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.images(annotated(spark, sf_dir), overlay.relationships(documents(spark, sf_dir)))


@query
def doc_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.context(annotated(spark, sf_dir), F.size("image_ids") > 0).withColumn("text", X.ellipsis(F.col("text"), 160))


@query
def doc_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.outline(classified(spark, sf_dir))


# Damage, counts, defects


@query
def doc_damage(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    out = classified(spark, sf_dir).filter("kind = 'p'").select("doc_id", "body_pos", damage.score(text).alias("score"), X.cjk(text).alias("cjk"), X.has_cjk(text).alias("has_cjk"), text.contains(damage.RISKY).alias("risky"))
    return out.withColumn("damaged", F.col("score") >= damage.LEAST_SCORE)


@query
def doc_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damage.issues(damage.inspect(classified(spark, sf_dir).filter("kind = 'p'")))


@query
def doc_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = documents(spark, sf_dir).select("doc_id", F.concat("text", F.lit(overlay.REPAIRABLE)).alias("text")).withColumn("body_pos", F.lit(0).cast("long"))
    return damage.inspect(broken, repairing=True).select("doc_id", "damage", "candidate", "final_text")


@query
def doc_ir_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagnose.profile(annotated(spark, sf_dir))


def _counts(spark: SparkSession, sf_dir: str, flavor: Column) -> DataFrame:
    return diagnose.profile(annotated(spark, sf_dir)).withColumn("defects", diagnose.defects(flavor))


@query
def doc_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    flavor = F.when(F.col("doc_id") % 3 == 0, "strict").when(F.col("doc_id") % 3 == 1, "unknown").otherwise("transitional")
    return _counts(spark, sf_dir, flavor).select("doc_id", F.posexplode("defects").alias("idx", "defect")).withColumn("idx", F.col("idx").cast("long"))


@query
def table_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = F.when(F.col("doc_id") % 7 == 0, F.array().cast("array<array<string>>")).otherwise(F.transform(F.split("text", "\n"), lambda line: F.when(F.length(line) % 5 == 0, F.array(F.lit(" "), F.lit(""))).otherwise(F.split(line, " "))))
    return documents(spark, sf_dir).select("doc_id", F.posexplode(T.notes(rows)).alias("idx", "note")).withColumn("idx", F.col("idx").cast("long"))


@query
def doc_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlay.guides(documents(spark, sf_dir)).select("doc_id", X.language(F.col("text")).alias("language"))


@query
def doc_raw_display_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).filter(F.contains("text", F.lit("$$"))).select("doc_id", X.occurrences(F.col("text"), "$$").alias("n"))


@query
def doc_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", X.ellipsis(F.col("text"), 180).alias("short"), F.left("text", F.lit(160)).alias("head"), F.right("text", F.lit(100)).alias("tail"))


# Pages and sources


@query
def page_tag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    opened = lambda tag: X.count("html", rf"<{tag}[\s>/]", "")
    return table(spark, sf_dir, "pages").select("page_id", *[opened(t).alias(f"n_{t}") for t in ("p", "li", "a", "h1", "br")], F.col("html").rlike(r"<body[\s>]").alias("has_body"), F.regexp_extract("html", r'<html lang="([^"]*)"', 1).alias("lang"))


@query
def page_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "pages").select("page_id", F.explode(markup.opened(F.col("html"))).alias("tag"))
    return own.groupBy("page_id", "tag").agg(F.count("*").alias("n"))


@query
def tag_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    tag = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("{http://n/"), F.col("page_id").cast("string"), F.lit("}body"))).otherwise("body")
    return table(spark, sf_dir, "pages").select("page_id", markup.namespace(tag).alias("namespace"), markup.local(tag).alias("local"), markup.count_local(F.col("html"), "p").alias("n_p"))


@query
def source_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("in/f"), F.col("page_id").cast("string"), F.element_at(F.array(*map(F.lit, (".docx", ".DOC", ".pdf", ".txt", "", ".tar.GZ"))), (F.col("page_id") % 6 + 1).cast("int")))
    out = table(spark, sf_dir, "pages").select("page_id", *[c.alias(k) for k, c in lists.source_format(path).items()])
    return out.withColumn("conversion_plan", F.array_join(F.transform("conversion_plan", lambda x: x["method"]), ";"))


@query
def conversion_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("document"), (F.col("event_id") % 4).alias("priority"), F.concat(F.lit("method"), (F.col("event_id") % 4).cast("string")).alias("method"), (F.col("value") > 50).alias("success"))
    return lists.first_success(e, "document")


def _packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docx.parse(overlay.packages(documents(spark, sf_dir)))


@query
def package_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _packages(spark, sf_dir).withColumn("failed", F.col("error").isNotNull()).withColumn("n_relationships", F.size("relationships").cast("long")).withColumn("namespaces", F.array_join("namespaces", "|"))
    return own.drop("elements", "relationships", "error", "size_bytes")


@query
def package_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = docx.elements(_packages(spark, sf_dir))
    rows = F.array_join(F.transform("rows", lambda r: F.array_join(r, "|")), chr(10))
    return own.withColumns({"rel_ids": F.array_join("rel_ids", "|"), "rows": rows})


@query
def package_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docx.relationships(_packages(spark, sf_dir))


@query
def package_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docx.media(overlay.packages(documents(spark, sf_dir))).select("doc_id", "member", F.sha2("content", 256).alias("sha256"))


@query
def png_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = lambda c: F.lpad(F.hex(c), 8, "0")
    head = F.when(F.col("doc_id") % 5 == 0, "FFD8FFE0").otherwise(tree.PNG)
    content = F.unhex(F.concat(head, F.lit("0000000D49484452"), number(F.col("doc_id") + 1), F.when(F.col("doc_id") % 5 != 1, number(F.length("text"))).otherwise("")))
    width, height = tree.png_size(content)
    return documents(spark, sf_dir).select("doc_id", width.alias("width"), height.alias("height"))


@query
def decoded_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = F.concat(F.unhex(F.lit("EFBBBF")), F.encode("text", "UTF-8"), F.unhex(F.lit("FFC3")), F.encode(F.lit("é"), "UTF-8"))
    return documents(spark, sf_dir).select("doc_id", tree.lenient(bad).alias("lenient"), tree.ignoring(bad).alias("ignoring"))


# Gate


@query
def graphics_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.graphics_references(files(spark, sf_dir))


@query
def unreferenced_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.unreferenced(files(spark, sf_dir)).select("project", "rel_path")


@query
def environment_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = files(spark, sf_dir).filter("text IS NOT NULL")
    return own.select("project", "rel_path", F.explode(gate.blocks("text", "table", "longtable", "equation", "align")).alias("block"))


@query
def rendered_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.rendered_tables(files(spark, sf_dir))


def _findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = documents(spark, sf_dir).groupBy((F.col("doc_id") % 20).alias("project")).agg(F.count_if(F.col("doc_id") % 6 == 0).alias("extracted"))
    return gate.findings(files(spark, sf_dir), extracted)


@query
def gate_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _findings(spark, sf_dir).withColumn("paths", F.array_join("paths", "|")).withColumn("rule_ordinal", F.col("rule_ordinal").cast("long"))


@query
def gate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.summary(_findings(spark, sf_dir), files(spark, sf_dir), strict=True)


@query
def gate_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _findings(spark, sf_dir)
    return render.gate_markdown(found, gate.summary(found, files(spark, sf_dir)))


# Templates and requirements


@query
def latex_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = template.sources(files(spark, sf_dir)).select("project", "rel_path", template.commands("text").alias("c")).select("project", "rel_path", "c.*")
    return own.withColumns({c: F.array_join(c, "|") for c in ("packages", "inputs", "bibliography_files")})


@query
def main_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template.candidates(files(spark, sf_dir))


@query
def package_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template.package_usage(files(spark, sf_dir))


@query
def template_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = template.profile(files(spark, sf_dir))
    return out.select("project", *[F.array_join(c, "|").alias(c) if t.startswith("array") else F.col(c) for c, t in out.dtypes if c != "project"])


@query
def format_requirements(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = requirements.extract(overlay.guides(documents(spark, sf_dir)))
    return out.select("doc_id", *[F.array_join(c, "|").alias(c) if t.startswith("array") else F.col(c) for c, t in out.dtypes if c != "doc_id"])


# Manifest


def _artifacts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    path = F.concat(F.lit("a/"), F.col("doc_id").cast("string"))
    there = F.col("doc_id") % 11 != 5
    now = documents(spark, sf_dir).select(path.alias("path"), there.alias("exists"), F.when(there, "file").alias("kind"), F.when(there, F.sha2("text", 256)).alias("sha256"))
    old = F.when(F.col("doc_id") % 23 == 3, F.sha2(F.lit("old"), 256)).otherwise(F.sha2("text", 256))
    before = documents(spark, sf_dir).select(
        F.concat(F.lit("m"), (F.col("doc_id") % 97).cast("string")).alias("module"), F.when(F.col("doc_id") % 2 == 0, "input").otherwise("output").alias("kind_of"), path.alias("path"),
        (there | (F.col("doc_id") % 4 == 0)).alias("exists"), F.when(there, "file").alias("kind"), F.when(there, old).alias("sha256"),
    )
    return before, now


@query
def artifact_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.changes(*_artifacts(spark, sf_dir)).select("module", "kind_of", "path", "now_exists", "unchanged")


@query
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, now = _artifacts(spark, sf_dir)
    modules = spark.range(100).select(F.concat(F.lit("m"), F.col("id").cast("string")).alias("module"))
    return manifest.freshness(before, now, modules).withColumns({c: F.array_join(c, "|") for c in ("changed", "missing")})


@query
def latest_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    records = e.select(manifest.scoped(F.col("event_type"), (F.col("user_id") % 5).cast("string")).alias("module"), F.col("ts").alias("updated_at"), F.col("event_id").alias("record"))
    return manifest.latest(records)


@query
def directory_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rel = F.concat(F.when(F.col("doc_id") % 10 == 0, ".git/").when(F.col("doc_id") % 3 == 0, "a/").otherwise("a."), F.col("doc_id").cast("string"))
    own = documents(spark, sf_dir).select((F.col("doc_id") % 20).alias("directory"), rel.alias("rel_path"), F.sha2("text", 256).alias("sha256"))
    return manifest.directory_hashes(own)


@query
def modules_to_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(a, i, m) for a in ("docx", "template", "project", "guide") for i, m in enumerate(manifest.rerun({a}))]
    return spark.createDataFrame(rows, "changed string, position long, module string")


# Reports


@query
def list_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.element_at(F.array(*map(F.lit, ("a; b,c ,, d", "[x, y;z]", '["p","q"]', '"one"', "12", ""))), (F.col("doc_id") % 6 + 1).cast("int"))
    return documents(spark, sf_dir).select("doc_id", F.array_join(lists.merge(lists.parse_list(raw), F.array(F.lit("a"), F.lit(""), F.concat(F.lit("d"), (F.col("doc_id") % 3).cast("string")))), "|").alias("merged"))


@query
def compile_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 5
    status = lists.compile_status(k != 0, k == 1, F.when(k == 2, "true").when(k == 3, "false").when(k == 4, "partial"))
    return documents(spark, sf_dir).select("doc_id", status.alias("status"), X.bullets(lists.compile_notes(k == 1, F.lit("no engine"))).alias("notes"))


@query
def ir_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.ir_summary(annotated(spark, sf_dir), _counts(spark, sf_dir, F.lit("transitional")))


@query
def authoring_brief(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.brief(annotated(spark, sf_dir), _counts(spark, sf_dir, F.lit("strict")))


def _joined_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All optional artifacts of a document in one row."""
    docs = documents(spark, sf_dir).withColumn("project", F.col("doc_id") % 20)
    profile = template.profile(files(spark, sf_dir)).select("project", "main_file", "documentclass", "bibliography_system", "needs_preprocessing")
    known = ("paragraphs", "headings", "tables", "images", "equations", "citation_paragraphs")
    counts = diagnose.profile(annotated(spark, sf_dir)).select("doc_id", *[F.when(F.col("doc_id") % 3 != 0, F.col(c)).alias(c) for c in known])  # else that artifact is missing
    result = {"findings": "findings", "errors": "errors", "warnings": "gate_warnings"}
    own = gate.summary(_findings(spark, sf_dir), files(spark, sf_dir)).select("project", *[F.when(F.col("project") != 3, F.col(c)).alias(k) for c, k in result.items()])
    needs = F.when(F.col("doc_id") % 2 == 0, F.to_json(F.struct(X.language(F.col("text")).alias("language"))))
    meta = F.create_map(F.lit("path"), F.concat(F.lit("d"), F.col("doc_id").cast("string")), F.lit("format"), F.lit("docx"), F.lit("has_chinese"), X.has_cjk(F.col("text")).cast("string"), F.lit("chars"), F.length("text").cast("string"))
    base = docs.select("doc_id", "project", needs.alias("requirements"), meta.alias("metadata"), F.array(F.lit("draft.docx")).alias("sources"), F.array().cast("array<string>").alias("warnings"), F.lit("Not run").alias("compile_status"), F.left("text", F.lit(4000)).alias("brief"))
    return base.join(profile, "project", "left").join(own, "project", "left").join(counts, "doc_id", "left")


@query
def authoring_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.plan(_joined_artifacts(spark, sf_dir), excerpt=4000)


@query
def conversion_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.conversion_report(_joined_artifacts(spark, sf_dir))


def queries() -> dict[str, Query]:
    return dict(QUERIES)
