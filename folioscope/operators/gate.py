"""Quality gate over markup project trees: one scan of files, rules as data, findings as rows.

Input ``files``: project, rel_path, size_bytes, text (null for images), and
optionally width and height of images. A finding: project, rule_ordinal,
severity, check, n (what was counted), paths (sorted, distinct). Paths are listed whole
but for missing and unsupported graphics and tiny images, of which the first ``LISTED`` are;
so a row of facts grows with the offending files of one project, and with nothing else.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions import paths
from folioscope.functions.text import EXACT, count, every, has, leading, strip
from folioscope.operators.damage import project_damaged

# Kinds of files, thresholds and patterns.
TEXT = (".tex", ".bib", ".md", ".cls", ".sty", ".def")
LATEX = (".tex", ".cls", ".sty", ".def")
IMAGES = (".png", ".jpg", ".jpeg", ".pdf")
UNSUPPORTED = (".wmf", ".emf")
SEMANTIC = ("article", "report", "thesis")
FLAT, UNREFERENCED, TINY, TINY_BYTES, TINY_SIDE, LISTED = 2, 0.35, 5, 1024, 24, 20
GRAPHICS = r"\\includegraphics(?:\[[^\]]*\])?\{([^}]+)\}"
MANUAL_REFERENCE = r"(?:formula|equation|eq\.|式|公式)\s*[~ ]*[\(（]\s*\d+(?:[-.]\d+)+\s*[\)）]"
INLINE = r"(?s)\\\((.*?)\\\)"
CHAPTER_CLASS = r"\\documentclass(?:\[[^\]]*\])?\{(?:book|report|ctexrep|nwputhesis)\}"
MARKER = r"(REVIEW|TODO|待复核|待确认|人工复核|placeholder|占位)"
TABLE_MARKER = r"%\s*REVIEW:.*(?:table|tabular|caption|表格|表题|表注|三线表)"
RENDERED = r"\\begin\{(?:table|longtable|sidewaystable)\}"
TABLE_LIKE = ("table", "longtable", "tabular", "tabularx", "tblr")


def blocks(text: Column | str, *environments: str) -> Column:
    """Whole environments in order, the shortest to an end of the same name; nested ones belong to the outer."""
    return F.regexp_extract_all(text, F.lit(rf"(?s)\\begin\{{({'|'.join(environments)})\}}.*?\\end\{{\1\}}"), F.lit(0))


def _in(block: Column, part: str) -> Column:
    return F.contains(block, F.lit(part))


@dataclass(frozen=True)
class FileRule:
    """A finding for each project that has files for which ``fires`` holds."""

    ordinal: int
    check: str
    severity: str
    suffixes: tuple[str, ...]
    fires: Column
    per_file: bool = False


def file_rules() -> list[FileRule]:
    text = F.col("text")
    bordered = lambda b: (F.regexp_count(b, F.lit(r"\\hline\b")) >= 2) & ~(_in(b, r"\toprule") | _in(b, r"\midrule") | _in(b, r"\bottomrule"))
    return [
        FileRule(1, "mojibake", "error", TEXT, project_damaged(text), per_file=True),
        FileRule(9, "longtable_graphics", "warning", TEXT, F.exists(blocks(text, "longtable", "table"), lambda b: _in(b, r"\includegraphics") & b.startswith(r"\begin{longtable}"))),
        FileRule(10, "table_graphics", "warning", TEXT, F.exists(blocks(text, "longtable", "table"), lambda b: _in(b, r"\includegraphics") & b.startswith(r"\begin{table}") & _in(b, r"\caption"))),
        FileRule(11, "formula_normalization", "warning", LATEX, _in(text, "$$")),
        FileRule(12, "formula_labels", "warning", LATEX, F.exists(blocks(text, "equation"), lambda b: ~_in(b, r"\label{"))),
        FileRule(13, "formula_align", "warning", LATEX, F.exists(blocks(text, "align"), lambda b: ~_in(b, r"\notag") & ~_in(b, r"\nonumber"))),
        FileRule(14, "formula_references", "warning", LATEX, has(text, MANUAL_REFERENCE)),
        FileRule(15, "formula_inline_style", "warning", LATEX, F.exists(every(text, INLINE, 1, ""), lambda b: _in(b, r"\gbinom") & ~_in(b, r"\displaystyle"))),
        FileRule(17, "table_placeholders", "warning", TEXT, has(text, TABLE_MARKER)),
        FileRule(18, "table_style", "warning", TEXT, F.exists(blocks(text, *TABLE_LIKE), bordered)),
    ]


#: Facts of a file that rules of a whole project need, beside the rules of files.
MARKED, CHAPTERS, FORMULAS, NUMBERED, RENDERS = "marked", "chapters", "formulas", "numbered", "renders"


def _evidence(files: DataFrame) -> DataFrame:
    """One row per project with the rules that its files break and the facts they show; texts are read once.

    evidence: array of (code, n, files), code being a rule's ordinal or a fact's
    name; as many entries as there are codes, however many files a project has.
    """
    text = F.col("text")
    inside = lambda part: _in(text, part)
    latex, own = paths.one_of(F.col("rel_path"), LATEX), F.col("rel_path")
    facts = [
        (MARKED, has(text, MARKER), F.lit(1)),
        (CHAPTERS, latex & has(text, CHAPTER_CLASS, EXACT), F.lit(1)),
        (FORMULAS, latex & (inside(r"\begin{equation}") | inside(r"\begin{align}")), F.lit(1)),
        (NUMBERED, latex & (inside(r"\numberwithin{equation}{chapter}") | inside(r"\thechapter-\arabic{equation}")), F.lit(1)),
        (RENDERS, inside(r"\begin{"), count("text", RENDERED, "")),
    ]
    rules = [(str(r.ordinal), paths.one_of(own, r.suffixes) & r.fires, F.lit(1)) for r in file_rules()]
    shown = F.array_compact(F.array(*[F.when(F.coalesce(fires, F.lit(False)), F.struct(F.lit(code).alias("code"), n.cast("long").alias("n"))) for code, fires, n in rules + facts]))
    rows = files.filter(paths.one_of(own, TEXT)).select("project", "rel_path", F.explode(shown).alias("e")).select("project", "rel_path", "e.*")
    listed = F.array_sort(F.collect_set(F.when(~F.col("code").isin(*[c for c, _, _ in facts]), F.col("rel_path"))))
    per = rows.groupBy("project", "code").agg(F.sum("n").alias("n"), listed.alias("files"))
    return per.groupBy("project").agg(F.collect_list(F.struct("code", "n", "files")).alias("evidence"))


def structure(files: DataFrame) -> DataFrame:
    """Facts of each project's layout and images; reads paths and sizes only."""
    path = F.col("rel_path")
    any_ = lambda c, name: F.coalesce(F.bool_or(c), F.lit(False)).alias(name)
    flat, inside = path.rlike(r"^content/[^/]+\.tex$"), path.startswith("content/")
    image = paths.one_of(path, IMAGES)
    small = F.col("size_bytes") < TINY_BYTES
    if "width" in files.columns:
        small = small | F.coalesce(F.least("width", "height") < TINY_SIDE, F.lit(False))
    little = files.filter(image & small).select("project", "rel_path", inside.alias("inside")).distinct()
    shown = leading(little, ["project"], "rel_path", LISTED).withColumnRenamed("listed", "tiny").join(leading(little.filter("inside"), ["project"], "rel_path", LISTED).withColumnRenamed("listed", "tiny_content"), "project", "left")
    facts = files.groupBy("project").agg(
        any_(path == "main.tex", "main"), any_(path.startswith("source/"), "source"), any_(path == "conversion_report.md", "report"), any_(inside, "content"),
        any_(path.rlike(rf"^content/({'|'.join(SEMANTIC)})/.*\.tex$"), "semantic"), F.array_sort(F.collect_set(F.when(flat, path))).alias("flat"),
        F.count_if(image).alias("n_images"), F.count_if(image & inside).alias("n_images_content"), F.count_if(image & small).alias("n_tiny"), F.count_if(image & small & inside).alias("n_tiny_content"),
    )
    return facts.join(shown, "project", "left")


def graphics_references(files: DataFrame) -> DataFrame:
    """Every reference with the file it means: the exact path, or for a name without suffix one with the suffix of an image.

    Several may exist; the first in the order of ``IMAGES`` counts.
    """
    raw = files.filter(paths.one_of(F.col("rel_path"), TEXT)).select("project", "rel_path", F.explode(every("text", GRAPHICS, 1, EXACT)).alias("raw")).withColumn("raw", strip("raw"))
    clean = F.regexp_replace(F.regexp_replace("raw", r"^(\./)+", ""), "//+", "/")
    raw = raw.withColumn("suffix", paths.suffix(F.col("raw"))).withColumn("clean", clean)
    candidates = F.when(F.col("suffix") == "", F.array(F.col("clean"), *[F.concat("clean", F.lit(s)) for s in IMAGES])).otherwise(F.array("clean"))
    there = files.select("project", F.col("rel_path").alias("candidate")).distinct()
    keys = raw.select("project", "clean", F.posexplode(candidates)).distinct().select("project", "clean", F.col("pos").alias("rank"), F.col("col").alias("candidate"))
    resolved = keys.join(there, ["project", "candidate"]).groupBy("project", "clean").agg(F.min_by("candidate", "rank").alias("resolved"))
    return raw.join(resolved, ["project", "clean"], "left").select("project", "rel_path", "raw", "suffix", "resolved")


def image_files(files: DataFrame) -> DataFrame:
    """Images below content/ if the project has that folder, else anywhere."""
    has_content = files.groupBy("project").agg(F.bool_or(F.col("rel_path").startswith("content/")).alias("content"))
    own = files.filter(paths.one_of(F.col("rel_path"), IMAGES)).select("project", "rel_path", "size_bytes").join(has_content, "project")
    return own.filter(~F.col("content") | F.col("rel_path").startswith("content/")).drop("content")


def unreferenced(files: DataFrame, references: DataFrame | None = None) -> DataFrame:
    used = (graphics_references(files) if references is None else references).filter("resolved IS NOT NULL").select("project", F.col("resolved").alias("rel_path")).distinct()
    return image_files(files).join(used, ["project", "rel_path"], "left_anti")


def rendered_tables(files: DataFrame) -> DataFrame:
    """Number of table environments of each project."""
    return files.filter(paths.one_of(F.col("rel_path"), TEXT)).groupBy("project").agg(F.sum(count("text", RENDERED, "")).alias("rendered"))


def table_coverage(extracted: Column, rendered: Column) -> Column:
    """How many extracted tables are not rendered."""
    return F.greatest(F.lit(0), F.coalesce(extracted, F.lit(0)) - F.coalesce(rendered, F.lit(0)))


def _references_by_project(references: DataFrame) -> DataFrame:
    missing, unsupported = F.col("resolved").isNull(), F.coalesce(F.col("suffix").isin(*UNSUPPORTED), F.lit(False))
    told = F.array_compact(F.array(F.when(missing, F.lit("missing")), F.when(unsupported, F.lit("unsupported"))))
    lines = references.select("project", F.concat_ws(": ", "rel_path", "raw").alias("line"), F.explode(told).alias("kind"))
    shown = leading(lines, ["project", "kind"], "line", LISTED)
    own = lines.groupBy("project", "kind").agg(F.count("*").alias("n")).join(shown, ["project", "kind"])
    of = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c)))
    return own.groupBy("project").agg(*[of(k, c).alias(name) for k in ("missing", "unsupported") for c, name in (("n", f"n_{k}"), ("listed", k))])


def findings(files: DataFrame, extracted: DataFrame | None = None) -> DataFrame:
    """All findings of all projects (extracted: project, extracted): one row of facts per project, from which all rules are told."""
    references = graphics_references(files)
    loose = unreferenced(files, references).groupBy("project").agg(F.count("*").alias("loose"))
    facts = structure(files)
    for other in (_evidence(files), _references_by_project(references), loose, *([] if extracted is None else [extracted.select("project", "extracted")])):
        facts = facts.join(other, "project", "left")
    if extracted is None:
        facts = facts.withColumn("extracted", F.lit(0))
    nothing = F.array().cast("array<string>")
    facts = facts.withColumn("evidence", F.map_from_entries(F.transform(F.coalesce("evidence", F.array().cast("array<struct<code:string,n:bigint,files:array<string>>>")), lambda e: F.struct(e["code"].alias("k"), F.struct(e["n"].alias("n"), e["files"].alias("files")).alias("v")))))
    entry = lambda code: F.try_element_at("evidence", F.lit(code))
    shows = lambda code: entry(code).isNotNull()
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    images, n_tiny = F.when(F.col("content"), F.col("n_images_content")).otherwise(F.col("n_images")), F.when(F.col("content"), F.col("n_tiny_content")).otherwise(F.col("n_tiny"))
    uncovered = table_coverage(F.col("extracted"), entry(RENDERS)["n"])
    gone, foreign = number("n_missing"), number("n_unsupported")

    def one(ordinal: int, severity: str, check: str, fires: Column, n: Column, listed: Column = nothing) -> Column:
        return F.when(F.coalesce(fires, F.lit(False)), F.struct(F.lit(ordinal).alias("rule_ordinal"), F.lit(severity).alias("severity"), F.lit(check).alias("check"), n.cast("long").alias("n"), listed.alias("paths")))

    whole, apart = [], []
    for r in file_rules():
        own = entry(str(r.ordinal))
        if r.per_file:
            apart.append(F.coalesce(_each(own["files"], r), F.slice(_each(F.array(F.lit("")), r), 1, 0)))
        else:
            whole.append(one(r.ordinal, r.severity, r.check, own.isNotNull(), F.size(own["files"]), own["files"]))
    name = lambda x: F.array(F.lit(x))
    whole += [
        one(2, "error", "structure", ~F.col("main"), F.lit(1), name("main.tex")),
        one(3, "warning", "structure", ~F.col("source"), F.lit(1), name("source/")),
        one(4, "warning", "structure", ~F.col("report"), F.lit(1), name("conversion_report.md")),
        one(5, "warning", "structure", F.col("content") & (F.size("flat") > FLAT) & ~F.col("semantic"), F.size("flat"), F.col("flat")),
        one(6, "error", "structure", ~F.col("content"), F.lit(1), name("content/")),
        one(7, "error", "missing_graphics", gone > 0, gone, F.col("missing")),
        one(8, "error", "unsupported_graphics", foreign > 0, foreign, F.col("unsupported")),
        one(16, "warning", "formula_numbering", shows(CHAPTERS) & shows(FORMULAS) & ~shows(NUMBERED), F.lit(1)),
        one(19, "warning", "review_placeholders", (gone + foreign > 0) & ~shows(MARKED), F.lit(1)),
        one(20, "warning", "images", F.try_divide(number("loose"), images) > UNREFERENCED, number("loose")),
        one(21, "warning", "images", n_tiny >= TINY, n_tiny, F.when(F.col("content"), F.col("tiny_content")).otherwise(F.col("tiny"))),
        one(22, "warning", "table_coverage", uncovered > 0, uncovered),
    ]
    found = F.array_compact(F.array(*whole))
    return facts.select("project", F.explode(F.concat(found, *apart)).alias("f")).select("project", "f.*")


def _each(listed: Column, rule: FileRule) -> Column:
    """A finding for each file of a list."""
    return F.transform(listed, lambda p: F.struct(F.lit(rule.ordinal).alias("rule_ordinal"), F.lit(rule.severity).alias("severity"), F.lit(rule.check).alias("check"), F.lit(1).cast("long").alias("n"), F.array(p).alias("paths")))


def summary(found: DataFrame, projects: DataFrame, strict: bool = False) -> DataFrame:
    """Per project: findings, errors, warnings, and whether the gate fails (on warnings too, if strict)."""
    counts = found.groupBy("project").agg(F.count("*").alias("findings"), F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    out = projects.select("project").distinct().join(counts, "project", "left").na.fill(0)
    return out.withColumn("failed", (F.col("errors") > 0) | (F.lit(strict) & (F.col("warnings") > 0)))


__all__ = ["FileRule", "blocks", "findings", "graphics_references", "image_files", "rendered_tables", "structure", "summary", "table_coverage", "unreferenced"]
