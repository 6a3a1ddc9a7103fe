"""Artifact fingerprints, module records and freshness.

Fingerprints: path, exists, kind (file, directory or null), sha256. A record:
module, updated_at, command, notes, inputs and outputs (arrays of fingerprints).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Modules with what they read and write (fixed values): a change of an input asks for the module to run again.
MODULES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "source_inventory": (("source",), ("document_profile",)),
    "doc_conversion": (("legacy_source",), ("docx", "conversion_result")),
    "docx_semantic_extraction": (("docx",), ("semantic_ir", "ir_summary", "assets")),
    "authoring_brief": (("semantic_ir",), ("brief",)),
    "template_analysis": (("template",), ("template_profile",)),
    "format_requirements": (("guide",), ("requirements",)),
    "authoring_plan": (("brief", "semantic_ir", "template_profile", "requirements"), ("plan",)),
    "latex_authoring": (("plan", "brief", "semantic_ir", "template_profile"), ("project",)),
    "compilation": (("project",), ("compile_result",)),
    "quality_gate": (("project", "semantic_ir"), ("gate_result",)),
    "conversion_report": (("document_profile", "compile_result", "template_profile", "requirements", "gate_result"), ("report",)),
}


def file_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def directory_hashes(files: DataFrame) -> DataFrame:
    """(directory, sha256, n_files): the hash of each file's relative path and hash, in the order of path parts, without .git.

    Input: directory, rel_path, sha256 (of each file's bytes). The hash is one of a whole
    sequence, so a task holds path and hash of all files of one directory, some 200 bytes each.
    """
    kept = files.filter(~F.array_contains(F.split("rel_path", "/"), ".git"))
    entries = F.array_sort(F.collect_list(F.struct(F.split("rel_path", "/").alias("parts"), "rel_path", "sha256")))
    joined = F.array_join(F.transform(entries, lambda e: F.concat(e["rel_path"], e["sha256"])), "")
    return kept.groupBy("directory").agg(F.sha2(joined.cast("binary"), 256).alias("sha256"), F.count("*").alias("n_files"))


def latest(records: DataFrame, by: str = "module") -> DataFrame:
    """The last record of each module; records are only ever appended."""
    order = Window.partitionBy(by).orderBy(F.desc("updated_at"), *[F.desc(c) for c in records.columns if c not in (by, "updated_at")])
    return records.withColumn("__n", F.row_number().over(order)).filter("__n = 1").drop("__n")


def changes(recorded: DataFrame, current: DataFrame) -> DataFrame:
    """Each recorded input or output (module, kind_of, path, exists, kind, sha256) beside its state now (path, exists, kind, sha256).

    unchanged compares existence, kind and hash, and null equals null; a path
    without a current row doesn't exist.
    """
    now = current.select("path", F.col("exists").alias("now_exists"), F.col("kind").alias("now_kind"), F.col("sha256").alias("now_sha256"))
    out = recorded.join(now, "path", "left").withColumn("now_exists", F.coalesce("now_exists", F.lit(False)))
    same = F.col("exists").eqNullSafe(F.col("now_exists")) & F.col("kind").eqNullSafe(F.col("now_kind")) & F.col("sha256").eqNullSafe(F.col("now_sha256"))
    return out.withColumn("unchanged", same)


def freshness(recorded: DataFrame, current: DataFrame, modules: DataFrame) -> DataFrame:
    """Per module of ``modules``: recorded, fresh (inputs unchanged and outputs there; true of none), changed and missing paths."""
    state = changes(recorded, current)
    is_input = F.col("kind_of") == "input"
    per = state.groupBy("module").agg(
        F.every(F.when(is_input, F.col("unchanged"))).alias("inputs"), F.every(F.when(~is_input, F.col("now_exists"))).alias("outputs"),
        F.array_sort(F.collect_set(F.when(is_input & ~F.col("unchanged"), F.col("path")))).alias("changed"), F.array_sort(F.collect_set(F.when(~is_input & ~F.col("now_exists"), F.col("path")))).alias("missing"),
    )
    known = recorded.select("module").distinct().withColumn("recorded", F.lit(True))
    out = modules.select("module").distinct().join(known, "module", "left").join(per, "module", "left").withColumn("recorded", F.coalesce("recorded", F.lit(False)))
    none = F.array().cast("array<string>")
    fresh = F.col("recorded") & F.coalesce("inputs", F.lit(True)) & F.coalesce("outputs", F.lit(True))
    return out.select("module", "recorded", fresh.alias("fresh"), F.coalesce("changed", none).alias("changed"), F.coalesce("missing", none).alias("missing"))


def scoped(module: Column, scope: Column) -> Column:
    """A module's id within a scope."""
    return F.concat_ws(":", module, scope)


def rerun(changed: set[str], modules: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] | None = None) -> list[str]:
    """Modules that must run again after artifacts changed, each after those whose outputs it reads. The graph is a dozen fixed rows."""
    modules = MODULES if modules is None else modules
    stale, out = set(changed), []
    waiting = dict(modules)
    while True:
        ready = [m for m, (inputs, _) in waiting.items() if not any(set(inputs) & set(o) for k, (_, o) in waiting.items() if k != m)]
        if not ready:
            return out
        for m in ready:
            inputs, outputs = waiting.pop(m)
            if stale & set(inputs):
                stale |= set(outputs)
                out.append(m)
