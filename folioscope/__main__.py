"""Command line: ``python -m folioscope COMMAND ...``, one command for each task over files and folders.

Paths may be anything that Spark reads. Results go to --output as JSON lines
(or text), else to standard output; ``--pretty`` prints each as an indented document.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators import gate, lists, manifest, render, requirements, template
from folioscope.plans import semantic_ir, stages
from folioscope.sources import docx, files


def emit(df: DataFrame, output: str | None, pretty: bool = False) -> None:
    """To a folder by the executors, or row by row to standard output."""
    own = df.select(F.to_json(F.struct("*"), {"pretty": str(pretty).lower(), "ignoreNullFields": "false"}).alias("value"))
    if output and pretty:
        own.write.mode("overwrite").option("lineSep", "\n").text(output)
    elif output:
        df.write.mode("overwrite").json(output)
    else:
        for row in own.toLocalIterator():
            print(row["value"])


def profile(spark: SparkSession, a: argparse.Namespace) -> int:
    """What sources are, and what packages hold."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(a.path).select(F.col("path").alias("doc_id"), F.col("length").alias("size_bytes"))
    known = docx.read(spark, a.path).drop("elements", "relationships", "size_bytes")
    emit(listed.select("*", *[c.alias(k) for k, c in lists.source_format(F.col("doc_id")).items()]).join(known, "doc_id", "left"), a.output)
    return 0


def extract(spark: SparkSession, a: argparse.Namespace) -> int:
    """The semantic record of packages, their summary or their brief."""
    ir = semantic_ir.from_path(spark, a.path, a.repair)
    emit({"record": ir.nested, "summary": ir.summary, "brief": ir.brief}[a.form](), a.output, a.pretty)
    if a.assets:
        print(json.dumps({"exported": docx.export(spark, a.path, ir.images, a.assets).count()}), file=sys.stderr)
    return 0


def check(spark: SparkSession, a: argparse.Namespace) -> int:
    """The quality gate over the project folders below a path."""
    tree = files.tree(spark, a.path, gate.TEXT)
    found = gate.findings(tree)
    counts = gate.summary(found, tree, a.strict)
    emit({"findings": lambda: found, "summary": lambda: counts, "markdown": lambda: render.gate_markdown(found, counts)}[a.form](), a.output)
    return int(counts.filter("failed").limit(1).count())


def analyze(spark: SparkSession, a: argparse.Namespace) -> int:
    """Profiles of the template folders below a path, or their candidates for the main file."""
    tree = files.tree(spark, a.path, (".tex",), decode=files.ignoring)
    caps = (template.READ_CAP, template.TEXT_CAP) if a.bounded else (None, None)
    emit(template.profile(tree, *caps) if a.form == "profile" else template.candidates(tree, caps[0]), a.output, a.pretty)
    return 0


def require(spark: SparkSession, a: argparse.Namespace) -> int:
    """Formatting requirements of guide texts, from files or given inline."""
    guides = files.inline(spark, a.text) if a.text else files.texts(spark, a.path)
    emit(requirements.extract(guides), a.output, a.pretty)
    return 0


def built(spark: SparkSession, a: argparse.Namespace) -> int:
    """Status and notes of builds, from the JSON results at a path."""
    emit(lists.compile_results(files.artifacts(spark, a.path, lists.RESULT)).select("status", "notes", "command", "log_path", "return_code"), a.output, a.pretty)
    return 0


def record(spark: SparkSession, a: argparse.Namespace) -> int:
    """Record what a module read and wrote."""
    stages.Manifest(spark, a.manifest).record(a.module, a.input, a.output_path, a.command or "", a.notes or "")
    return 0


def fresh(spark: SparkSession, a: argparse.Namespace) -> int:
    """Whether a module's record still holds; exit status 1 if not."""
    state = stages.Manifest(spark, a.manifest).check(a.module)
    print(json.dumps(state))
    return int(not state["fresh"])


def rerun(spark: SparkSession, a: argparse.Namespace) -> int:
    """The modules that must run again after artifacts changed, in order."""
    print("\n".join(manifest.rerun(set(a.changed))))
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="folioscope", description=__doc__)
    commands = top.add_subparsers(dest="name", required=True)

    def add(name: str, run, path: bool = True, forms: tuple[str, ...] = ()) -> argparse.ArgumentParser:  # noqa: ANN001
        own = commands.add_parser(name, help=run.__doc__, description=run.__doc__)
        own.set_defaults(run=run)
        if path:
            own.add_argument("path", nargs="?" if name == "requirements" else None)
            own.add_argument("--output")
            own.add_argument("--pretty", action="store_true")
        if forms:
            own.add_argument("--form", choices=forms, default=forms[0])
        return own

    add("profile", profile)
    own = add("extract", extract, forms=("record", "summary", "brief"))
    own.add_argument("--repair", action="store_true")
    own.add_argument("--assets", help="a folder for the images")
    add("gate", check, forms=("findings", "summary", "markdown")).add_argument("--strict", action="store_true")
    add("template", analyze, forms=("profile", "candidates")).add_argument("--bounded", action="store_true", help="read the usual number of characters of each file only")
    add("built", built)
    add("requirements", require).add_argument("--text", action="append")
    for name, run in (("record", record), ("fresh", fresh)):
        own = add(name, run, path=False)
        own.add_argument("manifest")
        own.add_argument("module")
        if name == "record":
            own.add_argument("--input", action="append", default=[])
            own.add_argument("--output-path", action="append", default=[])
            own.add_argument("--command")
            own.add_argument("--notes")
    add("rerun", rerun, path=False).add_argument("changed", nargs="+")
    return top


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("folioscope").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return a.run(spark, a)


if __name__ == "__main__":
    sys.exit(main())
