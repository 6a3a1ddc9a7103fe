"""Packages, project trees, artifacts, stages and streams from files made here."""

import struct
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from folioscope.operators import gate, lists, manifest, requirements
from folioscope.plans import semantic_ir, stages
from folioscope.sources import docx, files
from folioscope.streaming import ingest

W = docx.FAMILIES


def package(path, body, family="transitional", own=None, rels="", media=(), document=True):
    n = W[family]
    xml = f'<w:document xmlns:w="{own or n["w"]}" xmlns:r="{n["r"]}" xmlns:m="{n["m"]}" xmlns:a="http://x/a">{body}</w:document>'
    with zipfile.ZipFile(path, "w") as z:
        if document:
            z.writestr("word/document.xml", xml)
        z.writestr("word/_rels/document.xml.rels", f'<Relationships xmlns="http://p">{rels}</Relationships>')
        for name, data in media:
            z.writestr(name, data)


def p(text, style=None, extra=""):
    style = f'<w:pPr><w:pStyle w:val="{style}"/></w:pPr>' if style else ""
    return f"<w:p>{style}<w:r><w:t>{text}</w:t></w:r>{extra}</w:p>"


TABLE = "<w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc><w:tc><w:p/></w:tc></w:tr><w:tr><w:tc><w:p/></w:tc></w:tr></w:tbl>"
IMAGE = '<w:r><a:blip r:embed="rId1"/></w:r>'
BODY = "<w:body>" + p("Title", "Heading1") + p("Table 1: t") + TABLE + TABLE + p("see", None, IMAGE) + p("Figure 1: f") + p("x<w:tab/>y [2]".replace("<w:tab/>", "</w:t><w:tab/><w:t>"), None, "<m:oMath><m:t>z</m:t></m:oMath>") + "<w:sdt>" + p("hidden") + "</w:sdt></w:body>"
RELS = '<Relationship Id="rId1" Target="media/image1.png"/><Relationship Id="rId2"/>'


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("docx")
    package(d / "good.docx", BODY, rels=RELS, media=[("word/media/image1.png", b"png")])
    package(d / "strict.docx", BODY, family="strict", rels=RELS)
    package(d / "odd.docx", "<w:body>" + p("Text 中") + "</w:body>", own="http://example/own")
    package(d / "nobody.docx", "<w:other/>")
    package(d / "nodocument.docx", "", document=False)
    (d / "broken.docx").write_bytes(b"not a zip")
    (d / "old.doc").write_bytes(b"x")
    with zipfile.ZipFile(d / "badxml.docx", "w") as z:
        z.writestr("word/document.xml", "<w:document")
    return d


def test_packages(spark, folder):
    got = {r["doc_id"].rsplit("/", 1)[-1]: r for r in docx.read(spark, str(folder)).collect()}
    assert len(got) == 8
    assert [got[f"{n}.docx"]["flavor"] for n in ("good", "strict", "odd", "badxml")] == ["transitional", "strict", "unknown", "invalid_xml"]
    assert got["good.docx"]["error"] is None and got["good.docx"]["valid"] and got["good.docx"]["has_images"] and got["good.docx"]["has_tables"] and got["good.docx"]["has_formulas"]
    assert got["good.docx"]["relationships"] == {"rId1": "media/image1.png"} and got["good.docx"]["paragraph_count_estimate"] == 6 + 8
    assert got["odd.docx"]["has_chinese"] and got["odd.docx"]["elements"][0]["raw_text"] == "Text 中"
    assert not got["nobody.docx"]["valid"] and all(got[n]["error"] for n in ("nobody.docx", "nodocument.docx", "broken.docx", "old.doc", "badxml.docx"))


def test_semantic_record(spark, folder):
    ir = semantic_ir.build(docx.read(spark, str(folder)).filter("doc_id LIKE '%good.docx'"))
    paragraphs = ir.paragraphs.orderBy("para_pos").collect()
    assert [r["role"] for r in paragraphs] == ["heading", "table_caption", "body", "figure_caption", "body"]
    assert paragraphs[4]["text"] == "x\ty [2]z"
    tables = ir.tables.orderBy("body_pos").collect()
    assert [t["caption"] for t in tables] == ["Table 1: t", None] and tables[0]["rows"] == [["a\nb", ""], [""]] and len(tables[0]["quality_notes"]) == 2
    (image,) = ir.images.collect()
    assert (image["id"], image["target"], image["nearby_caption"]) == ("img0001", "media/image1.png", "Figure 1: f")
    assert [e["text_hint"] for e in ir.equations.collect()] == ["x\ty [2]z"]
    counts = ir.counts.first()
    assert (counts["paragraphs"], counts["tables"], counts["images"], counts["equations"], counts["n_defects"]) == (5, 2, 1, 1, 3)
    assert "## Tables" in ir.summary().first()["text"] and "img0001" in ir.brief().first()["text"] and ir.nested().count() == 1
    own = docx.assets(ir.images, docx.media(docx._files(spark, str(folder / "good.docx")))).first()
    assert own["exported_path"] == "images/img0001.png" and bytes(own["content"]) == b"png"


def png(width, height):
    return bytes.fromhex(files.PNG) + struct.pack(">I4sII", 13, b"IHDR", width, height) + zlib.crc32(b"").to_bytes(4, "big") + b"x" * 1200


def project(root, tree):
    for path, content in tree.items():
        at = root / path
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_bytes(content if isinstance(content, bytes) else content.encode())


CLEAN = {"main.tex": r"\documentclass{article}\begin{document}\input{content/article/a}\end{document}", "source/x.md": "x", "conversion_report.md": "ok", "content/article/a.tex": r"\includegraphics{content/f}", "content/f.png": png(100, 100)}
RULES = {
    "mojibake": {"content/article/b.tex": "锛" * 10 + "中" * 600},
    "longtable_graphics": {"content/article/b.tex": r"\begin{longtable}\includegraphics{content/f.png}\end{longtable}"},
    "table_graphics": {"content/article/b.tex": r"\begin{table}\includegraphics{content/f}\caption{c}\end{table}"},
    "formula_normalization": {"content/article/b.tex": "$$x$$"},
    "formula_labels": {"content/article/b.tex": r"\begin{equation}x\end{equation}"},
    "formula_align": {"content/article/b.tex": r"\begin{align}x\end{align}"},
    "formula_references": {"content/article/b.tex": "公式（1-2）"},
    "formula_inline_style": {"content/article/b.tex": "\\(\\gbinom{a}\n{b}\\)"},
    "table_placeholders": {"content/article/b.tex": "% REVIEW: 表格"},
    "table_style": {"content/article/b.tex": r"\begin{tabular}\hline\hline\end{tabular}"},
    "missing_graphics": {"content/article/b.tex": r"TODO \includegraphics{content/fig1.2}"},
    "images": {f"content/t{i}.png": png(10, 100) for i in range(5)} | {"content/article/b.tex": "".join(rf"\includegraphics{{content/t{i}}}" for i in range(5))},
    "formula_numbering": {"main.tex": r"\documentclass{book}\begin{equation}\label{eq:a}\end{equation}"},
    "structure": {f"content/{i}.tex": r"\includegraphics{content/f.png}" for i in range(3)} | {"content/article/a.tex": None},
}
NEAR = {
    "mojibake": {"content/article/b.tex": "锛" * 10 + "中" * 700},
    "formula_labels": {"content/article/b.tex": r"\begin{equation}\label{eq:a}\end{equation}"},
    "table_style": {"content/article/b.tex": r"\begin{tabular}\toprule\hline\hline\end{tabular}"},
    "images": {f"content/t{i}.png": png(10, 100) for i in range(4)} | {"content/article/b.tex": "".join(rf"\includegraphics{{content/t{i}}}" for i in range(4))},
    "sides": {f"content/t{i}.png": png(24, 24) for i in range(5)} | {"content/article/b.tex": "".join(rf"\includegraphics{{content/t{i}}}" for i in range(5))},
    "structure": {f"content/{i}.tex": "x" for i in range(3)},
}


def test_gate_rules(spark, tmp_path):
    project(tmp_path / "clean", CLEAN)
    for kind, cases in (("one", RULES), ("near", NEAR)):
        for name, change in cases.items():
            project(tmp_path / f"{kind}_{name}", {k: v for k, v in (CLEAN | change).items() if v is not None})
    project(tmp_path / "bare", {"notes.txt": "x"})
    tree = files.tree(spark, str(tmp_path), gate.TEXT)
    found = {}
    for r in gate.findings(tree).collect():
        found.setdefault(r["project"], set()).add(r["check"])
    assert "clean" not in found
    for name in RULES:
        assert found.get(f"one_{name}") == {name}, (name, found.get(f"one_{name}"))
    for name in NEAR:
        assert f"near_{name}" not in found, (name, found.get(f"near_{name}"))
    summary = {r["project"]: r for r in gate.summary(gate.findings(tree), tree).collect()}
    assert summary["bare"]["errors"] == 2 and summary["bare"]["failed"] and not summary["clean"]["failed"]


def test_placeholder_rule_needs_missing_graphics(spark, tmp_path):
    project(tmp_path / "p", {k: v for k, v in CLEAN.items() if k != "content/f.png"})
    checks = {r["check"] for r in gate.findings(files.tree(spark, str(tmp_path), gate.TEXT)).collect()}
    assert {"missing_graphics", "review_placeholders"} <= checks


def test_decoding_and_artifacts(spark, tmp_path):
    df = spark.createDataFrame([(b"\xef\xbb\xbfa\xffb",), (None,), (png(3, 7),)], "c binary")
    width, height = files.png_size(F.col("c"))
    got = df.select(files.lenient("c").alias("l"), files.ignoring("c").alias("i"), width.alias("w"), height.alias("h")).collect()
    assert got[0]["l"] == "a�b" and got[0]["i"].endswith("ab") and got[1]["l"] is None and (got[2]["w"], got[2]["h"]) == (3, 7) and got[0]["w"] is None
    (tmp_path / "a.json").write_text('{"x": 1}')
    (tmp_path / "b.json").write_text("{nope")
    rows = files.artifacts(spark, str(tmp_path), "x long").collect()
    assert sorted((r["x"], r["_corrupt"] is None) for r in rows if r["x"]) == [(1, True)] and any(r["_corrupt"] for r in rows)
    assert files.inline(spark, ["a"]).first()["text"] == "a"


def test_lists_and_requirements(spark):
    raw = spark.createDataFrame([("[a, b; c]",), ('["x", "y"]',), ('"z"',), ("3",), ("",), (None,)], "r string")
    assert [r[0] for r in raw.select(lists.parse_list(F.col("r"))).collect()] == [["a", "b", "c"], ["x", "y"], ["z"], ["3"], [], []]
    guide = spark.createDataFrame([(1, "Margins: 2 cm. myxelatex"), (2, ""), (3, None), (4, "Letter, A4 paper. Font:\u3000 Arial, 12 pt,\n1.5 spacing")], "doc_id long, text string")
    got = requirements.extract(guide).orderBy("doc_id").collect()
    assert got[0]["margin"] == "2 cm" and got[0]["compiler"] is None and got[1]["warnings"] == got[2]["warnings"] == ["page", "bibliography_style", "compiler"]
    assert (got[3]["page_size"], got[3]["main_font"], got[3]["font_size"], got[3]["line_spacing"], got[3]["warnings"]) == ("Letter", "Arial", "12 pt", "1.5 spacing", ["bibliography_style", "compiler"])


def test_stages_skip_what_is_fresh(spark, tmp_path):
    source, out = tmp_path / "in.txt", tmp_path / "out"
    source.write_text("1")
    runs = []

    def stage():
        runs.append(1)
        out.mkdir(exist_ok=True)
        (out / "x.txt").write_text(source.read_text())

    record = stages.Manifest(spark, str(tmp_path / "manifest"))
    args = ("m", stage, [str(source), str(tmp_path / "absent")], [str(out)])
    assert record.run(*args) == "done" and record.run(*args) == "fresh" and len(runs) == 1
    source.write_text("2")
    assert record.check("m")["changed"] == [str(source)]
    assert record.run(*args) == "done" and record.run(*args) == "fresh"
    (out / "x.txt").unlink()
    out.rmdir()
    assert record.check("m")["missing"] == [str(out)]
    assert record.run("f", lambda: False, [], []) == "failed" and not record.check("f")["recorded"]


def test_directory_hash_orders_by_parts(spark):
    import hashlib

    rows = [("d", "a.b", "1"), ("d", "a/b", "2"), ("d", ".git/x", "3"), ("d", "c/.git/y", "4")]
    got = manifest.directory_hashes(spark.createDataFrame(rows, "directory string, rel_path string, sha256 string")).first()
    assert got["sha256"] == hashlib.sha256(b"a/b2a.b1").hexdigest() and got["n_files"] == 2


def test_rerun_follows_the_graph():
    assert manifest.rerun({"docx"})[0] == "docx_semantic_extraction" and manifest.rerun({"docx"})[-1] == "conversion_report" and manifest.rerun({"nothing"}) == []


def test_stream(spark, tmp_path):
    spark.createDataFrame([(1, "1.1 A\nFigure 2 b"), (2, "x")], "doc_id long, text string").write.parquet(str(tmp_path / "in"))
    ingest.start(ingest.roles(ingest.documents(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("doc_id", "body_pos").collect()
    assert [r["role"] for r in got] == ["heading_candidate", "figure_caption", "body"]


def test_windows_of_a_stream_leave_out_what_is_too_late(spark, tmp_path):
    schema = "ts timestamp, text string"
    first = spark.createDataFrame([(1, "1.1 A\nx"), (2, "Figure 2 b"), (3, "late by hours")], "k long, text string")
    at = lambda df, hours: df.selectExpr(f"timestamp_seconds(3600 * {hours}) AS ts", "text")
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in (at(first.filter("k < 3"), 10), at(first.filter("k = 2"), 30), at(first.filter("k = 3"), 10), at(first.filter("k = 2"), 50)):
        rows.coalesce(1).write.mode("append").parquet(folder)
        counts = ingest.role_counts(spark.readStream.schema(schema).parquet(folder), "ts")
        ingest.start(counts.selectExpr("window.start AS start", "role", "count"), out, str(tmp_path / "check")).awaitTermination()
    got = spark.read.parquet(out).selectExpr("unix_timestamp(start) DIV 3600 AS hour", "role", "count").collect()
    assert sorted(tuple(r) for r in got if r["hour"] == 10) == [(10, "body", 1), (10, "figure_caption", 1), (10, "heading_candidate", 1)]
    assert sorted(tuple(r) for r in got if r["hour"] == 30) == [(30, "figure_caption", 1)]
