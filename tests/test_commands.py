"""The command line over files made here."""

import json

from folioscope.__main__ import main
from tests.test_sources import BODY, CLEAN, RELS, RULES, package, project


def lines(capsys):
    return [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]


def test_commands(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    package(tmp_path / "in" / "a.docx", BODY, rels=RELS)
    (tmp_path / "in" / "b.doc").write_bytes(b"x")
    assert main(["profile", str(tmp_path / "in")]) == 0
    assert {(r["extension"], r["conversion_required"], r.get("flavor")) for r in lines(capsys)} == {(".docx", False, "transitional"), (".doc", True, None)}
    for form, part in (("record", "elements"), ("summary", "text"), ("brief", "text")):
        assert main(["extract", str(tmp_path / "in"), "--form", form, "--repair"]) == 0
        assert len(out := lines(capsys)) == 1 and out[0][part]
    project(tmp_path / "p" / "clean", CLEAN)
    assert main(["gate", str(tmp_path / "p"), "--strict"]) == 0 and lines(capsys) == []
    project(tmp_path / "p" / "bad", CLEAN | RULES["formula_labels"])
    assert main(["gate", str(tmp_path / "p")]) == 0 and [r["check"] for r in lines(capsys)] == ["formula_labels"]
    assert main(["gate", str(tmp_path / "p"), "--strict", "--form", "markdown"]) == 1 and len(lines(capsys)) == 2
    assert main(["template", str(tmp_path / "p")]) == 0 and {r["main_file"] for r in lines(capsys)} == {"main.tex"}
    assert main(["requirements", "--text", "A4 paper"]) == 0 and lines(capsys)[0]["page_size"] == "A4"
    source, m = tmp_path / "s.txt", str(tmp_path / "manifest")
    source.write_text("1")
    assert main(["fresh", m, "x"]) == 1
    assert main(["record", m, "x", "--input", str(source)]) == 0 and main(["fresh", m, "x"]) == 0
    source.write_text("2")
    assert main(["fresh", m, "x"]) == 1
    capsys.readouterr()
    assert main(["rerun", "guide"]) == 0 and capsys.readouterr().out.split()[0] == "format_requirements"


def test_documents_assets_and_results(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    package(tmp_path / "in" / "a.docx", BODY, rels=RELS, media=[("word/media/image1.png", b"png bytes")])
    assert main(["extract", str(tmp_path / "in"), "--pretty", "--assets", str(tmp_path / "out")]) == 0
    printed = capsys.readouterr()
    assert json.loads(printed.out)["elements"] and printed.out.count("\n") > 5 and json.loads(printed.err.splitlines()[-1]) == {"exported": 1}
    assert [(p.relative_to(tmp_path / "out").as_posix(), p.read_bytes()) for p in (tmp_path / "out").rglob("*") if p.is_file()] == [("a.docx/images/img0001.png", b"png bytes")]
    results = {"a": {"success": True, "command": ["latexmk"], "return_code": 0}, "b": {"success": False}, "c": {"success": False, "environment_blocker": True, "error": "no engine"}, "d": None}
    (tmp_path / "built").mkdir()
    for name, result in results.items():
        (tmp_path / "built" / f"{name}.json").write_text("{not json" if result is None else json.dumps(result))
    assert main(["built", str(tmp_path / "built")]) == 0
    assert sorted((r["status"], tuple(r["notes"])) for r in lines(capsys)) == [("Environment blocker", ("no engine",)), ("False", ()), ("Not run", ()), ("True", ())]


def test_bytes_that_are_not_text_are_left_out(spark, tmp_path, capsys):
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "guide.txt").write_bytes(b"\xffA\xc34 paper, compile with xelatex")
    assert main(["requirements", str(tmp_path / "g")]) == 0 and lines(capsys)[0]["page_size"] == "A4"
    project(tmp_path / "t" / "one", {"main.tex": "\\documentclass{article}" + "x" * 450_000 + "\\usepackage{late}\\keywords{k}"})
    found = []
    for bounds in ([], ["--bounded"]):
        assert main(["template", str(tmp_path / "t"), *bounds]) == 0
        (own,) = lines(capsys)
        found.append((own["packages"], own["metadata_fields"]))
    assert found == [(["late"], ["keywords"]), ([], [])]
