"""Roles, captions and table notes against independent models in plain Python."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioscope import catalog
from folioscope.operators import damage, diagnose, tables
from folioscope.operators import elements as E

CASES = [
    ("Intro", "Heading2", "heading", 2),
    ("Intro", "My Title3 style", "heading", 3),
    ("Intro", "heading 4", "heading", 4),
    ("Intro", "Heading7", "body", None),
    ("1.2 About v3.0", None, "heading_candidate", 3),
    ("1.1", None, "body", None),
    ("第三章 绪论", None, "heading_candidate", 1),
    ("1 " + "x" * 79, None, "body", None),
    ("1 Abstract", None, "heading_candidate", 1),
    ("abstract: we", None, "abstract", None),
    ("摘  要 本文", None, "abstract", None),
    ("KEYWORDS a; b", None, "keywords", None),
    ("References", None, "bibliography_heading", None),
    ("References to x", None, "body", None),
    ("Figure 3 shows that", None, "figure_caption", None),
    ("　图 7 标题", None, "figure_caption", None),
    ("Fig. 2-1: a", None, "figure_caption", None),
    ("Fig. 2: a\nb", None, "body", None),
    ("表 1 数据", None, "table_caption", None),
    ("[1, 2-4]", None, "citation_fragment", None),
    ("see [1]", None, "body", None),
    ("", None, "body", None),
]


def test_roles(spark):
    rows = [(i, 0, "p", style, text) for i, (text, style, _, _) in enumerate(CASES)]
    got = E.classify(spark.createDataFrame(rows, "doc_id long, body_pos long, kind string, style string, raw_text string")).orderBy("doc_id").collect()
    assert [(r["role"], r["level"]) for r in got] == [c[2:] for c in CASES]
    assert [r["citations"] for r in got][CASES.index(("see [1]", None, "body", None))] == ["[1]"]


def captions(kinds):
    """Table captions and nearby figure captions of a list of (kind, caption number)."""
    pending, out, paragraphs = None, [], []
    for i, kind in enumerate(kinds):
        if kind == "tbl":
            out.append((i, pending))
            pending = None
        else:
            paragraphs.append((i, kind))
            if kind == "T":
                pending = f"Table {i}: c"
    near = [next((f"Figure {j}: c" for j, k in paragraphs[max(0, n - 2) : n + 3] if k == "F"), None) for n in range(len(paragraphs))]
    return out, near


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["tbl", "T", "F", "b"]), min_size=1, max_size=14))
def test_captions(spark, kinds):
    text = {"T": "Table {}: c", "F": "Figure {}: c", "b": "body {}", "tbl": "cell"}
    rows = [(1, i, "tbl" if k == "tbl" else "p", None, text[k].format(i)) for i, k in enumerate(kinds)]
    own = E.identify(E.classify(spark.createDataFrame(rows, "doc_id long, body_pos long, kind string, style string, raw_text string")))
    tables_, near = captions(kinds)
    assert [(r["body_pos"], r["caption"]) for r in E.table_captions(own).orderBy("body_pos").collect()] == tables_
    assert [r["nearby_caption"] for r in E.figure_captions(own).orderBy("para_pos").collect()] == near


@pytest.mark.parametrize(
    ("rows", "expected"),
    [
        ([], [tables.EMPTY]),
        ([["a", "b"], ["c", "d"]], []),
        ([["a", "b"], ["c"]], [tables.UNEVEN]),
        ([[" ", ""], ["c", "d"]], [tables.BLANK_ROWS + "1", tables.BLANK_HEAD]),
        ([["a"]], [tables.SHORT]),
        ([[]], [tables.BLANK_ROWS + "1", tables.BLANK_HEAD, tables.SHORT]),
    ],
)
def test_table_notes(spark, rows, expected):
    df = spark.createDataFrame([(rows,)], "cells array<array<string>>")
    assert df.select(tables.notes(F.col("cells")).alias("n")).first()["n"] == expected


def test_damage_and_repair(spark):
    broken = "实验结果".encode().decode("gbk")
    rows = [(1, 0, "plain"), (2, 0, "see " + broken), (3, 0, "é " + broken), (4, 0, "胃"), (5, 0, None), (6, 0, "瀹 only once")]
    df = spark.createDataFrame(rows, "doc_id long, body_pos long, text string")
    got = {r["doc_id"]: r for r in damage.inspect(df, repairing=True).collect()}
    assert got[2]["candidate"] == got[2]["final_text"] == "see 实验结果" and got[2]["damage"] == 3
    assert got[3]["candidate"] is None and got[3]["final_text"] == "é " + broken
    assert got[1]["candidate"] is None and got[1]["final_text"] == "plain" and got[5]["final_text"] is None and got[6]["candidate"] is None
    kept = damage.inspect(df)
    assert {(r["doc_id"], r["issue_type"], r["repaired_sample"]) for r in damage.issues(kept).collect()} == {(2, "mojibake", "see 实验结果"), (3, "mojibake", None), (4, "risky_symbol_mojibake", None)}


def test_defects(spark):
    row = {"heading_candidates": 2, "captionless_images": 0, "table_notes": 1, "equations": 0, "mojibake": 1, "repairable": 1, "risky": 0, "citation_paragraphs": 3, "bibliography_headings": 0}
    df = spark.createDataFrame([tuple(row.values())], list(row))
    got = df.select(diagnose.defects(F.lit("strict")).alias("d")).first()["d"]
    assert [re.sub(r"\W.*", "", d) for d in got] == ["strict", "headings", "table", "damaged", "citations"]


def test_context_is_that_of_elements_with_images(spark, sf_dir, monkeypatch):
    embedded = catalog.overlay.embedded
    some = F.when((F.col("kind") == "p") & (F.col("body_pos") % 2 == 1), F.array(F.lit("rId1")))
    monkeypatch.setattr(catalog.overlay, "embedded", lambda elements: embedded(elements).withColumn("rel_ids", some))
    got = {(r["doc_id"], r["anchor"]) for r in catalog.doc_context(spark, sf_dir).collect()}
    own = catalog.annotated(spark, sf_dir).filter("body_pos % 2 = 1 AND size(context) > 0")
    assert got == {(r["doc_id"], r["para_pos"]) for r in own.collect()} and got
