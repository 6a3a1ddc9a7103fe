"""Inputs that show all features, computed from the given tables by the same arithmetic in Spark and in SQL."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.operators import elements as E
from folioscope.sources.docx import DOCUMENT, FAMILIES, RELATIONSHIPS

IDEOGRAPHIC_SPACE = "\u3000"
#: Damage that no reading repairs, and damage that reads as the other text.
DAMAGED, REPAIRABLE, REPAIRED = "瀹為", "瀹為獙缁撴灉", "实验结果"
FILE_DAMAGE = "锛鐨鑸垫浠妯绯璇鎺鍥琛寮"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# (k, kind, style, text in SQL of both engines; l is the line)
ELEMENTS = [
    (0, "p", "Heading1", "l"),
    (1, "p", None, "concat('1.2 ', l)"),
    (2, "p", None, "concat('图 1-2 ', l)"),
    (3, "p", None, "concat('Table 3: ', l)"),
    (4, "tbl", None, "l"),
    (5, "p", None, "concat(l, ' [1] and [2-4, 6]')"),
    (6, "p", None, "concat('Abstract: ', l)"),
    (7, "p", None, "concat('关键词：', l)"),
    (8, "p", None, "'References'"),
    (9, "p", None, f"concat(l, '{DAMAGED}')"),
    (10, "p", None, "concat(l, '胃')"),
    (11, "p", "heading 2", "l"),
    (12, "p", None, f"concat('{IDEOGRAPHIC_SPACE}', '图 7 ', l)"),
    (13, "p", None, "'[3]'"),
    (14, "p", None, f"concat(l, '{REPAIRABLE}')"),
]


def _case(column: int, default: str) -> str:
    own = [(k, row) for k, *row in ELEMENTS]
    value = lambda x: "NULL" if x is None else x if column == 2 else _quoted(x)
    return "CASE k " + " ".join(f"WHEN {k} THEN {value(row[column])}" for k, row in own) + f" ELSE {default} END"


def elements(documents: DataFrame) -> DataFrame:
    rows = E.lines(documents).selectExpr("doc_id", "body_pos", "raw_text AS l", "(doc_id * 31 + body_pos * 7) % 16 AS k")
    return rows.selectExpr("doc_id", "body_pos", f"{_case(0, _quoted('p'))} AS kind", f"{_case(1, 'NULL')} AS style", f"{_case(2, 'l')} AS raw_text")


ELEMENTS_SQL = f"""
lines AS (SELECT doc_id, p AS body_pos, x[p + 1] AS l, (doc_id * 31 + p * 7) % 16 AS k FROM (SELECT doc_id, x, unnest(range(len(x))) AS p FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents))),
overlay AS (SELECT doc_id, body_pos, {_case(0, "'p'")} AS kind, {_case(1, 'NULL')} AS style, {_case(2, 'l')} AS raw_text FROM lines)"""


def embedded(elements: DataFrame) -> DataFrame:
    """Elements with the images, mathematics and cells that packages would give."""
    paragraph = F.col("kind") == "p"
    some = paragraph & ((F.col("doc_id") + F.col("body_pos")) % 9 == 0)
    return elements.withColumns(
        {
            "rel_ids": F.when(some, F.array(F.concat(F.lit("rId"), F.col("body_pos").cast("string")))),
            "has_math": paragraph & F.contains("raw_text", F.lit("$$")),
            "rows": F.when(~paragraph, F.array(F.split("raw_text", " "))),
        }
    )


def relationships(documents: DataFrame) -> DataFrame:
    own = elements(documents).filter("kind = 'p' AND (doc_id + body_pos) % 9 = 0 AND body_pos % 4 <> 0")
    return own.selectExpr("doc_id", "concat('rId', body_pos) AS rel_id", "concat('media/image', body_pos, '.png') AS target")


# Project files: one document is one file of project doc_id % 20. SQL of both engines; b: the document's text.
PATH = r"""CASE
 WHEN doc_id < 20 THEN CASE WHEN doc_id % 4 <> 0 THEN 'main.tex' ELSE 'other.tex' END
 WHEN doc_id < 40 THEN CASE WHEN doc_id % 5 <> 0 THEN 'conversion_report.md' ELSE 'notes.md' END
 WHEN doc_id < 60 THEN CASE WHEN doc_id % 2 = 0 THEN concat('source/raw', doc_id, '.md') ELSE concat('misc/raw', doc_id, '.md') END
 WHEN doc_id % 20 = 7 THEN concat('plain/c', doc_id, '.tex')
 WHEN doc_id % 9 < 3 THEN concat('content/c', doc_id, '.tex')
 WHEN doc_id % 9 = 3 THEN CASE WHEN doc_id % 3 = 0 AND doc_id % 20 < 9 THEN concat('content/article/c', doc_id, '.tex') ELSE concat('chapters/c', doc_id, '.tex') END
 WHEN doc_id % 9 = 4 THEN concat('style/s', doc_id, '.sty')
 WHEN doc_id % 9 < 7 THEN concat('content/img/i', doc_id, '.png')
 WHEN doc_id % 9 = 7 THEN concat('content/img/i', doc_id, '.pdf')
 ELSE concat('bib/b', doc_id, '.bib') END"""
BODIES = [
    r"'\documentclass[12pt]{book}\usepackage{amsmath, graphicx}\title{T}\author{A}\begin{document}', b, '\end{document}'",
    r"'\begin{equation}x\end{equation}', b",
    r"'\begin{align}a&b\end{align}', b",
    r"'\includegraphics[width=1cm]{content/img/i', doc_id + 40, '}', b",
    r"'\includegraphics{ figure.wmf }', b",
    r"'$$x$$ see Equation (1.2) ', b",
    r"'\(\gbinom{a}{b}\) \(\displaystyle\gbinom{c}{d}\)', b",
    r"'\begin{table}\hline a \hline\end{table}', b",
    r"'% REVIEW: check table 3 ', b",
    r"'\begin{longtable}\includegraphics{./content/img/i', doc_id + 20, '.png}\end{longtable}', b",
    r"'\begin{table}\includegraphics{content//img/i', doc_id + 60, '.pdf}\caption{c}\end{table}', b",
    f"'{FILE_DAMAGE}', b",
    r"'\label{a}\usepackage{natbib,amsmath}\input{chapter1}\bibliography{refs}\section{s} C:\\\\x', b",
    r"'\begin{equation}\label{eq:a}x\end{equation}\begin{align}a\notag\end{align}\usepackage{biblatex}\addbibresource{r.bib}\appendix', b",
]


def _body(escape) -> str:  # noqa: ANN001
    return "CASE doc_id % 17 " + " ".join(f"WHEN {i} THEN concat({escape(x)})" for i, x in enumerate(BODIES)) + " ELSE b END"


def files(documents: DataFrame) -> DataFrame:
    """project, rel_path, size_bytes, text."""
    start = documents.selectExpr("doc_id", "coalesce(text, '') AS b").selectExpr("doc_id", f"{PATH} AS rel_path", f"{_body(lambda x: x.replace(chr(92), chr(92) * 2))} AS body")
    image = "rel_path RLIKE '[.](png|pdf)$'"
    return start.selectExpr("doc_id % 20 AS project", "rel_path", "(doc_id * 37) % 3000 AS size_bytes", f"CASE WHEN {image} THEN NULL ELSE body END AS text")


FILES_SQL = f"""
files AS (SELECT doc_id % 20 AS project, rel_path, (doc_id * 37) % 3000 AS size_bytes, CASE WHEN regexp_matches(rel_path, '[.](png|pdf)$') THEN NULL ELSE body END AS text
 FROM (SELECT doc_id, {PATH} AS rel_path, {_body(lambda x: x)} AS body FROM (SELECT doc_id, coalesce(text, '') AS b FROM documents)))"""

# Guide texts by doc_id % 6; b as above.
GUIDES = [
    "'Use A4 paper, margins of 2.5 cm on all sides. Font: Times New Roman 12 pt, double spacing. IEEE style. Compile with xelatex. Figure captions go below; table captions above. ', b",
    "'页边距 2.54 厘米，字体：宋体，小四，1.5倍行距，参考文献采用GB/T 7714，学位论文，图题位于下方，表题在上方，章节编号。本文要求双栏排版并且使用规定的字号与格式完成全部内容', b",
    "'Left margin 3 cm, right 2 cm; top 25 mm. two-column article, APA or author-year; biblatex with biber. Arial or Calibri. ', b",
    "'thesis report; numbered headings; 11pt; single spacing; Letter. pdflatex; natbib. 黑体 四号 ', b",
    "'A3纸 双栏 毕业设计 不编号 顺序编码制 上下左右 3 厘米', b",
    "b",
]
GUIDES_CASE = "CASE doc_id % 6 " + " ".join(f"WHEN {i} THEN concat({x})" for i, x in enumerate(GUIDES)) + " END"


def guides(documents: DataFrame) -> DataFrame:
    return documents.selectExpr("doc_id", "coalesce(text, '') AS b").selectExpr("doc_id", f"{GUIDES_CASE} AS text")


GUIDES_SQL = f"guides AS (SELECT doc_id, {GUIDES_CASE} AS text FROM (SELECT doc_id, coalesce(text, '') AS b FROM documents))"


# Packages: a document is a package whose kind is doc_id % 7; its lines are paragraphs, and one table holds the words of the first two.
PACKAGE_KINDS = ("strict", "unknown", "no_body", "not_a_zip", "no_document", "transitional", "other_suffix")
OWN_SPACE = "http://example.org/own"


def package(doc_id: int, text: str) -> bytes:
    """The bytes of a package."""
    kind = PACKAGE_KINDS[doc_id % 7]
    if kind == "not_a_zip":
        return text.encode()
    spaces = FAMILIES["strict" if kind == "strict" else "transitional"] | ({"w": OWN_SPACE} if kind == "unknown" else {})
    lines = text.split("\n")
    paragraphs = []
    for i, line in enumerate(lines):
        properties = ('<w:pStyle w:val="Heading1"/>' if i % 5 == 0 else "") + ("<w:numPr/>" if i % 7 == 1 else "")
        math = "<m:oMath><m:r><m:t>x=1</m:t></m:r></m:oMath>" if i % 11 == 2 else ""
        image = f'<w:drawing><w:blip r:embed="rId{i}"/></w:drawing>' if i % 6 == 3 else ""
        paragraphs.append(f"<w:p><w:pPr>{properties}</w:pPr><w:r><w:t>{escape(line)}</w:t><w:tab/>{image}</w:r>{math}</w:p>")
    rows = "".join("<w:tr>" + "".join(f"<w:tc><w:p><w:r><w:t>{escape(w)}</w:t></w:r></w:p></w:tc>" for w in line.split(" ")) + "</w:tr>" for line in lines[:2])
    name = "notes" if kind == "no_body" else "body"
    declared = " ".join(f'xmlns:{k}="{v}"' for k, v in spaces.items())
    document = f'<?xml version="1.0" encoding="UTF-8"?><w:document {declared}><w:{name}>{"".join(paragraphs)}<w:tbl>{rows}</w:tbl></w:{name}></w:document>'
    related = "".join(f'<Relationship Id="rId{i}" Target="media/image{i}.png"/>' for i in range(len(lines)) if i % 6 == 3)
    sink = io.BytesIO()
    with zipfile.ZipFile(sink, "w") as archive:
        if kind != "no_document":
            archive.writestr(DOCUMENT, document)
        archive.writestr(RELATIONSHIPS, f"<Relationships>{related}</Relationships>")
        for i in range(len(lines)):
            if i % 6 == 3:
                archive.writestr(f"word/media/image{i}.png", bytes([i % 256]) * 10)
    return sink.getvalue()


def packages(documents: DataFrame) -> DataFrame:
    """(path, content): a package for each document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                suffix = "txt" if PACKAGE_KINDS[doc_id % 7] == "other_suffix" else "docx"
                yield pd.DataFrame({"path": [f"p{doc_id}.{suffix}"], "content": [package(doc_id, text or "")]})

    return documents.select("doc_id", "text").mapInPandas(run, "path string, content binary")
