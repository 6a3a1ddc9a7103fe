"""DuckDB SQL with the same rows as the queries of the catalog.

Its expressions are RE2: white space is written with the Unicode separators,
lookbehind as an optional group, and a backreference as one alternative for
each name.
"""

from __future__ import annotations

from folioscope.operators import damage, gate, lists, manifest, requirements, template
from folioscope.operators import elements as E
from folioscope.operators import tables as T
from folioscope.plans.overlay import ELEMENTS_SQL, FILES_SQL, GUIDES_SQL, REPAIRABLE, REPAIRED

WS = r"[\s\p{Z}\x1c-\x1f\x85]"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def re2(pattern: str) -> str:
    """A pattern whose white space also is Unicode's; inside of classes too."""
    out, inside, i = [], False, 0
    while i < len(pattern):
        two = pattern[i : i + 2]
        if two[:1] == "\\":
            out.append((r"\s\p{Z}" if inside else WS) if two == r"\s" else two)
            i += 2
            continue
        inside = True if two[:1] == "[" and not inside else False if two[:1] == "]" else inside
        out.append(two[:1])
        i += 1
    return "".join(out)


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{WS}+', ''), '{WS}+$', '')"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def ellipsis(x: str, n: int) -> str:
    return f"CASE WHEN length({squeeze(x)}) > {n} THEN left({squeeze(x)}, {n - 1}) || '…' ELSE {squeeze(x)} END"


def has(x: str, pattern: str, loose: bool = True) -> str:
    return f"regexp_matches({x}, {q(('(?i)' if loose else '') + re2(pattern))})"


def score(x: str, tokens: list[str]) -> str:
    return "(" + " + ".join(f"(len(string_split({x}, {q(t)})) - 1)" for t in tokens) + ")::BIGINT"


CJK = "len(regexp_extract_all({x}, '[一-鿿]'))::BIGINT"
_level = f"coalesce(TRY_CAST(nullif(regexp_extract(style, {q('(?i)' + E.STYLED_HEADING)}, 1), '') AS INT), CASE WHEN starts_with(lower(style), 'heading') THEN TRY_CAST(nullif(regexp_extract(style, '([1-6])$', 1), '') AS INT) END)"
_numbered = f"({has('text', E.NUMBERED_HEADING, False)} AND length(text) <= {E.NUMBERED_HEADING_LENGTH})"
_role = f"""CASE WHEN {_level} IS NOT NULL THEN 'heading' WHEN {_numbered} THEN 'heading_candidate' WHEN {has('text', E.ABSTRACT)} THEN 'abstract' WHEN {has('text', E.KEYWORDS)} THEN 'keywords'
 WHEN {has('text', E.REFERENCES)} THEN 'bibliography_heading' WHEN {has('text', E.FIGURE)} THEN 'figure_caption' WHEN {has('text', E.TABLE)} THEN 'table_caption' WHEN regexp_full_match(text, {q(re2(E.CITATION))}) THEN 'citation_fragment' ELSE 'body' END"""
CLASSIFIED = f"""{ELEMENTS_SQL},
stripped AS (SELECT *, {strip('raw_text')} AS text FROM overlay),
classified AS (SELECT *, CASE WHEN kind = 'p' THEN {_role} END AS role,
  CASE WHEN kind = 'p' THEN coalesce({_level}, CASE WHEN {_numbered} THEN CASE WHEN {has('text', r'^\s*[0-9]', False)} THEN length(text) - length(replace(text, '.', '')) + 1 ELSE 1 END END) END::BIGINT AS level,
  CASE WHEN kind = 'p' THEN regexp_extract_all(text, {q(re2(E.CITATION))}) END AS citations FROM stripped)"""
IDENTIFIED = f"""{CLASSIFIED},
identified AS (SELECT *, CASE WHEN kind = 'p' THEN 'p' || lpad(n::VARCHAR, 5, '0') ELSE 'tab' || lpad(n::VARCHAR, 4, '0') END AS id, CASE WHEN kind = 'p' THEN n - 1 END::BIGINT AS para_pos
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, kind ORDER BY body_pos) AS n FROM classified)),
anchors AS (SELECT doc_id, para_pos, 'rId' || body_pos AS rel_id, CASE WHEN body_pos % 4 <> 0 THEN 'media/image' || body_pos || '.png' END AS target FROM identified WHERE kind = 'p' AND (doc_id + body_pos) % 9 = 0),
near AS (SELECT doc_id, para_pos, first_value(CASE WHEN role = 'figure_caption' THEN text END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY para_pos ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS nearby_caption FROM identified WHERE kind = 'p'),
images AS (SELECT doc_id, 'img' || lpad(row_number() OVER (PARTITION BY doc_id ORDER BY para_pos, rel_id)::VARCHAR, 4, '0') AS id, para_pos, rel_id, target, nearby_caption FROM anchors LEFT JOIN near USING (doc_id, para_pos)),
captions AS (SELECT doc_id, body_pos, id, c.text AS caption, c.id AS caption_paragraph_id FROM (
  SELECT *, last_value(CASE WHEN role = 'table_caption' THEN struct_pack(text := text, id := id) END IGNORE NULLS) OVER (PARTITION BY doc_id, segment ORDER BY body_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS c
  FROM (SELECT *, coalesce(sum(CASE WHEN kind = 'tbl' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY body_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS segment FROM identified)) WHERE kind = 'tbl')"""
_scored = score("text", damage.EXTRACTED)
_repaired = f"CASE WHEN regexp_matches(text, '(?s)^[\\x00-\\x7F]*{REPAIRABLE}$') THEN replace(text, '{REPAIRABLE}', '{REPAIRED}') END"  # other bytes don't read as UTF-8
ISSUES = f"""issues AS (SELECT doc_id, body_pos, 'mojibake' AS issue_type, 'warning' AS severity, left(text, 160) AS sample, left({_repaired}, 160) AS repaired_sample FROM classified WHERE kind = 'p' AND {_scored} >= 2
 UNION ALL SELECT doc_id, body_pos, 'risky_symbol_mojibake', 'review', left(text, 160), NULL FROM classified WHERE kind = 'p' AND contains(text, '{damage.RISKY}'))"""


def notes(rows: str) -> str:
    blank = f"len(list_filter(c, lambda v: {strip('v')} <> '')) = 0"
    n_blank = f"len(list_filter({rows}, lambda c: {blank}))"
    return f"""CASE WHEN len({rows}) = 0 THEN [{q(T.EMPTY)}] ELSE list_filter([CASE WHEN len(list_distinct(list_transform({rows}, lambda c: len(c)))) > 1 THEN {q(T.UNEVEN)} END, CASE WHEN {n_blank} > 0 THEN {q(T.BLANK_ROWS)} || {n_blank} END,
 CASE WHEN len(list_filter({rows}[1], lambda v: {strip('v')} <> '')) = 0 THEN {q(T.BLANK_HEAD)} END, CASE WHEN len({rows}) <= 1 THEN {q(T.SHORT)} END], lambda z: z IS NOT NULL) END"""


PROFILE = f"""{IDENTIFIED}, {ISSUES},
profile AS (SELECT a.*, coalesce(images, 0) AS images, coalesce(captionless_images, 0) AS captionless_images, coalesce(table_notes, 0) AS table_notes, coalesce(equations, 0) AS equations, coalesce(text_issues, 0) AS text_issues, coalesce(mojibake, 0) AS mojibake, coalesce(repairable, 0) AS repairable, coalesce(risky, 0) AS risky
 FROM (SELECT doc_id, count(*) FILTER (kind = 'p') AS paragraphs, count(*) FILTER (role IN ('heading', 'heading_candidate')) AS headings, count(*) FILTER (role = 'heading_candidate') AS heading_candidates, count(*) FILTER (kind = 'tbl') AS tables,
   count(*) FILTER (len(citations) > 0) AS citation_paragraphs, count(*) FILTER (role = 'bibliography_heading') AS bibliography_headings FROM identified GROUP BY doc_id) a
 LEFT JOIN (SELECT doc_id, count(*) AS images, count(*) FILTER (nearby_caption IS NULL) AS captionless_images FROM images GROUP BY doc_id) USING (doc_id)
 LEFT JOIN (SELECT doc_id, sum(len({notes("[string_split(text, ' ')]")}))::BIGINT AS table_notes FROM identified WHERE kind = 'tbl' GROUP BY doc_id) USING (doc_id)
 LEFT JOIN (SELECT doc_id, count(*) AS equations FROM identified WHERE kind = 'p' AND contains(text, '$$') GROUP BY doc_id) USING (doc_id)
 LEFT JOIN (SELECT doc_id, count(*) AS text_issues, count(*) FILTER (issue_type = 'mojibake') AS mojibake, count(repaired_sample) AS repairable, count(*) FILTER (issue_type <> 'mojibake') AS risky FROM issues GROUP BY doc_id) USING (doc_id))"""


def defects(flavor: str) -> str:
    n = lambda title, c: f"CASE WHEN {c} > 0 THEN {q(title)} || {c} END"
    return f"""list_filter([CASE {flavor} WHEN 'strict' THEN 'strict package: read with its own namespaces' WHEN 'unknown' THEN 'unknown package namespace: review the extraction' END,
 {n('headings by number only: ', 'heading_candidates')}, {n('images without a caption nearby: ', 'captionless_images')}, {n('table notes to review: ', 'table_notes')}, {n('equations to rebuild: ', 'equations')},
 CASE WHEN mojibake > 0 THEN 'damaged paragraphs: ' || mojibake || ', repairable: ' || repairable END, {n('paragraphs with risky symbols: ', 'risky')},
 CASE WHEN citation_paragraphs > 0 AND bibliography_headings = 0 THEN 'citations without a bibliography heading' END], lambda z: z IS NOT NULL)"""


def indexed(key: str, values: str, source: str, name: str) -> str:
    return f"SELECT {key}, i::BIGINT AS idx, x[i + 1] AS {name} FROM (SELECT {key}, x, unnest(range(len(x))) AS i FROM (SELECT {key}, {values} AS x FROM {source}))"


# Files


def suffix(path: str) -> str:
    return f"lower(regexp_extract(string_split({path}, '/')[-1], '[^.]([.][^.]+)$', 1))"


def among(suffixes: tuple[str, ...]) -> str:
    return f"({suffix('rel_path')} IN ({', '.join(map(q, suffixes))}))"


def blocks(text: str, *names: str) -> str:
    return f"regexp_extract_all({text}, {q('(?s)' + '|'.join(rf'\\begin\{{{n}\}}.*?\\end\{{{n}\}}' for n in names))})"


def _exists(values: str, condition: str) -> str:
    return f"len(list_filter({values}, lambda blk: {condition})) > 0"


_bordered = r"len(regexp_extract_all(blk, '\\hline\b')) >= 2 AND NOT (contains(blk, '\toprule') OR contains(blk, '\midrule') OR contains(blk, '\bottomrule'))"
_hits = score("text", damage.PROJECT)
_FILE_RULES = [
    (1, "mojibake", "error", gate.TEXT, f"{_hits} >= 10 AND {_hits} / greatest({CJK.format(x='text')}, 1) >= 0.015", True),
    (9, "longtable_graphics", "warning", gate.TEXT, _exists(blocks("text", "longtable", "table"), r"contains(blk, '\includegraphics') AND starts_with(blk, '\begin{longtable}')"), False),
    (10, "table_graphics", "warning", gate.TEXT, _exists(blocks("text", "longtable", "table"), r"contains(blk, '\includegraphics') AND starts_with(blk, '\begin{table}') AND contains(blk, '\caption')"), False),
    (11, "formula_normalization", "warning", gate.LATEX, "contains(text, '$$')", False),
    (12, "formula_labels", "warning", gate.LATEX, _exists(blocks("text", "equation"), r"NOT contains(blk, '\label{')"), False),
    (13, "formula_align", "warning", gate.LATEX, _exists(blocks("text", "align"), r"NOT contains(blk, '\notag') AND NOT contains(blk, '\nonumber')"), False),
    (14, "formula_references", "warning", gate.LATEX, has("text", gate.MANUAL_REFERENCE), False),
    (15, "formula_inline_style", "warning", gate.LATEX, _exists(f"regexp_extract_all(text, {q(gate.INLINE)}, 1)", r"contains(blk, '\gbinom') AND NOT contains(blk, '\displaystyle')"), False),
    (17, "table_placeholders", "warning", gate.TEXT, has("text", gate.TABLE_MARKER), False),
    (18, "table_style", "warning", gate.TEXT, _exists(blocks("text", *gate.TABLE_LIKE), _bordered), False),
]
_empty = "[]::VARCHAR[]"
REFERENCES = f"""refs AS (SELECT *, {suffix('raw')} AS suffix, regexp_replace(regexp_replace(raw, '^([.]/)+', ''), '//+', '/', 'g') AS clean FROM (SELECT project, rel_path, {strip('r')} AS raw FROM (SELECT project, rel_path, unnest(regexp_extract_all(text, {q(gate.GRAPHICS)}, 1)) AS r FROM files WHERE {among(gate.TEXT)}))),
tries AS (SELECT DISTINCT project, clean, k, CASE WHEN k = 0 THEN clean ELSE clean || [{', '.join(map(q, gate.IMAGES))}][k] END AS candidate FROM refs, range({len(gate.IMAGES) + 1}) o(k) WHERE k = 0 OR suffix = ''),
found AS (SELECT project, clean, arg_min(candidate, k) AS resolved FROM tries JOIN (SELECT DISTINCT project, rel_path AS candidate FROM files) USING (project, candidate) GROUP BY ALL),
resolved AS (SELECT project, rel_path, raw, suffix, resolved FROM refs LEFT JOIN found USING (project, clean)),
pictures AS (SELECT files.* FROM files JOIN (SELECT project, bool_or(starts_with(rel_path, 'content/')) AS content FROM files GROUP BY project) USING (project) WHERE {among(gate.IMAGES)} AND (NOT content OR starts_with(rel_path, 'content/'))),
loose AS (SELECT project, rel_path FROM pictures p WHERE NOT EXISTS (SELECT 1 FROM resolved r WHERE r.project = p.project AND r.resolved = p.rel_path))"""
RENDERED = f"rendered AS (SELECT project, sum(len(regexp_extract_all(text, {q(gate.RENDERED)})))::BIGINT AS rendered FROM files WHERE {among(gate.TEXT)} GROUP BY project)"
_structure = "structure AS (SELECT project, bool_or(rel_path = 'main.tex') AS main, bool_or(starts_with(rel_path, 'source/')) AS source, bool_or(rel_path = 'conversion_report.md') AS report, bool_or(starts_with(rel_path, 'content/')) AS content, bool_or(regexp_matches(rel_path, '^content/(article|report|thesis)/.*[.]tex$')) AS semantic, list_sort(list(DISTINCT rel_path) FILTER (regexp_matches(rel_path, '^content/[^/]+[.]tex$'))) AS flat FROM files GROUP BY project)"
FINDINGS = f"""{FILES_SQL}, {REFERENCES}, {RENDERED}, {_structure},
broken AS ({' UNION ALL '.join(f"SELECT project, {o} AS rule_ordinal, {q(sev)} AS severity, {q(c)} AS \"check\", rel_path, {'rel_path' if per else q('')} AS own FROM files WHERE {among(s)} AND coalesce({cond}, false)" for o, c, sev, s, cond, per in _FILE_RULES)}),
graphics AS (SELECT project, count(*) FILTER (resolved IS NULL) AS n_missing, list_slice(list_sort(list(rel_path || ': ' || raw) FILTER (resolved IS NULL)), 1, 20) AS missing, count(*) FILTER (suffix IN ('.wmf', '.emf')) AS n_unsupported, list_slice(list_sort(list(rel_path || ': ' || raw) FILTER (suffix IN ('.wmf', '.emf'))), 1, 20) AS unsupported FROM resolved GROUP BY project),
marked AS (SELECT project, bool_or({has('text', gate.MARKER)}) AS marked FROM files WHERE {among(gate.TEXT)} GROUP BY project),
shown AS (SELECT project, count(*) AS images, count(*) FILTER (size_bytes < 1024) AS n_tiny, list_slice(list_sort(list(rel_path) FILTER (size_bytes < 1024)), 1, 20) AS tiny FROM pictures GROUP BY project),
hidden AS (SELECT project, count(*) AS loose FROM loose GROUP BY project),
numbering AS (SELECT project, bool_or({has('text', gate.CHAPTER_CLASS, False)}) AS chapters, bool_or(contains(text, '\\begin{{equation}}') OR contains(text, '\\begin{{align}}')) AS formulas, bool_or(contains(text, '\\numberwithin{{equation}}{{chapter}}') OR contains(text, '\\thechapter-\\arabic{{equation}}')) AS numbered FROM files WHERE {among(gate.LATEX)} GROUP BY project),
extracted AS (SELECT doc_id % 20 AS project, count(*) FILTER (doc_id % 6 = 0) AS extracted FROM documents GROUP BY ALL),
findings AS (
 SELECT project, rule_ordinal, severity, "check", count(DISTINCT rel_path) AS n, list_sort(list(DISTINCT rel_path)) AS paths FROM broken GROUP BY project, rule_ordinal, severity, "check", own
 UNION ALL SELECT project, 2, 'error', 'structure', 1, ['main.tex'] FROM structure WHERE NOT main
 UNION ALL SELECT project, 3, 'warning', 'structure', 1, ['source/'] FROM structure WHERE NOT source
 UNION ALL SELECT project, 4, 'warning', 'structure', 1, ['conversion_report.md'] FROM structure WHERE NOT report
 UNION ALL SELECT project, 5, 'warning', 'structure', len(flat), flat FROM structure WHERE content AND len(flat) > 2 AND NOT semantic
 UNION ALL SELECT project, 6, 'error', 'structure', 1, ['content/'] FROM structure WHERE NOT content
 UNION ALL SELECT project, 7, 'error', 'missing_graphics', n_missing, missing FROM graphics WHERE n_missing > 0
 UNION ALL SELECT project, 8, 'error', 'unsupported_graphics', n_unsupported, unsupported FROM graphics WHERE n_unsupported > 0
 UNION ALL SELECT project, 19, 'warning', 'review_placeholders', 1, {_empty} FROM graphics LEFT JOIN marked USING (project) WHERE n_missing + n_unsupported > 0 AND NOT coalesce(marked, false)
 UNION ALL SELECT project, 20, 'warning', 'images', coalesce(loose, 0), {_empty} FROM shown LEFT JOIN hidden USING (project) WHERE coalesce(loose, 0) / images > 0.35
 UNION ALL SELECT project, 21, 'warning', 'images', n_tiny, tiny FROM shown WHERE n_tiny >= 5
 UNION ALL SELECT project, 16, 'warning', 'formula_numbering', 1, {_empty} FROM numbering WHERE chapters AND formulas AND NOT numbered
 UNION ALL SELECT project, 22, 'warning', 'table_coverage', extracted - coalesce(rendered, 0), {_empty} FROM extracted LEFT JOIN rendered USING (project) WHERE extracted > 0 AND coalesce(rendered, 0) < extracted),
summary AS (SELECT project, coalesce(findings, 0) AS findings, coalesce(errors, 0) AS errors, coalesce(warnings, 0) AS warnings FROM (SELECT DISTINCT project FROM files) LEFT JOIN (SELECT project, count(*) AS findings, count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warning') AS warnings FROM findings GROUP BY project) USING (project))"""

# Templates

_packages = f"list_sort(list_distinct(list_filter(list_transform(flatten(list_transform(regexp_extract_all(text, {q(template.PACKAGE)}, 1), lambda g: string_split(g, ','))), lambda g: trim(g)), lambda g: g <> '')))"
_inside = lambda part: f"contains(text, {q(part)})"
_named = lambda names: "(lower(string_split(rel_path, '/')[-1]) IN (" + ", ".join(map(q, names)) + "))::BIGINT"
_begins, _classed = _inside(r"\begin{document}"), _inside(r"\documentclass")
_main_score = (
    f"({_named(template.COMMON_NAMES)} * 8 + {_named(template.THESIS_NAMES)} * 10 + {_classed}::BIGINT * 25 + {_begins}::BIGINT * 10 + {_inside(chr(92) + 'end{document}')}::BIGINT * 7"
    f" + ({_inside(chr(92) + 'input')} OR {_inside(chr(92) + 'include')})::BIGINT * 2 - ({_begins} AND NOT {_classed})::BIGINT * 8 - greatest(0, len(string_split(rel_path, '/')) - 1))"
)
TEX = f"""{FILES_SQL},
tex AS (SELECT *, nullif(regexp_extract(text, {q(template.CLASS)}, 1), '') AS documentclass, {_packages} AS packages, regexp_extract_all(text, {q(template.INPUT)}, 1) AS inputs, regexp_extract_all(text, {q(template.BIBLIOGRAPHY)}, 1) AS bibliography_files,
 len(regexp_extract_all(text, {q(template.LABEL)}))::BIGINT AS label_count, {_main_score}::BIGINT AS score, {_begins} AS begins, {_inside(chr(92) + 'end{document}')} AS ends FROM files WHERE ends_with(rel_path, '.tex')),
ranked AS (SELECT *, row_number() OVER (PARTITION BY project ORDER BY score DESC, rel_path) AS rank FROM tex),
usage AS (SELECT project, package, count(DISTINCT rel_path) AS n_files FROM (SELECT project, rel_path, unnest(packages) AS package FROM tex) GROUP BY ALL)"""
_any = lambda p, loose=True: f"bool_or({has('text', p, loose)})"
_joined = lambda x: f"array_to_string(coalesce({x}, {_empty}), '|')"
_listed = lambda c: f"list_sort(coalesce(list(DISTINCT rel_path) FILTER ({c}), {_empty}))"
_all = lambda c: f"list_sort(list_distinct(flatten(list({c}))))"
_offers = lambda prefix, names: "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {prefix}_{k} THEN {q(k)} END" for k in names) + "], lambda z: z IS NOT NULL), '|')"
_auxiliary = " OR ".join(f"ends_with(lower(rel_path), {q(s)})" for s in template.AUXILIARY)
PROFILES = f"""{TEX},
own AS (SELECT project, {_all('packages')} AS packages, {_all('inputs')} AS inputs, {_all('bibliography_files')} AS bibliography_files, {_any(r'\\addbibresource|\\printbibliography', False)} AS added, {_any(r'\\bibliography', False)} AS plain, {_any(template.DRIVE)} AS drive,
 {', '.join(f'{_any(p)} AS m_{k}' for k, p in template.METADATA.items())}, {', '.join(f'{_any(p)} AS p_{k}' for k, p in template.POINTS.items())}, count(*) FILTER (score >= 15) AS likely FROM tex GROUP BY project),
other AS (SELECT project, {_listed(among(template.STYLES))} AS style_files, {_listed(among(template.ASSETS))} AS assets, {_listed(_auxiliary)} AS auxiliary_files FROM files GROUP BY project),
twice AS (SELECT project, list_sort(list(package)) AS duplicate_packages FROM usage WHERE n_files > 1 GROUP BY project),
whole AS (SELECT *, list_filter([CASE WHEN likely > 1 THEN 'several_main_files' END, CASE WHEN len(auxiliary_files) > 0 THEN 'auxiliary_files' END, CASE WHEN drive THEN 'absolute_paths' END, CASE WHEN main_file IS NULL THEN 'no_main_file' END], lambda z: z IS NOT NULL) AS warnings
 FROM other LEFT JOIN own USING (project) LEFT JOIN twice USING (project) LEFT JOIN (SELECT project, rel_path AS main_file, documentclass FROM ranked WHERE rank = 1) USING (project)),
profiles AS (SELECT project, main_file, documentclass, array_to_string(style_files, '|') AS style_files, len(assets)::BIGINT AS asset_files_count, array_to_string(list_slice(assets, 1, 20), '|') AS asset_files_sample, array_to_string(auxiliary_files, '|') AS auxiliary_files,
 {', '.join(f"{_joined(c)} AS {c}" for c in ('packages', 'duplicate_packages', 'inputs', 'bibliography_files'))},
 CASE WHEN list_contains(packages, 'biblatex') OR added THEN 'biblatex/biber' WHEN list_contains(packages, 'natbib') THEN 'natbib/bibtex' WHEN plain THEN 'bibtex' END AS bibliography_system,
 {_offers('m', template.METADATA)} AS metadata_fields, {_offers('p', template.POINTS)} AS insertion_points, len(auxiliary_files) > 0 OR len(warnings) > 0 AS needs_preprocessing, array_to_string(warnings, '|') AS warnings FROM whole)"""

# Requirements: without lookaround, the compiler's name is taken with its neighbours

_SIZE = [(r"(?:^|[^\w\p{L}])(A4|A3|Letter|Legal)(?:$|[^\w\p{L}])", 1), *requirements.SLOTS["page_size"][1:]]  # \b knows ASCII only
_COMPILER = [(r"(?:^|[^A-Za-z])(xelatex|lualatex|pdflatex|latexmk|bibtex|biber)(?:$|[^A-Za-z])", 1)]
_first = lambda patterns: "coalesce(" + ", ".join(f"nullif({squeeze(f'regexp_extract(compact, {q(chr(40) + chr(63) + chr(105) + chr(41) + re2(p))}, {g})')}, '')" for p, g in patterns) + ", NULL)"
_found = lambda patterns: "flatten([" + ", ".join(f"regexp_extract_all(compact, {q('(?i)' + re2(p))}, {g})" for p, g in patterns) + "])"
_ordered = lambda x: f"(SELECT string_agg(v, '|' ORDER BY k) FROM (SELECT v, min(k) AS k FROM (SELECT {squeeze('y[k]')} AS v, k FROM (SELECT {x} AS y), range(1, len(y) + 1) o(k)) GROUP BY v))"
_LANGUAGE = f"CASE WHEN {CJK.format(x='text')} > 20 AND {CJK.format(x='text')} >= len(regexp_extract_all(text, '[A-Za-z]')) / 3 THEN 'zh' WHEN len(regexp_extract_all(text, '[A-Za-z]')) > 20 THEN 'en' END"
_slots = {k: _first({"compiler": _COMPILER, "page_size": _SIZE}.get(k, p)) for k, p in requirements.SLOTS.items()}
REQUIREMENTS = f"""WITH {GUIDES_SQL}, c AS (SELECT *, {squeeze('text')} AS compact FROM guides),
s AS (SELECT doc_id, {_LANGUAGE} AS language, {', '.join(f'{x} AS {k}' for k, x in _slots.items())}, {', '.join(f"coalesce({_ordered(_found(p))}, '') AS {k}" for k, p in requirements.LISTS.items())} FROM c)
SELECT *, array_to_string(list_filter([CASE WHEN page_size IS NULL AND margin IS NULL THEN 'page' END, CASE WHEN bibliography_style IS NULL THEN 'bibliography_style' END, CASE WHEN compiler IS NULL THEN 'compiler' END], lambda z: z IS NOT NULL), '|') AS warnings FROM s"""

_ARTIFACTS = """now AS (SELECT 'a/' || doc_id AS path, true AS exists_, 'file' AS kind, sha256(text) AS sha FROM documents WHERE doc_id % 11 <> 5),
before AS (SELECT 'm' || (doc_id % 97) AS module, CASE WHEN doc_id % 2 = 0 THEN 'input' ELSE 'output' END AS kind_of, 'a/' || doc_id AS path, doc_id % 11 <> 5 OR doc_id % 4 = 0 AS exists_, CASE WHEN doc_id % 11 <> 5 THEN 'file' END AS kind,
 CASE WHEN doc_id % 11 <> 5 THEN CASE WHEN doc_id % 23 = 3 THEN sha256('old') ELSE sha256(text) END END AS sha FROM documents),
state AS (SELECT module, kind_of, b.path, coalesce(n.exists_, false) AS now_exists, b.exists_ = coalesce(n.exists_, false) AND b.kind IS NOT DISTINCT FROM n.kind AND b.sha IS NOT DISTINCT FROM n.sha AS unchanged FROM before b LEFT JOIN now n ON b.path = n.path)"""

_format = "CASE page_id % 6 WHEN 0 THEN '.docx' WHEN 1 THEN '.doc' WHEN 2 THEN '.pdf' WHEN 3 THEN '.txt' WHEN 4 THEN '' ELSE '.gz' END"

ORACLES: dict[str, str] = {
    "doc_elements": f"WITH {ELEMENTS_SQL} SELECT doc_id, body_pos, {squeeze('l')} AS text FROM lines",
    "doc_roles": f"WITH {CLASSIFIED} SELECT doc_id, body_pos, kind, role, level FROM classified",
    "doc_role_counts": f"WITH {CLASSIFIED} SELECT doc_id, role, count(*) AS n, sum(level)::BIGINT AS levels FROM classified WHERE kind = 'p' GROUP BY ALL",
    "doc_citations": f"WITH {CLASSIFIED} " + indexed("doc_id, body_pos", "citations", "classified", "citation"),
    "doc_ids": f"WITH {IDENTIFIED} SELECT doc_id, body_pos, id, para_pos FROM identified",
    "doc_table_caption": f"WITH {IDENTIFIED} SELECT * FROM captions",
    "doc_figure_caption": f"WITH {IDENTIFIED} SELECT * FROM images",
    "doc_context": f"WITH {IDENTIFIED} SELECT a.doc_id, a.para_pos AS anchor, p.para_pos - a.para_pos AS offset, p.role, {ellipsis('p.text', 160)} AS text FROM anchors a JOIN identified p ON p.doc_id = a.doc_id AND p.para_pos BETWEEN a.para_pos - 2 AND a.para_pos + 2 WHERE p.kind = 'p' AND p.text <> ''",
    "doc_outline": f"WITH {CLASSIFIED} SELECT doc_id, body_pos, repeat('#', least(6, coalesce(level, 1) + 2)) || ' ' || text || CASE WHEN role = 'heading_candidate' THEN ' (candidate)' ELSE '' END AS line FROM classified WHERE role IN ('heading', 'heading_candidate')",
    "doc_damage": f"WITH {CLASSIFIED} SELECT doc_id, body_pos, {_scored} AS score, {CJK.format(x='text')} AS cjk, regexp_matches(text, '[一-鿿]') AS has_cjk, contains(text, '{damage.RISKY}') AS risky, {_scored} >= 2 AS damaged FROM classified WHERE kind = 'p'",
    "doc_issues": f"WITH {CLASSIFIED}, {ISSUES} SELECT * FROM issues",
    # only pure ASCII around the damage survives the way back to bytes
    "doc_repair": f"SELECT doc_id, {score("(text || '瀹為獙缁撴灉')", damage.EXTRACTED)} AS damage, c AS candidate, coalesce(c, text || '瀹為獙缁撴灉') AS final_text FROM (SELECT *, CASE WHEN regexp_matches(text, '(?s)^[\\x00-\\x7F]*$') THEN text || '实验结果' END AS c FROM documents)",
    "doc_ir_counts": f"WITH {PROFILE} SELECT * FROM profile",
    "doc_defects": f"WITH {PROFILE} " + indexed("doc_id", defects("CASE doc_id % 3 WHEN 0 THEN 'strict' WHEN 1 THEN 'unknown' ELSE 'transitional' END"), "profile", "defect"),
    "table_quality": "WITH r AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN []::VARCHAR[][] ELSE list_transform(string_split(text, chr(10)), lambda t: CASE WHEN length(t) % 5 = 0 THEN [' ', ''] ELSE string_split(t, ' ') END) END AS rws FROM documents) " + indexed("doc_id", notes("rws"), "r", "note"),
    "doc_language": f"WITH {GUIDES_SQL} SELECT doc_id, {_LANGUAGE} AS language FROM guides",
    "doc_raw_display_math": "SELECT doc_id, (len(string_split(text, '$$')) - 1)::BIGINT AS n FROM documents WHERE contains(text, '$$')",
    "doc_snippets": f"SELECT doc_id, {ellipsis('text', 180)} AS short, left(text, 160) AS head, right(text, 100) AS tail FROM documents",
    "page_tag_counts": "SELECT page_id, " + ", ".join(f"len(regexp_extract_all(html, '<{t}[\\s>/]'))::BIGINT AS n_{t}" for t in ("p", "li", "a", "h1", "br")) + ", regexp_matches(html, '<body[\\s>]') AS has_body, regexp_extract(html, '<html lang=\"([^\"]*)\"', 1) AS lang FROM pages",
    "page_tags": "SELECT page_id, tag, count(*) AS n FROM (SELECT page_id, lower(unnest(regexp_extract_all(html, '<([A-Za-z][A-Za-z0-9]*)', 1))) AS tag FROM pages) GROUP BY ALL",
    "tag_names": "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'http://n/' || page_id ELSE '' END AS namespace, 'body' AS local, len(regexp_extract_all(html, '<p[\\s>/]'))::BIGINT AS n_p FROM pages",
    "source_formats": f"SELECT page_id, x AS extension, CASE WHEN x = '' THEN 'unknown' ELSE x[2:] END AS format, x = '.doc' AS conversion_required, CASE WHEN x = '.doc' THEN {q(';'.join(lists.CONVERSIONS))} ELSE '' END AS conversion_plan, CASE x WHEN '.docx' THEN 'source' WHEN '.doc' THEN 'convert first' WHEN '.pdf' THEN 'reference only' ELSE 'unsupported' END AS role FROM (SELECT page_id, {_format} AS x FROM pages)",
    "conversion_attempts": "SELECT user_id AS document, arg_min('method' || (event_id % 4), event_id % 4) FILTER (value > 50) AS method, count(*) AS attempts FROM events GROUP BY user_id",
    "graphics_references": f"WITH {FILES_SQL}, {REFERENCES} SELECT * FROM resolved",
    "unreferenced_images": f"WITH {FILES_SQL}, {REFERENCES} SELECT * FROM loose",
    "environment_blocks": f"WITH {FILES_SQL} SELECT project, rel_path, unnest({blocks('text', 'table', 'longtable', 'equation', 'align')}) AS block FROM files WHERE text IS NOT NULL",
    "rendered_tables": f"WITH {FILES_SQL}, {RENDERED} SELECT * FROM rendered",
    "gate_findings": f"WITH {FINDINGS} SELECT project, rule_ordinal::BIGINT AS rule_ordinal, severity, \"check\", n::BIGINT AS n, array_to_string(paths, '|') AS paths FROM findings",
    "gate_summary": f"WITH {FINDINGS} SELECT *, errors > 0 OR warnings > 0 AS failed FROM summary",
    "gate_markdown": f"WITH {FINDINGS} SELECT s.project, '# Quality gate' || repeat(chr(10), 2) || '- findings: ' || findings || chr(10) || '- errors: ' || errors || chr(10) || '- warnings: ' || warnings || repeat(chr(10), 2) || '## Findings' || repeat(chr(10), 2) || coalesce(l, '- no findings') || chr(10) AS text FROM summary s LEFT JOIN (SELECT project, string_agg('- [' || severity || '] ' || \"check\" || ': ' || n, chr(10) ORDER BY rule_ordinal, n) AS l FROM findings GROUP BY project) USING (project)",
    "latex_commands": f"WITH {TEX} SELECT project, rel_path, documentclass, array_to_string(packages, '|') AS packages, array_to_string(inputs, '|') AS inputs, array_to_string(bibliography_files, '|') AS bibliography_files, label_count FROM tex",
    "main_candidates": f"WITH {TEX} SELECT project, rel_path, score, documentclass, begins, ends, rank FROM ranked WHERE rank <= 8",
    "package_usage": f"WITH {TEX} SELECT * FROM usage",
    "template_profile": f"WITH {PROFILES} SELECT * FROM profiles",
    "format_requirements": REQUIREMENTS,
    "artifact_changes": f"WITH {_ARTIFACTS} SELECT module, kind_of, path, now_exists, unchanged FROM state",
    "freshness": f"""WITH {_ARTIFACTS}, m AS (SELECT 'm' || i AS module FROM range(100) o(i)),
 per AS (SELECT module, bool_and(unchanged) FILTER (kind_of = 'input') AS i, bool_and(now_exists) FILTER (kind_of = 'output') AS o, string_agg(path, '|' ORDER BY path) FILTER (kind_of = 'input' AND NOT unchanged) AS changed, string_agg(path, '|' ORDER BY path) FILTER (kind_of = 'output' AND NOT now_exists) AS missing FROM state GROUP BY module)
 SELECT module, per.module IS NOT NULL AS recorded, per.module IS NOT NULL AND coalesce(i, true) AND coalesce(o, true) AS fresh, coalesce(changed, '') AS changed, coalesce(missing, '') AS missing FROM m LEFT JOIN per USING (module)""",
    "latest_manifest": "SELECT module, updated_at, record FROM (SELECT event_type || ':' || (user_id % 5) AS module, ts AS updated_at, event_id AS record FROM events) QUALIFY row_number() OVER (PARTITION BY module ORDER BY updated_at DESC, record DESC) = 1",
    "directory_hashes": "SELECT doc_id % 20 AS directory, sha256(string_agg(p || h, '' ORDER BY string_split(p, '/'))) AS sha256, count(*) AS n_files FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'a/' ELSE 'a.' END || doc_id AS p, sha256(text) AS h FROM documents WHERE doc_id % 10 <> 0) GROUP BY ALL",
    "modules_to_rerun": "SELECT * FROM (VALUES " + ", ".join(f"('{a}', {i}::BIGINT, '{m}')" for a in ("docx", "template", "project", "guide") for i, m in enumerate(manifest.rerun({a}))) + ") t(changed, position, module)",
    "list_values": "SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'a|b|c|d' WHEN 1 THEN 'x|y|z|a' WHEN 2 THEN 'p|q|a' WHEN 3 THEN 'one|a' WHEN 4 THEN '12|a' ELSE 'a' END || '|d' || (doc_id % 3) AS merged FROM documents",
    "compile_status": "SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'Not run' WHEN 1 THEN 'Environment blocker' WHEN 2 THEN 'True' WHEN 3 THEN 'False' ELSE 'partial' END AS status, CASE WHEN doc_id % 5 = 1 THEN '- no engine' ELSE '- None recorded' END AS notes FROM documents",
}

# Packages: written out here by the rule of the overlay, not by its code

_KIND = "['strict', 'unknown', 'no_body', 'not_a_zip', 'no_document', 'transitional', 'other_suffix'][doc_id % 7 + 1]"
_PARTS = f"""parts AS (SELECT doc_id, {_KIND} AS kind, 'p' || doc_id || CASE WHEN doc_id % 7 = 6 THEN '.txt' ELSE '.docx' END AS path, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)"""
_W = "CASE kind WHEN 'strict' THEN 'http://purl.oclc.org/ooxml/wordprocessingml/main' WHEN 'unknown' THEN 'http://example.org/own' ELSE 'http://schemas.openxmlformats.org/wordprocessingml/2006/main' END"
_M = "CASE kind WHEN 'strict' THEN 'http://purl.oclc.org/ooxml/officeDocument/math' ELSE 'http://schemas.openxmlformats.org/officeDocument/2006/math' END"
_OPENED = "kind IN ('strict', 'unknown', 'no_body', 'transitional')"
_READ = "kind IN ('strict', 'unknown', 'transitional')"
_CELLS = "len(string_split(x[1], ' ')) + CASE WHEN len(x) > 1 THEN len(string_split(x[2], ' ')) ELSE 0 END"
ORACLES["package_profile"] = f"""WITH {_PARTS} SELECT path AS doc_id, CASE kind WHEN 'strict' THEN 'strict' WHEN 'unknown' THEN 'unknown' WHEN 'no_body' THEN 'transitional' WHEN 'transitional' THEN 'transitional' END AS flavor,
 CASE WHEN {_OPENED} THEN {_W} END AS namespace, CASE WHEN {_OPENED} THEN array_to_string(list_sort(CASE WHEN len(x) > 2 THEN [{_W}, {_M}] ELSE [{_W}] END), '|') ELSE '' END AS namespaces, {_READ} AS has_body, {_READ} AS valid, NOT {_READ} AS failed,
 {_OPENED} AND regexp_matches(array_to_string(x, ' '), '[一-鿿]') AS has_chinese, {_OPENED} AND len(x) > 3 AS has_images, {_OPENED} AS has_tables, {_OPENED} AND len(x) > 2 AS has_formulas,
 CASE WHEN {_OPENED} THEN len(x) + {_CELLS} END::BIGINT AS paragraph_count_estimate, CASE WHEN {_OPENED} THEN (len(x) + 2) // 6 ELSE 0 END::BIGINT AS n_relationships FROM parts"""
ORACLES["package_elements"] = f"""WITH {_PARTS}, p AS (SELECT *, unnest(range(len(x))) AS i FROM parts WHERE {_READ})
SELECT path AS doc_id, i AS body_pos, 'p' AS kind, CASE WHEN i % 5 = 0 THEN 'Heading1' END AS style, {strip("x[i + 1] || chr(9) || CASE WHEN i % 11 = 2 THEN 'x=1' ELSE '' END")} AS raw_text, i % 7 = 1 AS list_hint, i % 11 = 2 AS has_math, CASE WHEN i % 6 = 3 THEN 'rId' || i ELSE '' END AS rel_ids, NULL AS "rows" FROM p
UNION ALL SELECT path, len(x), 'tbl', NULL, NULL, false, false, '', replace(x[1], ' ', '|') || CASE WHEN len(x) > 1 THEN chr(10) || replace(x[2], ' ', '|') ELSE '' END FROM parts WHERE {_READ}"""
ORACLES["package_relationships"] = f"""WITH {_PARTS}, p AS (SELECT *, unnest(range(len(x))) AS i FROM parts WHERE {_OPENED}) SELECT path AS doc_id, 'rId' || i AS rel_id, 'media/image' || i || '.png' AS target FROM p WHERE i % 6 = 3"""
ORACLES["package_media"] = f"""WITH {_PARTS}, p AS (SELECT *, unnest(range(len(x))) AS i FROM parts WHERE kind <> 'not_a_zip') SELECT path AS doc_id, 'word/media/image' || i || '.png' AS member, sha256(unhex(repeat(lpad(hex(i % 256), 2, '0'), 10))) AS sha256 FROM p WHERE i % 6 = 3"""
ORACLES["png_sizes"] = "SELECT doc_id, CASE WHEN doc_id % 5 > 1 THEN doc_id + 1 END AS width, CASE WHEN doc_id % 5 > 1 THEN length(text)::BIGINT END AS height FROM documents"
ORACLES["decoded_texts"] = "SELECT doc_id, text || repeat(chr(65533), 2) || 'é' AS lenient, chr(65279) || text || 'é' AS ignoring FROM documents"

# Reports

_N = ["paragraphs", "headings", "heading_candidates", "tables", "citation_paragraphs", "bibliography_headings", "images", "captionless_images", "table_notes", "equations", "mojibake", "repairable", "risky", "text_issues"]
_lines = " || chr(10) || ".join(f"'- {c}: ' || {c}" for c in _N)
_section = lambda title, body, note="- none found": f"'## {title}' || repeat(chr(10), 2) || coalesce({body}, '{note}')"
_per = lambda name, line, source, where, order="body_pos": f"{name} AS (SELECT doc_id, string_agg({line}, chr(10) ORDER BY {order}) AS {name} FROM {source} WHERE {where} GROUP BY doc_id)"
_image = "'- ' || id || ': ' || coalesce(nearby_caption, '(no caption nearby)')"
_captioned = "'- ' || id || ': ' || coalesce(caption, '(no caption)')"
ORACLES["ir_summary"] = f"""WITH {PROFILE},
{_per('structure', "'- ' || id || ' ' || role || CASE WHEN level IS NOT NULL THEN ' level ' || level ELSE '' END || ': ' || left(text, 120)", 'identified', "role IN ('heading', 'heading_candidate', 'abstract', 'keywords', 'bibliography_heading')")},
{_per('tabs', _captioned, 'captions', 'true')}, {_per('figures', _image, 'images', 'true', 'para_pos')}, {_per('damage', "'- ' || issue_type || ': ' || left(sample, 100) || coalesce('; could read: ' || left(repaired_sample, 80), '')", 'issues', 'true', 'body_pos, issue_type')}
SELECT doc_id, '# Extraction summary' || repeat(chr(10), 2) || {_lines} || repeat(chr(10), 2) || {_section('Structure', 'structure')} || repeat(chr(10), 2) || {_section('Tables', 'tabs')} || repeat(chr(10), 2) || {_section('Images', 'figures')}
 || repeat(chr(10), 2) || {_section('Text issues', 'damage')} || repeat(chr(10), 2) || {_section('Defects', "nullif(array_to_string(list_transform(" + defects("'transitional'") + ", lambda z: '- ' || z), chr(10)), '')")} || chr(10) AS text
FROM profile LEFT JOIN structure USING (doc_id) LEFT JOIN tabs USING (doc_id) LEFT JOIN figures USING (doc_id) LEFT JOIN damage USING (doc_id)"""
ORACLES["authoring_brief"] = f"""WITH {PROFILE},
{_per('heads', ellipsis("(repeat('#', least(6, coalesce(level, 1) + 2)) || ' ' || text || CASE WHEN role = 'heading_candidate' THEN ' (candidate)' ELSE '' END)", 120), 'identified', "role IN ('heading', 'heading_candidate')")},
around AS (SELECT a.doc_id, a.para_pos, string_agg('  - (' || p.role || '): ' || {ellipsis('p.text', 160)}, chr(10) ORDER BY p.para_pos) AS around FROM anchors a JOIN identified p ON p.doc_id = a.doc_id AND p.para_pos BETWEEN a.para_pos - 2 AND a.para_pos + 2 WHERE p.kind = 'p' AND p.text <> '' GROUP BY ALL),
{_per('figures', _image + " || coalesce(chr(10) || around, '')", 'images LEFT JOIN around USING (doc_id, para_pos)', 'true', 'para_pos')}, {_per('tabs', _captioned, 'captions', 'true')},
{_per('maths', "'- near ' || id || ': ' || coalesce(nullif(" + ellipsis('text', 120) + ", ''), '(no text)')", 'identified', "kind = 'p' AND contains(text, '$$')")}
SELECT doc_id, '# Authoring brief' || repeat(chr(10), 2) || 'Source facts for authoring; uncertain parts stay marked for review.' || repeat(chr(10), 2) || {_section('Defects', "nullif(array_to_string(list_transform(" + defects("'strict'") + ", lambda z: '- ' || z), chr(10)), '')")} || repeat(chr(10), 2) || {_section('Outline', 'heads', '- no reliable headings')}
 || repeat(chr(10), 2) || {_section('Figures', 'figures', '- no images')} || repeat(chr(10), 2) || {_section('Tables', 'tabs', '- no tables')} || repeat(chr(10), 2) || {_section('Formulas', 'maths', '- no formulas')} || chr(10) AS text
FROM profile LEFT JOIN heads USING (doc_id) LEFT JOIN figures USING (doc_id) LEFT JOIN tabs USING (doc_id) LEFT JOIN maths USING (doc_id)"""

_or = lambda title, c: f"'- {title}: ' || coalesce(nullif({c}::VARCHAR, ''), 'Not recorded')"
_template = " || chr(10) || ".join(_or(t, f"t.{c}") for t, c in (("Main file", "main_file"), ("Document class", "documentclass"), ("Bibliography system", "bibliography_system"), ("Needs preprocessing", "needs_preprocessing")))
_counted = " || chr(10) || ".join(_or(t, f"p.{c}") for t, c in (("Paragraphs", "paragraphs"), ("Headings", "headings"), ("Tables", "tables"), ("Images", "images"), ("Equations", "equations"), ("Citation paragraphs", "citation_paragraphs")))
_json = f"CASE WHEN d.doc_id % 2 = 0 THEN coalesce('{{\"language\":\"' || ({_LANGUAGE.replace('text', 'd.text')}) || '\"}}', '{{}}') END"
_SOURCES = "documents d LEFT JOIN profiles t ON t.project = d.doc_id % 20 LEFT JOIN (SELECT * FROM profile WHERE doc_id % 3 <> 0) p ON p.doc_id = d.doc_id"
ORACLES["authoring_plan"] = f"""WITH {PROFILE}, {PROFILES}
SELECT d.doc_id, concat_ws(chr(10), '# Authoring plan' || repeat(chr(10), 2) || '## Source', {_counted}, chr(10) || '## Template', {_template},
 chr(10) || '## Modules' || chr(10) || '- [ ] front matter' || chr(10) || '- [ ] structure' || chr(10) || '- [ ] prose and formulas' || chr(10) || '- [ ] tables' || chr(10) || '- [ ] figures' || chr(10) || '- [ ] bibliography' || chr(10) || '- [ ] appendices' || chr(10) || '- [ ] review notes',
 chr(10) || '## Requirements' || chr(10) || {_json}, chr(10) || '## Brief' || chr(10) || left(d.text, 4000)) || chr(10) AS text FROM {_SOURCES}"""
_report_template = " || chr(10) || ".join(_or(t, f"g.{c}") for t, c in (("Findings", "findings"), ("Errors", "errors"), ("Warnings", "warnings")))
ORACLES["conversion_report"] = f"""WITH {PROFILE}, {FINDINGS}, {PROFILES.replace(FILES_SQL + ",", "", 1)}
SELECT d.doc_id, concat_ws(chr(10), '# Conversion report' || repeat(chr(10), 2) || '## Summary', '- Source: d' || d.doc_id, '- Format: docx', '- Compile status: Not run', chr(10) || '## Sources', '- draft.docx', chr(10) || '## Features',
 '- chars: ' || length(d.text) || chr(10) || '- has_chinese: ' || regexp_matches(d.text, '[一-鿿]'), chr(10) || '## Template', {_template}, chr(10) || '## Requirements', coalesce({_json}, '{{}}'), chr(10) || '## Warnings', '- None recorded',
 chr(10) || '## Quality gate', {_report_template}) || chr(10) AS text FROM {_SOURCES} LEFT JOIN (SELECT * FROM summary WHERE project <> 3) g ON g.project = d.doc_id % 20"""
