"""DuckDB SQL with the same rows as the queries that SQL can express."""

from __future__ import annotations

from folioscope.llm import quality_rules as R
from folioscope.llm.url_filter import RULES


def _quality_rules(source: str = "documents") -> str:
    """Common table expressions that end in ``judged``."""
    text = lambda s: "'" + s.replace("'", "''") + "'"
    listed = lambda names: "[" + ", ".join(map(text, names)) + "]"
    drop = lambda p: f"length(rest) - length(regexp_replace(rest, {text(p)}, '', 'g'))"
    space, kinds = text(R.SPACE), list(R.CLASSES)
    classes = ", ".join(["word_chars - length(rest)", *[f"c_{k}" for k in kinds], "length(rest) - " + " - ".join(f"c_{k}" for k in kinds)])
    words = ", ".join(f"len(list_filter(w, lambda x: x = {text(w)}))" for w in R.COMMON)
    n_words = len(R.COMMON) + 1
    sums = lambda c, n: "[" + ", ".join(f"sum({c}[{i + 1}])" for i in range(n)) + "]"
    profile = lambda source, where: f"SELECT lang, {sums('classes', len(kinds) + 2)} c, {sums('words', n_words)} w, row_number() OVER (ORDER BY sum(n_words) DESC, lang) k FROM {source} WHERE lang IS NOT NULL {where} GROUP BY lang HAVING sum(n_words) >= {R.REFERENCE_WORDS}"
    log = lambda x: f"CASE WHEN {x} > 0 THEN {x} * log2({x}) ELSE 0.0 END"

    def distance(own: str, other: str, n: int) -> str:
        p = lambda i: f"(f.{own}[{i}] / greatest(list_sum(f.{own}), 1)::DOUBLE)"
        q = lambda i: f"(r.{other}[{i}]::DOUBLE / greatest(list_sum(r.{other}), 1)::DOUBLE)"
        terms = " + ".join(f"({log(p(i))}) / 2 + ({log(q(i))}) / 2 - ({log(f'(({p(i)} + {q(i)}) / 2)')})" for i in range(1, n + 1))
        return f"round(sqrt(greatest({terms}, 0.0)), 9)"

    def nearest(refs: str, limit: float) -> str:
        return f"SELECT f.*, coalesce((SELECT min(greatest({distance('classes', 'c', len(kinds) + 2)} / {limit!r}, {distance('words', 'w', n_words)} / {R.MAX_WORD!r})) FROM {refs} r WHERE f.lang IN (SELECT lang FROM {refs}) AND (r.lang = f.lang OR r.k <= {R.OTHERS})), 0.0) x FROM counted f"

    return f"""
    t0 AS (SELECT row_number() OVER () u, doc_id, lang, coalesce(text, '') t FROM {source}),
    t1 AS (SELECT u, doc_id, lang, t, list_filter(string_split_regex(t, {space}), lambda x: x <> '') w FROM t0),
    t2 AS (SELECT *, array_to_string(w, '') j, regexp_replace(array_to_string(w, ''), {text(R.LOWER)}, '', 'g') rest FROM t1),
    g AS (SELECT u, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] g FROM (SELECT u, w, unnest(range(1, len(w) - 1)) i FROM t1 WHERE len(w) >= 3)),
    again AS (SELECT u, i FROM g QUALIFY count(*) OVER (PARTITION BY u, g) > 1),
    rep AS (SELECT u, count(DISTINCT i + k) n FROM again, range(3) o(k) GROUP BY u),
    lines AS (SELECT u, count(*) - count(DISTINCT l) n FROM (SELECT u, unnest(string_split(t, chr(10))) l FROM t0) WHERE regexp_matches(l, {text(R.NOT_SPACE)}) GROUP BY u),
    t3 AS (SELECT u, doc_id, lang, len(w)::BIGINT n_words, length(coalesce(j, ''))::BIGINT word_chars, coalesce(rest, '') rest, w FROM t2),
    t4 AS (SELECT *, {", ".join(f"{drop(p)} c_{k}" for k, p in R.CLASSES.items())} FROM t3),
    t5 AS (SELECT t4.*, [{classes}] classes, [{words}] hits FROM t4),
    counted AS (SELECT u, doc_id, lang, n_words, word_chars, c_symbol::BIGINT n_symbols, coalesce(lines.n, 0)::BIGINT n_dup_lines, coalesce(rep.n, 0)::BIGINT n_repeat_words,
        classes, list_append(hits, n_words - list_sum(hits)::BIGINT) words, n_words < {R.MIN_BASE_WORDS} OR 100 * coalesce(rep.n, 0) > {R.MAX_REPEAT_PERCENT} * n_words base_failed
        FROM t5 LEFT JOIN rep USING (u) LEFT JOIN lines USING (u)),
    r1 AS ({profile("counted", "")}),
    first AS ({nearest("r1", R.FIRST * R.MAX_CLASS)}),
    r2 AS ({profile("first", f"AND NOT base_failed AND NOT (n_words >= {R.MIN_WORDS} AND x > 1)")}),
    judged AS (SELECT *, NOT base_failed AND NOT (n_words >= {R.MIN_WORDS} AND x > 1) kept FROM ({nearest("r2", R.MAX_CLASS)}))"""


OP10 = f"WITH {_quality_rules()} SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"

_rules = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)
OP2 = f"""
WITH parsed AS (
  SELECT row_number() OVER () u, page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) path FROM pages),
rules(verdict, h, p) AS (VALUES {_rules}),
fits AS (SELECT u, h || p rule, verdict FROM parsed JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  QUALIFY row_number() OVER (PARTITION BY u ORDER BY length(h) DESC, length(p) DESC) = 1)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') verdict FROM parsed LEFT JOIN fits USING (u)"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _low_words(pattern: str) -> str:
    return f"list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{pattern}'), lambda x: x <> '')"


OP9 = f"""
WITH d AS (SELECT row_number() OVER () u, doc_id, {_low_words("[\x00-\x2F\x3A-\x60\x7B-\x7F]+")} w FROM documents),
b AS (SELECT item_id, {_low_words("[\x00-\x2F\x3A-\x60\x7B-\x7F]+")} w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') g FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM win),
grams AS (SELECT u, i, k, array_to_string(w[i:i + k - 1], ' ') g FROM (SELECT u, w, k, unnest(range(1, len(w) - k + 2)) i FROM d, ks WHERE len(w) >= k)),
hits AS (SELECT u, i, grams.k, item_id FROM grams JOIN win ON grams.g = win.g AND grams.k = win.k),
n AS (SELECT u, count(DISTINCT p) n FROM (SELECT u, unnest(range(i, i + k)) p FROM hits) GROUP BY u),
items AS (SELECT u, count(*) n, string_agg(x, ',' ORDER BY x) l FROM (SELECT DISTINCT u, item_id::VARCHAR x FROM hits WHERE item_id IS NOT NULL) GROUP BY u)
SELECT doc_id, len(w)::BIGINT n_words, coalesce(n.n, 0)::BIGINT n_hit, coalesce(items.n, 0)::BIGINT n_items, sha256(coalesce(items.l, '')) items_sha256, coalesce(n.n, 0) > 0 contaminated
FROM d LEFT JOIN n USING (u) LEFT JOIN items USING (u)"""

_SETS = f"""
d AS (SELECT row_number() OVER () u, doc_id, {_low_words("[\x20\x09-\x0D]+")} w FROM documents),
s AS (SELECT DISTINCT u, g FROM (SELECT u, array_to_string(w[i:i + 4], ' ') g FROM (SELECT u, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) i FROM d WHERE len(w) > 0))),
n AS (SELECT u, count(*) n FROM s GROUP BY u)"""
OP7 = f"""
WITH RECURSIVE {_SETS},
freq AS (SELECT g, count(*) f FROM s GROUP BY g HAVING count(*) > 1),
ranked AS (SELECT u, s.g, n.n, row_number() OVER (PARTITION BY u ORDER BY coalesce(f, 1), s.g) r, f FROM s JOIN n USING (u) LEFT JOIN freq USING (g)),
prefix AS (SELECT u, g FROM ranked WHERE f IS NOT NULL AND r <= n - ceil(0.75 * n) + 1),
pairs AS (SELECT DISTINCT a.u x, b.u y FROM prefix a JOIN prefix b USING (g) WHERE a.u < b.u),
common AS (SELECT x, y, count(*) k FROM pairs JOIN s a ON a.u = x JOIN s b ON b.u = y AND a.g = b.g GROUP BY x, y),
links AS (SELECT x, y FROM common JOIN n a ON a.u = x JOIN n b ON b.u = y WHERE 100 * k >= 75 * (a.n + b.n - k)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(u, v) AS (SELECT u, u FROM d UNION SELECT reach.u, edges.y FROM reach JOIN edges ON reach.v = edges.x),
least_id AS (SELECT reach.u, min(d.doc_id) c FROM reach JOIN d ON d.u = reach.v GROUP BY reach.u)
SELECT doc_id, coalesce(n.n, 0)::BIGINT n_shingles, c component_id, doc_id IS NOT DISTINCT FROM c kept FROM d JOIN least_id USING (u) LEFT JOIN n USING (u)"""

OP6 = """
WITH p AS (SELECT row_number() OVER () u, page_id, coalesce(html, '') h FROM pages),
d AS (SELECT u, page_id, octet_length(encode(h))::BIGINT payload_bytes, sha1(h) payload_digest, max(page_id) OVER (PARTITION BY h) holder FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM holder THEN 'revisit' ELSE 'response' END record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM holder THEN holder END refers_to
FROM d"""

ORACLES = {"op6_warc": OP6, "op7_near_dedup": OP7, "op9_decontamination": OP9, "op2_url_filter": OP2, "op10_quality_rules": OP10}
