"""Each method against a brute-force version, a library, or a property."""

import gzip
import io
import itertools
import os
import random
import re
import tracemalloc
import zlib

import duckdb
import numpy as np
import pandas
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioscope.llm import decontaminate, license_scan, main_text, near_dedup, pieces, quality_model, quality_rules, queries, token_file, url_filter, warc, words
from folioscope.llm.components import components, least_nodes
from folioscope.llm.license_texts import TEMPLATES
from folioscope.llm.shared import new_folder
from folioscope.llm.sql import OP6, OP10
from tests.conftest import rows_of, rows_of_sql

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
RND = random.Random(5)


def spoken(n, vocabulary=400, rnd=RND):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


# Queries that SQL can express


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(name, spark, sf_dir, duck):
    df = queries.queries()[name](spark, sf_dir)
    names, expected = rows_of_sql(duck, queries.oracle_sql()[name])
    assert names == sorted(df.columns) and rows_of(df) == expected


# 10 quality rules


def _rules_by_hand(rows):
    """kept of (doc_id, lang, text) rows, by dictionaries and loops."""
    import math
    from collections import Counter

    from folioscope.llm import quality_rules as R

    shares = lambda counts: [x / max(1, sum(counts)) for x in counts]
    log = lambda p: p * math.log2(p) if p > 0 else 0.0

    def far(a, b):
        p, q = shares(a), shares(b)
        return round(math.sqrt(max(0.0, sum((log(x) + log(y)) / 2 - log((x + y) / 2) for x, y in zip(p, q, strict=True)))), 9)

    own = {}
    for i, lang, text in rows:
        w = [x for x in re.split(R.SPACE, text or "") if x]
        grams = Counter(zip(w, w[1:], w[2:], strict=False))
        again = {k + o for k, g in enumerate(zip(w, w[1:], w[2:], strict=False)) if grams[g] > 1 for o in range(3)}
        classes = Counter()
        for c in "".join(w):
            classes["lower" if re.match(R.LOWER, c) else next((k for k, p in R.CLASSES.items() if re.match(p, c)), "other")] += 1
        words_ = Counter(x if x in R.COMMON else "" for x in w)
        own[i] = (lang, len(w), len(w) < 50 or 100 * len(again) > 50 * len(w), [classes[k] for k in ("lower", *R.CLASSES, "other")], [words_[k] for k in (*R.COMMON, "")])
    strange = set()
    for limit, skipped in ((R.FIRST * R.MAX_CLASS, False), (R.MAX_CLASS, True)):
        known = {}
        for i, (lang, n, failed, c, w) in own.items():
            if lang is not None and not (skipped and (failed or i in strange)):
                old = known.get(lang, (0, [0] * len(c), [0] * len(w)))
                known[lang] = (old[0] + n, [a + b for a, b in zip(old[1], c, strict=True)], [a + b for a, b in zip(old[2], w, strict=True)])
        known = {k: v for k, v in known.items() if v[0] >= R.REFERENCE_WORDS}
        largest = sorted(known, key=lambda k: (-known[k][0], k))[: R.OTHERS]
        strange = {i for i, (lang, n, _, c, w) in own.items() if n >= R.MIN_WORDS and lang in known and min(max(far(c, known[k][1]) / limit, far(w, known[k][2]) / R.MAX_WORD) for k in {lang, *largest}) > 1}
    return {i: not o[2] and i not in strange for i, o in own.items()}


def test_rules_for_every_language(spark):
    rnd = random.Random(21)
    english = lambda n: " ".join(rnd.choice("the of and to in is that it for with house river stone light water walks green under".split()) for _ in range(n))
    letters = lambda low, high, n, most=9: " ".join("".join(chr(rnd.randrange(low, high)) for _ in range(rnd.randrange(2, most))) for _ in range(n))
    junk = lambda n: " ".join("".join(rnd.choice("#$%&|<>0123456789") for _ in range(5)) for _ in range(n))
    rows = [(i, "en", english(150)) for i in range(90)]
    rows += [(100 + i, "ru", letters(0x430, 0x450, 150)) for i in range(20)] + [(200 + i, "ja", letters(0x3041, 0x3097, 300, 4)) for i in range(10)]
    rows += [(300, "ru", junk(300)), (301, "en", junk(300)), (302, "ja", english(200)), (303, "en", letters(0x430, 0x450, 200)), (304, "en", letters(0x600, 0x640, 200)), (305, "th", letters(0xE01, 0xE30, 200)), (306, None, junk(300)), (307, "en", junk(60)), (308, "ru", None), (309, "en", "a b c " * 100)]
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, lang string, text string")).collect()}
    assert got == _rules_by_hand(rows)
    assert all(got[i] for i, *_ in rows[:120])  # whole languages stay, also those without common words here
    assert {i: got[i] for i in range(300, 310)} == {300: False, 301: False, 302: True, 303: True, 304: True, 305: True, 306: True, 307: True, 308: False, 309: False}
    con = duckdb.connect()
    con.register("raw", pandas.DataFrame(rows, columns=["doc_id", "lang", "text"]))
    con.execute("CREATE VIEW documents AS SELECT doc_id, lang::VARCHAR lang, text::VARCHAR \"text\" FROM raw")
    assert {r[0]: r[-1] for r in con.sql(OP10).fetchall()} == got


# 1 classifier


def test_gradient_learns_held_out_labels(spark):
    rows = [(i, spoken(150) if i % 3 else " ".join(f"x{RND.randrange(60)}###" for _ in range(150)), int(i % 3 > 0)) for i in range(240)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality_model.classify(docs, labels).collect()}
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i in got if got[i]["held_out"]} == set(held)
    assert all(got[i]["predicted"] == rows[i][2] for i in held)


def test_gradient_equals_differences():
    rng = np.random.default_rng(4)
    first = np.array([0, 1, 4, 9])
    x, ratios, y = rng.random((9, quality_model.N_FEATURES)) / 50, rng.random((9, quality_model.N_RATIOS)), np.array([1.0, 0.0, 1.0])
    m = quality_model.started(3, np.float64)

    def loss():
        p = m.head(x @ m.rows + ratios @ m.ratio + m.shift, first)["p"]
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())

    for name, slope in quality_model.slopes(m, x, ratios, first, y).items():
        value = np.atleast_1d(getattr(m, name)).astype(np.float64)
        for at in rng.integers(0, value.size, 8):
            both = []
            for step in (1e-5, -1e-5):
                moved = value.copy()
                moved.flat[at] += step
                setattr(m, name, moved if np.ndim(slope) else moved[0])
                both.append(loss())
            setattr(m, name, value if np.ndim(slope) else value[0])
            assert abs((both[0] - both[1]) / 2e-5 - np.atleast_1d(slope).flat[at]) < 1e-7, name


def test_the_driver_holds_the_sample_once():
    """Bags of BAG passages: learning needs less memory beside them than 16 MB, and the parts give the slopes of the whole."""
    rng, width = np.random.default_rng(5), quality_model.N_FEATURES + quality_model.N_RATIOS
    rows = []
    for i in range(1500):
        bag = np.zeros((quality_model.BAG, width), np.uint16)
        bag[:, rng.integers(0, quality_model.N_WORDS, 40)] = 3
        bag[:, quality_model.N_FEATURES :] = rng.random((quality_model.BAG, quality_model.N_RATIOS)).astype(np.float16).view(np.uint16)
        rows.append({"doc_id": str(i), "quality": i % 2, "bag": bag.tobytes()})
    tracemalloc.start()
    quality_model.fit(rows, epochs=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    size = sum(len(r["bag"]) for r in rows)
    assert peak < 16 << 20 < size, (peak, size)
    m, few = quality_model.started(3), rows[:200]
    whole = quality_model.slopes(m, *quality_model.unpacked(few), np.array([r["quality"] for r in few], np.float64))
    parts = quality_model.parts(few)
    assert len(parts) > 2 and [r for p in parts for r in p] == few and all(sum(map(quality_model.passages, p)) <= quality_model.STEP for p in parts)
    for name, g in quality_model.mean_slopes(m, parts).items():
        assert np.allclose(g, whole[name], rtol=1e-3, atol=1e-6), name


def test_one_bad_passage_decides(spark):
    """Only one passage of many tells the label, so equal weights of the learnt model fail where its attention finds it."""
    rnd = random.Random(31)

    def text(bad):
        parts = [" ".join(f"w{rnd.randrange(300)}" for _ in range(quality_model.PASSAGE)) for _ in range(rnd.randrange(8, 15))]
        if bad:
            parts[rnd.randrange(len(parts))] = " ".join(f"x{rnd.randrange(40)}###" for _ in range(quality_model.PASSAGE))
        return " ".join(parts)

    rows = [(i, text(i % 2), 1 - i % 2) for i in range(400)]
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    model = quality_model.fit(quality_model.sample(docs, labels))
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    first, cuts, codes, own, ratios = quality_model.Features().of(pa.array([r[1] for r in held], pa.large_string()))
    mean = np.stack([model.rows[own[codes[a:b]]].sum((0, 1)) / (b - a) for a, b in zip(cuts, cuts[1:], strict=False)])
    f = model.head(mean + ratios @ model.ratio + model.shift, first)
    right = lambda p: np.mean([(q >= quality_model.THRESHOLD) == bool(r[2]) for q, r in zip(p, held, strict=True)])
    equal = np.stack([f["h"][a:b].mean(0) for a, b in zip(first, first[1:], strict=False)])
    assert right(f["p"]) >= 0.95 and right(1 / (1 + np.exp(-(equal @ model.out + model.bias)))) <= 0.8
    bad = [f["a"][a:b].max() * (b - a) for a, b, r in zip(first, first[1:], held, strict=False) if not r[2]]
    assert np.median(bad) > 3  # times an equal weight


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame([(1, "b " * 60_000), (1, "a x"), (3, "c " * 60_000), (4, "d")], "doc_id long, text string")
    docs = docs.union(docs.filter("doc_id = 4")).union(docs)
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 0), (4, 1)], "doc_id long, quality int")
    ids = [i for i in (1, 3, 4) if zlib.crc32(str(i).encode()) % 4 != 2]
    for limit, most in ((10, 5), (1, 5), (10, 10**6)):
        rows = quality_model.sample(docs, labels, limit, most)
        assert len(rows) == min(limit, len(ids)) == len({r["doc_id"] for r in rows})
        sizes = {int(r["doc_id"]): len(r["bag"]) // 2 // (quality_model.N_FEATURES + quality_model.N_RATIOS) for r in rows}
        assert all(n == {1: 1, 3: min(most, -(-60_000 // quality_model.PASSAGE)), 4: 1}[i] for i, n in sizes.items())
    assert quality_model.shape("a" * 70 + "#") != quality_model.shape("a" * 70)


def test_held_out_labels_are_never_learnt(spark):
    docs = spark.createDataFrame([(i, spoken(60)) for i in range(80)], "doc_id long, text string")
    labels = [(i, i % 2) for i in range(80)]
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q) for i, q in labels]
    scores = [[r["score"] for r in quality_model.classify(docs, spark.createDataFrame(own, "doc_id long, quality int")).orderBy("doc_id").collect()] for own in (labels, turned)]
    assert scores[0] == scores[1]


def naive_score(model, text):
    """One text at a time, without batches."""
    own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    count = max(1, -(-len(own) // quality_model.PASSAGE))
    h = []
    for k in range(count):
        part = own[k * len(own) // count : (k + 1) * len(own) // count]
        mean = sum((model.rows[list(quality_model._feature(w)[:2])].sum(0) for w in part), np.zeros(quality_model.WIDTH)) / max(1, len(part))
        ratios = np.array([len(set(part)) / max(1, len(part)), np.log1p(len(part)) / 5, min(sum(map(len, part)) / max(1, len(part)), 40) / 10, len(part) > 0])
        h.append(np.tanh(mean + ratios @ model.ratio + model.shift))
    h = np.array(h)
    e = (np.tanh(h @ model.v) / (1 + np.exp(-(h @ model.u)))) @ model.w
    a = np.exp(e - e.max())
    return 1 / (1 + np.exp(-((a / a.sum()) @ h @ model.out + model.bias)))


def test_scores_match_a_naive_forward_pass(spark, sf_dir):
    docs, labels = (queries.table(spark, sf_dir, t) for t in ("documents", "labels"))
    model = quality_model.fit(quality_model.sample(docs, labels))
    texts = {r["doc_id"]: r["text"] for r in docs.limit(60).collect()}
    got = {r["doc_id"]: r["score"] for r in quality_model.score(docs, model).collect()}
    assert all(abs(got[i] - naive_score(model, t)) < 1e-4 for i, t in texts.items())


# 2 urls


def fits(rule, host, path):
    return (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path)


def test_trie_and_joins_match_brute_force(spark):
    hosts = [".".join(p) for n in (1, 2, 3) for p in itertools.product(["a", "b", "com"], repeat=n)]
    paths = ["/", "/x/", "/x/y", "/xy/", "/x", "", "/x/y/z"]
    rnd = random.Random(1)
    rules = [url_filter.Rule(rnd.choice(["allow", "block"]), rnd.choice(hosts), rnd.choice(paths)) for _ in range(60)]
    urls = [(i, f"http://{h.upper() if i % 2 else h}{p}{e}") for i, (h, p, e) in enumerate(itertools.product(hosts, paths, ["", "?q=/x/", "#x"]))]
    best = {}
    for r in sorted(set(rules)):
        best[r.host, r.path] = r  # block sorts after allow

    def expected(url):
        host, path = url_filter.parts(url)
        own = max((r for r in best.values() if fits(r, host, path)), key=lambda r: (r.host.count("."), len(r.path)), default=None)
        return host, path, own and own.text, own.verdict if own else "allow"

    pages = spark.createDataFrame(urls, "page_id long, url string")
    for df in (url_filter.classify(pages, rules), url_filter.classify(pages, rules, limit=10)):
        assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in df.collect()} == {i: expected(u) for i, u in urls}


# 3 html


@given(st.lists(st.floats(-3, 3), min_size=1, max_size=7), st.randoms())
@settings(deadline=None)
def test_minimum_cut_is_least(gain, rnd):
    ties = [(i, j, rnd.uniform(0, 2)) for i in range(len(gain)) for j in range(i + 1, len(gain)) if rnd.random() < 0.6]

    def cost(side):
        return sum(max(0, -g) if s else max(0, g) for g, s in zip(gain, side, strict=True)) + sum(w for i, j, w in ties if side[i] != side[j])

    assert cost(main_text.minimum_cut(gain, ties)) <= min(map(cost, itertools.product((False, True), repeat=len(gain)))) + 1e-9


def test_articles_of_the_pages(spark, sf_dir):
    import html

    def inside(page):
        article = page[page.index("<article>") + 9 : page.index("</article>")]
        parts = (" ".join(html.unescape(re.sub(r"<br>", " ", x).replace("<b>", "")).split()) for x in re.split(r"</?(?:p|h1)>", article))
        return "\n".join(p for p in parts if p)

    pages = queries.table(spark, sf_dir, "pages")
    got = {r["page_id"]: r for r in main_text.main_text(pages).collect()}
    for r in pages.collect():
        assert got[r["page_id"]]["text"] == inside(r["html"]) and got[r["page_id"]]["n_chars"] == len(inside(r["html"]))


def test_other_layouts():
    page = (
        "<title>x</title><header>Site</header><ul class=menu><li><a href=/>Home</a><li><a href=/b>B</a></ul><div id='main-content'><h2>Head &amp; line</h2><p>A first paragraph of some length, with a <a href=x>link</a> in it."
        "<p>Short.</p><script>if (a < b) document.write('<p>no</p>')</script><div class='advert'><p>Buy this now, it is a very good thing to own.</p></div><p>Another&nbsp;paragraph&#46;</p>"
        "<section id=comments><p>I do not agree with what was written here at all.</p></section></div><aside><p>Some other long text that stands beside the article.</p></aside><form><p>Your mail address goes into this field.</p></form><footer>All rights</footer>"
    )
    page = f"<body class='with-sidebar'><div id=page class='has-sidebar page-menu'>{page}</div>"
    assert main_text.extract(page)[0] == "Head & line\nA first paragraph of some length, with a link in it.\nShort.\nAnother paragraph."


WORDS = "The committee met in the old town hall on the first day of spring and agreed to go on."


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (f"<article><p>{WORDS}</p><svg width='1'/><p>{WORDS}</p><svg><text>no</text></svg><p>a<math><mi>x</mi><annotation>no</annotation></math>b {WORDS}</p></article>", f"{WORDS}\n{WORDS}\naxb {WORDS}"),
        (f"<article><video-card>{WORDS}</video-card><video>no</video><object-x>{WORDS}</object-x></article>", f"{WORDS}\n{WORDS}"),
        (f"<body><form id=aspnet><nav><ul><li><a href=x>Home</a></ul></nav><article><h1>Title</h1><p>{WORDS}</p></article></form>", f"Title\n{WORDS}"),
        (f"<form><p>Search the site</p><input></form><article><p>{WORDS}</p></article>", WORDS),
        (f"<article><header><h1>Title of it</h1></header><p class='share-holder'>{WORDS}</p><p>{WORDS}</p></article>", f"Title of it\n{WORDS}\n{WORDS}"),
        (f"<header><p>Site of all news</p></header><article><p>{WORDS}</p></article><footer><p>{WORDS}</p></footer>", WORDS),
        (f"<article><p>{WORDS}</p><table><tr><td>one<td>two<tr><td>three</table></article>", f"{WORDS}\none\ntwo\nthree"),
        (f"<main><article class=post><h2>Title</h2><div class=ad-box><p>{WORDS} {WORDS}</p></div><p>{WORDS}</p><ul><li>one<li>two</ul><section id=comments><p>{WORDS} {WORDS}</p></section></article></main>", f"Title\n{WORDS}\none\ntwo"),
        (f"<article><p hidden>{WORDS}</p><p style='display: none'>{WORDS}</p><p>{WORDS}</p></article>", WORDS),
        ("", ""), ("<<<", ""), ("<p", ""), ("<!-- never ends <p>x</p>", ""),
    ],
)
def test_markup(html, text):
    assert main_text.extract(html)[0] == text


def noisy_page(rnd):
    """(html, its main text): short and long paragraphs in a plain container, among menus with sentences and sponsored boxes."""
    sentence = lambda n: " ".join(rnd.choice(["light", "water", "stone", "river", "under", "walks", "slowly"]) for _ in range(n))
    body = [sentence(rnd.choice([1, 2, 3, 20, 30, 40])) + rnd.choice([".", "", ""]) for _ in range(rnd.randrange(6, 20))]
    body[0], body[-1] = sentence(30) + ".", sentence(25) + "."
    body = [x for i, x in enumerate(body) if len(x.split()) > 3 or len(body[i - 1].split()) > 3]  # no two short ones in a row
    menu = "".join(f"<li><a href=/{i}>{sentence(rnd.choice([1, 2, 3]))}</a></li>" for i in range(8)) + f"<li>{sentence(9)}.</li>" + "".join(f"<li><a href=/{i}>{sentence(2)}</a></li>" for i in range(5))
    return f"<body><div><ul>{menu}</ul></div><div><div><div>{''.join(f'<p>{x}</p>' for x in body)}</div></div></div><div><div>{sentence(3)}</div></div>", "\n".join(body)


def test_the_cut_decides_on_noisy_pages():
    rnd = random.Random(11)
    right = alone = moved = 0
    for _ in range(100):
        html, text = noisy_page(rnd)
        page = main_text.read(html)
        content, own = main_text.labelled(page)
        got = main_text.extract(html)
        assert got[0] == "\n".join(b.text for b, c in zip(page.blocks, content, strict=True) if c)
        moved += got[3]
        right += got[0] == text
        alone += "\n".join(b.text for b, c in zip(page.blocks, own, strict=True) if c) == text
    assert moved > 100 and right >= 95 and alone <= 30, (moved, right, alone)


def test_cut_of_pages_is_least():
    """On real page graphs, against all labellings."""
    rnd = random.Random(12)
    flows = 0
    for _ in range(60):
        page = main_text.read(noisy_page(rnd)[0])
        page.blocks = page.blocks[8:22]
        gain, ties = [main_text.odds(page, b) + rnd.uniform(-1, 1) for b in page.blocks], main_text.edges(page)
        sides = np.array(list(itertools.product((0, 1), repeat=len(gain))), np.int8)
        cost = sides @ np.maximum(0, -np.array(gain)) + (1 - sides) @ np.maximum(0, np.array(gain)) + sum(w * (sides[:, i] != sides[:, j]) for i, j, w in ties)
        cut = main_text.minimum_cut(gain, ties)
        assert cost[int("".join("01"[c] for c in cut), 2)] <= cost.min() + 1e-9
        flows += any(cut[i] != (g > 0) for i, g in enumerate(gain))
    assert flows > 10


def test_flow_alone_is_least():
    rnd = random.Random(13)
    for _ in range(300):
        n = rnd.randrange(1, 8)
        gain = [rnd.uniform(-2, 2) for _ in range(n)]
        near = [{} for _ in range(n)]
        for i, j in itertools.combinations(range(n), 2):
            if rnd.random() < 0.6:
                near[i][j] = near[j][i] = rnd.uniform(0, 2)
        cost = lambda side: sum(max(0, -g) if s else max(0, g) for g, s in zip(gain, side, strict=True)) + sum(w for i in range(n) for j, w in near[i].items() if i < j and side[i] != side[j])  # noqa: B023, E731
        assert cost(main_text._flow(gain, {i: i for i in range(n)}, near, list(range(n)))) <= min(map(cost, itertools.product((False, True), repeat=n))) + 1e-9


def test_deep_and_long_pages_take_linear_time():
    import time
    import tracemalloc

    deep, lists = "<div>a b c " * 90_000, "<ul>" + "<div>" * 8000 + "<li>x</li>" * 80_000
    rnd = random.Random(3)
    mixed = "".join(rnd.choice(["<p>", "<li>", "<div>", "<h2>", "</div>", "<section>", "</section>"]) + spoken(rnd.randrange(1, 20), rnd=rnd) + rnd.choice([".", ""]) for _ in range(16_000))
    for html in (deep, lists, mixed):
        tracemalloc.start()
        main_text.read(html)
        assert tracemalloc.get_traced_memory()[1] < 200e6
        tracemalloc.stop()
        start = time.process_time()
        main_text.extract(html)
        assert time.process_time() - start < 4


# 4 token files


@given(st.lists(st.integers(0, 300), max_size=3000), st.integers(0, 10**6))
@settings(deadline=None, max_examples=40)
def test_blocks_round_trip(ids, seed):
    ids = np.array(ids, np.uint32)
    counts = np.bincount(ids, minlength=301) + (np.random.default_rng(seed).random(301) < 0.1)
    coder = token_file.Coder(token_file.scaled(counts))
    assert (coder.decode(coder.encode(ids), len(ids)) == ids).all() if len(ids) else True


@given(st.lists(st.integers(0, 10**9), min_size=1, max_size=400))
@settings(deadline=None)
def test_frequencies_sum_to_the_scale(counts):
    counts = np.array(counts)
    f = token_file.scaled(counts)
    assert ((f > 0) == (counts > 0)).all() and f.sum() in (0, 1 << token_file.SCALE)


def test_damage_is_found():
    ids = np.random.default_rng(0).integers(0, 50, 400_000).astype(np.uint32)
    coder = token_file.Coder(token_file.scaled(np.bincount(ids)))
    sink = io.BytesIO()
    token_file.write_file(coder, list(range(4)), iter(np.array_split(ids, 4)), sink)
    data = sink.getvalue()
    source = pa.BufferReader(data)
    assert (np.concatenate([x for _, x in token_file.read_file(coder, source)]) == ids).all() and len(token_file.footer(source)["checkpoints"]) == 4
    third = token_file.footer(source)["checkpoints"][2]  # any block alone
    assert (token_file.read_block(coder, source, third) == ids[2 * token_file.BLOCK : 3 * token_file.BLOCK]).all()
    for bad in (data[:5000] + bytes([data[5000] ^ 1]) + data[5001:], data[:-1], data[1:], b"", token_file.MAGIC):
        with pytest.raises((ValueError, zlib.error)):
            list(token_file.read_file(coder, pa.BufferReader(bad)))


def test_documents_of_one_id_fill_several_files(spark, monkeypatch):
    monkeypatch.setattr(token_file, "n_parts", lambda *a: 6)
    rows = [(7 if i % 3 else None if i % 2 else i, spoken(30 + i % 5)) for i in range(300)] + [(7, "same text again")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    folder = new_folder(spark, "t")
    files = token_file.write(docs, public_tokenizers.path("word_bpe_49k.json"), 2, folder)
    held = {r["file"]: r["documents"] for r in files.collect()}
    assert len(held) >= 5 and max(held.values()) < 300 and sum(held.values()) == 600
    got = sorted((r["start"], r["doc_id"], r["n_tokens"]) for r in token_file.read(files, folder).collect())
    assert [i is None for _, i, _ in got] == sorted((r[0] is None for r in rows), reverse=True) and [i for _, i, _ in got if i is not None] == sorted(r[0] for r in rows if r[0] is not None)
    assert [a for a, _, _ in got] == [0, *itertools.accumulate(n for _, _, n in got)][:-1]


def test_starts_are_sums_of_lower_parts(spark):
    ids = [(i * 7919) % 50 for i in range(100) if i % 6]
    parts = [i for i in range(100) if i % 6]
    files = spark.createDataFrame(list(zip(parts, ids, strict=True)), "part long, ids long")
    expected = dict(zip(parts, [0, *itertools.accumulate(ids)][:-1], strict=True))
    for run in (1, 9, 1000):
        assert {r["part"]: r["start"] for r in token_file.started(files, run).collect()} == expected


def test_token_file_matches_the_library(spark, sf_dir):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start = 0
    got = queries.op4_token_file(spark, sf_dir).orderBy("doc_id").collect()
    docs = queries.table(spark, sf_dir, "documents").orderBy("doc_id").collect()
    for g, d in zip(got, docs, strict=True):
        ids = [*tokenizer.encode(d["text"] or "", add_special_tokens=False).ids, 2]
        assert tuple(g) == (d["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_words_encode_like_whole_texts():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, encode = Tokenizer.from_file(path), token_file.encoder(path)
    rnd = random.Random(2)
    alphabet = ["a", "b", "E", "é", "é", "Σ", "'s", "'re", "'", "’s", "1", ",", ".", "<|", "|>", "<|endoftext|>", "<|STARTOFTEXT|>", " ", "\n", " ", "日", "İ", "ﬁ", "́", "_", "\x85", "\x1c", "ß", "K"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 25))) for _ in range(3000)]
    ends, ids = encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


# 5 pieces


SP = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a  b", " abc", "abc ", "", "\n", "\n\nx", "x\n", "a\n b", "a \nb", "▁x", "<s>", "\x01", "日本語 テスト", "a\tb", "éé́ x", "a" * 900, "    def f(x):\n        return x\n" * 20]


def test_pieces_match_the_library_in_chunks_of_any_size():
    p = pieces.Pieces(SP)
    rnd = random.Random(1)
    texts = [*ODD, *["".join(rnd.choice("ab e\nthions.,  ▁é日x0") for _ in range(rnd.randint(0, 300))) for _ in range(150)]]
    assert [x.tolist() for x in pieces.Encoder(p).encode(pa.array(texts))] == [p.model.encode(t) for t in texts]
    for text in texts:
        ids = p.model.encode(text)
        assert p.decode(np.array(ids, np.int64)).decode() == p.model.decode(ids)
        for chunk in (7, 33, 64) if text else ():
            full = pieces.normal(text)
            n, own = len(full), []
            for k in range(-(-n // chunk)):
                base = max(0, k * chunk - p.longest - 1)
                own.append(pieces.Chunk(p, full[base : (k + 1) * chunk + p.longest + 1], base, k * chunk, min((k + 1) * chunk, n), n))
            way = pieces.route([c.matrix() for c in own])
            assert [i for c, a, b in zip(own, way, way[1:], strict=False) for i in c.trace(a, b)] == ids


def test_giant_texts_on_the_cluster(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents").select("doc_id", "text")
    p = pieces.Pieces(SP)
    got = {r["doc_id"]: r for r in pieces.encode(docs, SP, giant=2000, chunk=700).collect()}
    for r in docs.collect():
        assert list(got[r["doc_id"]]["ids"]) == p.model.encode(r["text"]) and got[r["doc_id"]]["round_trip"]
        assert got[r["doc_id"]]["ids_crc32"] == zlib.crc32(np.array(p.model.encode(r["text"]), "<u4").tobytes())
    assert max(r["n_chunks"] for r in got.values()) > 5


def test_tree_of_chunks_on_several_levels(spark):
    rnd = random.Random(8)
    texts = ["".join(rnd.choice("ab e\nthions.,  é日x0") for _ in range(n)) for n in (9000, 2500, 300, 1)]
    p = pieces.Pieces(SP)
    got = {r["doc_id"]: r for r in pieces.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), SP, giant=200, chunk=100, fan=4).collect()}
    assert [list(got[i]["ids"]) for i in range(4)] == [p.model.encode(t) for t in texts]
    assert [got[i]["n_chunks"] for i in range(4)] == [91, 26, 4, 1] and all(r["round_trip"] for r in got.values())


@given(st.lists(st.integers(1, 4), min_size=3, max_size=7), st.randoms())
@settings(deadline=None)
def test_route_is_best_between_any_ends(sizes, rnd):
    own = [np.array([[-rnd.random() for _ in range(b)] for _ in range(a)]) for a, b in zip(sizes, sizes[1:], strict=False)]  # one path is best, as in a text
    weight = lambda way: sum(m[a, b] for m, a, b in zip(own, way, way[1:], strict=False))
    source, target = rnd.randrange(sizes[0]), rnd.choice([None, rnd.randrange(sizes[-1])])
    way = pieces.route(own, source, target)
    every = [w for w in itertools.product(*map(range, sizes)) if w[0] == source and target in (None, w[-1])]
    assert way[0] == source and target in (None, way[-1]) and abs(weight(way) - max(map(weight, every))) < 1e-9


@given(st.lists(st.integers(1, 4), min_size=2, max_size=7), st.randoms())
@settings(deadline=None)
def test_scan_is_the_product_of_prefixes(sizes, rnd):
    own = [np.array([[rnd.choice([0.0, -1.0, -np.inf]) for _ in range(b)] for _ in range(a)]) for a, b in zip(sizes, sizes[1:], strict=False)]
    total = own[0]
    for got, m in zip(pieces.scan(own), [None, *own[1:]], strict=True):
        total = total if m is None else pieces.product(total, m)
        assert (got == total).all()


# 6 warc


def test_archive_stores_once_and_rebuilds(spark, tmp_path, monkeypatch):
    big, other = "x" * 1500, "y" * 1200
    rows = [(1, "http://a/\r\nX: y", big), (2, None, big), (3, "u", big), (4, "u", other), (5, "u", "small"), (6, "u", "small"), (7, "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    wholes = []
    for least in (warc.HOT_LEAST, 1):  # then every repeated payload takes the way of hot ones
        monkeypatch.setattr(warc, "HOT_LEAST", least)
        store = warc.archive(pages, new_folder(spark, "t"))
        assert store.places.count() == store.places.select("digest").distinct().count() == 4
        assert store.headers.filter("hot").count() == (5 if least == 1 else 0)
        wholes.append(sorted(bytes(r["record"]) for r in warc.rebuild(store).collect()))
    assert wholes[0] == wholes[1]
    parsed = [(warc.parse_header(h), b) for w in wholes[0] for h, b in warc.parse(io.BytesIO(w).read)]
    assert sorted(len(b) for _, b in parsed) == [0, 0, 0, 5, 5, 1200, 1500] and sum(h["warc-type"] == "revisit" for h, _ in parsed) == 2
    assert not any("x" in h for h, _ in parsed)
    assert [h["warc-target-uri"] for h, _ in parsed if h["warc-record-id"].startswith("<urn:page:1:")] == ["http://a/%0D%0AX:%20y"]
    assert warc.export(store, f"file://{tmp_path}/files").agg({"records": "sum"}).first()[0] == 7
    again = warc.records(spark, f"{tmp_path}/files/*.warc.gz").collect()
    assert sorted(bytes(r["header"]) + bytes(r["block"]) + warc.END for r in again) == wholes[0]


@pytest.mark.parametrize("size", [1, 7, 1 << 20])
@pytest.mark.parametrize("member", [bytes, gzip.compress])
def test_records_are_parsed_in_pieces_of_any_size(size, member):
    heads = [f"WARC/1.1\r\nContent-Length: {n}\r\n\r\n".encode() for n in (0, 5, 3000)]
    blocks = [b"", b"\r\n\r\n\r", bytes(range(250)) * 12]
    source = io.BytesIO(b"".join(member(h + b + warc.END) for h, b in zip(heads, blocks, strict=True)))
    assert list(warc.parse(lambda n: source.read(min(n, max(size, 2))))) == list(zip(heads, blocks, strict=True))
    with pytest.raises(ValueError, match="doesn't end"):
        list(warc.parse(io.BytesIO(heads[1] + b"short").read))


def test_wrong_payload_raises(spark):
    pages = spark.createDataFrame([(1, "u", "abc"), (2, "u", "abd")], "page_id long, url string, html string")
    store = warc.archive(pages, new_folder(spark, "t"))
    turned = store.places.withColumn("digest", F.unhex(F.sha2(F.when(F.col("digest") == F.unhex(F.sha2(F.lit("abc"), 256)), "abd").otherwise("abc"), 256)))
    with pytest.raises(Exception, match="doesn't match its digest"):
        warc.rebuild(store._replace(places=turned)).collect()


def test_repeated_pages_and_missing_ids(spark):
    big = "z" * 1000
    rows = [(i % 7 or None, f"u{i}", [big, None, "", "s", big + "é"][i % 5]) for i in range(60)]
    con = duckdb.connect()
    con.register("raw", pandas.DataFrame({"page_id": pandas.array([r[0] for r in rows], "Int64"), "html": [r[2] for r in rows]}))
    con.execute("CREATE VIEW pages AS SELECT page_id::BIGINT page_id, html FROM raw")
    got = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string"))
    names, expected = rows_of_sql(con, OP6)
    assert names == sorted(got.columns) and rows_of(got) == expected


# 7 near duplicates


def brute_components(texts):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    own = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in own}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(own), 2):
        both = len(own[a] & own[b])
        if own[a] and own[b] and 100 * both >= 75 * (len(own[a]) + len(own[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(own[i]), find(i)) for i in own}


def test_near_duplicates_match_brute_force(spark):
    rnd = random.Random(3)
    texts = {}
    for g in range(12):
        base = spoken(rnd.randint(6, 200), 5000, rnd).split()
        for _ in range(rnd.choice([1, 2, 6, 20])):
            own = list(base)
            for _ in range(rnd.randint(0, 1 + len(own) // 30)):
                own[rnd.randrange(len(own))] = f"v{rnd.randrange(10**6)}"
            texts[len(texts)] = rnd.choice(["", "A "]) + " ".join(own).upper() if g % 2 else " ".join(own)
    # a chain: each link holds, its ends don't
    base = spoken(120, 9000, rnd).split()
    for k in range(8):
        texts[len(texts)] = " ".join(base[4 * k : 4 * k + 80])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == brute_components(texts)


@pytest.mark.parametrize(("block", "size"), [(16, 8000), (1024, 16 << 20)])
def test_large_group_around_an_absent_origin(spark, monkeypatch, block, size):
    """Copies of one text, none of which need link with the leader: blocks find the links, in parts."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "SET_BYTES", size)
    rnd = random.Random(9)
    base = spoken(100, 9000, rnd).split()
    texts = {}
    for i in range(90):
        own = list(base)
        for k in rnd.sample(range(100), 3):
            own[k] = f"v{rnd.randrange(10**6)}"
        texts[i] = " ".join(own)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == brute_components(texts)


def test_two_groups_of_thousands_in_common_buckets(spark):
    """6,000 and 4,000 classes that share half of their text and a band, but don't link."""
    rnd = random.Random(10)
    for k in itertools.count():
        one = [f"a{k}x{i}" for i in range(100)]
        two = one[:60] + [f"b{k}x{i}" for i in range(40)]
        keys = near_dedup.band_keys(near_dedup.minima(near_dedup.sets(pa.array([" ".join(one), " ".join(two)]))))
        if (keys[0] == keys[1]).any():
            break
    texts = []
    for base, n in ((one, 6000), (two, 4000)):
        for _ in range(n):
            own = list(base)
            own[rnd.randrange(100)] = f"v{len(texts)}"
            texts.append(" ".join(own))
    got = near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8))
    assert {(r["component_id"], r["count"]) for r in got.groupBy("component_id").count().collect()} == {(0, 6000), (6000, 4000)}


def test_pairs_of_blocks_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "SET_BYTES", 100)
    rnd = random.Random(6)
    rows = [(k, i, j, side, node, node % 3, rnd.randrange(1, 30)) for k in (5, 6) for i, j, sides in ((0, 0, [2]), (0, 1, [0, 1])) for side in sides for node in range(side, 40, 2)]
    got = near_dedup.by_bytes(spark.createDataFrame(rows, ", ".join(f"{c} long" for c in near_dedup.CLOSE))).collect()
    size, met = {(r[0], r[1], r[2], r[4]): 8 * r[6] for r in rows}, {}
    for r in got:
        met.setdefault(tuple(r[:5]), []).append((r["side"], r["node"]))
    pairs = {}
    for (k, i, j, p, q), own in met.items():
        for side in (0, 1, 2):
            held = [size[k, i, j, n] for s, n in own if s == side]
            assert sum(held) - max(held, default=0) <= 100
        for (s1, n1), (s2, n2) in itertools.combinations(sorted(own), 2):
            if s1 == s2 == 2 or (s1, s2) == (0, 1):
                pairs[k, i, j, *sorted((n1, n2))] = pairs.get((k, i, j, *sorted((n1, n2))), 0) + 1
    expected = {}
    for a, b in itertools.combinations(rows, 2):
        if a[:3] == b[:3] and (a[3] == b[3] == 2 or {a[3], b[3]} == {0, 1}):
            expected[*a[:3], *sorted((a[4], b[4]))] = 1
    assert pairs == expected


def test_sequential_test_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(1)
    left = rng.integers(0, 256, (20_000, near_dedup.N_HASHES)).astype(np.uint8)
    for s, least, most in ((0.75, 0.9999, 1), (0.9, 1, 1), (0.3, 0, 0.01), (0.0, 0, 0)):
        right = np.where(rng.random(left.shape) < s, left, rng.integers(0, 256, left.shape)).astype(np.uint8)
        assert least <= near_dedup.agree(left, right).mean() <= most


def test_minima_estimate_similarity():
    a, b = (np.unique(words.mix(np.arange(lo, lo + 4000, dtype=np.uint64))) for lo in (0, 1000))
    x, y = near_dedup.minima([a, b])
    assert abs((x == y).mean() - 3000 / 5000) < 0.15


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 51)], [(5, 5)]])
def test_components(spark, edges):
    got = components(spark.createDataFrame(edges, "a long, b long"), new_folder(spark, "cc")).collect()
    root = {i: i for e in edges if e[0] != e[1] for i in e}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        if a != b:
            root[max(find(a), find(b))] = min(find(a), find(b))
    by = {}
    for r in got:
        by.setdefault(r["label"], set()).add(r["node"])
    expected = {}
    for i in root:
        expected.setdefault(find(i), set()).add(i)
    assert sorted(map(sorted, by.values())) == sorted(map(sorted, expected.values()))


@pytest.mark.parametrize(("few", "most"), [(1000, 2), (40, 99), (0, 99)])
def test_few_edges_are_finished_at_once(spark, few, most):
    """On the cluster, there down to 40 edges, and at once, which writes two tables whatever the length of the paths."""
    rnd = random.Random(4)
    path = rnd.sample(range(60), 60)
    edges = [*itertools.pairwise(path), *(tuple(rnd.sample(range(100, 140), 2)) for _ in range(16)), *((200, 200 + i) for i in range(1, 9)), (9, 9), (3, 3), (path[1], path[0])]
    root = {i: i for e in edges for i in e}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        root[max(find(a), find(b))] = min(find(a), find(b))
    folder = new_folder(spark, "cc")
    by = {}
    for r in components(spark.createDataFrame(edges, "a long, b long").repartition(3), folder, few=few).collect():
        by.setdefault(r["label"], []).append(r["node"])
    expected = {}
    for i in root:
        expected.setdefault(find(i), []).append(i)
    assert sorted(map(sorted, by.values())) == sorted(map(sorted, expected.values()))
    assert len(os.listdir(folder.removeprefix("file://"))) <= most


@given(st.lists(st.tuples(st.integers(-9, 9), st.integers(-9, 9)).filter(lambda e: e[0] != e[1])))
def test_least_nodes(edges):
    label = {i: i for e in edges for i in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    a, b = np.array(edges, np.int64).reshape(-1, 2).T
    assert dict(zip(*(x.tolist() for x in least_nodes(a, b)), strict=True)) == label


# 8 licenses


def full_alignment(template, text):
    """Matched words of the best local alignment, without a band."""
    best = (0, 0)
    before = [(0, 0)] * (len(text) + 1)
    for w in template:
        row = [(0, 0)]
        for j, x in enumerate(text):
            diagonal = (before[j][0] + (2 if x == w else -1), before[j][1] + (x == w))
            own = max(diagonal, (before[j + 1][0] - 1, before[j + 1][1]), (row[j][0] - 1, row[j][1]), (0, 0), key=lambda c: c[0])
            row.append(own)
            best = max(best, own)
        before = row
    return best[1]


SHORT = {k: v for k, v in TEMPLATES.items() if len(v) < 3000}


def test_scan_matches_full_alignment(spark):
    rnd = random.Random(4)
    rows, planted = [], {}
    for i in range(40):
        text = spoken(60, 300, rnd).split()
        if i % 2:
            name = rnd.choice(list(SHORT))
            own = SHORT[name].split()
            for _ in range(len(own) // 25):
                own[rnd.randrange(len(own))] = "changed"
            if len(own) > 30:
                del own[10:12]
            text[20:20] = own
            planted[i] = name
        rows.append((i, " ".join(text)))
    found = {}
    for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), SHORT).collect():
        found.setdefault(r["doc_id"], []).append(r)
    assert set(found) == set(planted)
    index = license_scan.Index(list(SHORT.values()))
    for i, text in rows:
        if i not in found:
            assert max(full_alignment(t, index.terms(text)) / len(t) for t in index.words) < license_scan.COVERAGE
            continue
        best = max(found[i], key=lambda r: r["matched_words"])
        t = list(SHORT).index(best["license"])
        assert best["matched_words"] == full_alignment(index.words[t], index.terms(text))
        top = max(full_alignment(x, index.terms(text)) for x in index.words if full_alignment(x, index.terms(text)) / len(x) >= license_scan.COVERAGE)
        assert best["matched_words"] == top
        span = text[best["start_char"] : best["end_char"]]
        assert len(index.terms(span)) == best["end_word"] - best["start_word"]


def test_whole_licenses_in_other_layouts(spark):
    rnd = random.Random(17)
    names = ["Apache-2.0", "GPL-2.0", "MPL-2.0", "CC0-1.0", "BSL-1.0"]
    rows = []
    for i, name in enumerate(names):
        own = TEMPLATES[name].split()
        flowed = "\n".join("// " + " ".join(own[k : k + 7]) for k in range(0, len(own), 7))  # wrapped in comments
        part = " ".join(own[: int(len(own) * 0.9)])  # the last tenth is missing
        paged = "\n\n".join(" ".join(own[k : k + 300]) + f" page {k // 300} of the licence file" for k in range(0, len(own), 300))
        rows += [(10 * i + j, f"{spoken(40, 300, rnd)}\n{t}\n{spoken(40, 300, rnd)}") for j, t in enumerate((flowed, part, paged, " ".join(own[: len(own) // 2])))]
    found = {}
    for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect():
        found.setdefault(r["doc_id"], []).append(r)
    for i, name in enumerate(names):
        size = len(license_scan.Index.terms(TEMPLATES[name]))
        for j, least in enumerate((size, int(size * 0.88), size)):
            best = max(found[10 * i + j], key=lambda r: r["matched_words"])
            assert best["license"] == name and best["matched_words"] >= least - 1, (name, j)
        assert all(r["license"] != name for r in found.get(10 * i + 3, []))


def test_templates_are_held_once_by_file(spark):
    many = {f"t{i}": " ".join(f"u{i}x{k}" for k in range(12)) for i in range(3000)}
    docs = spark.createDataFrame([(1, f"a b {many['t7']} c {many['t2999']}"), (2, "nothing here")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["license"], r["coverage"]) for r in license_scan.scan(docs, many).collect()) == [(1, "t2999", 1.0), (1, "t7", 1.0)]
    assert license_scan.scan(docs, {}).count() == 0


def test_each_of_repeated_notices_gives_a_row(spark):
    short = ["MIT notice", "Apache-2.0 notice", "CC-BY-SA-4.0 notice", "CC-BY-NC-4.0 notice"]
    rows = [(i, "\n".join([TEMPLATES[name]] * 7)) for i, name in enumerate(short)]
    rows.append((len(short), " ".join(TEMPLATES[name] for name in short * 2)))
    rows.append((len(short) + 1, "\n".join([TEMPLATES["MIT notice"]] * 2000)))  # longer than a block
    found = {}
    for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert r["coverage"] == 1
        found.setdefault(r["doc_id"], []).append((r["start_word"], r["license"]))
    size = {name: len(license_scan.Index.terms(TEMPLATES[name])) for name in short}
    for i, name in enumerate(short):
        assert sorted(found[i]) == [(k * size[name], name) for k in range(7)]
    assert [name for _, name in sorted(found[len(short)])] == short * 2
    assert sorted(found[len(short) + 1]) == [(k * size["MIT notice"], "MIT notice") for k in range(2000)]


def test_copies_with_long_insertions_are_found(spark):
    grant, warranty = TEMPLATES["MIT"].split(" THE SOFTWARE IS PROVIDED ")
    terms, names = TEMPLATES["BSD-3-Clause"].split(" 3. Neither ")
    rnd = random.Random(6)
    rows = [(n, f"{spoken(30, 300, rnd)} {grant} {spoken(n, 300, rnd)} THE SOFTWARE IS PROVIDED {warranty} {spoken(30, 300, rnd)}") for n in (10, 20, 40)]
    clause = "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the organization."
    rows.append((4, f"{terms} {clause} 4. Neither {names}"))
    own = TEMPLATES["MIT"].split()
    rows.append((5, " ".join(" ".join(own[k : k + 40]) + " " + spoken(12, 300, rnd) for k in range(0, len(own), 40))))
    index, found = license_scan.Index(list(TEMPLATES.values())), {}
    for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found.setdefault(r["doc_id"], []).append(r)
    for i, text in rows:
        (r,) = found[i]
        t = list(TEMPLATES).index(r["license"])
        assert r["license"] == ("BSD-3-Clause" if i == 4 else "MIT")
        assert r["matched_words"] == full_alignment(index.words[t], index.terms(text)) >= len(index.words[t]) - 2
        assert text[r["start_char"] : r["end_char"]].split()[0] == TEMPLATES[r["license"]].split()[0]


@given(st.lists(st.integers(0, 20), min_size=1, max_size=60))
def test_winnowing_takes_one_of_each_window(values):
    h = np.array(values, np.uint64)
    chosen = set(license_scan.winnow(h).tolist())
    n = len(values)
    assert all(chosen & set(range(i, min(n, i + license_scan.W))) for i in range(max(1, n - license_scan.W + 1)))
    assert all(any(values[c] == min(values[i : i + license_scan.W]) for i in range(max(0, c - license_scan.W + 1), min(c, max(0, n - license_scan.W)) + 1)) for c in chosen)


# 9 decontamination


def test_many_blocks_give_the_same(spark, sf_dir):
    docs, bench = (queries.table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    one = decontaminate.decontaminate(docs, bench)
    many = decontaminate.decontaminate(docs, bench, limit=37)
    assert rows_of(one) == rows_of(many) and one.filter("n_hit > 0").count() > 0


def test_blocks_hold_every_window_once(spark, tmp_path):
    rows = [(1, "a b c d e f"), (2, "b c d"), (3, None), (4, ""), (5, "x"), (None, "c d e"), (1, "a b c d e f"), (6, " ".join(f"t{i}" for i in range(50)))]
    bench = spark.createDataFrame(rows, "item_id long, text string").coalesce(1)
    for limit in (1, 7, 1000):
        found = set()
        files = decontaminate.prepare(bench, f"file://{tmp_path}/{limit}", 3, limit)
        for path in files:
            block = decontaminate.opened(path)
            terms = block.terms.to_pylist()
            assert sum(len(w) for w, _, _ in block.windows) <= limit
            for rows_, starts, owners in block.windows:
                found |= {(block.ids[o], tuple(terms[c] for c in row)) for row, a, b in zip(rows_.tolist(), starts[:-1], starts[1:], strict=True) for o in owners[a:b]}
        w = lambda text: tuple(text.split())
        expected = {(str(i) if i else None, w(t)[j : j + 3]) for i, t in rows if t for j in range(max(1, len(w(t)) - 2))}
        assert found == expected and (len(files) == 1) == (limit == 1000)


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "a x b c d"), (3, "d c b a"), (4, "a b"), (5, "z z c d")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "A, b c")], "item_id long, text string")
    near = {s: sorted(r["doc_id"] for r in decontaminate.decontaminate(docs, bench, k=3, slop=s).filter("size(items) > 0").collect()) for s in (0, 1)}
    assert near[0] == [1] and 2 in near[1] and 4 not in near[1] and 5 not in near[1]


def test_phrases_do_not_cross_documents(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c d")], "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame([(1, "b c")], "item_id long, text string")
    assert decontaminate.decontaminate(docs, bench).filter("n_hit > 0").count() == 0


# What the operators share


def test_marks_miss_no_key(spark):
    from pyspark.sql import functions as F

    from folioscope.llm.shared import marked

    rows = spark.range(20_000).select(F.when(F.col("id") > 5, F.col("id")).alias("doc_id"))
    keys = spark.range(1000, 3000).select(F.col("id").alias("k")).union(spark.createDataFrame([(None,)], "k long"))
    got = marked(rows, F.col("doc_id"), keys, "k")
    assert got.columns == ["doc_id", "__may"] and got.count() == 20_000
    assert got.filter("NOT __may AND (doc_id IS NULL OR doc_id BETWEEN 1000 AND 2999)").count() == 0
    assert got.filter("__may").count() < 2100
    assert marked(rows, F.col("doc_id"), keys.limit(0), "k").filter("__may").count() == 0


@given(st.lists(st.lists(st.integers(0, 60), min_size=1, max_size=30), max_size=8))
@settings(deadline=None)
def test_memo_gives_the_same_when_it_forgets(batches):
    def ids(strings):
        own = [list(range(int(w) % 4)) + [int(w)] for w in strings]
        return np.array([len(x) for x in own]), np.array([i for x in own for i in x], np.uint32)

    memo = words.Memo(ids, most=20)
    for batch in batches:
        vocabulary = sorted({str(i) for i in batch})
        codes = np.array([vocabulary.index(str(i)) for i in batch])
        total, flat = memo.expand(vocabulary, codes)
        assert [flat[a:b].tolist() for a, b in zip(total, total[1:], strict=False)] == [list(range(i % 4)) + [i] for i in batch]


@given(st.lists(st.text(alphabet=" \n\tabcABé日1,.", max_size=30), max_size=12))
@settings(deadline=None)
def test_words_of_batches(texts):
    for table, pattern in ((words.KEEP, r"[^\x20\x09-\x0D]+"), (words.LOWER, r"[^\x20\x09-\x0D]+"), (words.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        ends, codes, vocabulary = words.split(pa.array(texts, pa.string()), table)
        got = [[vocabulary[int(c)].as_py() for c in codes[a:b]] for a, b in zip(ends, ends[1:], strict=False)]
        assert got == [re.findall(pattern, t if table is words.KEEP else t.translate(LOWER)) for t in texts]
