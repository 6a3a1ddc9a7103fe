"""The pipeline against a version that judges one document at a time."""

import re

import corpus_pipeline
from folioscope.llm import pieces, quality_model, queries, quality_rules
from folioscope.llm.sql import OP10
from tests.conftest import rows_of
from tests.llm.test_methods import LOWER, SP, brute_components, naive_score


def benchmark_windows(items):
    out = set()
    for text in items:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        out |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    return out


def test_run(spark, sf_dir, duck):
    texts = {r["doc_id"]: r["text"] for r in queries.table(spark, sf_dir, "documents").collect()}
    kept = {d for d, *_, k in duck.sql(OP10).fetchall() if k}
    model = quality_model.fit(quality_model.sample(queries.table(spark, sf_dir, "documents"), queries.table(spark, sf_dir, "labels")))
    kept = {d for d in kept if naive_score(model, texts[d]) >= quality_model.THRESHOLD}
    groups = brute_components({d: texts[d] for d in kept})
    kept = {d for d in kept if groups[d][1] == d}
    windows = benchmark_windows(r["text"] for r in queries.table(spark, sf_dir, "benchmark").collect())
    sizes = {len(w) for w in windows}

    def clean(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))
        return not any(tuple(w[i : i + k]) in windows for k in sizes for i in range(len(w) - k + 1))

    model = pieces.Pieces(SP).model
    expected = {d: model.encode(texts[d]) for d in kept if clean(texts[d])}
    got = {r["doc_id"]: list(r["ids"]) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == expected and 0 < len(got) < len(texts)


def test_edges(spark, sf_dir):
    good = queries.table(spark, sf_dir, "documents").filter("lang = 'en'").limit(30).selectExpr("doc_id", "text", "lang", "source", "n_chars", "'x' AS kept", "'y' AS score", "1 AS component_id")
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "a b", "en", "s", 3), (10**9, "", "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = good.unionByName(odd, allowMissingColumns=True).unionByName(good)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), sf_dir).count() == 0, name
        if name == "near dedup":
            ids = [(r["doc_id"], r["text"]) for r in out.collect()]
            assert len(ids) == len(set(ids))
    name, last = corpus_pipeline.STAGES[-1]
    assert last(spark, docs, sf_dir).count() == docs.count()


def test_clean_documents_stay(spark, sf_dir):
    """Labelled good documents of some length pass the two filters."""
    docs = queries.table(spark, sf_dir, "documents")
    good = docs.join(queries.table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id"), "doc_id", "left_semi").select(docs.columns)
    long = quality_rules.judge(good).filter("n_words >= 60 AND NOT base_failed")
    ids = {r["doc_id"] for r in long.collect()}
    after = corpus_pipeline.classifier(spark, corpus_pipeline.rules(spark, docs, sf_dir), sf_dir)
    stay = {r["doc_id"] for r in after.select("doc_id").collect()}
    assert len(ids - stay) <= 0.02 * len(ids)
    assert rows_of(after.limit(0)) == []


def test_texts_of_one_id_are_judged_apart(spark, sf_dir):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(200)) for x in "abcd")
    item = max((r["text"] for r in queries.table(spark, sf_dir, "benchmark").collect()), key=len)
    rows = [(1, a), (1, a + " more"), (2, b), (2, b), (2, c), (3, c), (3, d), (4, c), (None, d), (None, "x " + d), (None, f"{a} {item}"), (3, f"{b} {item}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clean = corpus_pipeline.decontamination(spark, docs, sf_dir)
    assert rows_of(clean) == sorted(rows[:-2], key=repr)
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.dedup(spark, clean, sf_dir).collect()]
    assert sorted(i for i, _ in got) == [1, 2, 2, 3]
    assert {(2, b), (2, c), (3, d)} < set(got)
    nulls = spark.createDataFrame([(None, a), (None, a + " more"), (None, b), (None, None)], docs.schema)
    assert sorted(r["text"] or "" for r in corpus_pipeline.dedup(spark, nulls, sf_dir).collect())[0] == ""
    assert corpus_pipeline.dedup(spark, nulls, sf_dir).count() == 3
