"""Quality rules: base counts and the divergence of a document from its language's references.

Native: DataFrame functions only. One pass over the texts writes a few small
integers per document; references and verdicts are computed from those.

The verdict compares two histograms of a document, of its character classes and
of its common words, with the reference of its language, summed over all documents
of that ``lang``, by the Jensen-Shannon distance (base 2, 0 to 1). Every language with
``REFERENCE_WORDS`` words has a reference. A document that is far from its own is
rejected if it is far from those of the ``OTHERS`` largest languages, too, as labels
can be wrong. Documents of a language without a reference are left alone, and so are
short ones, whose histograms are noise.

Defined results: null text counts as empty (no words, base_failed); a null lang has
no reference and counts for none; ties and repeated rows each give their own row; an
empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.llm.shared import new_folder, project, stored

SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
LOWER = "[a-zß-öø-ÿ]+"
#: After lower-case letters, the classes by which characters of words are told apart; what is left is "other".
CLASSES = {"upper": "[A-ZÀ-ÖØ-Þ]+", "digit": "[0-9]+", "stop": r"[.,;:!?'\"()\-]+", "symbol": "[#*$%&|<>]+"}
#: Common function words of some large languages (fixed values); words of other languages all count as other.
COMMON = (
    "the of and to in is that it for with as on be at by this "
    "de la le et les des en un une que qui du dans pour "
    "el los las y se no con para por "
    "der die das und den von zu mit sich nicht ein für"
).split()
#: A character of one byte for each common word: texts are counted as strings of these.
CODES = {w: chr(48 + i) for i, w in enumerate(COMMON)}
#: Least words of a text whose divergence is judged, and the largest distances from a reference.
MIN_WORDS, MAX_CLASS, MAX_WORD = 100, 0.18, 0.6
#: The first references, which junk may pull, reject at this multiple of the class distance.
FIRST = 1.7
MIN_BASE_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Least words of a reference, how many of the largest stand for wrongly labelled texts, and how many references are broadcast at most.
REFERENCE_WORDS, OTHERS, BROADCAST_ROWS = 2000, 8, 10_000


def features(documents: DataFrame) -> DataFrame:
    """doc_id, a hash of the text, lang, base counts, and the two histograms as arrays of counts."""
    d = project(documents, "doc_id", "lang", "text").withColumn("t", F.coalesce("text", F.lit("")))
    d = d.withColumn("w", F.array_remove(F.split("t", SPACE), "")).withColumn("lines", F.filter(F.split("t", "\n"), lambda x: x.rlike(NOT_SPACE)))
    d = d.withColumn("n", F.size("w")).withColumn("joined", F.array_join("w", "")).withColumn("rest", F.regexp_replace("joined", LOWER, ""))
    at = lambda i: F.get("w", i)
    heads = F.when(F.col("n") >= 3, F.slice("w", 1, F.greatest(F.col("n") - 2, F.lit(0)))).otherwise(F.array().cast("array<string>"))
    d = d.withColumn("g", F.transform(heads, lambda x, i: F.xxhash64(x, at(i + 1), at(i + 2))))
    d = d.withColumn("some", F.size(F.array_distinct("g")) < F.size("g"))  # only then are windows compared as they stand
    whole = F.transform(heads, lambda x, i: F.struct(F.concat_ws(" ", x, at(i + 1), at(i + 2)).alias("g"), i.alias("i")))
    d = d.withColumn("s", F.when(F.col("some"), F.sort_array(whole)))
    same = lambda x, i: (x["g"] == F.get("s", i - 1)["g"]) | (x["g"] == F.get("s", i + 1)["g"])
    d = d.withColumn("at", F.sort_array(F.transform(F.filter("s", lambda x, i: F.coalesce(same(x, i), F.lit(False))), lambda x: x["i"])))
    covered = F.aggregate(
        "at",
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    known = F.create_map(*[y for w, c in CODES.items() for y in (F.lit(w), F.lit(c))])
    d = d.withColumn("common", F.array_join(F.transform(F.filter("w", lambda x: x.isin(COMMON)), lambda x: F.element_at(known, x)), ""))
    drop = lambda c, pattern: F.length(c) - F.length(F.regexp_replace(c, pattern, ""))
    d = d.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), "lang", F.col("n").cast("long").alias("n_words"), F.length("joined").cast("long").alias("word_chars"), F.length("rest").alias("not_lower"),
        *[drop(F.col("rest"), p).alias(f"c_{k}") for k, p in CLASSES.items()],
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.when(F.col("some"), covered), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.octet_length("common").alias("n_common"),
        F.array(*[F.octet_length("common") - F.octet_length(F.replace("common", F.lit(c), F.lit(""))) for c in CODES.values()]).alias("by_word"),
    )
    kinds = [F.col(f"c_{k}") for k in CLASSES]
    return d.select(
        "doc_id", "text_hash", "lang", "n_words", "word_chars", F.col("c_symbol").cast("long").alias("n_symbols"), "n_dup_lines", "n_repeat_words",
        F.array(F.col("word_chars") - F.col("not_lower"), *kinds, F.col("not_lower") - sum(kinds[1:], kinds[0])).cast("array<long>").alias("classes"),
        F.concat(F.col("by_word").cast("array<long>"), F.array(F.col("n_words") - F.col("n_common"))).alias("words"),
    )


def references(features: DataFrame) -> DataFrame:
    """A row for each language with words enough: lang, total, and for classes (c) and words (w) the shares and their sum of q log q."""
    sums = lambda c, n: F.array(*[F.sum(F.col(c)[i]) for i in range(n)]).alias(c)
    own = features.filter("lang IS NOT NULL").groupBy(F.col("lang").alias("known")).agg(sums("classes", len(CLASSES) + 2), sums("words", len(COMMON) + 1), F.sum("n_words").alias("total"))
    own = own.filter(F.col("total") >= REFERENCE_WORDS)
    share = lambda c: F.transform(c, lambda n: n / F.greatest(F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(1)))
    own = own.select("known", "total", share("classes").alias("q_c"), share("words").alias("q_w"))
    return own.withColumns({"f_c": _total(F.transform("q_c", _plogp)), "f_w": _total(F.transform("q_w", _plogp))})


def _plogp(x: Column) -> Column:
    return F.when(x > 0, x * F.log2(x)).otherwise(0.0)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def distance(shares: Column, own: Column, reference: Column, fixed: Column) -> Column:
    """Jensen-Shannon distance of shares and a reference, rounded to nine digits; own and fixed: the sums of p log p of either."""
    middle = F.zip_with(shares, reference, lambda p, q: _plogp((p + q) / 2))
    return F.round(F.sqrt(F.greatest((own + fixed) / 2 - _total(middle), F.lit(0.0))), 9)


def _nearest(counted: DataFrame, known: DataFrame, max_class: float, max_word: float) -> DataFrame:
    """Add ``best``: the distances (c, w) to the own reference, or to one of the largest if that is nearer, and x, their larger share of what is allowed; null without an own reference."""
    few = known.orderBy(F.desc("total"), "known").limit(OTHERS).collect()  # OTHERS rows of some fifty numbers
    if known.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    out = counted.join(known.drop("total"), F.col("lang") == F.col("known"), "left")
    for name, total in (("classes", "word_chars"), ("words", "n_words")):
        share = F.transform(name, lambda n: n / F.greatest(F.col(total), F.lit(1)))  # noqa: B023
        # bound in one-element arrays, so that a lambda reads a value that was computed once
        out = out.withColumn(f"p_{name}", F.transform(F.array(share), lambda p: F.struct(p.alias("p"), _total(F.transform(p, _plogp)).alias("own")))[0])

    def against(q_c: Column, f_c: Column, q_w: Column, f_w: Column) -> Column:
        both = F.struct(distance(F.col("p_classes.p"), F.col("p_classes.own"), q_c, f_c).alias("c"), distance(F.col("p_words.p"), F.col("p_words.own"), q_w, f_w).alias("w"))
        return F.transform(F.array(both), lambda d: F.struct(F.greatest(d["c"] / max_class, d["w"] / max_word).alias("x"), d["c"].alias("c"), d["w"].alias("w")))[0]

    listed = lambda values: F.array(*[F.lit(v) for v in values])
    others = [against(listed(r["q_c"]), F.lit(r["f_c"]), listed(r["q_w"]), F.lit(r["f_w"])) for r in few]
    out = out.withColumn("best", F.when(F.col("known").isNotNull(), against(F.col("q_c"), F.col("f_c"), F.col("q_w"), F.col("f_w"))))
    if others:
        out = out.withColumn("best", F.when(F.col("best.x") > 1, F.array_min(F.array("best", *others))).otherwise(F.col("best")))
    return out.drop("p_classes", "p_words", "known", "q_c", "q_w", "f_c", "f_w")


def judge(documents: DataFrame, min_words: int = MIN_WORDS, max_class: float = MAX_CLASS, max_word: float = MAX_WORD) -> DataFrame:
    """A row for each document: base counts, base_failed, kept, class_distance and word_distance to the nearest reference, and text_hash (xxhash64 of the text).

    References are summed twice: over all documents of a language, then again
    over those that the base rules and the first references let pass, so that
    junk does not pull them.
    """
    spark = documents.sparkSession
    failed = (F.col("n_words") < MIN_BASE_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    folder = new_folder(spark, "rules")
    counted = stored(features(documents), folder, "counts").withColumn("base_failed", failed)
    strange = (F.col("n_words") >= min_words) & F.coalesce(F.col("best.x") > 1, F.lit(False))
    first = _nearest(counted, stored(references(counted), folder, "first"), FIRST * max_class, max_word)
    known = stored(references(first.filter(~F.col("base_failed") & ~strange)), folder, "known")
    return _nearest(counted, known, max_class, max_word).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~strange).alias("kept"),
        F.col("best.c").alias("class_distance"), F.col("best.w").alias("word_distance"), "text_hash",
    )
