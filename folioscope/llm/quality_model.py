"""Quality classifier: attention-based multiple-instance learning over passages.

A text is a bag of passages of at most ``PASSAGE`` words, so every part of it
counts, however long it is. A passage is encoded from hashed features of its words (the
word and its shape) and a few ratios; gated attention weighs the passages; the
weighted encoding gives the score. Encoder, attention and output are learnt
together from document labels alone, by gradient descent in the driver, on a
sample of at most ``SAMPLE`` labelled documents taken in the order of a hash of
doc_id, and of each at most ``BAG`` passages, spread evenly over the text; so the driver
holds ``SAMPLE * BAG`` passages of 2 KB at most (131 MB). They come to it compressed, and
learning reads them ``STEP`` passages at a time, so nothing else there grows with the texts.
Scoring streams over all documents and takes all passages of each.

Only rows whose crc32(doc_id as text) mod 4 is not 2 are learnt from, and only
the text enters a score.

Defined results: a null or wordless text is a bag of one empty passage; labels
that are null, and rows of labels or documents without a partner, are not
learnt from; of several texts with one labelled doc_id the least in byte order is
learnt from; without labels of both kinds all texts score the share of ones (0.5
without any); repeated rows score alike; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.llm import words
from folioscope.llm.shared import project, slices, small_batches, tidy

PASSAGE, SAMPLE, BAG, THRESHOLD = 128, 4000, 16, 0.7
#: Buckets of hashed words and of hashed shapes; ratios of a passage; width of the encoding and of the attention.
N_WORDS, N_SHAPES, N_RATIOS, WIDTH, GATE = 768, 256, 4, 16, 8
N_FEATURES = N_WORDS + N_SHAPES
EPOCHS, RATE, DECAY = 160, 0.03, 1e-4
#: Passages whose features the driver holds as numbers at once.
STEP = 1024
#: Words whose features a worker remembers.
REMEMBERED = 250_000

_RUN = re.compile(r"(.)\1+", re.DOTALL)


class _Classes(dict):
    """Characters by code: letters and digits give their class, others themselves."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = out = "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c
        return out


_CLASSES = _Classes()


def shape(word: str) -> str:
    """A word with its letters and digits replaced by their class, and runs cut to one character."""
    return _RUN.sub(r"\1", word.translate(_CLASSES))


def _bucket(form: str) -> int:
    return N_WORDS + xxhash.xxh32_intdigest(form) % N_SHAPES


_PLAIN = _bucket("a")


def _feature(word: str) -> tuple[int, int, int]:
    lower = word.lower()
    plain = word == lower and word.isalpha() and word.islower()
    return xxhash.xxh32_intdigest(lower) % N_WORDS, _PLAIN if plain else _bucket(shape(word)), len(word)


class Features:
    """Passages of a batch of texts; remembers the features of words."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}
        self.table = np.zeros((0, 3), np.int64)

    def _own(self, vocabulary: list[str]) -> np.ndarray:
        """(word bucket, shape bucket, length) of each word."""
        fresh = [w for w in vocabulary if w not in self.known]
        if len(self.known) + len(fresh) > REMEMBERED:
            self.__init__()
            fresh = vocabulary
        if fresh:
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh)), strict=True))
            self.table = np.concatenate([self.table, np.array([_feature(w) for w in fresh], np.int64)])
        return self.table[np.fromiter(map(self.known.__getitem__, vocabulary), np.int64, len(vocabulary))]

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first passage of each text and the end, first word of each passage and the end, codes, features of the vocabulary, ratios)."""
        ends, codes, vocabulary = words.split(texts)
        own = self._own(vocabulary.to_pylist())
        n = np.diff(ends)
        count = np.maximum(1, -(-n // PASSAGE))
        first = np.concatenate([[0], np.cumsum(count)])
        bag = np.repeat(np.arange(len(n)), count)
        k = np.arange(first[-1]) - first[bag]
        cuts = np.concatenate([ends[bag] + k * n[bag] // count[bag], ends[-1:]])
        size = np.diff(cuts)
        at = np.repeat(np.arange(len(size)), size)
        some = np.maximum(size, 1)
        distinct = np.bincount(np.unique(at * np.int64(max(1, len(own))) + codes) // max(1, len(own)), minlength=len(size)) if len(codes) else np.zeros(len(size))
        length = np.bincount(at, own[codes, 2], len(size)) if len(codes) else np.zeros(len(size))
        ratios = np.stack([distinct / some, np.log1p(size) / 5, np.minimum(length / some, 40) / 10, size > 0], 1).astype(np.float32)
        return first, cuts, codes, own[:, :2], ratios


@dataclass
class Model:
    """Weights; a passage's encoding is tanh(mean of word rows + ratios @ ratio + shift)."""

    rows: np.ndarray
    ratio: np.ndarray
    shift: np.ndarray
    v: np.ndarray
    u: np.ndarray
    w: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    def names(self) -> list[str]:
        return list(self.__dataclass_fields__)

    def head(self, pre: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        """Forward pass from the passages' sums before tanh; first: where each bag starts, and the end; a: the weights of the passages."""
        h = np.tanh(pre)
        t, s = np.tanh(h @ self.v), 1 / (1 + np.exp(-(h @ self.u)))
        e = (t * s) @ self.w
        bag = np.repeat(np.arange(len(first) - 1), np.diff(first))
        a = np.exp(e - np.maximum.reduceat(e, first[:-1])[bag])
        a /= np.add.reduceat(a, first[:-1])[bag]
        z = np.add.reduceat(a[:, None] * h, first[:-1])
        return {"h": h, "t": t, "s": s, "a": a, "z": z, "bag": bag, "p": 1 / (1 + np.exp(-(z @ self.out + self.bias)))}

    def score(self, known: Features, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(scores, passages) of each text."""
        first, cuts, codes, own, ratios = known.of(texts)
        if len(first) == 1:
            return np.zeros(0), np.zeros(0, np.int64)
        vectors = self.rows[own].sum(1) if len(own) else np.zeros((1, WIDTH), np.float32)
        mean = np.zeros((len(cuts) - 1, WIDTH), np.float32)
        step = 1024  # passages
        for i in range(0, len(mean), step):
            j = min(i + step, len(mean))
            size = np.diff(cuts[i : j + 1])
            full = np.flatnonzero(size)
            if len(full):
                mean[i + full] = np.add.reduceat(vectors[codes[cuts[i] : cuts[j]]], cuts[i + full] - cuts[i]) / size[full, None]
        return self.head(mean + ratios @ self.ratio + self.shift, first)["p"], np.diff(first)


def learnable(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4 != 2


def sample(documents: DataFrame, labels: DataFrame, limit: int = SAMPLE, most: int = BAG) -> list:
    """(quality, bag) of at most ``limit`` labelled documents, ``most`` passages of each; the driver holds these. A bag: counts of features and, as half floats, ratios, two bytes each."""
    spark = documents.sparkSession
    known = project(labels, "doc_id", "quality").filter(F.col("quality").isin(0, 1) & learnable(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = known.join(documents.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).collect()
    if not chosen:
        return []
    few = spark.createDataFrame(chosen, known.schema)  # ``limit`` rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Features()
        for whole in batches:
            for batch in slices(whole, "text"):
                first, cuts, codes, own, ratios = known.of(batch.column("text"))
                out = []
                for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                    picked = np.unique(np.linspace(a, b - 1, min(b - a, most)).astype(np.int64))
                    bag = np.zeros((len(picked), N_FEATURES + N_RATIOS), np.uint16)
                    for k, i in enumerate(picked.tolist()):
                        bag[k, :N_FEATURES] = np.bincount(own[codes[cuts[i] : cuts[i + 1]]].ravel(), minlength=N_FEATURES)
                    bag[:, N_FEATURES:] = ratios[picked].astype(np.float16).view(np.uint16)
                    out.append(zlib.compress(bag.tobytes(), 1))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.string()), batch.column("quality").cast(pa.int32()), pa.array(out, pa.binary())], names=["doc_id", "quality", "bag"])

    texts = project(documents, "doc_id", "text").join(F.broadcast(few), "doc_id").groupBy("doc_id").agg(F.first("quality").alias("quality"), F.min("text").alias("text"))
    rows = texts.select("doc_id", "text", "quality").mapInArrow(tidy(run), "doc_id string, quality int, bag binary").collect()
    return sorted(({"doc_id": r["doc_id"], "quality": r["quality"], "bag": zlib.decompress(r["bag"])} for r in rows), key=lambda r: r["doc_id"])


def slopes(m: Model, x: np.ndarray, ratios: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """The gradient of the mean cross-entropy of the bags that start at ``first`` (and the end), by weight."""
    f = m.head(x @ m.rows + ratios @ m.ratio + m.shift, first)
    h, t, s, a, bag = f["h"], f["t"], f["s"], f["a"], f["bag"]
    d_logit = ((f["p"] - y) / len(y)).astype(x.dtype)
    d_z = d_logit[:, None] * m.out
    d_a = (d_z[bag] * h).sum(1)
    d_e = a * (d_a - np.add.reduceat(a * d_a, first[:-1])[bag])
    d_gate = d_e[:, None] * m.w
    d_t, d_s = d_gate * s * (1 - t * t), d_gate * t * s * (1 - s)
    d_h = a[:, None] * d_z[bag] + d_t @ m.v.T + d_s @ m.u.T
    d_pre = d_h * (1 - h * h)
    return {"rows": x.T @ d_pre, "ratio": ratios.T @ d_pre, "shift": d_pre.sum(0), "v": h.T @ d_t, "u": h.T @ d_s, "w": (t * s).T @ d_e, "out": f["z"].T @ d_logit, "bias": d_logit.sum()}


def passages(row: dict) -> int:
    return len(row["bag"]) // (2 * (N_FEATURES + N_RATIOS))


def parts(rows: list, step: int = STEP) -> list[list]:
    """The rows in parts of at most ``step`` passages, one row at least."""
    out, n = [], step
    for r in rows:
        n += passages(r)
        if n > step:
            out.append([])
            n = passages(r)
        out[-1].append(r)
    return out


def unpacked(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features as shares of the words, ratios, where each bag starts, and the end) of a few bags."""
    packed = np.frombuffer(b"".join(r["bag"] for r in rows), np.uint16).reshape(-1, N_FEATURES + N_RATIOS)
    x = packed[:, :N_FEATURES].astype(np.float32)
    x /= np.maximum(x[:, :N_WORDS].sum(1, keepdims=True), 1)
    ratios = np.ascontiguousarray(packed[:, N_FEATURES:]).view(np.float16).astype(np.float32)
    return x, ratios, np.concatenate([[0], np.cumsum([passages(r) for r in rows])])


def mean_slopes(m: Model, some: list[list]) -> dict[str, np.ndarray]:
    """``slopes`` over all rows of some parts, which are unpacked one at a time."""
    total: dict[str, np.ndarray] = {}
    n = sum(map(len, some))
    for rows in some:
        for name, g in slopes(m, *unpacked(rows), np.array([r["quality"] for r in rows], np.float64)).items():
            total[name] = total.get(name, 0) + g * np.float32(len(rows) / n)
    return total


def started(seed: int, kind: type = np.float32) -> Model:
    rng = np.random.default_rng(seed)
    start = lambda *shape: rng.normal(0, 0.3, shape).astype(kind)
    return Model(start(N_FEATURES, WIDTH), start(N_RATIOS, WIDTH), np.zeros(WIDTH, kind), start(WIDTH, GATE), start(WIDTH, GATE), start(GATE), start(WIDTH), kind(0))


def fit(rows: list, epochs: int = EPOCHS, seed: int = 7) -> Model | float:
    """Learn a model by Adam over the whole sample; without both labels, the share of ones."""
    y = np.array([r["quality"] for r in rows], np.float64)
    if not len(y) or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.5
    some = parts(rows)
    m = started(seed)
    moments = {n: (0.0, 0.0) for n in m.names()}
    for k in range(1, epochs + 1):
        for n, g in mean_slopes(m, some).items():
            value = getattr(m, n)
            g = g + DECAY * value * (n != "bias")
            one, two = moments[n] = 0.9 * moments[n][0] + 0.1 * g, 0.999 * moments[n][1] + 0.001 * g * g
            setattr(m, n, (value - RATE * (one / (1 - 0.9**k)) / (np.sqrt(two / (1 - 0.999**k)) + 1e-8)).astype(np.float32))
    return m


def score(documents: DataFrame, model: Model | float) -> DataFrame:
    """doc_id, score and n_passages of each document; the model is a few kilobytes."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kind = dict(documents.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Features()
        for whole in batches:
            for batch in slices(whole, "text"):
                if isinstance(shared.value, float):
                    p, n = np.full(batch.num_rows, shared.value), np.diff(known.of(batch.column("text"))[0])
                else:
                    p, n = shared.value.score(known, batch.column("text"))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p, pa.float64()), pa.array(n, pa.int64())], names=["doc_id", "score", "n_passages"])

    return project(documents, "doc_id", "text").mapInArrow(tidy(run), f"doc_id {kind}, score double, n_passages long")


def keep(documents: DataFrame, model: Model | float, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents``, with all their columns, that score ``threshold`` or more."""
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Features()
        for whole in batches:
            for batch in slices(whole, at):
                p = np.full(batch.num_rows, shared.value) if isinstance(shared.value, float) else shared.value.score(known, batch.column(at))[0]
                yield batch.filter(pa.array(p >= threshold))

    return documents.mapInArrow(tidy(run), documents.schema)


def classify(documents: DataFrame, labels: DataFrame, learn_from: DataFrame | None = None, threshold: float = THRESHOLD, limit: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted and n_passages of each document."""
    small_batches(documents.sparkSession)
    learn_from = documents if learn_from is None else learn_from
    scored = score(documents, fit(sample(learn_from, labels, limit)))
    return scored.select("doc_id", F.coalesce(~learnable(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_passages")
