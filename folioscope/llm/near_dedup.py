"""MinHash near-duplicates with sequential Bayesian verification.

1. Each text becomes the set of its word shingles (64-bit hashes); its sorted
   set gives a 128-bit digest, 128 minima of 8 bits each (the signature), and the
   keys of 32 bands of four full minima. Texts with one digest are one class,
   so copies are never compared with each other.
2. Classes meet in the buckets of the bands. In each bucket every class is
   compared with one leader only, the class that meets most others in all its
   buckets; that is the common origin of a group of copies if it is there, and
   joins the group without making all its pairs.
3. In buckets that still hold several components, each class outside of the largest
   one is compared with all of other components, inside the workers, in blocks of
   bounded size; the largest component's classes are not copied for that, so the work
   grows with the square of the others alone. First come signatures (blocks of ``BLOCK``
   classes), then the full sets of classes that still have a partner (blocks of
   ``SET_BYTES``); a block returns the links that join components, fewer than it has classes.
4. A comparison reads the signatures in batches: after n minima with m equal
   the chance of equal minima has the posterior Beta(m + 1, n - m + 1) under a
   flat prior, and a pair is dropped once P(similarity >= threshold) falls
   below ``miss``. Survivors are verified on the full sets.
5. Components of the verified links give the answer.

A pair at the threshold shares no band with probability (1 - 0.75 ** 4) ** 32,
about 5e-6, and less above it; ``miss`` adds 1e-6.

Joins of tables that grow with the input are merge joins at every size: nothing
unbounded is broadcast, and hot keys of two plain exchanges can be split.

Defined results: null or wordless texts have an empty set, no links and stay; a
text of fewer than five words is one shingle; copies and repeated rows link; a
null doc_id links like others and a component of null ids only has a null id; an empty
table gives an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.llm import words
from folioscope.llm.components import components
from folioscope.llm.shared import marked, new_folder, project, slices, small_batches, stored, tidy

SHINGLE, NUMERATOR, DENOMINATOR = 5, 75, 100
BANDS, ROWS = 32, 4
N_HASHES, BATCH, MISS = BANDS * ROWS, 16, 1e-6
#: Classes of a bucket that one block holds, and bytes of full sets.
BLOCK, SET_BYTES = 1024, 16 << 20

_random = np.random.default_rng(20260)
MULTIPLY = _random.integers(0, 1 << 32, N_HASHES, np.uint32) | np.uint32(1)
ADD = _random.integers(0, 1 << 32, N_HASHES, np.uint32)


def least_matches(threshold: float = NUMERATOR / DENOMINATOR, miss: float = MISS, batch: int = BATCH, n_hashes: int = N_HASHES, bits: int = 8) -> list[int]:
    """For n = batch, 2 batch, ...: the least number of equal minima at which a pair stays.

    Minima of which ``bits`` are kept are equal with probability s + (1 - s) / 2 ** bits at similarity s.
    """
    chance = threshold + (1 - threshold) / 2**bits

    def tail(n: int, m: int) -> float:
        # P(chance of equality >= chance | m of n) under Beta(m + 1, n - m + 1) = P(Binomial(n + 1, chance) <= m)
        return sum(math.comb(n + 1, i) * chance**i * (1 - chance) ** (n + 1 - i) for i in range(m + 1))

    return [next(m for m in range(n + 1) if tail(n, m) >= miss) for n in range(batch, n_hashes + 1, batch)]


LEAST = least_matches()


def sets(texts: pa.Array, k: int = SHINGLE) -> list[np.ndarray]:
    """The sorted shingle hashes of each text."""
    ends, codes, vocabulary = words.split(texts, words.LOWER)
    h = words.hashes(vocabulary)[codes] if len(codes) else np.zeros(0, np.uint64)
    grams = words.window_hashes(h, k)
    out = []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        out.append(np.unique(grams[a : b - k + 1]) if b - a >= k else words.window_hashes(h[a:b], b - a) if b > a else h[:0])
    return out


def minima(own: list[np.ndarray]) -> np.ndarray:
    """The least value of each hash function over each set, which must not be empty; a row for each set."""
    out = np.empty((len(own), N_HASHES), np.uint32)
    step = 1 << 16
    i = 0
    while i < len(own):
        j, n = i, 0
        while j < len(own) and (j == i or n + len(own[j]) <= step):
            n += len(own[j])
            j += 1
        x = (np.concatenate(own[i:j]) >> np.uint64(32)).astype(np.uint32)
        starts = np.concatenate([[0], np.cumsum([len(s) for s in own[i : j - 1]])]).astype(np.int64)
        v = np.empty_like(x)
        for c in range(N_HASHES):
            np.multiply(x, MULTIPLY[c], out=v)
            np.add(v, ADD[c], out=v)
            out[i:j, c] = np.minimum.reduceat(v, starts)
        i = j
    return out


def signature(least: np.ndarray) -> np.ndarray:
    """Eight bits of each minimum, mixed so that they are spread evenly."""
    return words.mix(least.astype(np.uint64)).astype(np.uint8)


def band_keys(least: np.ndarray) -> np.ndarray:
    """A key for each band of four minima, which also tells the bands apart."""
    x = least.astype(np.uint64).reshape(-1, BANDS, ROWS)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), x.shape[:2])
    for r in range(ROWS):
        h = words.mix((h * np.uint64(0x9E3779B97F4A7C15)) ^ x[:, :, r])
    return h.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            own = sets(batch.column("text"))
            some = [i for i, s in enumerate(own) if len(s)]
            least = minima([own[i] for i in some]) if some else np.zeros((0, N_HASHES), np.uint32)
            digest, sig, keys = [None] * len(own), [None] * len(own), [None] * len(own)
            for i, row, key in zip(some, signature(least), band_keys(least), strict=True):
                digest[i], sig[i], keys[i] = xxhash.xxh3_128_digest(own[i].tobytes()), row.tobytes(), key
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in own], pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "digest", "sig", "keys"],
            )


def agree(left: np.ndarray, right: np.ndarray, least: list[int] = LEAST) -> np.ndarray:
    """Which rows of two arrays of signatures survive the sequential test."""
    alive = np.arange(len(left))
    equal = np.zeros(len(left), np.int64)
    for k, m in enumerate(least):
        part = slice(k * BATCH, (k + 1) * BATCH)
        equal = equal + (left[alive, part] == right[alive, part]).sum(1)
        stay = equal >= m
        alive, equal = alive[stay], equal[stay]
        if not len(alive):
            break
    out = np.zeros(len(left), bool)
    out[alive] = True
    return out


def _rows(column: pa.Array, dtype: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def _survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield batch.select(["a", "b"]).filter(pa.array(agree(_rows(batch.column("sig_a"), np.uint8, N_HASHES), _rows(batch.column("sig_b"), np.uint8, N_HASHES))))


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(DENOMINATOR * both >= NUMERATOR * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _runs(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[dict[str, list]]:
    """The rows of each pair of blocks, which come sorted by the first ``n_keys`` columns; one pair is held at a time."""
    names, held, last = [], [], None
    for batch in batches:
        names = batch.schema.names
        for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            if row[:n_keys] != last and held:
                yield dict(zip(names, zip(*held, strict=True), strict=True))
                held = []
            last = row[:n_keys]
            held.append(row)
    if held:
        yield dict(zip(names, zip(*held, strict=True), strict=True))


def _partners(sig: np.ndarray, keys: np.ndarray, run: dict[str, list]) -> Iterator[tuple[int, np.ndarray]]:
    """(i, those j of other components that survive with it), each pair of a run once, and only in the first band that it shares. side 2: one block with itself, else 0 against 1."""
    comp, side = np.array(run["comp"]), np.array(run["side"])
    band = int((keys[0] == run["key"][0]).argmax())
    own, other = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    same = not (side != 2).any()
    for i in own.tolist():
        j = other[other > i] if same else other
        j = j[comp[j] != comp[i]]
        if len(j):
            j = j[agree(np.broadcast_to(sig[i], (len(j), N_HASHES)), sig[j])]
        if len(j):
            j = j[(keys[j] == keys[i]).argmax(1) == band]
        if len(j):
            yield i, j


#: Columns of the classes of a pair of blocks: n is the size of the set; side 0 and 1 are compared with each other, 2 among themselves.
CLOSE = ["key", "i", "j", "side", "node", "comp", "n"]


def _with_partner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each run that survive with another."""
    for run in _runs(batches, 3):
        stay = np.zeros(len(run["node"]), bool)
        for i, j in _partners(np.frombuffer(b"".join(run["sig"]), np.uint8).reshape(-1, N_HASHES), np.array(run["keys"], np.int64), run):
            stay[i] = stay[j] = True
        at = np.flatnonzero(stay)
        yield pa.RecordBatch.from_arrays([pa.array(np.array(run[c], np.int64)[at]) for c in CLOSE], names=CLOSE)


def _joining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verified links of each run that join its components, on full sets."""
    for run in _runs(batches, 5):
        own = [np.frombuffer(x, np.uint64) for x in run["set"]]
        least, node = minima(own), run["node"]
        root: dict[int, int] = {c: c for c in run["comp"]}

        def find(c: int) -> int:
            while root[c] != c:  # noqa: B023
                root[c] = c = root[root[c]]  # noqa: B023
            return c

        links = []
        for i, j in _partners(signature(least), band_keys(least), run):
            j = np.array([x for x in j.tolist() if find(run["comp"][x]) != find(run["comp"][i])], np.int64)
            if not len(j):
                continue
            sizes = np.array([len(own[x]) for x in j])
            flat = np.concatenate([own[x] for x in j])
            at = np.minimum(np.searchsorted(own[i], flat), len(own[i]) - 1)
            both = np.add.reduceat((own[i][at] == flat).astype(np.int64), np.cumsum(sizes) - sizes)
            for x in j[DENOMINATOR * both >= NUMERATOR * (sizes + len(own[i]) - both)].tolist():
                a, b = find(run["comp"][i]), find(run["comp"][x])
                if a != b:
                    root[a] = b
                    links.append((node[i], node[x]))
        pairs = np.array(links, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def full_sets(nodes: DataFrame, classes: DataFrame, documents: DataFrame, folder: str, name: str) -> DataFrame:
    """(node, set) of some classes, from the whole texts of their first documents."""
    needed = stored(nodes.join(classes.select("node", "digest", "first_id").hint("merge"), "node"), folder, f"{name}-needed")
    few = marked(documents, F.col("doc_id"), needed, "first_id").filter("__may").select("doc_id", "text")  # only these texts move
    texts = few.join(needed.hint("merge"), few["doc_id"].eqNullSafe(needed["first_id"])).select("node", "digest", "text")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                own = [s.tobytes() for s in sets(batch.column("text"))]
                right = [xxhash.xxh3_128_digest(s) == d for s, d in zip(own, batch.column("digest").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(own, pa.binary())], names=["node", "set"]).filter(pa.array(right, pa.bool_()))

    full = texts.mapInArrow(tidy(shingled), "node long, set binary")
    return stored(full.dropDuplicates(["node"]), folder, f"{name}-sets")  # repeated rows give their set again


def verified(pairs: DataFrame, classes: DataFrame, documents: DataFrame, folder: str, name: str) -> DataFrame:
    """The pairs (a, b) that survive the sequential test and whose full sets are similar enough."""
    sig = lambda c: classes.select(F.col("node").alias(c), F.col("sig").alias(f"sig_{c}")).hint("merge")
    pairs = stored(pairs.join(sig("a"), "a").join(sig("b"), "b").mapInArrow(tidy(_survivors), "a long, b long"), folder, f"{name}-survivors")
    full = full_sets(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), classes, documents, folder, name)
    side = lambda c: full.select(F.col("node").alias(c), F.col("set").alias(f"set_{c}")).hint("merge")
    return stored(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(tidy(_exact), "a long, b long"), folder, f"{name}-links")


def mixed_links(members: DataFrame, labels: DataFrame, classes: DataFrame, documents: DataFrame, folder: str) -> DataFrame:
    """Links between components that share a bucket (members: key, n, node)."""
    labelled = members.filter("n > 2").join(labels.hint("merge"), "node", "left").select("key", "n", "node", F.coalesce("label", "node").alias("comp"))
    labelled = stored(labelled, folder, "labelled")
    parts = labelled.groupBy("key", "comp").agg(F.count("*").alias("size")).groupBy("key").agg(F.max(F.struct("size", "comp")).alias("most"), F.count("*").alias("parts")).filter("parts > 1")
    mixed = stored(parts.select("key", F.col("most.comp").alias("large"), F.col("most.size").alias("size")), folder, "mixed")
    rest = labelled.join(mixed.hint("merge"), "key")
    # blocks 0 to r - 1 hold the others, r to r + l - 1 the largest component; every pair of blocks but those of the latter
    rest = rest.withColumn("r", F.ceil((F.col("n") - F.col("size")) / BLOCK)).withColumn("l", F.ceil(F.col("size") / BLOCK)).withColumn("in", F.col("comp") == F.col("large"))
    rest = rest.withColumn("at", F.when(F.col("in"), F.col("r") + F.pmod(F.xxhash64("node"), "l")).otherwise(F.pmod(F.xxhash64("node"), "r")))
    partners = F.sequence(F.lit(0).cast("long"), F.col("r") + F.when(F.col("in"), 0).otherwise(F.col("l")) - 1)
    rest = rest.select("key", "node", "comp", F.explode(F.transform(partners, lambda o: _pair(F.col("at"), o))).alias("p")).select("key", "p.i", "p.j", "p.side", "node", "comp")
    arranged = lambda d, *by: d.repartition(*by).sortWithinPartitions(*by, "side", "node")
    rest = stored(rest, folder, "rest").join(classes.select("node", "sig", "keys", F.col("n_shingles").alias("n")).hint("merge"), "node").select(*CLOSE, "sig", "keys")
    kinds = ", ".join(f"{c} long" for c in CLOSE)
    close = stored(arranged(rest, "key", "i", "j").mapInArrow(tidy(_with_partner), kinds), folder, "close")
    full = full_sets(close.select("node").distinct(), classes, documents, folder, "rest")
    close = by_bytes(close).join(full.hint("merge"), "node").select("key", "i", "j", "p", "q", "side", "node", "comp", "set")
    return stored(arranged(close, "key", "i", "j", "p", "q").mapInArrow(tidy(_joining), "a long, b long"), folder, "rest-links")


def _pair(at: Column, o: Column) -> Column:
    """The pair of blocks of a row in block ``at`` that meets block ``o``, and its side there."""
    side = F.when(at == o, 2).when(at < o, 0).otherwise(1).cast("long")
    return F.struct(F.least(at, o).alias("i"), F.greatest(at, o).alias("j"), side.alias("side"))


def by_bytes(close: DataFrame) -> DataFrame:
    """Deal the classes of each pair of blocks (key, i, j) to pairs of smaller ones (p, q), whose full sets have about ``SET_BYTES`` each."""
    pair = Window.partitionBy("key", "i", "j")
    before = Window.partitionBy("key", "i", "j", "side").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    own = close.withColumn("sub", F.floor(F.coalesce(F.sum(8 * F.col("n")).over(before), F.lit(0)) / SET_BYTES).cast("long"))
    own = own.withColumns({f"last{k}": F.max(F.when(F.col("side") == k, F.col("sub"))).over(pair) for k in (0, 1, 2)})
    others = lambda k: F.sequence(F.lit(0).cast("long"), F.col(f"last{k}"))
    as_pair = lambda p, q: F.struct(p.alias("i"), q.alias("j"), F.col("side").alias("side"))
    dealt = (
        F.when(F.col("side") == 0, F.transform(others(1), lambda o: as_pair(F.col("sub"), o)))
        .when(F.col("side") == 1, F.transform(others(0), lambda o: as_pair(o, F.col("sub"))))
        .otherwise(F.transform(others(2), lambda o: _pair(F.col("sub"), o)))
    )
    return own.select("key", "i", "j", "node", "comp", F.explode(dealt).alias("x")).select("key", "i", "j", F.col("x.i").alias("p"), F.col("x.j").alias("q"), "x.side", "node", "comp")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row."""
    spark = documents.sparkSession
    small_batches(spark)
    folder = new_folder(spark, "near-dedup")
    documents = project(documents, "doc_id", "text")
    kind = dict(documents.dtypes)["doc_id"]
    rows = stored(documents.mapInArrow(tidy(_sign), f"doc_id {kind}, n_shingles long, digest binary, sig binary, keys array<long>"), folder, "rows")
    classes = rows.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"), F.first("keys").alias("keys"))
    classes = stored(classes.select(F.monotonically_increasing_id().alias("node"), "digest", "first_id", "n_shingles", "sig", "keys"), folder, "classes")

    bands = classes.select("node", F.explode("keys").alias("key"))
    buckets = stored(bands.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), folder, "buckets")
    members = stored(bands.join(buckets.hint("merge"), "key"), folder, "members")
    met = members.withColumn("met", F.sum(F.col("n") - 1).over(Window.partitionBy("node")))  # a node has a row for each band at most
    leaders = met.groupBy("key").agg(F.max(F.struct("met", "node")).alias("leader"))
    leaders = stored(leaders.select("key", F.col("leader.node").alias("a")), folder, "leaders")
    star = members.join(leaders.hint("merge"), "key").select("a", F.col("node").alias("b")).filter("a <> b").distinct()
    links = verified(star, classes, documents, folder, "star")
    labels = components(links, folder, "star-cc")
    more = mixed_links(members, labels, classes, documents, folder)
    if not more.isEmpty():
        labels = components(links.union(more), folder)

    named = classes.join(labels.hint("merge"), "node", "left").select("digest", "first_id", F.coalesce("label", "node").alias("label"))
    named = stored(named, folder, "named")
    least = stored(named.groupBy("label").agg(F.min("first_id").alias("component_id")), folder, "least")
    answer = stored(named.join(least.hint("merge"), "label").select("digest", "component_id"), folder, "answer")
    out = rows.select("doc_id", "n_shingles", "digest").join(answer.hint("merge"), "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
