"""SentencePiece encoding and decoding of byte-pair models, with a parallel scan for giant texts.

A sequence of pieces is the model's encoding of a text if and only if every
piece encodes to itself and every two neighbours encode to just these two. So
the encoding is the one path of weight 0 through the lattice of pieces, where an
allowed step weighs 0 and another minus infinity, and the max-plus product of
the steps' matrices is associative.

Texts of up to ``GIANT`` characters are encoded in one piece of work, each
distinct word once. Longer ones are cut into chunks of ``CHUNK`` characters at
any place. A state of a boundary is a piece that starts before it and ends at or
after it. Each chunk yields, on its own, the matrix from the states of its left to those
of its right boundary. The matrices of a text are combined in a tree: a task multiplies
``FAN`` neighbours at a time, level by level, until a text has no more than that; there
the best states at the boundaries are chosen, and each level below chooses those inside
of its groups, by a scan in both directions. Then each chunk traces its own part of the
path back. So no task gets all chunks of a text, however long it is. Inside a chunk,
places between two characters that stand side by side in no piece part the lattice, and
what lies between two such places is encoded by the merges themselves.

Defined results: a null or empty text has no ids; characters without a piece
become their UTF-8 bytes; U+2581 in a text decodes as a space, so it alone
fails the round trip; a null doc_id and repeated rows each give a row; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm import words
from folioscope.llm.shared import new_folder, project, slices, small_batches, stored, tidy

GIANT, CHUNK, FAN = 40_000, 8_192, 64
SPACE = "▁"
#: Stand for a line end, and for a word without a space before it; texts that hold them are encoded whole.
LINE, BARE = "\x01", "\x02"
REMEMBERED, TEXT_BYTES = 150_000, 3 << 20
BYTES = re.compile(r"<0x([0-9A-F]{2})>")


class Pieces:
    """A model's vocabulary."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        self.names = [m.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (m.is_control(i) or m.is_byte(i) or m.is_unknown(i) or m.is_unused(i))]
        self.ids = {self.names[i]: i for i in plain}
        self.rank = {self.names[i]: m.get_score(i) for i in plain}
        self.byte = {int(BYTES.fullmatch(self.names[i])[1], 16): i for i in range(n) if m.is_byte(i)}
        self.unknown = m.unk_id()
        self.longest = max(map(len, self.ids), default=1)
        self.joined = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}  # two characters that some piece holds side by side
        self.line_parts = not any("\n" in p for p in self.ids)
        self.space_parts = not any(x[1] == SPACE != x[0] for x in self.joined)
        raw = [bytes([int(BYTES.fullmatch(p)[1], 16)]) if m.is_byte(i) else b"" if m.is_control(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(self.names)]
        self.size = np.array([len(x) for x in raw])
        self.begin = np.cumsum(self.size) - self.size
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self._merged: dict[str, tuple[str, ...]] = {}
        self._pair: dict[tuple[str, str], bool] = {}

    def merges(self, text: str) -> tuple[str, ...]:
        """The symbols of a short text after all merges: best score first, then leftmost."""
        found = self._merged.get(text)
        if found is None:
            s = list(text)
            while len(s) > 1:
                best = max(((self.rank[a + b], -i) for i, (a, b) in enumerate(zip(s, s[1:], strict=False)) if a + b in self.rank), default=None)
                if best is None:
                    break
                s[-best[1] : 2 - best[1]] = [s[-best[1]] + s[1 - best[1]]]
            found = tuple(s)
            if len(self._merged) > REMEMBERED:
                self._merged.clear()
            self._merged[text] = found
        return found

    def follows(self, a: str, b: str) -> bool:
        """Whether b may stand after a; a is empty at the start of a text."""
        if not a:
            return self.merges(b) == (b,)
        if a[-1] + b[0] not in self.joined:
            return self.merges(b) == (b,)
        found = self._pair.get((a, b))
        if found is None:
            if len(self._pair) > REMEMBERED:
                self._pair.clear()
            found = self._pair[a, b] = self.merges(b) == (b,) and self.merges(a + b) == (a, b)
        return found

    def numbers(self, symbols: Iterator[str]) -> list[int]:
        out: list[int] = []
        for s in symbols:
            if s in self.ids:
                out.append(self.ids[s])
            elif self.byte:
                out += [self.byte[b] for b in s.encode()]
            else:
                out.append(self.unknown)
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The UTF-8 bytes of a text."""
        if not len(ids):
            return b""
        n = self.size[ids]
        out = self.raw[np.arange(n.sum()) + np.repeat(self.begin[ids] - (np.cumsum(n) - n), n)].tobytes()
        return out.removeprefix(b" ")  # the space that encoding puts before a text


class Encoder:
    """Encodes batches of texts; remembers the ids of words."""

    def __init__(self, pieces: Pieces) -> None:
        self.p = pieces
        self.parts = pieces.line_parts and pieces.space_parts
        self.memo = words.Memo(self._fresh, REMEMBERED)

    def _fresh(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        model = self.p.model
        skip = len(model.encode("\n"))  # a bare word is encoded after a line end
        sizes, ids = [], []
        for i in range(0, len(found), 20_000):
            part = found[i : i + 20_000]
            coded = model.encode(["\n" + w[1:] if w[:1] == BARE else w for w in part], num_threads=1)
            own = [self.p.numbers("\n") if w == LINE else x[skip:] if w[:1] == BARE else x for w, x in zip(part, coded, strict=True)]
            sizes += map(len, own)
            ids.append(np.fromiter(itertools.chain.from_iterable(own), np.uint32))
        return np.array(sizes, np.int64), np.concatenate([*ids, np.zeros(0, np.uint32)])

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, f"^ |  | \n| $|^$|[{LINE}{BARE}{SPACE}]").to_numpy(zero_copy_only=False) if self.parts else np.ones(len(texts), bool)
        odd = odd | pc.starts_with(texts, "\n").to_numpy(zero_copy_only=False)  # a text that starts with a line end has a lone space before it
        usual = np.flatnonzero(~odd)
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        if len(usual):
            listed = pc.split_pattern(pc.replace_substring(texts.take(pa.array(usual)), "\n", f" {LINE} {BARE}"), " ")
            flat = listed.flatten().dictionary_encode()
            ends = np.asarray(listed.offsets, np.int64)
            total, ids = self.memo.expand(flat.dictionary.to_pylist(), flat.indices.to_numpy(zero_copy_only=False))
            at = total[ends - ends[0]]
            for i, a, b in zip(usual.tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                out[i] = ids[a:b]
        for i in np.flatnonzero(odd).tolist():
            out[i] = np.array(self.p.model.encode(texts[i].as_py()), np.uint32)
        return out


# The scan. Positions are places between characters of the normal form; a state is (start, end).

BEGIN = (-1, 0)


def normal(text: str) -> str:
    """The form that pieces are matched with."""
    return SPACE + text.replace(" ", SPACE)


def states(p: Pieces, text: str, at: int, n: int, base: int) -> list[tuple[int, int]]:
    """The states of the boundary at ``at`` of a text of n characters, of which ``text`` starts at ``base``."""
    if at <= 0:
        return [BEGIN]
    out = []
    for a in range(max(0, at - p.longest), at):
        for b in range(at, min(n, a + p.longest) + 1):
            piece = text[a - base : b - base]
            if (b == at if at >= n else True) and (len(piece) == 1 or piece in p.ids) and p.merges(piece) == (piece,):
                out.append((a, b))
    return out


class Chunk:
    """The lattice of one chunk [left, right) of a text of n characters; ``text`` holds it with a margin on both sides."""

    def __init__(self, p: Pieces, text: str, base: int, left: int, right: int, n: int) -> None:
        self.p, self.text, self.base, self.right, self.n = p, text, base, right, n
        self.sources, self.targets = states(p, text, left, n, base), states(p, text, right, n, base)
        last = max((b for _, b in self.sources), default=left)
        cuts = [i for i in range(max(last, 1), right) if self.cut(i)] if self.sources else []
        self.inner = (cuts[0], cuts[-1]) if cuts else None

    def cut(self, i: int) -> bool:
        return self.text[i - 1 - self.base : i + 1 - self.base] not in self.p.joined

    def name(self, state: tuple[int, int]) -> str:
        return self.text[max(0, state[0] - self.base) : state[1] - self.base] if state != BEGIN else ""

    def paths(self, sources: list[tuple[int, int]], stop: int) -> dict[tuple[int, int], dict]:
        """Pieces that paths reach, with the sources (bits) that reach them and the pieces before; those that start at ``stop`` or later are not made."""
        made: dict[tuple[int, int], dict] = {s: {"from": 1 << i, "before": []} for i, s in enumerate(sources)}
        ending: dict[int, list[tuple[int, int]]] = {}
        for s in sources:
            ending.setdefault(s[1], []).append(s)
        for a in range(min(ending, default=stop), stop):
            before = ending.pop(a, ())
            if not before:
                continue
            for b in range(a + 1, min(self.n, a + self.p.longest) + 1):
                piece = self.text[a - self.base : b - self.base]
                if b > a + 1 and piece not in self.p.ids:
                    continue
                good = [s for s in before if self.p.follows(self.name(s), piece)]
                if good:
                    own = made[a, b] = {"from": 0, "before": good}
                    for s in good:
                        own["from"] |= made[s]["from"]
                    ending.setdefault(b, []).append((a, b))
        return made

    def _sides(self) -> tuple[dict, dict]:
        first, last = self.inner
        # at the last parting place one path goes on, whatever came before
        return self.paths(self.sources, first), self.paths([(last - 1, last)], self.right) if last < self.right else {}

    def matrix(self) -> np.ndarray:
        """Max-plus weights from each source to each target."""
        out = np.full((len(self.sources), len(self.targets)), -np.inf, np.float32)
        if self.inner:
            head, tail = self._sides()
            there = 0
            for (_, b), x in head.items():
                if b == self.inner[0]:
                    there |= x["from"]
            to = np.array([tail[t]["from"] if t in tail else 0 for t in self.targets], bool)
            come = np.array([there >> i & 1 for i in range(len(self.sources))], bool)
            out[np.ix_(come, to)] = 0
        else:
            made = self.paths(self.sources, self.right)
            for j, t in enumerate(self.targets):
                if t in made:
                    for i in range(len(self.sources)):
                        if made[t]["from"] >> i & 1:
                            out[i, j] = 0
        return out

    def _back(self, made: dict, source: tuple[int, int], end: tuple[int, int]) -> list[str]:
        out = []
        while end != source:
            out.append(self.name(end))
            end = next(s for s in made[end]["before"] if made[s]["from"])
        return out[::-1]

    def trace(self, source: int, target: int) -> list[int]:
        """Ids of the pieces that start in this chunk, on the path from one state to the other."""
        start, end = self.sources[source], self.targets[target]
        if not self.inner:
            return self.p.numbers(self._back(self.paths([start], self.right), start, end))
        first, last = self.inner
        head = self.paths([start], first)
        near = next((s for s, x in head.items() if s[1] == first and x["from"]), start)
        middle, a = [], first
        for b in [i for i in range(first + 1, last + 1) if i == last or self.cut(i)] if last > first else []:
            middle += self.p.merges(self.text[a - self.base : b - self.base])
            a = b
        stub = (last - 1, last)
        return self.p.numbers([*self._back(head, start, near), *middle, *self._back(self.paths([stub], self.right), stub, end)])


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of two matrices."""
    return (a[:, :, None] + b[None, :, :]).max(1, initial=-np.inf)


def scan(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """Products of all prefixes, in a tree of depth log n."""
    out, step = list(matrices), 1
    while step < len(out):
        out = [product(out[i - step], m) if i >= step else m for i, m in enumerate(out)]
        step *= 2
    return out


def route(matrices: list[np.ndarray], source: int = 0, target: int | None = None) -> list[int]:
    """The state at each boundary on the best path from a state of the first to one of the last, or to the best."""
    before = scan([m if i else m[source : source + 1] for i, m in enumerate(matrices)])
    own = [*matrices[:-1], matrices[-1] if target is None else matrices[-1][:, target : target + 1]]
    after = [m.T for m in scan([m.T for m in reversed(own)])][::-1]
    return [source, *[int(np.argmax(b[0] + after[i + 1].max(1))) for i, b in enumerate(before[:-1])], int(np.argmax(before[-1][0])) if target is None else target]


def _packed(matrix: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(matrix).tobytes())


def _opened(rows: list[dict]) -> list[np.ndarray]:
    return [np.frombuffer(zlib.decompress(r["matrix"]), np.float32).reshape(-1, r["width"]) for r in rows]


def _product(table: pa.Table) -> pa.Table:
    """The product of a group's matrices, as one of the level above."""
    rows = sorted(table.to_pylist(), key=lambda r: r["k"])
    whole = functools.reduce(product, _opened(rows))
    return pa.table({"uid": [rows[0]["uid"]], "k": [rows[0]["parent"]], "width": [whole.shape[1]], "matrix": [_packed(whole)]})


def _ways(table: pa.Table) -> pa.Table:
    """Source and target of each of a group's matrices, from those of the whole group; a null target is the best."""
    rows = sorted(table.to_pylist(), key=lambda r: r["k"])
    way = route(_opened(rows), rows[0]["source"], rows[0]["target"])
    return pa.table({"uid": [r["uid"] for r in rows], "k": [r["k"] for r in rows], "source": way[:-1], "target": way[1:]})


def ways(matrices: DataFrame, most: int, folder: str, fan: int = FAN) -> DataFrame:
    """(uid, k, source, target): the states that the best path of each text has at the ends of each chunk; matrices: uid, k, width, matrix, ``most`` of a text at most."""
    levels = [matrices]
    parent = F.floor(F.col("k") / fan).cast("long")
    while most > fan:
        up = levels[-1].withColumn("parent", parent).groupBy("uid", "parent").applyInArrow(_product, "uid long, k long, width long, matrix binary")
        levels.append(stored(up, folder, f"level-{len(levels)}"))
        most = -(-most // fan)
    found = None
    for level in reversed(range(len(levels))):
        own = levels[level].withColumn("parent", parent)
        if found is None:
            own = own.withColumns({"source": F.lit(0).cast("long"), "target": F.lit(None).cast("long")})
        else:
            own = own.join(found.withColumnRenamed("k", "parent"), ["uid", "parent"])
        found = stored(own.groupBy("uid", "parent").applyInArrow(_ways, "uid long, k long, source long, target long"), folder, f"ways-{level}")
    return found


def _cut(chunk: int, margin: int, kind: pa.DataType):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                full, n, crc = normal(text), n + 1, zlib.crc32(text.encode())
                count = -(-len(full) // chunk)
                for k in range(count):
                    base = max(0, k * chunk - margin)
                    part = full[base : (k + 1) * chunk + margin]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([(task << 33) + n]), pa.array([doc_id], kind), pa.array([crc]), pa.array([k]), pa.array([base]), pa.array([len(full)]), pa.array([part])],
                        names=["uid", "doc_id", "crc", "k", "base", "n", "part"],
                    )

    return run


def _chunk(p: Pieces, row: dict, chunk: int) -> Chunk:
    left = row["k"] * chunk
    return Chunk(p, row["part"], row["base"], left, min(left + chunk, row["n"]), row["n"])


def encode(documents: DataFrame, path: str, giant: int = GIANT, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """doc_id, ids (array), ids_crc32 (of the ids as little-endian 32-bit numbers), n_chunks and round_trip (the ids decode to the text) of each document."""
    spark = documents.sparkSession
    small_batches(spark)
    documents = project(documents, "doc_id", "text")
    kind = dict(documents.dtypes)["doc_id"]
    crcs = lambda own: pa.array([zlib.crc32(np.asarray(x).astype("<u4").tobytes()) for x in own], pa.int64())

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(Pieces(path))
        for whole in batches:
            for batch in slices(whole, "text", TEXT_BYTES):
                own = coder.encode(batch.column("text"))
                plain = pc.fill_null(batch.column("text"), "").cast(pa.binary())
                same = [coder.p.decode(x) == t.as_py() for x, t in zip(own, plain, strict=True)]
                ends = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int32))
                flat = pa.array(np.concatenate([*own, np.zeros(0, np.uint32)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(ends, flat), crcs(own), pa.array(np.ones(len(own), np.int64)), pa.array(same, pa.bool_())], names=["doc_id", "ids", "ids_crc32", "n_chunks", "round_trip"])

    schema = f"doc_id {kind}, ids array<int>, ids_crc32 long, n_chunks long, round_trip boolean"
    long = F.length("text") > giant
    usual = documents.filter(~F.coalesce(long, F.lit(False))).mapInArrow(tidy(small), schema)

    folder = new_folder(spark, "pieces")
    longest = Pieces(path).longest
    own_kind = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    cut = _cut(chunk, longest + 1, own_kind)
    chunks = stored(documents.filter(long).mapInArrow(tidy(cut), f"uid long, doc_id {kind}, crc long, k long, base long, n long, part string"), folder, "chunks")

    def transfer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Pieces(path)
        for batch in batches:
            rows = batch.to_pylist()
            made = [_chunk(p, r, chunk).matrix() for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), batch.column("k"), pa.array([m.shape[1] for m in made], pa.int64()), pa.array([_packed(m) for m in made], pa.binary())],
                names=["uid", "k", "width", "matrix"],
            )

    matrices = stored(chunks.repartition("uid", "k").mapInArrow(tidy(transfer), "uid long, k long, width long, matrix binary"), folder, "matrices")

    most = chunks.agg(F.max("k")).first()[0]
    chosen = ways(matrices, 0 if most is None else most + 1, folder, fan)

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Pieces(path)
        for batch in batches:
            rows = batch.to_pylist()
            own = [np.array(_chunk(p, r, chunk).trace(r["source"], r["target"]), np.int32) for r in rows]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("uid", "doc_id", "crc", "k")], pa.array(own, pa.list_(pa.int32()))], names=["uid", "doc_id", "crc", "k", "ids"])

    own = chunks.join(chosen, ["uid", "k"]).select("uid", "doc_id", "crc", "k", "part", "base", "n", "source", "target")
    traced = stored(own.mapInArrow(tidy(trace), f"uid long, doc_id {kind}, crc long, k long, ids array<int>"), folder, "traced")
    whole = traced.groupBy("uid", "doc_id", "crc").agg(F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("x"))
    whole = whole.select("doc_id", F.flatten(F.col("x.ids")).alias("ids"), F.size("x").cast("long").alias("n_chunks"), "crc")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Pieces(path)
        for batch in batches:
            own = [np.array(x, np.int64) for x in batch.column("ids").to_pylist()]
            same = [zlib.crc32(p.decode(x)) == c for x, c in zip(own, batch.column("crc").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), crcs(own), batch.column("n_chunks"), pa.array(same, pa.bool_())], names=["doc_id", "ids", "ids_crc32", "n_chunks", "round_trip"])

    return usual.union(whole.mapInArrow(tidy(check), schema))
