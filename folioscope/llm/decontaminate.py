"""Benchmark decontamination over a distributed positional inverted index.

``build`` writes the index: each row is a segment, the inverted index of a few
megabytes of documents, with the sorted positions of every token. Segments are
independent, so no posting is shuffled and a lost one is built again from its
documents. ``prepare`` writes the benchmark's distinct windows of term codes to files of
``BLOCK_WINDOWS`` windows. ``search`` opens a few segments and one such block at a time: windows
with a term that the segment lacks go in one vectorised step, and for each of the
others the postings of its rarest term are intersected with those of the next rarer
ones, each adjusted by the term's offset.

Words are runs of ASCII letters and digits and of all other non-ASCII
characters, after A-Z are put in lower case.

Defined results: null or wordless texts have no words and no hits; items without
words match nothing; an item of fewer words than a window is one window; rows
with a null item_id hit, but are not counted or listed as items; repeated items
count once, repeated documents each give a row; an empty table on either side
gives no hits; other columns are not read.
"""

from __future__ import annotations

import functools
import io
import itertools
import json
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm import words
from folioscope.llm.shared import file_system, new_folder, project, publish, slices, small_batches, stored, tidy

WINDOW = 10
#: Windows of the benchmark, and segments of the index, that a worker holds at once.
BLOCK_WINDOWS, SEGMENTS = 400_000, 4


def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _unpack(data: bytes, dtype: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, n = TaskContext.get().partitionId(), 0
    for whole in batches:
        for batch in slices(whole, "text"):
            ends, codes, vocabulary = words.split(batch.column("text"), words.ALNUM)
            order = np.argsort(codes.astype(np.uint32), kind="stable").astype(np.int32)  # positions by term, ascending in each
            starts = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(vocabulary)))]).astype(np.int32)
            gaps = np.diff(order, prepend=np.int32(0))
            terms = zstandard.ZstdCompressor(level=1).compress(" ".join(vocabulary.to_pylist()).encode())
            ids = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("doc_id"))
            columns = [pa.array([(task << 33) + n], pa.int64()), ids, *[pa.array([x], pa.binary()) for x in (_pack(ends.astype(np.int32)), terms, _pack(starts), _pack(gaps))]]
            yield pa.RecordBatch.from_arrays(columns, names=["segment", "doc_ids", "ends", "terms", "starts", "gaps"])
            n += 1


def build(documents: DataFrame, folder: str) -> DataFrame:
    """The index of all tokens of ``documents`` (doc_id, text), written below ``folder``."""
    kind = dict(documents.dtypes)["doc_id"]
    schema = f"segment long, doc_ids array<{kind}>, ends binary, terms binary, starts binary, gaps binary"
    return stored(project(documents, "doc_id", "text").mapInArrow(tidy(_segments), schema), folder, "index")


class Segment:
    """One row of the index, opened; its postings are read when they are first asked for."""

    def __init__(self, doc_ids: list, ends: bytes, terms: bytes, starts: bytes, gaps: bytes) -> None:
        self.doc_ids, self.ends, self.starts, self.gaps = doc_ids, _unpack(ends, np.int32), _unpack(starts, np.int32), gaps
        text = zstandard.ZstdDecompressor().decompress(terms).decode()
        self.terms = pa.array(text.split(" ") if text else [], pa.large_string())

    @functools.cached_property
    def positions(self) -> np.ndarray:
        return np.cumsum(_unpack(self.gaps, np.int32), dtype=np.int32)

    def codes(self, vocabulary: pa.Array) -> np.ndarray:
        """The segment's code of each term; -1 for those that don't occur."""
        return pc.fill_null(pc.index_in(vocabulary, value_set=self.terms), -1).to_numpy(zero_copy_only=False)

    def lists(self, codes: np.ndarray) -> list[np.ndarray]:
        """The postings of terms that occur, by code."""
        return [self.positions[self.starts[c] : self.starts[c + 1]] for c in codes.tolist()]

    def phrase(self, lists: list[np.ndarray], slop: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents (by number) and spans (start, end) of a phrase; lists: the postings of its terms in order.

        slop: how far each term may lie from its place; spans grow by as many, within the document.
        """
        sizes = [len(x) for x in lists]
        rarest, *others = sorted(range(len(lists)), key=sizes.__getitem__)
        place = lists[rarest]
        document = np.searchsorted(self.ends, place, "right") - 1
        at, first, last = place - rarest, self.ends[document], self.ends[document + 1]
        for o in others:
            if not len(at):
                break
            found = lists[o]
            least, most = np.maximum(at + (o - slop), first), np.minimum(at + (o + slop), last - 1)
            k = np.searchsorted(found, least)
            stay = (k < len(found)) & (found[np.minimum(k, len(found) - 1)] <= most)
            at, first, last, document = at[stay], first[stay], last[stay], document[stay]
        return document, np.maximum(at - slop, first), np.minimum(at + len(lists) + slop, last)


class Block(NamedTuple):
    """Some windows of the benchmark: its terms, its items' ids, and for each length the windows (term codes) and who owns them."""

    terms: pa.Array
    ids: list[str | None]
    windows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # rows of codes; where each row's owners start, and the end; owners


def _saved(terms: list[str], ids: list[str | None], parts: dict[int, list[tuple[np.ndarray, int]]]) -> bytes:
    """A block as a file."""
    out = {"terms": np.frombuffer(" ".join(terms).encode(), np.uint8), "ids": np.frombuffer(json.dumps(ids).encode(), np.uint8), "lengths": np.array(sorted(parts))}
    for n, own in parts.items():
        rows, which = np.unique(np.concatenate([w for w, _ in own]), axis=0, return_inverse=True)
        pairs = np.unique(np.stack([which.ravel(), np.repeat([o for _, o in own], [len(w) for w, _ in own])], 1), axis=0)
        out |= {f"rows{n}": rows, f"starts{n}": np.searchsorted(pairs[:, 0], np.arange(len(rows) + 1)), f"owners{n}": pairs[:, 1]}
    sink = io.BytesIO()
    np.savez(sink, **out)
    return sink.getvalue()


@functools.lru_cache(1)
def opened(path: str) -> Block:
    fs, own = file_system(path)
    with fs.open_input_stream(own) as source:
        data = np.load(io.BytesIO(source.read()))
    text = data["terms"].tobytes().decode()
    return Block(pa.array(text.split(" ") if text else [], pa.large_string()), json.loads(data["ids"].tobytes()), [tuple(data[f"{x}{n}"] for x in ("rows", "starts", "owners")) for n in data["lengths"].tolist()])


def prepare(benchmark: DataFrame, folder: str, k: int = WINDOW, limit: int = BLOCK_WINDOWS) -> list[str]:
    """Write the windows of ``benchmark`` (item_id, text) to files of about ``limit`` windows each; returns their paths, which are all that the driver holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms: dict[str, int] = {}
        ids: list[str | None] = []
        parts: dict[int, list[tuple[np.ndarray, int]]] = {}
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal terms, ids, parts, size
            name, data = f"block-{uuid.uuid4().hex}.npz", _saved(list(terms), ids, parts)
            publish(folder, name, lambda sink: sink.write(data))
            terms, ids, parts, size = {}, [], {}, 0
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"])], names=["file"])

        for whole in batches:
            for batch in slices(whole, "text"):
                ends, codes, vocabulary = words.split(batch.column("text"), words.ALNUM)
                vocabulary, items = vocabulary.to_pylist(), batch.column("item_id").to_pylist()
                for item, a, b in zip(items, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                    n = min(k, b - a)
                    last = b - n + 1 if n else a
                    while a < last:  # an item can go on in the next block
                        stop = min(last, a + max(1, limit - size))
                        own = np.array([terms.setdefault(vocabulary[c], len(terms)) for c in codes[a : stop + n - 1].tolist()], np.int32)
                        ids.append(item)
                        parts.setdefault(n, []).append((np.lib.stride_tricks.sliding_window_view(own, n), len(ids) - 1))
                        size += stop - a
                        a = stop
                        if size >= limit:
                            yield close()
        if size:
            yield close()

    own = project(benchmark, "item_id", "text").withColumn("item_id", F.col("item_id").cast("string"))
    return sorted(r["file"] for r in own.mapInArrow(tidy(run), "file string").collect())


class _Hits:
    """What windows cover of a segment, and the items that occur in each of its documents."""

    def __init__(self, segment: Segment) -> None:
        self.segment = segment
        self.marks = np.zeros(int(segment.ends[-1]) + 1, np.int32)
        self.items: list[set[str]] = [set() for _ in segment.doc_ids]

    def add(self, block: Block, slop: int) -> None:
        codes = self.segment.codes(block.terms)
        there = codes >= 0
        for rows, starts, owners in block.windows:
            alive = np.arange(len(rows))
            for c in range(rows.shape[1]):
                alive = alive[there[rows[alive, c]]]
            for w in alive.tolist():
                document, begin, end = self.segment.phrase(self.segment.lists(codes[rows[w]]), slop)
                if len(document):
                    np.add.at(self.marks, begin, 1)
                    np.add.at(self.marks, end, -1)
                    names = {block.ids[o] for o in owners[starts[w] : starts[w + 1]].tolist()} - {None}
                    for d in set(document.tolist()):
                        self.items[d] |= names

    def spans(self) -> list[list[dict]]:
        ends, out = self.segment.ends, [[] for _ in self.items]
        edges = np.flatnonzero(np.diff((np.cumsum(self.marks) > 0).astype(np.int8), prepend=0, append=0))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            for d in range(int(np.searchsorted(ends, a, "right")) - 1, int(np.searchsorted(ends, b, "left"))):
                e0, e1 = int(ends[d]), int(ends[d + 1])  # covers of neighbours can touch at their border
                if e1 > e0:
                    out[d].append({"start": max(a, e0) - e0, "end": min(b, e1) - e0})
        return out


def search(index: DataFrame, benchmark: DataFrame, folder: str, k: int = WINDOW, slop: int = 0, limit: int = BLOCK_WINDOWS) -> DataFrame:
    """doc_id, n_words, spans (disjoint, in words), n_hit, items (sorted) of every indexed document; the benchmark's blocks go below ``folder``.

    slop 0: exact phrases. Else proximity: each term may lie up to so many words
    from its place, and the span grows by as many on either side.
    """
    files = prepare(benchmark, f"{folder}/benchmark", k, limit)
    columns = ("doc_ids", "ends", "terms", "starts", "gaps")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((row, batch.schema.field("doc_ids").type.value_type) for batch in batches for row in batch.to_pylist())
        while some := list(itertools.islice(rows, SEGMENTS)):
            found = [_Hits(Segment(*(row[c] for c in columns))) for row, _ in some]
            for path in files:
                block = opened(path)
                for hits in found:
                    hits.add(block, slop)
            for hits, (_, kind) in zip(found, some, strict=True):
                spans = hits.spans()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hits.segment.doc_ids, kind), pa.array(np.diff(hits.segment.ends), pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                        pa.array([sum(s["end"] - s["start"] for s in own) for own in spans], pa.int64()), pa.array([sorted(x) for x in hits.items], pa.list_(pa.string())),
                    ],
                    names=["doc_id", "n_words", "spans", "n_hit", "items"],
                )

    kind = dict(index.dtypes)["doc_ids"][6:-1]
    return index.select(*columns).mapInArrow(tidy(run), f"doc_id {kind}, n_words long, spans array<struct<start:int,end:int>>, n_hit long, items array<string>")


def decontaminate(documents: DataFrame, benchmark: DataFrame, k: int = WINDOW, slop: int = 0, limit: int = BLOCK_WINDOWS) -> DataFrame:
    """Index the documents and search the benchmark in them."""
    spark = documents.sparkSession
    small_batches(spark)
    folder = new_folder(spark, "positions")
    return search(build(documents, folder), benchmark, folder, k, slop, limit)
