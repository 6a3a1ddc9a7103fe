"""Token ids in files of independent, interleaved range-asymmetric-numeral-system blocks.

A data set is a folder with ``frequencies.bin`` (the shared static table) and
files ``part-NNNNNNN.rans`` in ascending doc_id order; the table ``list`` beside them tells which ids
each starts at. A file holds

    magic "FRANS1\\0\\0", then blocks, then a footer and its length (8 bytes)

A block codes up to ``BLOCK`` ids in ``LANES`` interleaved states; it starts with
the states (64 bits each), and 32-bit words follow in the order of decoding. The
footer (JSON) is the list of checkpoints: for each block its offset, length, number of ids
and two CRC-32, of the coded bytes and of the ids; and the lists of doc ids and
lengths. Any block can be decoded alone, so readers can start at any checkpoint.

Frequencies are scaled to sum to 2 ** SCALE, at least 1 for each id that occurs.

Defined results: a null or empty text has the end id only; a null doc_id sorts
first; equal doc_ids keep one order, by the CRC of their ids; an empty table
gives no files and an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.llm import words
from folioscope.llm.shared import file_system, new_folder, project, publish, slices, small_batches, stored, tidy

MAGIC, FREQUENCIES = b"FRANS1\0\0", "frequencies.bin"
SCALE, LANES, BLOCK = 18, 512, 1 << 17
LOW = np.uint64(1 << 31)
#: Bytes of text that the tokenizer takes at once.
TEXT_BYTES = 8 << 20
#: Least bytes of input table for one file.
PART_BYTES = 8 << 20


def scaled(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Frequencies that sum to 2 ** scale, in proportion to the counts, at least 1 where a count is."""
    total, some = counts.sum(), np.flatnonzero(counts)
    if not len(some):
        return np.zeros(len(counts), np.int64)
    if len(some) > 1 << scale:
        raise ValueError("more ids than the scale has room for")
    out = np.zeros(len(counts), np.int64)
    out[some] = np.maximum(1, (counts[some].astype(np.float64) * (1 << scale) / total).astype(np.int64))
    order = some[np.argsort(-out[some], kind="stable")]
    left = (1 << scale) - int(out.sum())
    if left > 0:
        out[order[0]] += left
    while left < 0:  # the largest give, in turns, what the least were raised by
        give = np.minimum(out[order] // 2, np.maximum(1, (-left) * out[order] // out[order].sum()))
        give = np.minimum(give, np.maximum(0, -left - (np.cumsum(give) - give)))
        out[order] -= give
        left += int(give.sum())
    return out


class Coder:
    """Codes blocks with one table of frequencies."""

    def __init__(self, frequencies: np.ndarray) -> None:
        self.f = frequencies.astype(np.uint64)
        self.c = np.concatenate([[0], np.cumsum(frequencies)[:-1]]).astype(np.uint64)
        self.of = np.repeat(np.arange(len(frequencies), dtype=np.uint32), frequencies)
        self.most = self.f << np.uint64(63 - SCALE)

    def encode(self, ids: np.ndarray) -> bytes:
        """States, then words. Ids are dealt to the lanes in rows; the last row may be short."""
        x = np.full(LANES, LOW, np.uint64)
        out, n = [], len(ids)
        for start in range((n - 1) // LANES * LANES, -1, -LANES):
            row = ids[start : start + LANES]
            y, f = x[: len(row)], self.f[row]
            full = y >= self.most[row]
            out.append((y[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            y = np.where(full, y >> np.uint64(32), y)
            q = y // f
            x[: len(row)] = (q << np.uint64(SCALE)) + (y - q * f) + self.c[row]
        return x.astype("<u8").tobytes() + b"".join(w.tobytes() for w in reversed(out))

    def decode(self, data: bytes, n: int) -> np.ndarray:
        x = np.frombuffer(data, "<u8", LANES).astype(np.uint64)
        more = np.frombuffer(data, "<u4", offset=8 * LANES)
        out, at, mask = np.empty(n, np.uint32), 0, np.uint64((1 << SCALE) - 1)
        for start in range(0, n, LANES):
            y = x[: min(LANES, n - start)]
            slot = y & mask
            row = self.of[slot]
            out[start : start + LANES] = row
            y = self.f[row] * (y >> np.uint64(SCALE)) + slot - self.c[row]
            low = np.flatnonzero(y < LOW)
            y[low] = (y[low] << np.uint64(32)) | more[at : at + len(low)]
            at += len(low)
            x[: len(y)] = y
        return out


def write_file(coder: Coder, doc_ids: list, sequences: Iterator[np.ndarray], sink) -> tuple[int, int]:  # noqa: ANN001
    """Write a file to an open sink; returns its documents and ids. Holds one block and one document at a time."""
    at, checkpoints, lengths = len(MAGIC), [], []
    sink.write(MAGIC)
    held: list[np.ndarray] = []

    def close(ids: np.ndarray) -> None:
        nonlocal at
        data = coder.encode(ids)
        checkpoints.append([at, len(data), len(ids), zlib.crc32(data), zlib.crc32(ids.astype("<u4").tobytes())])
        sink.write(data)
        at += len(data)

    size = 0
    for ids in sequences:
        lengths.append(len(ids))
        held.append(ids)
        size += len(ids)
        if size >= BLOCK:
            flat = np.concatenate(held)
            for i in range(0, size - BLOCK + 1, BLOCK):
                close(flat[i : i + BLOCK])
            held = [flat[size // BLOCK * BLOCK :]]
            size %= BLOCK
    if size:
        close(np.concatenate(held))
    footer = zlib.compress(json.dumps({"scale": SCALE, "lanes": LANES, "checkpoints": checkpoints, "doc_ids": doc_ids, "lengths": lengths}).encode(), 1)
    sink.write(footer + len(footer).to_bytes(8, "little"))
    return len(lengths), sum(lengths)


def footer(source: pa.NativeFile) -> dict:
    """The checkpoints, doc ids and lengths of a file that can be read at any place."""
    size = source.size()
    n = int.from_bytes(source.read_at(8, size - 8), "little") if size >= 8 + len(MAGIC) else 0
    if source.read_at(len(MAGIC), 0) != MAGIC or not 0 < n <= size - 8:
        raise ValueError("not a token file")
    return json.loads(zlib.decompress(source.read_at(n, size - 8 - n)))


def read_block(coder: Coder, source: pa.NativeFile, checkpoint: list[int]) -> np.ndarray:
    """Decode one block, wherever it lies, and verify both checksums."""
    at, size, n, coded, plain = checkpoint
    body = source.read_at(size, at)
    if zlib.crc32(body) != coded:
        raise ValueError("a block's bytes are damaged")
    ids = coder.decode(body, n)
    if zlib.crc32(ids.astype("<u4").tobytes()) != plain:
        raise ValueError("a block decodes to other ids")
    return ids


def read_file(coder: Coder, source: pa.NativeFile) -> Iterator[tuple[object, np.ndarray]]:
    """(doc_id, ids) in order, a block at a time."""
    info = footer(source)
    parts = iter(info["checkpoints"])
    held = np.zeros(0, np.uint32)
    for doc_id, n in zip(info["doc_ids"], info["lengths"], strict=True):
        have, extra = len(held), []
        while have < n:
            extra.append(read_block(coder, source, next(parts)))
            have += len(extra[-1])
        held = np.concatenate([held, *extra]) if extra else held
        yield doc_id, held[:n]
        held = held[n:]


@functools.lru_cache(1)
def encoder(path: str):  # noqa: ANN201
    """A function from texts to (ends, ids), by the tokenizers library. A worker keeps it, and the words it remembers, for its next tasks.

    The vocabulary's own splitting never joins what white space parts, nor a
    letter with an ASCII mark after it, and it ignores case; so each distinct
    run of letters is encoded once and remembered. Words that could hold a special token
    are encoded as they stand.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    mark = next(t.content for t in tokenizer.get_added_tokens_decoder().values() if t.special)  # parts words in one call
    mark_id = tokenizer.token_to_id(mark)
    encode_all = lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    vocabulary = tokenizer.get_vocab()
    last = np.zeros(max(vocabulary.values()) + 1, bool)
    last[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True  # ids that end a run of letters

    def parted(found: list[str], by: str) -> Iterator[np.ndarray]:
        """Ids of the strings, joined; few encodings are held at once."""
        for i in range(0, len(found), 2000):
            yield np.array(encode_all([by.join(found[i : i + 2000]) + by])[0], np.uint32)

    def fresh(runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        plain = pc.match_substring_regex(pa.array(runs, pa.large_string()), "^[a-zß-öø-ÿ]+$").to_numpy(zero_copy_only=False)
        sizes, begin, parts = np.zeros(len(runs), np.int64), np.zeros(len(runs), np.int64), [np.zeros(0, np.uint32)]
        at = 0
        for some, by in ((np.flatnonzero(plain), " "), (np.flatnonzero(~plain), mark)):
            flat = np.concatenate([np.zeros(0, np.uint32), *parted([runs[i] for i in some.tolist()], by)])
            if by == mark:
                ends = np.flatnonzero(flat == mark_id)
                sizes[some], flat = np.diff(ends, prepend=-1) - 1, np.delete(flat, ends)
            else:
                sizes[some] = np.diff(np.flatnonzero(last[flat]), prepend=-1)
            begin[some] = at + np.cumsum(sizes[some]) - sizes[some]
            at += len(flat)
            parts.append(flat)
        return sizes, words.gathered(np.concatenate(parts), begin, sizes)[1]

    def whole(odd: list[str]) -> tuple[np.ndarray, np.ndarray]:
        own = encode_all(odd)
        return np.array([len(x) for x in own], np.int64), np.array([i for x in own for i in x], np.uint32)

    runs, odds = words.Memo(fresh, 600_000), words.Memo(whole, 20_000)

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ends, codes, vocabulary = words.split(texts)
        odd = pc.match_substring(vocabulary, "<|").to_numpy(zero_copy_only=False)
        plain = words.mapped(pc.if_else(pa.array(odd), "", vocabulary) if odd.any() else vocabulary, words.LOWER)
        inner, parts, dictionary = words.split(pc.replace_substring_regex(plain, r"([a-zß-öø-ÿÀ-ÖØ-Þ])([!-/:-@\[-`{-~])", r"\1 \2"))
        total, ids = runs.expand(dictionary.to_pylist(), parts)
        begin, size = total[inner[:-1]], np.diff(total[inner])
        if odd.any():
            at = np.flatnonzero(odd)
            more, extra = odds.expand(vocabulary.take(pa.array(at)).to_pylist(), np.arange(len(at)))
            begin[at], size[at] = len(ids) + more[:-1], np.diff(more)
            ids = np.concatenate([ids, extra])
        total, ids = words.gathered(ids, begin[codes], size[codes])
        return total[ends], ids

    return encode


@functools.lru_cache(1)
def _zstd() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(ids: np.ndarray) -> bytes:
    """Ids in 16 bits where all fit, else in 32, compressed."""
    short = len(ids) == 0 or int(ids.max()) < 1 << 16
    return (b"2" if short else b"4") + _zstd()[0].compress(ids.astype("<u2" if short else "<u4").tobytes())


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(_zstd()[1].decompress(data[1:]), "<u" + data[:1].decode())


def tokenize(documents: DataFrame, path: str, end: int | None) -> DataFrame:
    """doc_id and packed ids of each document, the end id last."""
    kind = dict(documents.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        tail = np.zeros(0, np.uint32) if end is None else np.array([end], np.uint32)
        for whole in batches:
            for batch in slices(whole, "text", TEXT_BYTES):
                ends, ids = encode(batch.column("text"))
                rows = [pack(np.concatenate([ids[a:b], tail])) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.binary())], names=["doc_id", "ids"])

    return project(documents, "doc_id", "text").mapInArrow(tidy(run), f"doc_id {kind}, ids binary")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        n = np.bincount(np.concatenate([np.zeros(0, np.uint16), *[unpack(x) for x in batch.column("ids").to_pylist()]]), minlength=len(total))
        n[: len(total)] += total
        total = n
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["id", "n"])


def n_parts(documents: DataFrame, least: int = PART_BYTES, most: int = 8 * PART_BYTES) -> int:
    """How many files a table asks for: small ones up to a thousand, then larger ones, which still fit a task."""
    size = int(documents._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size >= 1 << 55:  # Spark doesn't know
        return int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, size // min(most, max(least, size // 1000)))


def write(documents: DataFrame, path: str, end: int | None, folder: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """Encode ``documents`` into the files of ``folder``; returns their list, which is also stored there: file, part, documents, ids and start (ids of all files before).

    The driver holds one row for each id of the vocabulary. Documents of one
    doc_id go on over as many files as they fill.
    """
    spark = documents.sparkSession
    tokens = stored(tokenize(documents, path, end), folder, "tokens")
    table = tokens.select("ids").mapInArrow(tidy(_counts), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in table), default=0) + 1, np.int64)
    for r in table:
        counts[r["id"]] = r["n"]
    frequencies = scaled(counts)
    target = f"{folder}/files"
    publish(target, FREQUENCIES, lambda sink: sink.write(zlib.compress(frequencies.astype("<u4").tobytes())))
    shared = spark.sparkContext.broadcast(frequencies)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        coder, doc_ids = Coder(shared.value), []

        def sequences() -> Iterator[np.ndarray]:
            for batch in itertools.chain([first], batches):
                for doc_id, data in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                    doc_ids.append(doc_id)
                    yield unpack(data)

        part = TaskContext.get().partitionId()  # partitions of a range are in its order
        name = f"part-{part:07d}.rans"
        n, ids = publish(target, name, lambda sink: write_file(coder, doc_ids, sequences(), sink))
        yield pa.RecordBatch.from_arrays([pa.array([f"{target}/{name}"]), *[pa.array([x], pa.int64()) for x in (part, n, ids)]], names=["file", "part", "documents", "ids"])

    order = ["doc_id", F.crc32("ids"), "row"]
    ordered = tokens.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(n_parts(documents, part_bytes), *order).sortWithinPartitions(*order).select("doc_id", "ids")
    files = stored(ordered.mapInArrow(tidy(run), "file string, part long, documents long, ids long"), folder, "written")
    return stored(started(files), folder, "list")


def started(files: DataFrame, run: int = 1000) -> DataFrame:
    """Add ``start``, the sum of ``ids`` over all lower parts: sums of runs of parts first, then within each run."""
    block = F.floor(F.col("part") / run)
    sums = files.groupBy(block.alias("block")).agg(F.sum("ids").alias("all"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("block", F.coalesce(F.sum("all").over(before(Window.orderBy("block"))), F.lit(0)).alias("base"))  # a row for each thousand files
    own = files.withColumn("block", block).withColumn("start", F.coalesce(F.sum("ids").over(before(Window.partitionBy("block").orderBy("part"))), F.lit(0)))
    return own.join(sums, "block").withColumn("start", (F.col("start") + F.col("base")).cast("long")).drop("block", "base")


def read(files: DataFrame, folder: str, kind: str = "bigint") -> DataFrame:
    """doc_id, start, n_tokens and ids (binary) of each document, decoded from listed files; ``folder`` has the frequencies.

    A worker holds one block and one document at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        for batch in batches:
            for path, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                coder = coder or stored_coder(folder)
                fs, own = file_system(path)
                rows, size = [], 0
                with fs.open_input_file(own) as source:
                    for doc_id, ids in read_file(coder, source):
                        rows.append((doc_id, start, len(ids), ids.astype("<u4").tobytes()))
                        start += len(ids)
                        size += len(ids)
                        if size >= 1 << 20:
                            yield _batch(rows, kind)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows, kind)

    listed = files.select("file", "start").repartition(max(1, files.count()), "file")
    return listed.mapInArrow(tidy(run), f"doc_id {kind}, start long, n_tokens long, ids binary")


def stored_coder(folder: str) -> Coder:
    """The coder of the frequencies in a folder."""
    fs, own = file_system(f"{folder}/files/{FREQUENCIES}")
    with fs.open_input_stream(own) as source:
        return Coder(np.frombuffer(zlib.decompress(source.read()), "<u4").astype(np.int64))


def _batch(rows: list[tuple], kind: str) -> pa.RecordBatch:
    ids, starts, sizes, data = zip(*rows, strict=True)
    own = pa.int32() if kind == "int" else pa.int64() if kind == "bigint" else pa.string()
    return pa.RecordBatch.from_arrays([pa.array(ids, own), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(data, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])


def round_trip(documents: DataFrame, path: str, end: int | None = 2, part_bytes: int = PART_BYTES) -> DataFrame:
    """Write the files of ``documents`` to the shared folder and read them back."""
    spark = documents.sparkSession
    small_batches(spark, 2 * TEXT_BYTES)
    folder = new_folder(spark, "tokens")
    files = write(project(documents, "doc_id", "text"), path, end, folder, part_bytes)
    return read(files, folder, dict(documents.dtypes)["doc_id"])
