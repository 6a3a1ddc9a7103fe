"""A content-addressed store of WARC records, and the WARC files that are rebuilt from it.

``archive`` keeps three things below a folder: ``headers``, the exact header bytes
of each record with the SHA-256 of its payload; payload files, in which each distinct
payload lies once, compressed; and ``places``, where in them each digest lies.
``rebuild`` joins headers with places and sends the headers to the payload files,
which are read in place and in order, every payload verified against its digest.
``export`` writes the rebuilt records to ``.warc.gz`` files, a member each, and
returns their list; ``read_back`` parses listed files record by record, and
``records`` any WARC files that Spark can read.

Of records with one payload of ``MIN_REVISIT`` bytes or more, that with the largest
page_id is a response and the others revisit it; all smaller ones are responses.

Payloads whose digest surely occurs once (a bitmap of fixed size tells) go from the
scan to their file; the others first meet by digest, one of each task at most, so
a payload crosses the cluster once at most, and a hot one as one row a task.
Digests with more than a ``HOT_PART``-th of all rows are joined by broadcast: there are
fewer than ``HOT_PART`` of them. Files are written under names of their own and count only once
the table that lists them is committed, so a lost task leaves nothing that is read.

Defined results: a null html is an empty payload; a null url leaves out the
target header; in a url, white space and control bytes are percent-encoded; a null
page_id is a record without a page and is never the one
that others revisit while one of its group has an id; of repeated rows of the largest
page_id each is a response; an empty table gives an empty archive; other
columns are not read.
"""

from __future__ import annotations

import functools
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm.shared import file_system, marked, new_folder, project, publish, small_batches, stored, tidy

MIN_REVISIT = 1000
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
#: Keys with more than this part of all rows, and a thousand rows, are joined by broadcast.
HOT_PART, HOT_LEAST = 5000, 1000
#: Bytes of a payload file, and records of one payload, that stay together when records are dealt to tasks.
STRETCH, RUN = 2 << 20, 2000
#: Bytes that are read of a payload file and of a WARC file at a time.
READ_BYTES, PARSE_BYTES = 4 << 20, 64 << 10
_LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*(\d+)", re.IGNORECASE)


class Archive(NamedTuple):
    """headers: page_id, digest, record_type, n_copies, hot, header; places: digest, file, at, size; n_files payload files."""

    headers: DataFrame
    places: DataFrame
    n_files: int


def record_id(page_id: Column, sha1: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), sha1, F.lit(">"))


def encoded(url: Column) -> Column:
    """A url with its white space and control bytes percent-encoded, so that no line end in it ends the header."""
    each = functools.reduce(lambda u, c: F.replace(u, F.lit(chr(c)), F.lit(f"%{c:02X}")), [*range(0x21), 0x7F], url)
    return F.when(url.rlike(r"[\x00-\x20\x7F]"), each).otherwise(url)


def header(date: str = DATE) -> Column:
    """The header of a record, from page_id, url, n, sha1, record_type and refers_to."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    revisit = F.col("record_type") == "revisit"
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", record_id(F.col("page_id"), F.col("sha1"))), line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", encoded(F.col("url"))), F.lit("")), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", record_id(F.col("refers_to"), F.col("sha1"))))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")), line("Content-Length", F.when(revisit, "0").otherwise(F.col("n").cast("string"))), F.lit("\r\n"),
    )


@functools.lru_cache(1)
def _zstd() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def pack(body: bytes) -> bytes:
    return _zstd()[0].compress(body)


def unpack(packed: bytes) -> bytes:
    return _zstd()[1].decompress(packed)


def _first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """digest and packed payload of the first row of each digest in a task."""
    seen: set[bytes] = set()
    for batch in batches:
        found = {d: x for d, x in zip(batch.column("digest").to_pylist(), batch.column("body").to_pylist(), strict=True) if d not in seen}
        seen.update(found)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array([pack(x) for x in found.values()], pa.binary())], names=["digest", "payload"])


def _keeper(folder: str, name: str, of: Callable[[bytes], bytes]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function that writes the payloads (column ``name``) of a task to one file and tells where each digest lies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        file, rows, at = f"payloads-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.zst", [], 0

        def write(sink) -> None:  # noqa: ANN001
            nonlocal at
            batch = first
            while batch is not None:
                for digest, body in zip(batch.column("digest").to_pylist(), batch.column(name).to_pylist(), strict=True):
                    packed = of(body)
                    sink.write(packed)
                    rows.append((digest, at, len(packed)))
                    at += len(packed)
                batch = next(batches, None)

        publish(folder, file, write)
        digests, starts, sizes = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array([file] * len(rows)), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], names=["digest", "file", "at", "size"])

    return run


def _hot(n: Column, total: int) -> Column:
    return n > max(HOT_LEAST, total // HOT_PART)


def known(rows: DataFrame, facts: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` left-joined with ``facts`` (key, n_copies and others; a row for each key), and ``hot``: whether the key has more than its part of ``total``.

    Hot keys, of which there are fewer than ``HOT_PART``, are joined by broadcast, so no task gets all rows of one.
    """
    more = [c for c in facts.columns if c != key]
    hot = F.broadcast(facts.filter(_hot(F.col("n_copies"), total)))
    own = rows.join(hot, key, "left")
    found = own.filter("n_copies IS NOT NULL").withColumn("hot", F.lit(True))
    rest = own.filter("n_copies IS NULL").drop(*more).join(facts.hint("merge"), key, "left").withColumn("hot", F.lit(False))
    return found.select(*rows.columns, *more, "hot").union(rest.select(*rows.columns, *more, "hot"))


def archive(pages: DataFrame, folder: str, min_revisit: int = MIN_REVISIT, date: str = DATE) -> Archive:
    """Write the records of ``pages`` (page_id, url, html) to a store below ``folder``."""
    pages = project(pages, "page_id", "url", "html")
    body = F.coalesce("html", F.lit("")).cast("binary")
    digest = F.unhex(F.sha2(body, 256))
    index = stored(pages.select("page_id", "url", F.octet_length(body).cast("long").alias("n"), F.sha1(body).alias("sha1"), digest.alias("digest")), folder, "index")
    total = index.count()
    copies = index.groupBy("digest").agg(F.count("*").alias("n_copies"), F.max("page_id").alias("holder")).filter("n_copies > 1")
    copies = stored(copies, folder, "copies")

    own = marked(index, F.col("digest"), copies, "digest")
    kind = dict(pages.dtypes)["page_id"]
    once = own.filter("NOT __may").drop("__may").withColumns({"n_copies": F.lit(1).cast("long"), "holder": F.lit(None).cast(kind), "hot": F.lit(False)})
    typed = once.unionByName(known(own.filter("__may").drop("__may"), copies, "digest", total)).withColumn("n_copies", F.coalesce("n_copies", F.lit(1)))
    revisit = (F.col("n") >= min_revisit) & (F.col("n_copies") > 1) & ~F.col("page_id").eqNullSafe(F.col("holder"))
    typed = typed.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn("refers_to", F.when(revisit, F.col("holder")))
    headers = stored(typed.select("page_id", "digest", "record_type", "n_copies", "hot", header(date).alias("header")), folder, "headers")

    bodies = marked(pages.select(digest.alias("digest"), body.alias("body")), F.col("digest"), copies, "digest")
    place, where = "digest binary, file string, at long, size long", f"{folder}/payloads"
    sure = bodies.filter("NOT __may").select("digest", "body").mapInArrow(tidy(_keeper(where, "body", pack)), place)
    some = bodies.filter("__may").select("digest", "body").mapInArrow(tidy(_first), "digest binary, payload binary").dropDuplicates(["digest"])
    places = stored(sure.union(some.mapInArrow(tidy(_keeper(where, "payload", bytes)), place)).withColumn("file", F.concat(F.lit(f"{where}/"), "file")), folder, "places")
    return Archive(headers, places, places.select("file").distinct().count())


def parse_header(head: bytes) -> dict[str, str]:
    """Fields by lower-case name."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not re.fullmatch(r"WARC/\d+\.\d+", lines[0]):
        raise ValueError("not a WARC record")
    fields = (x.partition(":") for x in lines[1:] if x)
    return {k.strip().lower(): v.strip() for k, _, v in fields}


def _plain(read: Callable[[int], bytes]) -> Iterator[bytes]:
    """The bytes of a file, plain or of any number of gzip members, in pieces."""
    data = read(PARSE_BYTES)
    if data[:2] != b"\x1f\x8b":
        while data:
            yield data
            data = read(PARSE_BYTES)
        return
    member = zlib.decompressobj(31)
    while data or (data := read(PARSE_BYTES)):
        yield member.decompress(data)
        data = member.unused_data
        if member.eof:
            member = zlib.decompressobj(31)


def parse(read: Callable[[int], bytes]) -> Iterator[tuple[bytes, bytes]]:
    """(header with its blank line, block) of each record of a file that ``read(n)`` gives; one record is held at a time."""
    held, pieces = bytearray(), _plain(read)

    def fill(n: int) -> bool:
        while len(held) < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while fill(1):
        at = 0
        while (end := held.find(END, at)) < 0:
            at = max(0, len(held) - len(END))
            if not fill(len(held) + 1):
                raise ValueError("a header doesn't end")
        head = bytes(held[: end + len(END)])
        length = _LENGTH.search(head)
        if not head.startswith(b"WARC/") or length is None:
            raise ValueError("not a WARC record")
        n = len(head) + int(length[1])
        if not fill(n + len(END)) or held[n : n + len(END)] != END:
            raise ValueError("a record doesn't end where its length says")
        yield head, bytes(held[len(head) : n])
        del held[: n + len(END)]


class _Payloads:
    """Verified payloads of the store; a file is read in order, a few megabytes at a time."""

    def __init__(self) -> None:
        self.path = self.source = self.last = None
        self.start, self.data, self.body = 0, b"", b""

    def get(self, path: str, at: int, size: int, digest: bytes) -> bytes:
        if (path, at) == self.last:
            return self.body
        if path != self.path:
            fs, own = file_system(path)
            self.path, self.source, self.start, self.data = path, fs.open_input_file(own), 0, b""
        if not self.start <= at <= at + size <= self.start + len(self.data):
            self.start, self.data = at, self.source.read_at(max(size, min(READ_BYTES, self.source.size() - at)), at)
        self.body = unpack(self.data[at - self.start : at - self.start + size])
        if hashlib.sha256(self.body).digest() != digest:
            raise ValueError("a payload doesn't match its digest")
        self.last = path, at
        return self.body


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, bytes]]:
    """(digest, record) of headers with the places of their payloads, in the order of these."""
    payloads = _Payloads()
    for batch in batches:
        for digest, head, file, at, size in zip(*(batch.column(c).to_pylist() for c in ("digest", "header", "file", "at", "size")), strict=True):
            yield digest, head.encode() + (b"" if file is None else payloads.get(file, at, size, digest)) + END


def _placed(store: Archive) -> DataFrame:
    """Headers with the places of their payloads (revisits: null); those of one payload file lie together in its order."""
    response, columns = store.headers.filter("record_type = 'response'"), ["digest", "header", "file", "at", "size"]
    few = F.broadcast(response.filter("hot").select("digest").distinct())  # fewer than HOT_PART
    hot = response.filter("hot").join(F.broadcast(store.places.join(few, "digest", "left_semi")), "digest")
    cold = response.filter("NOT hot").join(store.places.hint("merge"), "digest")
    part = F.pmod(F.xxhash64("page_id", "header"), F.ceil(F.col("n_copies") / RUN)).alias("part")  # of the records of one payload
    full = hot.select(*columns, part).union(cold.select(*columns, part)).withColumn("stretch", F.floor(F.col("at") / STRETCH))
    full = full.repartition(2 * max(1, store.n_files), "file", "stretch", "part").sortWithinPartitions("file", "at").select(columns)
    bare = store.headers.filter("record_type = 'revisit'").select("digest", "header", F.lit(None).cast("string"), F.lit(None).cast("long"), F.lit(None).cast("long"))
    return full.union(bare)


def rebuild(store: Archive) -> DataFrame:
    """digest and the exact bytes of each record; a payload that doesn't match its digest raises."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*rows, strict=True)], names=["digest", "record"])
        rows, size = [], 0
        for row in _rebuilt(batches):
            rows.append(row)
            size += len(row[1])
            if size >= READ_BYTES:
                yield batch_of(rows)
                rows, size = [], 0
        if rows:
            yield batch_of(rows)

    return _placed(store).mapInArrow(tidy(run), "digest binary, record binary")


def export(store: Archive, folder: str) -> DataFrame:
    """Write all records to ``.warc.gz`` files in ``folder``, a member each; returns (file, records), the list of those that count.

    Write the result once, for example as a table: each time it is computed it writes files anew.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = _rebuilt(batches)
        first = next(records, None)
        if first is None:
            return
        name, n = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz", 0

        def write(sink) -> None:  # noqa: ANN001
            nonlocal n
            row = first
            while row is not None:
                sink.write(gzip.compress(row[1], 6, mtime=0))
                n += 1
                row = next(records, None)

        publish(folder, name, write)
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([n])], names=["file", "records"])

    return _placed(store).mapInArrow(tidy(run), "file string, records long")


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, length, digest, type and reference of each record of the listed files; a response whose block doesn't match its digest raises."""
    names, kinds = ["id", "payload_bytes", "payload_digest", "record_type", "target"], [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
    for batch in batches:
        for path, n in zip(batch.column("file").to_pylist(), batch.column("records").to_pylist(), strict=True):
            fs, own = file_system(path)
            rows, count = [], 0
            with fs.open_input_stream(own, compression=None) as source:
                for head, block in parse(source.read):
                    fields, count = parse_header(head), count + 1
                    sha1 = fields["warc-payload-digest"].removeprefix("sha1:")
                    if fields["warc-type"] == "response" and sha1 != hashlib.sha1(block).hexdigest():
                        raise ValueError("a record doesn't match its digest")
                    rows.append((fields["warc-record-id"], len(block), sha1, fields["warc-type"], fields.get("warc-refers-to")))
                    if len(rows) == 2000:
                        yield batch_of(rows)
                        rows = []
            if count != n:
                raise ValueError("a file doesn't hold the records that were written")
            if rows:
                yield batch_of(rows)


def read_back(files: DataFrame, folder: str, kind: str = "bigint") -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of each record, as parsed from listed files (file, records).

    A revisit takes length and digest from the verified response that it refers to.
    """
    listed = files.repartition(max(1, files.count()), "file")
    parsed = stored(listed.mapInArrow(tidy(_facts), "id string, payload_bytes long, payload_digest string, record_type string, target string"), folder, "parsed")
    page = lambda c: F.nullif(F.regexp_extract(c, r"^<urn:page:(.*):[0-9a-f]*>$", 1), F.lit("")).cast(kind)
    response, revisit = parsed.filter("record_type = 'response'"), parsed.filter("record_type = 'revisit'").select("id", "target")
    wanted = revisit.groupBy("target").agg(F.count("*").alias("n_copies"))
    own = response.groupBy(F.col("id").alias("target")).agg(F.max("payload_bytes").alias("payload_bytes"), F.max("payload_digest").alias("payload_digest"))
    held = stored(wanted.join(own.hint("merge"), "target"), folder, "held")
    full = known(revisit, held, "target", revisit.count()).select("id", "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), "target")
    out = response.select("id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("string").alias("target")).union(full)
    return out.select(page("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("target").alias("refers_to"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """file, position, header and block of each record of the WARC files at ``path``, each of less than 2 GB."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                for i, (head, block) in enumerate(parse(io.BytesIO(data).read)):
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([i]), pa.array([head], pa.binary()), pa.array([block], pa.binary())], names=["file", "position", "header", "block"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(tidy(run), "file string, position long, header binary, block binary")


def round_trip(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Archive ``pages`` in the shared folder, write the WARC files, and read every record back."""
    spark = pages.sparkSession
    small_batches(spark)
    folder = new_folder(spark, "warc")
    files = stored(export(archive(pages, folder, min_revisit), f"{folder}/files"), folder, "list")
    return read_back(files, folder, dict(pages.dtypes)["page_id"])
