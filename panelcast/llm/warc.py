"""WARC archives with a two-level capture index.

Writing: every task writes one archive of gzip members below the shared folder
and returns a capture row per record; only the rows of tasks that succeeded are
kept, so an archive left by a lost attempt is never read.

Index: capture rows are range-partitioned by their key, the URL with its host
reversed followed by the page id.  Each partition becomes one index file of
compressed blocks of sorted lines, closed by a sparse directory that holds the
first key and the place of every block.

Lookup: a wanted key range is sent to the index files it can touch (one first
and last key per file), the directory of the file is searched for the block, the
block for the line, and the record is then fetched with one range read.  Lookups
are exchanged twice: by index file, and by archive and offset for the reads.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import re
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.session import materialize, scratch_path

CAPTURE = ("key string, url string, page_id long, record_type string, archive string, offset long, length long")
RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
          "payload binary")
LINES_PER_BLOCK = 300
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Fixed, so that archives of equal pages are equal.
DATE = "2024-01-01T00:00:00Z"


def _open_folder(folder: str):
    return pafs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


def _columns(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


_TYPES = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(p.split()[0], _TYPES[p.split()[1]]) for p in schema.split(", ")])


def url_key(url: Column) -> Column:
    """Host labels reversed, then the path: ``com,example)/a?b``; empty for NULL.

    Scheme, user, a leading ``www.`` and the fragment do not count; the host is lower-cased.
    """
    bare = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://|#.*$", "")
    host = F.lower(F.regexp_replace(F.regexp_extract(bare, r"^([^/?]*)", 1), r"^[^@]*@|:(80|443)?$", ""))
    host = F.regexp_replace(host, r"^www\.", "")
    path = F.regexp_extract(bare, r"^[^/?]*(.*)$", 1)
    path = F.when(F.substring(path, 1, 1) == "/", path).otherwise(F.concat(F.lit("/"), path))
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), path)
    # Blanks separate the parts of an index line's key.
    return F.when(url.isNull(), F.lit("")).otherwise(F.regexp_replace(key, r"[\x00-\x20]", "%20"))


def capture_key(url: Column, page_id: Column) -> Column:
    """URL key and zero-padded id; ids are shifted to be positive, NULL sorts first."""
    shifted = F.lpad((page_id.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    return F.concat(url_key(url), F.lit(" "), F.coalesce(shifted, F.lit("-")))


def bare_digest(hexadecimal: Column) -> Column:
    """Upper-case base32 of a SHA-1 given in hexadecimal, by the digits' bits."""
    def quint(i):
        bits = F.conv(F.substring(hexadecimal, 10 * (i // 8) + 1, 10), 16, 10).cast("long")
        return F.shiftright(bits, 35 - 5 * (i % 8)).bitwiseAND(F.lit(31)) + 1
    letters = F.split(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), "")
    return F.concat(*[F.element_at(letters, quint(i).cast("int")) for i in range(32)])


def classify(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Adds ``digest``, ``n_bytes`` and ``refers_to``: the smallest page id with an equal payload, if it is another's.

    The first ids are one partial aggregate per payload, so a payload that a
    third of the pages share sends one row per task; only digests travel, and
    payloads that occur once are not joined.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    pages = pages.withColumns({"digest": F.sha1(payload.cast("binary")), "n_bytes": F.octet_length(payload).cast("long")})
    first = pages.filter(F.col("n_bytes") >= least_bytes).groupBy("digest", "n_bytes") \
        .agg(F.min("page_id").alias("first"), F.count("page_id").alias("n")).filter("n > 1").drop("n")
    return pages.join(first, ["digest", "n_bytes"], "left") \
        .withColumn("refers_to", F.when(F.col("page_id") > F.col("first"), F.col("first"))).drop("first")


def record_bytes(url: str | None, page_id: int | None, payload: bytes, digest: str, n_bytes: int,
                 refers_to: int | None) -> bytes:
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Date: {DATE}",
            f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>",
            "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:  # as JSON, because a URL may hold line ends
        head.append(f"WARC-Target-URI: {json.dumps(url)[1:-1]}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """A record's fields; raises if lengths or the digest of a stored payload are wrong."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError(f"wrong length of {fields['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    n_bytes = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    response = fields["WARC-Type"] == "response"
    if response:
        real = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if real != digest or len(payload) != n_bytes:
            raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
    number = lambda name: re.fullmatch(r"<urn:page:(-?\d+|null)>", fields[name])[1]
    own = number("WARC-Record-ID")
    url = fields.get("WARC-Target-URI")
    return {"page_id": None if own == "null" else int(own), "url": None if url is None else json.loads(f'"{url}"'),
            "payload_bytes": n_bytes, "payload_digest": digest, "record_type": fields["WARC-Type"],
            "refers_to": None if response else int(number("WARC-Refers-To")), "payload": payload if response else None}


def write_archives(pages: DataFrame, folder: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Writes a record per page; returns the capture rows of the archives.

    ``pages`` needs ``page_id, url, html``; other columns are ignored.  A NULL
    html is an empty payload, a NULL url an empty key.  Among equal payloads the
    page with the smallest id is the response; rows that share that id (repeated
    rows) and rows without an id are responses too.  An empty table gives no
    captures.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    own = pages.select("page_id", "url", "html")
    typed = classify(own, least_bytes).select(
        "page_id", "url", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"), "n_bytes", "refers_to",
        bare_digest(F.col("digest")).alias("digest"), capture_key(F.col("url"), F.col("page_id")).alias("key"))
    schema = _arrow(CAPTURE)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _open_folder(folder)
        files.create_dir(path, recursive=True)
        archive, out, at = f"{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                page, url, html, n, refers, digest, key = (batch.column(c)[i].as_py() for c in range(7))
                raw = record_bytes(url, page, (html or "").encode(), digest, n, refers)
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = packer.compress(raw) + packer.flush()
                out = out or files.open_output_stream(f"{path}/{archive}", compression=None)
                out.write(member)
                rows.append((key, url, page, "response" if refers is None else "revisit", archive, at, len(member)))
                at += len(member)
            yield _batch(rows, schema)
        if out:
            out.close()

    captures = materialize(typed.mapInArrow(write, CAPTURE), "captures")
    return captures.withColumn("archive", F.concat(F.lit(f"{folder}/"), "archive"))


def build_index(captures: DataFrame, files: int | None = None, folder: str | None = None) -> DataFrame:
    """Writes the index; returns one row per index file: ``file, first_key, last_key, n_lines``."""
    spark = captures.sparkSession
    folder = folder or scratch_path(spark, "cdx")
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = captures.select("key", F.to_json(F.struct(*[c for c in _columns(CAPTURE) if c != "key"])).alias("line")) \
        .repartitionByRange(files, "key", "line").sortWithinPartitions("key", "line")
    top = "file string, first_key string, last_key string, n_lines long"
    schema = _arrow(top)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _open_folder(folder)
        store.create_dir(path, recursive=True)
        name, out, at, n, block, directory, last = f"{uuid.uuid4().hex}.cdx", None, 0, 0, [], [], ""

        def flush():
            nonlocal at
            packed = zlib.compress("\n".join(f"{k}\t{v}" for k, v in block).encode())
            out.write(packed)
            directory.append((block[0][0], at, len(packed)))
            at += len(packed)
            block.clear()

        for batch in batches:
            for key, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out = out or store.open_output_stream(f"{path}/{name}", compression=None)
                block.append((key, line))
                n, last = n + 1, key
                if len(block) == LINES_PER_BLOCK:
                    flush()
        if not out:
            return
        if block:
            flush()
        packed = zlib.compress(json.dumps(directory).encode())
        out.write(packed + struct.pack(">QQ", at, len(packed)))
        out.close()
        yield _batch([(f"{folder}/{name}", directory[0][0], last, n)], schema)

    return materialize(lines.mapInArrow(write, top), "cdx-files")


def _lines_between(handle, directory, low: str, high: str, cache: dict) -> Iterator[tuple[str, str]]:
    """Index lines with low <= key < high: binary search over blocks, then inside them."""
    firsts = directory["firsts"]
    block = max(bisect_left(firsts, low) - 1, 0)
    while block < len(firsts) and firsts[block] < high:
        if cache.get("block") != block:
            _, at, size = directory["blocks"][block]
            handle.seek(at)
            lines = [line.split("\t", 1) for line in zlib.decompress(handle.read(size)).decode().split("\n")]
            cache.update(block=block, keys=[k for k, _ in lines], lines=[v for _, v in lines])
        keys = cache["keys"]
        for i in range(bisect_left(keys, low), bisect_left(keys, high)):
            yield keys[i], cache["lines"][i]
        block += 1


def lookup(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """Capture rows of each wanted key range ``low, high`` (``high`` exclusive).

    Every row of ``wanted`` is answered on its own, so repeated ranges give
    repeated captures; a range without captures gives none.
    """
    spark = wanted.sparkSession
    # One row per index file, whose number is a parameter: small enough for the driver and for every task.
    files = sorted(((r["first_key"], r["last_key"], r["file"]) for r in index.collect()))
    firsts, lasts, names = [list(x) for x in zip(*files)] if files else ([], [], [])

    @F.pandas_udf("array<int>")
    def touched(low, high):
        import pandas as pd
        return pd.Series([list(range(bisect_left(lasts, a), bisect_left(firsts, b))) for a, b in zip(low, high)])

    schema = _arrow(CAPTURE)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, handle, directory, cache = None, None, None, {}
        for batch in batches:
            rows = []
            for file, low, high in zip(*(c.to_pylist() for c in batch.columns)):
                if file != current:
                    store, path = _open_folder(names[file])
                    handle, current, cache = store.open_input_file(path), file, {}
                    handle.seek(handle.size() - 16)
                    at, size = struct.unpack(">QQ", handle.read(16))
                    handle.seek(at)
                    blocks = json.loads(zlib.decompress(handle.read(size)))
                    directory = {"firsts": [b[0] for b in blocks], "blocks": blocks}
                for key, line in _lines_between(handle, directory, low, high, cache):
                    got = json.loads(line)
                    rows.append((key, *(got.get(c) for c in _columns(CAPTURE)[1:])))
            yield _batch(rows, schema)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return wanted.select(F.explode(touched("low", "high")).alias("file"), "low", "high") \
        .repartitionByRange(parts, "file", "low").sortWithinPartitions("file", "low").mapInArrow(find, CAPTURE)


def read_records(captures: DataFrame) -> DataFrame:
    """The records at the captures' places, by range reads in the order of archive and offset."""
    schema = _arrow(RECORD)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, handle = None, None
        for batch in batches:
            rows, held = [], 0
            for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if archive != current:
                    store, path = _open_folder(archive)
                    handle, current = store.open_input_file(path), archive
                handle.seek(offset)
                found = parse_record(zlib.decompress(handle.read(length), 31))
                rows.append(tuple(found[c] for c in _columns(RECORD)))
                held += len(found["payload"] or b"")
                if held > 8 << 20:
                    yield _batch(rows, schema)
                    rows, held = [], 0
            yield _batch(rows, schema)

    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return captures.select("archive", "offset", "length").repartitionByRange(parts, "archive", "offset") \
        .sortWithinPartitions("archive", "offset").mapInArrow(fetch, RECORD)


def exact(captures: DataFrame) -> DataFrame:
    """Wanted ranges that match one capture key each."""
    return captures.select(F.col("key").alias("low"), F.concat("key", F.lit("\x01")).alias("high"))


def captures_of(urls: DataFrame) -> DataFrame:
    """Wanted ranges with all captures of each ``url``."""
    key = url_key(F.col("url"))
    return urls.select(F.concat(key, F.lit(" ")).alias("low"), F.concat(key, F.lit("!")).alias("high"))


def archive_and_read(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes all pages, indexes the captures, looks every page up and reads its record back."""
    captures = write_archives(pages, least_bytes=least_bytes)
    index = build_index(captures)
    wanted = exact(pages.select(capture_key(F.col("url"), F.col("page_id")).alias("key")).distinct())
    return read_records(lookup(index, wanted))


SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS h FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h, payload_bytes) AS first FROM d)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (1 +
         ((('0x' || substr(h, (10 * (i // 8) + 1)::INT, 10))::BIGINT >> (35 - 5 * (i % 8))::INT) & 31))::INT, 1)), '')
         AS payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to FROM f
"""
