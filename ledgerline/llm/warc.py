"""WARC archives with a two-level capture index.

Archives hold one gzip member per record. Of pages with equal payloads the one with the
smallest page_id has a response record, the others revisit it. The index sorts captures by
their URL key, host reversed, into gzip blocks, and keeps one line per block in a directory.
A look-up binary-searches the directory, reads the one or few blocks that may hold the key,
and then just the ranges of the records.
"""

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from itertools import islice
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from ledgerline.llm.files import file_system, new_name, shared_folder
from ledgerline.llm.shared import broadcast_if_small, map_in_arrow, written

# Payloads below this size are always written whole.
LEAST_REVISIT = 0
BLOCK_LINES = 1000
# Pages whose page_id it divides are looked up by their URL.
ASKING = 20
# Up to so many results of theirs are sent to all tasks; more are shuffled.
FEW_ASKING = 1_000_000
# Pages have no time of capture; WARC asks for one.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

CAPTURE = (
    "url_key string, page_id long, digest string, record_type string, file string, "
    "at long, size long"
)
RECORD = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)


def url_key(url):
    """The sort key of a URL: host reversed and in lower case, then port, path and query.

    What is no URL is its own key in lower case; null is the empty key. Keys have no white
    space, which separates the parts of an index line.
    """
    text = "".join((url or "").split())
    try:
        parts = urlsplit(text)
        host, port = parts.hostname, parts.port
    except ValueError:
        return text.lower()
    if not host:
        return text.lower()
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port else "")
    return key + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def base32_sha1(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _roles(pages):
    """(page_id, sha, response_id): which page's record holds the payload of each page."""
    sizes = pages.select(
        "page_id", F.sha1("html").alias("sha"), F.octet_length("html").alias("bytes")
    ).distinct()
    groups = (
        sizes.where(F.col("bytes") >= LEAST_REVISIT)
        .groupBy("sha")
        .agg(F.min("page_id").alias("response_id"), F.count("*").alias("n"))
        .where("n > 1 and response_id is not null")
        .select("sha", "response_id")
    )
    return sizes.join(groups, "sha", "left").select("page_id", "sha", "response_id")


def _lines(pairs):
    return b"".join(f"{k}: {v}\r\n".encode() for k, v in pairs if v is not None)


def _record(kind, pairs, block):
    head = b"WARC/1.1\r\n" + _lines([("WARC-Type", kind), *pairs, ("Content-Length", len(block))])
    # A fixed time in the gzip header keeps a repeated task's bytes the same.
    return gzip.compress(head + b"\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def _record_id(page_id, digest):
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{page_id}/{digest}')}>"


def page_record(page_id, url, html, refers_to):
    """(record, payload digest) of one page; ``refers_to`` is null for a response."""
    payload = html.encode("utf-8")
    digest = base32_sha1(payload)
    uri = "".join((url or "").split()) or f"urn:page:{page_id}"
    pairs = [
        ("WARC-Record-ID", _record_id(page_id, digest)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        # Fields of our own: ids as in the table, null left out, and the payload's size.
        ("Page-Id", page_id),
        ("Page-Payload-Length", len(payload)),
    ]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += f"Content-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        return _record("response", pairs, http + payload), digest
    pairs += [
        ("WARC-Profile", PROFILE),
        ("WARC-Refers-To", _record_id(refers_to, digest)),
        ("Page-Refers-To", refers_to),
    ]
    return _record("revisit", pairs, http), digest


def parse_record(member):
    """(headers, payload) of a gzip member; the payload of a revisit is empty."""
    raw = zlib.decompress(member, zlib.MAX_WBITS | 16)
    head, _, block = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def write_archives(pages, folder=None):
    """Write one record per row of ``pages`` (page_id, url, html); the captures, see CAPTURE.

    Null html is an empty payload. Of rows with equal payloads of at least LEAST_REVISIT
    bytes those with the smallest page_id are responses, the others refer to it; a group
    without any id, and a row of a smaller payload, is all responses. Repeated rows are
    written each. An empty table gives no archives.
    """
    spark = pages.sparkSession
    folder = folder or shared_folder(spark, "warc")
    rows = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    roles = _roles(rows).alias("r")
    left = rows.withColumn("sha", F.sha1("html")).alias("p")
    placed = left.join(
        roles,
        F.col("p.page_id").eqNullSafe(F.col("r.page_id")) & (F.col("p.sha") == F.col("r.sha")),
    ).select(
        "p.page_id",
        "url",
        "html",
        F.when(~F.col("p.page_id").eqNullSafe(F.col("response_id")), F.col("response_id")).alias(
            "refers_to"
        ),
    )

    def each(batches):
        part, name, sink, at = TaskContext.get().partitionId(), None, None, 0
        for batch in batches:
            out = []
            for page_id, url, html, refers_to in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if sink is None:
                    system, root = file_system(folder)
                    system.create_dir(root, recursive=True)
                    name = new_name("pages", part, ".warc.gz")
                    sink = system.open_output_stream(f"{root}/{name}", compression=None)
                    info = _record(
                        "warcinfo",
                        [
                            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(NAMES, name)}>"),
                            ("WARC-Date", DATE),
                            ("Content-Type", "application/warc-fields"),
                        ],
                        b"format: WARC File Format 1.1\r\n",
                    )
                    sink.write(info)
                    at = len(info)
                record, digest = page_record(page_id, url, html, refers_to)
                sink.write(record)
                kind = "response" if refers_to is None else "revisit"
                out.append(
                    (url_key(url), page_id, digest, kind, f"{folder}/{name}", at, len(record))
                )
                at += len(record)
            if out:
                columns = list(zip(*out, strict=True))
                kinds = [pa.string(), pa.int64(), *[pa.string()] * 3, pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    [c.split()[0] for c in CAPTURE.split(", ")],
                )
        if sink is not None:
            sink.close()

    return written(map_in_arrow(placed, each, CAPTURE), "warc-captures")


def write_index(captures, folder=None):
    """Write the index of ``captures``; one row per shard: shard, file, first, last, blocks.

    A shard is a file: gzip blocks of sorted lines, then the directory (per block its
    first and last key, place and size, as JSON, gzip), then the directory's size in eight
    bytes. Keys repeat across blocks and shards where one URL has many captures.
    """
    spark = captures.sparkSession
    folder = folder or shared_folder(spark, "warc-index")

    def each(batches):
        part = TaskContext.get().partitionId()
        sink, name, directory, lines, at = None, None, [], [], 0

        def block():
            nonlocal at
            text = "".join(f"{k} {json.dumps(v)}\n" for k, v in lines)
            packed = gzip.compress(text.encode(), 6, mtime=0)
            sink.write(packed)
            directory.append((lines[0][0], lines[-1][0], at, len(packed)))
            at += len(packed)
            lines.clear()

        for batch in batches:
            for key, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if sink is None:
                    system, root = file_system(folder)
                    system.create_dir(root, recursive=True)
                    name = new_name("index", part, ".cdx")
                    sink = system.open_output_stream(f"{root}/{name}", compression=None)
                lines.append((key, rest))
                if len(lines) == BLOCK_LINES:
                    block()
        if sink is None:
            return
        if lines:
            block()
        packed = gzip.compress(json.dumps(directory).encode(), 6, mtime=0)
        sink.write(packed + struct.pack("<Q", len(packed)))
        sink.close()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int64()),
                pa.array([f"{folder}/{name}"]),
                pa.array([directory[0][0]]),
                pa.array([directory[-1][1]]),
                pa.array([len(directory)], pa.int64()),
            ],
            ["shard", "file", "first", "last", "blocks"],
        )

    # The tie columns let one URL with many captures go to several shards.
    ordered = captures.repartitionByRange("url_key", "page_id", "at").sortWithinPartitions(
        "url_key", "page_id", "file", "at"
    )
    return written(
        map_in_arrow(
            ordered, each, "shard long, file string, first string, last string, blocks long"
        ),
        "warc-shards",
    )


class Shard:
    """One index file: its directory is read, blocks are read when asked for."""

    def __init__(self, uri):
        self.system, place = file_system(uri)
        self.source = self.system.open_input_file(place)
        end = self.source.size()
        (size,) = struct.unpack("<Q", self._read(end - 8, 8))
        self.directory = json.loads(gzip.decompress(self._read(end - 8 - size, size)))
        self.firsts = [d[0] for d in self.directory]
        self.lasts = [d[1] for d in self.directory]

    def _read(self, at, size):
        self.source.seek(at)
        return self.source.read(size)

    def block(self, number):
        """(key, [page_id, digest, record_type, file, at, size]) of each line of a block."""
        _, _, at, size = self.directory[number]
        for line in gzip.decompress(self._read(at, size)).decode().split("\n")[:-1]:
            key, _, rest = line.partition(" ")
            yield key, json.loads(rest)

    def captures(self, key):
        """The captures of one key: the blocks whose range holds it, by binary search."""
        for number in range(bisect_left(self.lasts, key), bisect_right(self.firsts, key)):
            yield from (rest for found, rest in self.block(number) if found == key)

    def close(self):
        self.source.close()


class Archives:
    """Reads records by range; keeps the last archive open."""

    def __init__(self):
        self.uri, self.source = None, None

    def record(self, uri, at, size):
        if uri != self.uri:
            self.close()
            system, place = file_system(uri)
            self.uri, self.source = uri, system.open_input_file(place)
        self.source.seek(at)
        return parse_record(self.source.read(size))

    def close(self):
        if self.source is not None:
            self.source.close()
        self.uri, self.source = None, None


def _row(headers, payload):
    """A row of RECORD; the digest of a payload that is there is computed from it."""

    def number(name):
        return int(headers[name]) if name in headers and headers[name] != "None" else None

    said = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    response = headers["WARC-Type"] == "response"
    if response and base32_sha1(payload) != said:
        raise ValueError(f"the payload of {headers['WARC-Record-ID']} is damaged")
    size = len(payload) if response else number("Page-Payload-Length")
    return (
        number("Page-Id"),
        headers["WARC-Target-URI"],
        size,
        said,
        headers["WARC-Type"],
        number("Page-Refers-To"),
        payload if response else None,
    )


def _rows(rows):
    kinds = [
        pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(),
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
        [c.split()[0] for c in RECORD.split(", ")],
    )


def read_all(shards):
    """All records, see RECORD, by way of the index: block after block, range after range."""

    def each(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                shard, archives = Shard(uri), Archives()
                for number in range(len(shard.directory)):
                    # In the order of the archives, so that neighbours are read together.
                    places = sorted(rest[3:6] for _, rest in shard.block(number))
                    for start in range(0, len(places), 200):
                        yield _rows(
                            [_row(*archives.record(*p)) for p in places[start : start + 200]]
                        )
                archives.close()
                shard.close()

    spark = shards.sparkSession
    spread = shards.select("file", "shard").repartitionByRange(
        max(1, min(shards.count(), spark.sparkContext.defaultParallelism * 8)), "shard"
    )
    return map_in_arrow(spread.select("file"), each, RECORD)


def look_up(shards, urls):
    """The records, see RECORD, of all captures whose key is that of one of ``urls`` (url).

    The shard or shards of a key are found by binary search as well; their list has a row
    per index file, so no more than there were partitions when the index was sorted.
    """
    listed = shards.select("first", "last", "file").orderBy("shard").collect()
    firsts, lasts = [r["first"] for r in listed], [r["last"] for r in listed]
    files = [r["file"] for r in listed]

    def keys(batches):
        for batch in batches:
            found = sorted({url_key(u) for u in batch.column(0).to_pylist()})
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["url_key"])

    def shards_of(batches):
        for batch in batches:
            pairs = [
                (files[i], key)
                for key in batch.column(0).to_pylist()
                for i in range(bisect_left(lasts, key), bisect_right(firsts, key))
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in pairs], pa.string()) for i in range(2)],
                ["file", "url_key"],
            )

    def each(batches):
        shard, archives, uri = None, Archives(), None
        for batch in batches:
            for file, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file != uri:
                    if shard:
                        shard.close()
                    uri, shard = file, Shard(file)
                # A key may have any number of captures: some at a time.
                captures = shard.captures(key)
                while rows := [_row(*archives.record(*c[3:6])) for c in islice(captures, 200)]:
                    yield _rows(rows)
        archives.close()
        if shard:
            shard.close()

    wanted = map_in_arrow(urls.select(F.col("url").cast("string")), keys, "url_key string").distinct()
    held = map_in_arrow(wanted, shards_of, "file string, url_key string")
    near = held.repartition("file").sortWithinPartitions("file", "url_key")
    return map_in_arrow(near, each, RECORD)


def archived_pages(pages):
    """Per row of ``pages``, from archives written and read back through their index.

    Columns: page_id, payload_bytes, payload_digest, record_type, refers_to, and
    found_by_url: whether the page is among the captures that a look-up of its URL finds.
    Pages whose page_id ASKING divides are looked up; for others it is null.

    A null html is an empty payload, a null url an empty key; a row without a page_id is
    kept and refers to nothing; rows that repeat a page_id and a payload are all there, as
    the response or as revisits, as :func:`write_archives` says; an empty table gives no
    rows. Only ``page_id``, ``url`` and ``html`` are read.
    """
    shards = write_index(write_archives(pages))
    asking = pages.where(F.col("page_id").cast("long") % ASKING == 0)
    found = written(
        look_up(shards, asking.select(F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url")))
        .select(F.col("page_id").alias("of"))
        .where(F.col("of") % ASKING == 0)
        .distinct(),
        "warc-found",
    ).withColumn("there", F.lit(True))
    rows = read_all(shards).drop("payload", "url")
    asks = F.when(F.col("page_id") % ASKING == 0, F.col("page_id"))
    return rows.join(broadcast_if_small(found, FEW_ASKING), asks == F.col("of"), "left").select(
        *rows.columns,
        F.when(asks.isNotNull(), F.coalesce("there", F.lit(False))).alias("found_by_url"),
    )
