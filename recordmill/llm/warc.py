"""Deterministic sharded WARC writer and its reader.

Records are sorted by page id over shards of contiguous ranges of ids and digests. Each record is a gzip
member of its own; a shard's writer rolls to the next file when the compressed bytes written
reach ``roll_bytes``. Shard bounds come from exact sums over the whole table, members carry
no clock and no host, so the same rows give the same files whatever the cluster.

A task writes under a temporary name that holds its attempt; only names that reach the
written manifest are renamed, and readers open only what the committed manifest lists. A
task that is run again leaves a stray temporary file, never a second record.

Headers and digests are made anew from the payload on writing and checked on reading.

Nulls, ties, repeats: null html is an empty payload, a null url has no target header, a null
page id is kept as ``null`` (and sorts first). Of equal payloads of at least
``min_revisit_bytes`` the rows with the smallest page id are responses and the others refer
to it; rows with a null id refer to it as well, and are all responses if no row has an id.
Wholly repeated rows are records of their own. An empty table gives no files and no rows.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import short_batches
from recordmill.session import cut_lineage

DATE = "1970-01-01T00:00:00Z"  # records say nothing of when they were written
RECORD_ID = "urn:page:"
MAX_SHARDS = 100_000
RANGES = 4_096  # id ranges whose bytes are summed first to place the shard bounds
FINE = 16  # parts of a heavy range for each shard that it holds
DIGEST_DIGITS = 15

MEMBER_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, member binary"
MANIFEST_SCHEMA = "shard int, file int, temporary string, final string, records long, bytes long"
RECORD_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _member(raw: bytes) -> bytes:
    """``raw`` as a gzip member without name or time."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(raw) + packer.flush()
    tail = zlib.crc32(raw).to_bytes(4, "little") + (len(raw) & 0xFFFFFFFF).to_bytes(4, "little")
    return b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff" + body + tail


def _record_id(page_id: int | None) -> str:
    return f"<{RECORD_ID}{'null' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes | None, length: int, digest: str, refers_to: int | None = None) -> bytes:
    """One WARC record: a response with its payload, or a revisit (``payload`` None) with the HTTP header alone."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    headers = ["WARC/1.1", f"WARC-Type: {'response' if payload is not None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        headers.append(f"WARC-Target-URI: {quote(url.encode('utf-8', 'replace'), safe=SAFE)}")
    if payload is None:
        headers += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    else:
        block += payload
    headers += ["Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", f"Content-Length: {len(block)}"]
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


# Characters of a URL that stand for themselves in a header; fixed by the URL syntax.
SAFE = "!#$%&'()*+,-./:;=?@[]_~"


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every page as a compressed response, so that only compressed bytes are shuffled."""
    for batch in batches:
        out = {"page_id": [], "url": [], "payload_bytes": [], "payload_digest": [], "member": []}
        for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
            payload = (html or "").encode("utf-8", "surrogatepass")
            digest = hashlib.sha256(payload).hexdigest()
            row = (page_id, url, len(payload), digest, _member(record(page_id, url, payload, len(payload), digest)))
            for name, value in zip(out, row):
                out[name].append(value)
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()))], list(out))


def revisits(pages: DataFrame, min_revisit_bytes: int) -> DataFrame:
    """(page_id, payload_digest, refers_to) of the pages whose payload an earlier one has; narrow rows only."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    narrow = pages.select("page_id", F.sha2(payload, 256).alias("payload_digest"), F.octet_length(payload).cast("long").alias("payload_bytes"))
    long = narrow.where(F.col("payload_bytes") >= min_revisit_bytes)
    shared = long.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("rows")).where("rows > 1 AND refers_to IS NOT NULL").drop("rows")
    joined = long.select("page_id", "payload_digest").join(shared, "payload_digest")
    return joined.where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).distinct()


def shard_starts(pages: DataFrame, shard_bytes: int) -> list[tuple[int, int, int]]:
    """The keys (see :func:`_key`) at which the second and later shards start, in order; fewer than :data:`MAX_SHARDS`.

    A shard is a run of keys of about ``shard_bytes`` of text, or more where that would make
    more than :data:`MAX_SHARDS` of them; its writer streams, so that is no memory. Bounds
    come from exact sums of ranges of ids. A range that holds over a quarter of a shard is
    cut finer until it does not, a single id by digests; only rows of one id and one payload
    stay together whatever they weigh.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    digest = F.conv(F.substring(F.sha2(payload, 256), 1, DIGEST_DIGITS), 16, 10).cast("long")
    rows = pages.select("page_id", digest.alias("digest"), (F.octet_length(payload).cast("long") + 512).alias("bytes"))
    facts = pages.select("page_id", F.octet_length(payload).alias("b")).agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"), F.sum(F.col("b").cast("long") + 512).alias("bytes")).first()
    target = max(shard_bytes, -(-(facts["bytes"] or 0) // MAX_SHARDS))
    if (facts["bytes"] or 0) <= target:
        return []
    rows = cut_lineage(rows.withColumn("range", F.col("page_id").isNotNull().cast("int")))
    digests = (0, 16**DIGEST_DIGITS)
    ranges = {0: (0, 0, False, *digests)}  # number: (has an id, the id, cut by ids, low, width)
    if facts["first"] is not None:
        span = facts["last"] - facts["first"] + 1
        ranges[1] = (1, facts["first"], True, facts["first"], span) if span > 1 else (1, facts["first"], False, *digests)
    parts = dict.fromkeys(ranges, RANGES)
    leaves = []
    while ranges:
        steps = {n: -(-width // parts[n]) for n, (_, _, _, _, width) in ranges.items()}
        cuts = [(n, by_id, str(low), str(steps[n])) for n, (_, _, by_id, low, _) in ranges.items()]
        cuts = rows.sparkSession.createDataFrame(cuts, "range int, by_id boolean, low string, step string")
        # at most four ranges for each shard
        at = F.expr("(CAST(if(by_id, page_id, digest) AS DECIMAL(20,0)) - CAST(low AS DECIMAL(20,0))) div CAST(step AS DECIMAL(20,0))")
        rows = rows.join(F.broadcast(cuts), "range").select("page_id", "digest", "bytes", "range", at.alias("part"))
        heavy = {}
        for n, part, size in rows.groupBy("range", "part").agg(F.sum("bytes")).collect():
            has_id, page_id, by_id, low, _ = ranges[n]
            low, step = low + part * steps[n], steps[n]
            key = (has_id, low, 0) if by_id else (has_id, page_id, low)
            if size <= target // 4 or (step == 1 and not by_id):
                leaves.append((key, size))
            elif step == 1:
                heavy[n, part] = ((1, low, False, *digests), size)
            else:
                heavy[n, part] = ((has_id, low if by_id else page_id, by_id, low, step), size)
        ranges = {i: found for i, (found, _) in enumerate(heavy.values())}
        parts = {i: max(FINE * -(-size // target), RANGES // len(heavy)) for i, (_, size) in enumerate(heavy.values())}
        if heavy:
            names = rows.sparkSession.createDataFrame([(n, part, i) for i, (n, part) in enumerate(heavy)], "range int, part long, next int")
            rows = rows.join(F.broadcast(names), ["range", "part"]).select("page_id", "digest", "bytes", F.col("next").alias("range"))
    starts, before, shard = [], 0, 0
    for key, size in sorted(leaves):
        if before // target > shard:
            shard = before // target
            starts.append(key)
        before += size
    return starts


def _key(page_id: int | None, digest: str) -> tuple[int, int, int]:
    """What records are dealt to shards by: ids, null first, then the payload's digest."""
    return (page_id is not None, page_id or 0, int(digest[:DIGEST_DIGITS], 16))


def _dealer(starts: list[tuple[int, int, int]]):
    """Adds the shard to rows that have (page_id, payload_digest)."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column("page_id").to_pylist(), batch.column("payload_digest").to_pylist())
            shards = pa.array([bisect_right(starts, _key(*key)) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, shards], [*batch.schema.names, "shard"])

    return deal


def _writer(uri: str, roll_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(uri)
        store.create_dir(f"{root}/_temporary", recursive=True)
        done, known, current, sink, shard = [], {}, None, None, None

        def close():
            nonlocal sink, current
            if sink is not None:
                sink.close()
                done.append(current)
            sink = current = None

        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    close()
                    shard, number, known = row["shard"], 0, {}
                if row["member"] is None:  # says whom the pages that follow refer to
                    if known.get("page_id", ()) != row["page_id"]:
                        known = {"page_id": row["page_id"]}
                    known[row["payload_digest"]] = row["refers_to"]
                    continue
                member = row["member"]
                if known.get("page_id", ()) == row["page_id"] and row["payload_digest"] in known:
                    member = _member(record(row["page_id"], row["url"], None, row["payload_bytes"], row["payload_digest"], known[row["payload_digest"]]))
                if current is not None and current["bytes"] + len(member) > roll_bytes:
                    close()
                    number += 1
                if sink is None:
                    final = f"{root}/part-{shard:05d}-{number:05d}.warc.gz"
                    current = {"shard": shard, "file": number, "temporary": f"{root}/_temporary/{shard:05d}-{number:05d}-{uuid.uuid4().hex}", "final": final, "records": 0, "bytes": 0}
                    sink = store.open_output_stream(current["temporary"], compression=None)
                sink.write(member)
                current["records"] += 1
                current["bytes"] += len(member)
        close()
        names = [("shard", pa.int32()), ("file", pa.int32()), ("temporary", pa.string()), ("final", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]
        if done:
            yield pa.RecordBatch.from_pylist(done, pa.schema(names))

    return write


def _committer(uri: str):
    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(uri)
        for batch in batches:
            for row in batch.to_pylist():
                if store.get_file_info(row["temporary"]).type == fs.FileType.File:
                    store.move(row["temporary"], row["final"])
                found = store.get_file_info(row["final"])  # a repeated task finds its work done
                if found.type != fs.FileType.File or found.size != row["bytes"]:
                    raise OSError(f"{row['final']} should hold {row['bytes']} bytes, it has {found.size}")
            yield batch

    return commit


def write_archives(pages: DataFrame, uri: str, min_revisit_bytes: int = 100, shard_bytes: int = 64 << 20, roll_bytes: int = 32 << 20) -> DataFrame:
    """Write ``pages`` (page_id, url, html) under ``uri``; return the committed manifest, one row per file."""
    spark = pages.sparkSession
    short_batches(spark)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    starts = shard_starts(pages, shard_bytes)
    deal = _dealer(starts)
    members = pages.mapInArrow(lambda batches: deal(_members(batches)), MEMBER_SCHEMA + ", shard int").withColumn("refers_to", F.lit(None).cast("long"))
    notes = revisits(pages, min_revisit_bytes).select("page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("long").alias("payload_bytes"), "payload_digest", F.lit(None).cast("binary").alias("member"), "refers_to")
    notes = notes.mapInArrow(deal, MEMBER_SCHEMA + ", refers_to long, shard int")
    dealt = members.unionByName(notes).repartitionById(len(starts) + 1, F.col("shard"))
    ordered = dealt.sortWithinPartitions("shard", "page_id", F.col("member").isNotNull(), "url", "payload_digest")
    manifest = cut_lineage(ordered.mapInArrow(_writer(uri, roll_bytes), MANIFEST_SCHEMA))
    committed = cut_lineage(manifest.mapInArrow(_committer(uri), MANIFEST_SCHEMA))
    store, root = fs.FileSystem.from_uri(uri)
    if store.get_file_info(f"{root}/_temporary").type == fs.FileType.Directory:
        store.delete_dir(f"{root}/_temporary")  # strays of tasks that were run again
    return committed


def _member_texts(source) -> Iterator[bytes]:
    """The records of an archive, one gzip member at a time."""
    rest = b""
    while True:
        piece = rest or source.read(1 << 18)
        if not piece:
            return
        opened, parts = zlib.decompressobj(31), []
        while not opened.eof:
            parts.append(opened.decompress(piece))
            if not opened.eof:
                piece = source.read(1 << 18)
                if not piece:
                    raise OSError("an archive ends within a record")
        rest = opened.unused_data
        yield b"".join(parts)


def parse(raw: bytes) -> dict:
    """A record's fields; its digests are checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    if headers["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError(f"{headers['WARC-Record-ID']}: the block doesn't match its digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if headers["WARC-Type"] == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"{headers['WARC-Record-ID']}: the payload doesn't match its digest")
    number = lambda text: None if text is None or text.endswith("null>") else int(text.strip("<>").removeprefix(RECORD_ID))
    return {
        "page_id": number(headers["WARC-Record-ID"]),
        "url": headers.get("WARC-Target-URI"),
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": headers["WARC-Type"],
        "refers_to": number(headers.get("WARC-Refers-To")),
    }


def _reader(uri: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(uri)
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        schema = pa.schema(list(zip(("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"), types)))
        for batch in batches:
            for row in batch.to_pylist():
                rows = []
                with store.open_input_stream(row["final"], compression=None) as source:
                    for raw in _member_texts(source):
                        rows.append(parse(raw))
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return read


def read_archives(manifest: DataFrame, uri: str) -> DataFrame:
    """The records of the files in a committed manifest; a task takes about a file."""
    files = max(1, min(manifest.count(), 10_000))
    return manifest.repartition(files, "final").mapInArrow(_reader(uri), RECORD_SCHEMA)
