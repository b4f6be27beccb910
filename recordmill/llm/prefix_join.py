"""Grouped prefix join: documents whose shingle sets have a Jaccard similarity of at least t.

A document's set holds the 64-bit hashes of its distinct word shingles. Shingles are ordered
by how often their hash bucket occurs in the corpus, rare ones first; two sets that are
similar enough must share a shingle among the first ``n - ceil(t * n) + 1`` of each (the prefix).

Documents with the same set are one node. Nodes with the same size and prefix are one group;
postings are made for groups only, and postings of a shingle that a single group has are
dropped. Surviving groups are expanded to their members, and pairs that pass the size and
position bounds are verified on the whole texts.

All pairs of a group of near copies are never made: first, and as long as the pairs that pass the bounds between
different components are more than twice the postings, every posting list only compares its
members with a few hubs, and what links falls into one component, whose inner pairs need no
further look. When few are left, all of them are verified, so that no link between
components is lost. A list is put aside once it lies in one component or every two of its
members have been compared, so later rounds move the long lists only.

Besides size and place, pairs are held to a parity bound: each set has the parities of its
hashes in 256 classes, and two sets differ in at least as many shingles as classes. Before
texts are moved the same bound is held to sketches, which have a class for each shingle at least.

Nulls, ties, repeats: words are cut at white space after A-Z became lower case; a text with
fewer words than a shingle is one shingle, one without words is empty and links with
nothing. A null id links with nothing and has a null component. Rows that repeat an id with
other texts are linked through that id. An empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordmill.llm.common import at_most_partitions, files_for, map_batches, short_batches
from recordmill.llm.components import components
from recordmill.session import cut_lineage

BUCKETS = 1 << 20  # of the frequency table, four megabytes
BLOCK = 1 << 12
BYTES_AT_ONCE = 1 << 18
BROADCAST_IDS = 1_000_000
HUB_ROUNDS = 24
OPEN_PAIRS = 512  # pairs of a shingle's members still apart, per posting, whose bounds are looked at
OPEN_IN_LIST = 1 << 30  # and of one shingle, which are one task's
LOOKED_AT = 6  # rounds after which the bounds of all are looked at
MOST_HUBS = 32
TILE = 256
PACKING = 6  # level of the compression of texts that are moved
UNPACKED = 16  # texts of a tile that lie open at once
HUB_PARTS = 16  # of a hub's partners, at least
ODD = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

PARITIES = ["p0", "p1", "p2", "p3"]  # of 64 classes each
TEXTS_A_TASK = 64  # at least, when there are fewer than this times the partitions

SIGNATURE_SCHEMA = "doc_id long, n int, digest binary, prefix_digest binary, prefix binary, " + ", ".join(f"{p} long" for p in PARITIES) + ", sketch binary"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(1)
def _letters() -> np.ndarray:
    """A fixed 64-bit number for each byte, capitals as their small letters."""
    lower = np.arange(256, dtype=np.uint64)
    lower[65:91] += np.uint64(32)
    return _mix(lower * ODD + np.uint64(1))


@lru_cache(1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for factor in (ODD, INVERSE):
        line = np.full(size, factor, np.uint64)
        line[0] = 1
        out.append(np.multiply.accumulate(line))
    return out[0], out[1]


def _sets_of(parts: list[bytes], size: int) -> list[np.ndarray]:
    data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    room = 1 << max(18, int(len(data)).bit_length())
    power, inverse = _powers(room)
    white = (data == 32) | ((data >= 9) & (data <= 13))
    change = np.flatnonzero(np.diff(np.concatenate([[True], white]).astype(np.int8)))
    begins, ends = change[::2], change[1::2]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_letters()[data] * power[: len(data)])])
    words = _mix((sums[ends] - sums[begins]) * inverse[begins] + (ends - begins).astype(np.uint64))
    bounds = np.searchsorted(begins, np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])]))
    out = []
    if len(words) >= size:
        line = words[: len(words) - size + 1].copy()
        for k in range(1, size):
            line = _mix(line * ODD + words[k : len(words) - size + 1 + k])
    for first, last in zip(bounds, bounds[1:]):
        if last - first >= size:
            out.append(np.unique(line[first : last - size + 1]))
        elif last > first:
            short = words[first]
            for word in words[first + 1 : last]:
                short = _mix(np.array([short * ODD + word], np.uint64))[0]
            out.append(_mix(np.array([short + np.uint64(last - first)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each whole text."""
    out, waiting, held = [], [], 0
    with np.errstate(over="ignore"):
        for text in texts:
            part = (text or "").encode("utf-8", "surrogatepass")
            if waiting and held + len(part) > BYTES_AT_ONCE:
                out += _sets_of(waiting, size)
                waiting, held = [], 0
            waiting.append(part)
            held += len(part)
        if waiting:
            out += _sets_of(waiting, size)
    return out


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(44)).astype(np.int64)


def bucket_frequencies(rows: DataFrame, size: int) -> np.ndarray:
    """For each bucket, how many documents' shingles fall into it; counted over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.uint32)
        for batch in batches:
            sets = shingle_sets(batch.column(0).to_pylist(), size)
            if sets:
                counts += np.bincount(_buckets(np.concatenate(sets)), minlength=BUCKETS).astype(np.uint32)
        for block in range(BUCKETS // BLOCK):
            part = counts[block * BLOCK : (block + 1) * BLOCK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["block", "counts"])

    def add(frames):
        sums: dict[int, np.ndarray] = {}
        for batch in frames:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(counts, np.uint32 if len(counts) == 4 * BLOCK else np.uint64).astype(np.uint64)
                sums[block] = sums.get(block, 0) + part
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["block", "counts"])

    # a partition's sums are a table of fixed size, and so is what the driver gets
    parts = map_batches(rows.select("text"), count, "block int, counts binary").repartition(32, "block")
    table = np.zeros(BUCKETS, np.uint64)
    for row in map_batches(parts, add, "block int, counts binary").toLocalIterator():
        table[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] += np.frombuffer(row["counts"], np.uint64)
    return table


def classes(frequencies: np.ndarray) -> np.ndarray:
    """Frequency classes of the buckets: quarter powers of two above the usual bucket."""
    usual = max(float(np.median(frequencies)), 1.0)
    return np.clip(4 * np.log2(np.maximum(frequencies / usual, 1.0)), 0, 255).astype(np.uint8)


def signatures(rows: DataFrame, class_table: bytes, size: int, percent: int) -> DataFrame:
    """(doc_id, n, digest, prefix_digest, prefix, parities, sketch): the set's size and digest, its prefix in the common order, its parities and its sketch."""
    shared = rows.sparkSession.sparkContext.broadcast(class_table)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            n, digests, heads, prefixes, parities, sketches = [], [], [], [], [], []
            for held in shingle_sets(batch.column(1).to_pylist(), size):
                kept = len(held) - (percent * len(held) + 99) // 100 + 1 if len(held) else 0
                first = held[np.argsort(order[_buckets(held)], kind="stable")[:kept]]  # by class, then by hash
                n.append(len(held))
                digests.append(hashlib.blake2b(held.tobytes(), digest_size=16).digest())
                prefixes.append(first.astype(">u8").tobytes())
                heads.append(hashlib.blake2b(prefixes[-1], digest_size=16).digest())
                parities.append(_parities(held))
                sketches.append(_sketch(held))
            told = [pa.array(n, pa.int32()), *(pa.array(x, pa.binary()) for x in (digests, heads, prefixes))]
            told += [pa.array(p) for p in np.array(parities, np.int64).reshape(-1, len(PARITIES)).T]
            told.append(pa.array(sketches, pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *told], ["doc_id", "n", "digest", "prefix_digest", "prefix", *PARITIES, "sketch"])

    return map_batches(rows.select("doc_id", "text"), sign, SIGNATURE_SCHEMA)


def _odd(held: np.ndarray, many: int) -> np.ndarray:
    """The parity of the hashes in each of ``many`` classes, a power of two, as packed bits."""
    return np.packbits((np.bincount((held & np.uint64(many - 1)).astype(np.int64), minlength=many) & 1).astype(np.uint8))


def _parities(held: np.ndarray) -> np.ndarray:
    """The parity of the hashes in each of 256 classes, as four 64-bit numbers."""
    return _odd(held, 64 * len(PARITIES)).view(np.int64)


def _sketch(held: np.ndarray) -> bytes:
    """Parities in at least as many classes as there are hashes, so that they tell large sets apart too."""
    return _odd(held, max(64, 1 << (len(held) - 1).bit_length() if len(held) else 0)).tobytes()


def _unlike(one: bytes, two: bytes) -> int:
    """In how many classes of the smaller sketch the parities differ: never more than the sets differ in."""
    x, y = (np.frombuffer(b, np.uint64) for b in sorted((one, two), key=len))
    while len(y) > len(x):  # a class is the sum of two of twice as many
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _postings(groups: DataFrame) -> DataFrame:
    """(token, grp, told): one row per prefix shingle of each group; ``told`` packs n, place and whether there are members."""

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefixes = batch.column(2).to_pylist()
            lengths = np.array([len(p) // 8 for p in prefixes], np.int64)
            tokens = np.frombuffer(b"".join(prefixes), ">u8").astype(np.uint64).view(np.int64)
            ends = np.cumsum(lengths)
            place = np.arange(len(tokens)) - np.repeat(ends - lengths, lengths)
            ids, sizes, members = (np.repeat(batch.column(i).to_numpy(), lengths) for i in (0, 1, 3))
            told = (sizes.astype(np.int64) << 32) + (place << 1) + (members > 1)
            yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(ids), pa.array(told)], ["token", "grp", "told"])

    return map_batches(groups.select("grp", "n", "prefix", "members"), unfold, "token long, grp long, told long")


def _tiles(pairs: DataFrame) -> DataFrame:
    """(tile, a, b): pairs that share documents come together, at most about twice TILE documents to a tile."""
    clusters = cut_lineage(components(pairs))
    sizes = clusters.groupBy("component").agg(F.ceil(F.count("*") / TILE).alias("blocks"))
    blocks = clusters.join(sizes, "component").select("node", "component", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"))
    one, two = (blocks.toDF(end, f"cluster_{end}", f"block_{end}") for end in ("a", "b"))
    both = pairs.join(one, "a").join(two, "b")
    low, high = F.least("block_a", "block_b"), F.greatest("block_a", "block_b")
    return both.select(F.xxhash64("cluster_a", low, high).alias("tile"), "a", "b")


def _hub_tiles(pairs: DataFrame) -> DataFrame:
    """(tile, a, b) of pairs with a hub ``a``: its partners in sixteen parts, or more so that a part has about TILE."""
    large = pairs.groupBy("a").agg(F.count("*").alias("partners")).where(F.col("partners") > HUB_PARTS * TILE)
    large = cut_lineage(large.select(F.col("a").alias("hub"), F.ceil(F.col("partners") / TILE).alias("many")))
    # a hub of these has over four thousand pairs, so they are few
    named = F.broadcast(large) if large.count() <= BROADCAST_IDS else large
    parts = F.coalesce("many", F.lit(HUB_PARTS))
    return pairs.join(named, F.col("a") == F.col("hub"), "left").select(F.xxhash64("a", F.pmod(F.xxhash64("b"), parts)).alias("tile"), "a", "b")


def _packed(texts: DataFrame) -> DataFrame:
    """(tile, a, text): texts compressed for the way to their tiles."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=PACKING)
        for batch in batches:
            packed = [packer.compress((t or "").encode("utf-8", "surrogatepass")) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["tile", "a", "text"])

    return map_batches(texts, pack, "tile long, a long, text binary")


def verify(tiled: DataFrame, texts: DataFrame, size: int, percent: int, files: int | None = None) -> DataFrame:
    """The (a, b) of (tile, a, b) whose whole texts, the rows (doc_id, text) say, are similar enough.

    A text goes once to each tile that has a pair of it, not once to each pair. ``files`` are those of a step of the pairs.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, texts, sets = None, [], {}
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            linked = []
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if row[0] != tile:
                    tile, texts, sets = row[0], [], {}
                if row[2] is None:
                    texts.append((row[1], row[3]))
                    continue
                if texts:  # all of the tile's texts have come
                    for first in range(0, len(texts), UNPACKED):
                        some = texts[first : first + UNPACKED]
                        unpacked = [opener.decompress(t).decode("utf-8", "surrogatepass") for _, t in some]
                        for (node, _), held in zip(some, shingle_sets(unpacked, size)):
                            sets.setdefault(node, []).append(held)
                    texts = []
                if any(_similar(x, y, percent) for x in sets[row[1]] for y in sets[row[2]]):
                    linked.append((row[1], row[2]))
            if linked:
                yield pa.RecordBatch.from_arrays([pa.array(side, pa.int64()) for side in zip(*linked)], ["a", "b"])

    tiled = cut_lineage(tiled, files)
    seats = cut_lineage(tiled.select("tile", F.col("a").alias("node")).union(tiled.select("tile", "b")).distinct(), files)
    taken = seats.count()
    few = taken <= BROADCAST_IDS
    # only the texts of this round's pairs are moved
    seated = texts.join(F.broadcast(seats) if few else seats, F.col("doc_id") == F.col("node"))
    seated = _packed(seated.select("tile", F.col("node").alias("a"), "text")).withColumn("b", F.lit(None).cast("long"))
    rows = seated.unionByName(tiled.withColumn("text", F.lit(None).cast("binary")))
    parts = at_most_partitions(texts.sparkSession, taken, TEXTS_A_TASK)
    ordered = rows.select("tile", "a", "b", "text").repartition(parts, "tile").sortWithinPartitions("tile", F.col("b").isNotNull())
    return map_batches(ordered, check, "a long, b long")


def _similar(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(one, two, assume_unique=True))
    return shared > 0 and 100 * shared >= percent * (len(one) + len(two) - shared)


def _large_enough(one: str, two: str, percent: int, parities: list[str] = PARITIES) -> str:
    """The size, position and parity bounds of two postings of one shingle, as a condition."""
    unlike = " + ".join(["0", *(f"bit_count({one}.{p} ^ {two}.{p})" for p in parities)])
    most = f"least({one}.n - {one}.place, {two}.n - {two}.place)"
    return f"(100 + {percent}) * {most} >= {percent} * ({one}.n + {two}.n) AND 100 * least({one}.n, {two}.n) >= {percent} * greatest({one}.n, {two}.n) AND (100 + {percent}) * ({unlike}) <= (100 - {percent}) * ({one}.n + {two}.n)"


def _may_link(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` that their sketches, the rows (node, n, sketch), do not rule out; an id's rows all count."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, sizes, two_sizes, one, two = (batch.column(i).to_pylist() for i in range(6))
            near = [(100 + percent) * _unlike(x, y) <= (100 - percent) * (n + m) for x, y, n, m in zip(one, two, sizes, two_sizes)]
            yield pa.RecordBatch.from_arrays([pa.array([v for v, ok in zip(side, near) if ok], pa.int64()) for side in (a, b)], ["a", "b"])

    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    few = 2 * pairs.count() <= BROADCAST_IDS
    held = sketches.join(F.broadcast(ends) if few else ends, "node", "left_semi")
    both = pairs.join(held.toDF("a", "n_a", "sketch_a"), "a").join(held.toDF("b", "n_b", "sketch_b"), "b")
    return map_batches(both.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b"), check, "a long, b long").distinct()


def join_components(documents: DataFrame, size: int = 4, percent: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id): the smallest id reachable by links of at least ``percent`` similarity."""
    spark = documents.sparkSession
    short_batches(spark)
    rows = documents.selectExpr(f"CAST(`{doc_id}` AS bigint) AS doc_id", f"`{text}` AS text")
    order = classes(bucket_frequencies(rows, size)).tobytes()
    signed = cut_lineage(signatures(rows, order, size, percent))
    linkable = signed.drop("prefix", "sketch").where("n > 0 AND doc_id IS NOT NULL")
    nodes = cut_lineage(linkable.groupBy("digest", "n", "prefix_digest").agg(F.min("doc_id").alias("node"), *(F.min(p).alias(p) for p in PARITIES)))
    grouped = cut_lineage(nodes.groupBy("n", "prefix_digest").agg(F.min("node").alias("grp"), F.count("*").alias("members")))
    members = cut_lineage(nodes.join(grouped.where("members > 1"), ["n", "prefix_digest"]).select("node", "grp"))
    several = F.broadcast(members) if members.count() <= BROADCAST_IDS else members
    few = grouped.count() <= BROADCAST_IDS
    named = grouped.toDF("group_n", "group_digest", "grp", "members")
    named = F.broadcast(named) if few else named
    # the prefixes stay where they are unless there are very many groups
    same = (F.col("doc_id") == F.col("grp")) & (F.col("n") == F.col("group_n")) & (F.col("prefix_digest") == F.col("group_digest"))
    postings = _postings(signed.join(named, same))
    # one exchange by token: a posting is kept if its list has another, or if its group has members
    postings = postings.withColumn("nodes", F.sum(F.expr("1 + (told & 1)")).over(Window.partitionBy("token"))).where("nodes > 1")
    inner = members.where("node <> grp").select(F.col("grp").alias("a"), F.col("node").alias("b"))
    # whatever can still link: members of the postings kept, and members of one group
    unpacked = postings.selectExpr("token", "grp", "CAST(told >> 32 AS int) AS n", "CAST((told & 4294967295) >> 1 AS int) AS place")
    expanded = cut_lineage(unpacked.join(several, "grp", "left").select("token", "place", "n", F.coalesce("node", "grp").alias("node")))
    sketches = signed.where("n > 0").select(F.col("doc_id").alias("node"), "n", "sketch")
    labels = _resolve(expanded, inner, rows, _repeated_ids(linkable, nodes), nodes.select("node", *PARITIES), sketches, size, percent)
    placed = signed.join(nodes.select("digest", "node"), "digest", "left")
    placed = placed.join(labels, "node", "left")
    own = F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("component", "node"))
    return placed.select("doc_id", F.col("n").cast("long").alias("n_shingles"), own.cast("long").alias("component_id"))


def _repeated_ids(linkable: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b) links of nodes that share an id."""
    several = linkable.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id")
    placed = linkable.join(several, "doc_id").join(nodes.select("digest", "node"), "digest").select("doc_id", "node").distinct()
    return placed.select(F.col("doc_id").alias("a"), F.col("node").alias("b"))


def _distinct_pairs(met: DataFrame, tried: DataFrame, a: Column, b: Column) -> DataFrame:
    """The (a, b) of ``met`` that were not tried in either order."""
    pairs = met.select(a.alias("a"), b.alias("b")).distinct()
    return pairs.join(tried.union(tried.select("b", "a")), ["a", "b"], "left_anti")


def _open_lists(postings: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """The postings of lists with several components, in one exchange.

    Each has its component and seat, the pairs of its list that are still apart (``left``), how many postings the list
    has (``k``), how many of them are the hub of no seat (``unmet``), and the hub of its seat.
    """
    seat = F.pmod(F.xxhash64("node", F.lit(-1 - turn)), F.lit(MOST_HUBS if turn else 1)).cast("int")
    placed = postings.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")).withColumn("seat", seat)
    whole, part = Window.partitionBy("token"), Window.partitionBy("token", "component")
    told = placed.repartition("token").withColumn("alike", F.count("*").over(part))
    told = told.withColumns({"k": F.count("*").over(whole), "alike": F.sum("alike").over(whole), "seats": F.expr("bit_or(shiftleft(1L, seat)) OVER (PARTITION BY token)")})
    told = told.withColumns({"left": F.expr("(k * k - alike) div 2"), "unmet": F.expr("k - bit_count(seats)")}).where("left > 0").drop("alike", "seats")
    if turn:
        return told
    # one seat: the hub of the list is the hub of each of its postings
    first = F.min(F.struct(F.xxhash64("node", F.lit(turn)), "node", "n", "place", "component")).over(whole)
    return told.withColumn("hub", first).withColumn("hub", F.struct(*(F.col(f"hub.{c}").alias(c) for c in ("node", "n", "place", "component"))))


def _resolve(postings: DataFrame, inner: DataFrame, texts: DataFrame, given: DataFrame, parities: DataFrame, sketches: DataFrame, size: int, percent: int) -> DataFrame:
    """(node, component) of all nodes with a link."""
    tried = inner
    links = cut_lineage(verify(_hub_tiles(inner), texts, size, percent, files_for(inner.count())).unionByName(given))
    labels = cut_lineage(components(links))
    # members of one group that do not link with its first are compared by their postings; theirs are all the same
    rows = postings.count()
    files = files_for(rows)
    for turn in range(HUB_ROUNDS + 1):
        x = cut_lineage(_open_lists(postings, labels, turn), files)
        left, longest = x.agg(F.coalesce(F.sum(F.col("left") / F.col("k")), F.lit(0)), F.max("left")).first()
        if not left:
            break
        pairs, last = None, False
        if turn > 1 and (left <= OPEN_PAIRS * rows and longest <= OPEN_IN_LIST or turn >= LOOKED_AT):
            met = x.alias("x").join(x.alias("y"), F.expr("x.token = y.token AND x.node < y.node AND x.component <> y.component AND " + _large_enough("x", "y", percent)))
            pairs = cut_lineage(_distinct_pairs(met, tried, F.least("x.node", "y.node"), F.greatest("x.node", "y.node")), files)
            last = turn == HUB_ROUNDS or pairs.count() <= 2 * rows
        if not last:
            # one hub of each list first, by size and place alone, then several
            if not turn:
                met = x.selectExpr("struct(node, n, place, component) AS x", "hub AS y").where("x.component <> y.component AND " + _large_enough("x", "y", percent, []))
            else:
                hubs = x.groupBy("token", "seat").agg(F.min(F.struct(F.xxhash64("node", F.lit(turn)), "node", "n", "place", "component", *PARITIES)).alias("hub"))
                hubs = hubs.select("token", *(f"hub.{c}" for c in ("node", "n", "place", "component", *PARITIES))).alias("y")
                met = x.alias("x").join(hubs, F.expr("x.token = y.token AND x.component <> y.component AND " + _large_enough("x", "y", percent)))
            pairs = cut_lineage(_distinct_pairs(met, tried, F.col("y.node"), F.col("x.node")), files)
        near = cut_lineage(_may_link(pairs, sketches, percent), files_for(pairs.count()))
        found = verify(_tiles(near) if last else _hub_tiles(near), texts, size, percent, files_for(near.count()))
        tried = tried.unionByName(pairs)
        stars = labels.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        labels = cut_lineage(components(found.unionByName(stars)))
        if last:
            break
        # any two postings of the other lists were met, one of them as a hub
        postings = x.where("unmet > 1").select("token", "node", "n", "place", *(PARITIES if turn else []))
        postings = postings if turn else postings.join(parities, "node")
    return labels
