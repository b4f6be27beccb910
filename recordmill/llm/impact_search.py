"""Exact top-k inner products from an impact-ordered index, processed score at a time.

Vectors are quantised to integers and dealt into blocks of bounded size. The index of a block
holds, for each dimension, posting segments of equal quantised impact: the rows whose
component has that size and sign. A query walks the segments in descending order of
``|weight| * impact``, whatever the sign of the product. A row's accumulator holds the
products it has met; each dimension it hasn't met yet gives at most the largest positive
impact still to come there. The walk ends only when that proves which rows can still be
members; those are rescored exactly.

Each query first meets the block that holds it. Its k-th score there goes with it to all
other blocks as a threshold that members have to reach. Queries move, the index doesn't: a
task holds one block, and the queries pass it a pack at a time.

Nulls, ties, repeats: vectors that are null, or hold null or non-finite components, and null
ids take no part. An id given more than once counts once, with the smallest of its quantised
vectors. Missing trailing components count as zero. Ties go to the smaller id. An empty
table gives no rows; columns other than the two named ones are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordmill.session import cut_lineage

VECTOR_BLOCK = 8192
LEVEL = 8  # components from n*8 to n*8+7 share a segment
CHECKS = 8  # times the proof is tried while segments are walked
SHALLOW = 16  # rows rescored at each check to raise the threshold
RESCORED = 3  # the walk ends once all but one in so many rows are ruled out: the rest costs less to rescore than to walk on
PROBES = 128  # rows that tell whether a check is worth the bounds of all rows

INDEX_SCHEMA = "block int, ids binary, rows binary, dim int, postings binary, starts binary, segment_dim binary, segment_sign binary, segment_size binary"
QUERY_SCHEMA = "home int, query_ids binary, query_rows binary, query_dim int, floors binary"
NO_FLOOR = -(2**63)
HITS_SCHEMA = "query_id long, vec_id long, score long"


def quantise(vectors: DataFrame, vec_id: str, vector: str, scale: int = 256) -> DataFrame:
    """(vec_id, q array<long>): floor(scale * x) of each component, one row per id."""
    x = F.col(vector)
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    q = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    kept = vectors.where(F.col(vec_id).isNotNull() & x.isNotNull() & sound)
    return kept.select(F.col(vec_id).cast("long").alias("vec_id"), q.alias("q")).groupBy("vec_id").agg(F.min("q").alias("q"))


def _matrix(rows: pd.Series) -> np.ndarray:
    width = max((len(r) for r in rows), default=0)
    if all(len(r) == width for r in rows):
        return np.array(rows.tolist(), dtype=np.int64).reshape(len(rows), width)
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _build(block: pd.DataFrame) -> pd.DataFrame:
    """One index row: the block's vectors and, by dimension and sign, segments of equal impact."""
    block = block.sort_values("vec_id")
    rows = _matrix(block["q"])
    n, dim = rows.shape
    postings, starts, dims, signs, sizes = [], [0], [], [], []
    for d in range(dim):
        column = rows[:, d]
        impact = np.sign(column) * (np.abs(column) // LEVEL + 1)
        order = np.argsort(impact, kind="stable").astype(np.int32)
        levels, first = np.unique(impact[order], return_index=True)
        for level, begin, end in zip(levels, first, [*first[1:], n]):
            if level:
                postings.append(order[begin:end])
                starts.append(starts[-1] + end - begin)
                dims.append(d)
                signs.append(np.sign(level))
                sizes.append(np.abs(column[order[begin:end]]).max())
    flat = np.concatenate(postings) if postings else np.zeros(0, np.int32)
    packed = {
        "block": [int(block["block"].iloc[0])],
        "ids": [block["vec_id"].to_numpy(np.int64).tobytes()],
        "rows": [rows.tobytes()],
        "dim": [dim],
        "postings": [flat.tobytes()],
        "starts": [np.array(starts, np.int64).tobytes()],
        "segment_dim": [np.array(dims, np.int64).tobytes()],
        "segment_sign": [np.array(signs, np.int64).tobytes()],
        "segment_size": [np.array(sizes, np.int64).tobytes()],
    }
    return pd.DataFrame(packed)


def build_index(quantised: DataFrame, blocks: int) -> DataFrame:
    """One row per block of about :data:`VECTOR_BLOCK` vectors."""
    dealt = quantised.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block").applyInPandas(_build, INDEX_SCHEMA)


def _pack_queries(block: pd.DataFrame) -> pd.DataFrame:
    block = block.sort_values("vec_id")
    rows = _matrix(block["q"])
    return pd.DataFrame(
        {
            "home": [int(block["home"].iloc[0])],
            "query_ids": [block["vec_id"].to_numpy(np.int64).tobytes()],
            "query_rows": [rows.tobytes()],
            "query_dim": [rows.shape[1]],
            "floors": [block["floor"].to_numpy(np.int64).tobytes()],
        }
    )


class BlockIndex:
    """A block's index row, ready to be walked."""

    def __init__(self, row):
        self.ids = np.frombuffer(row.ids, np.int64)
        self.exact = np.frombuffer(row.rows, np.int64).reshape(len(self.ids), int(row.dim))
        self.postings = np.frombuffer(row.postings, np.int32)
        self.starts = np.frombuffer(row.starts, np.int64)
        self.dims = np.frombuffer(row.segment_dim, np.int64)
        self.signs = np.frombuffer(row.segment_sign, np.int64)
        self.sizes = np.frombuffer(row.segment_size, np.int64)
        lengths = np.diff(self.starts)
        rows_of = np.repeat(self.dims, lengths)
        self.values = np.abs(self.exact[self.postings, rows_of]).astype(np.float64) if len(self.postings) else np.zeros(0)
        self.probes = np.arange(0, len(self.ids), max(1, len(self.ids) // PROBES))
        self.lengths = lengths
        cells = self.postings * np.int64(row.dim) + rows_of  # of a matrix of rows and dimensions
        self.cells = cells.astype(np.int32) if self.exact.size < 2**31 else cells
        largest = int(np.abs(self.exact).max(initial=0))
        self.small = largest  # for the test whether doubles are exact
        self.walked = 0  # postings

    def top(self, weights: np.ndarray, own: int, k: int, floor: int = NO_FLOOR) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the k best rows of the block that reach ``floor``, ``own`` left out."""
        n, dim = self.exact.shape
        w = np.zeros(dim, np.int64)
        w[: min(dim, len(weights))] = weights[:dim]
        allowed = self.ids != own
        wanted = min(k, int(allowed.sum()))
        if not wanted:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if float(np.abs(w).max(initial=0)) * self.small * max(dim, 1) >= 2.0**52:
            return self._best(np.flatnonzero(allowed), w, wanted, floor)  # doubles would round
        weight = w[self.dims] * self.signs
        live = np.flatnonzero(weight)
        live = live[np.argsort(-np.abs(weight[live]) * self.sizes[live], kind="stable")]
        impact = np.maximum(weight[live], 0) * self.sizes[live]
        ends = np.cumsum(self.lengths[live])
        gains = np.zeros(n)
        gains[~allowed] = -np.inf
        met = np.zeros(n * dim, bool)
        known = met.reshape(n, dim)
        threshold, done = -np.inf if floor == NO_FLOOR else float(floor), 0
        candidates = np.flatnonzero(allowed)
        total = int(ends[-1]) if len(ends) else 0
        for check in range(1, CHECKS + 1):
            upto = int(np.searchsorted(ends, total * check / CHECKS, side="left")) + 1 if total else 0
            upto = len(live) if check == CHECKS else min(upto, len(live))
            if upto > done:
                step = live[done:upto]
                at = _ranges(self.starts[step], self.lengths[step])
                weighed = self.values[at] * np.repeat(weight[step], self.lengths[step])
                gains += np.bincount(self.postings[at], weights=weighed, minlength=n)
                met[self.cells[at]] = True
                self.walked += len(at)
                done = upto
            rest = np.zeros(dim)
            np.maximum.at(rest, self.dims[live[done:]], impact[done:])
            ahead = np.argpartition(-gains, min(SHALLOW, n - 1))[:SHALLOW]
            ahead = ahead[allowed[ahead]]
            if len(ahead) >= wanted:
                scores = self.exact[ahead] @ w
                threshold = max(threshold, float(np.sort(scores)[-wanted]))
            bound = gains[self.probes] + (rest.sum() - known[self.probes] @ rest)
            if check < CHECKS and (bound >= threshold).sum() > len(bound) // RESCORED:
                continue  # too many rows can still be members
            bound = gains + (rest.sum() - known @ rest)
            # a row whose bound is under the k-th exact score can't be a member; ties stay
            candidates = np.flatnonzero(allowed & (bound >= threshold))
            if len(candidates) <= max(2 * wanted, n // RESCORED):
                break
        return self._best(candidates, w, wanted, floor)

    def _best(self, candidates: np.ndarray, w: np.ndarray, wanted: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        scores = self.exact[candidates] @ w
        candidates, scores = candidates[scores >= floor], scores[scores >= floor]
        order = np.lexsort((self.ids[candidates], -scores))[:wanted]
        return candidates[order], scores[order]


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start..start+length-1 of every segment, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def _search(k: int):
    """A block's index row comes before the packs of queries that meet it."""

    def search(frames):
        index, block = None, None
        for frame in frames:
            for row in frame.itertuples():
                if row.ids is not None:
                    index, block = BlockIndex(row), row.block
                    continue
                if row.block != block:
                    continue  # no vector was dealt to it
                ids = np.frombuffer(row.query_ids, np.int64)
                queries = np.frombuffer(row.query_rows, np.int64).reshape(len(ids), int(row.query_dim))
                out = []
                for own, weights, floor in zip(ids, queries, np.frombuffer(row.floors, np.int64)):
                    at, scores = index.top(weights, own, k, int(floor))
                    out.append(pd.DataFrame({"query_id": own, "vec_id": index.ids[at], "score": scores}))
                if out:
                    yield pd.concat(out).astype("int64")

    return search


def _meet(index: DataFrame, packs: DataFrame, blocks: int, k: int) -> DataFrame:
    """Hits of packs (block, home, query_ids, query_rows, query_dim, floors) with the block of that number, a task for each block."""
    rows = index.unionByName(packs, allowMissingColumns=True).repartitionById(blocks, F.col("block"))
    return rows.sortWithinPartitions("block", F.asc_nulls_first("home")).mapInPandas(_search(k), HITS_SCHEMA)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best other rows by integer inner product.

    ``is_query`` is a condition on ``vec_id``. The index has a row per block and is shuffled
    twice. Every query meets every block once, which is what an exact search over all rows
    takes: the queries are copied once for each :data:`VECTOR_BLOCK` rows.
    """
    spark = vectors.sparkSession
    quantised = cut_lineage(quantise(vectors, vec_id, vector, scale))
    blocks = max(1, -(-quantised.count() // VECTOR_BLOCK))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    index = cut_lineage(build_index(quantised, blocks))
    home = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    queries = quantised.where(is_query).withColumn("home", home)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = lambda hits: hits.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)

    def packed(dealt: DataFrame) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
        done = cut_lineage(dealt.groupBy("home").applyInPandas(_pack_queries, QUERY_SCHEMA))
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")  # a row is a whole block
        return done

    packs = packed(queries.withColumn("floor", F.lit(NO_FLOOR).cast("long")))
    hits = cut_lineage(_meet(index, packs.withColumn("block", F.col("home")), blocks, k))
    if blocks > 1:
        floors = best(hits).groupBy("query_id").agg(F.count("*").alias("found"), F.min("score").alias("score")).where(F.col("found") == k)
        floors = floors.select(F.col("query_id").alias("floor_id"), F.col("score").alias("floor"))
        told = queries.join(floors, F.col("vec_id") == F.col("floor_id"), "left").drop("floor_id")
        packs = packed(told.withColumn("floor", F.coalesce("floor", F.lit(NO_FLOOR).cast("long"))))
        others = F.filter(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: b != F.col("home"))
        hits = hits.unionByName(_meet(index, packs.withColumn("block", F.explode(others)), blocks, k))
    return best(hits).select("query_id", "rank", "vec_id", "score")
