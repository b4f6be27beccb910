"""Cross-entropy difference of documents under matched target and background n-gram models.

Tokens are characters, all that occur, and one symbol for the text's edge. Trigrams of every
document are counted for the target (documents a condition marks) and for the background (all
others), in tasks first and then by key, into a table that grows with the corpus. Both models
are interpolated the same way (Witten-Bell), and the background's counts are scaled to the
target's mass, so that neither is smoother for having seen more. A document's score is the
mean over its tokens of the target's loss less the background's: lower means nearer to the
target.

The losses of the ``HOT`` most frequent trigrams are broadcast; a document's other trigrams,
with their counts, are joined with the losses by shuffle, which the frequent ones never reach.

Nulls, ties, repeats: a null or empty text has no tokens and null losses; it adds nothing to
the counts. A repeated document row counts each time. A document is in the target if one of
its labels marks it and none is against it; null ids are in the background. With an empty
target or background that model is uniform. Empty tables give no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import map_batches, short_batches
from recordmill.session import cut_lineage

EDGE = 0x110000  # no character's code
BITS = 21  # of a code
HOT = 400_000  # rows of 24 bytes
HELD = 1 << 20  # trigrams a task counts before it hands them on
SIDES = ("target", "background")


def _step(rows: DataFrame) -> DataFrame:
    """A step of a table of counts, as many files as cores: it has a row a trigram at most, far fewer than the corpus, whatever the partitions."""
    return cut_lineage(rows, rows.sparkSession.sparkContext.defaultParallelism)


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def _trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All trigrams of non-empty texts, three codes in a number each, two edges before and one after, and where each text's begin."""
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + 3)])
    line = np.full(starts[-1], EDGE, np.int64)
    inner = np.ones(starts[-1], bool)
    for edge in (starts[:-1], starts[:-1] + 1, starts[1:] - 1):
        inner[edge] = False
    line[inner] = _codes(texts)
    cells = (line[:-2] << 2 * BITS) + (line[1:-1] << BITS) + line[2:]
    last = np.ones(len(line) - 2, bool)
    for edge in (starts[1:-1] - 1, starts[1:-1] - 2):  # these would run from one text into the next
        last[edge] = False
    return cells[last], np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])


def _added(cells: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells and the sums of their rows of counts."""
    found, place = np.unique(np.concatenate(cells), return_inverse=True)
    sums = np.zeros((len(found), 2), np.int64)
    np.add.at(sums, place, np.concatenate(counts))
    return found, sums


def trigram_counts(flagged: DataFrame) -> DataFrame:
    """(cell, target, background) over a table of (text, in_target): a row for each trigram of the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, counts, held = [], [], 0
        told = lambda c, n: pa.RecordBatch.from_arrays([pa.array(c), pa.array(n[:, 0].copy()), pa.array(n[:, 1].copy())], ["cell", *SIDES])
        for batch in batches:
            texts, flags = (batch.column(i).to_pylist() for i in (0, 1))
            for side in (0, 1):
                chosen = [t for t, f in zip(texts, flags) if t and f == (side == 0)]
                if chosen:
                    found, times = np.unique(_trigrams(chosen)[0], return_counts=True)
                    both = np.zeros((len(found), 2), np.int64)
                    both[:, side] = times
                    cells.append(found)
                    counts.append(both)
                    held += len(found)
            if held > HELD:
                found, sums = _added(cells, counts)
                cells, counts, held = [found], [sums], len(found)
                if held > HELD // 2:
                    yield told(found, sums)
                    cells, counts, held = [], [], 0
        if held:
            yield told(*_added(cells, counts))

    counted = map_batches(flagged, count, "cell long, target long, background long")
    return counted.groupBy("cell").agg(*(F.sum(side).alias(side) for side in SIDES))


def trigram_losses(counted: DataFrame) -> DataFrame:
    """(cell, target, background, times): bits of each trigram's last symbol after its pair, as :func:`losses` has them, and how often it occurs."""
    mask = (1 << BITS) - 1
    tri = counted.select("cell", F.expr(f"cell >> {BITS}").alias("pair"), F.expr(f"cell & {(1 << 2 * BITS) - 1}").alias("end"), *SIDES)
    sums = [F.sum(s).alias(s) for s in SIDES]
    after = lambda rows, key: rows.groupBy(key).agg(*(x for s in SIDES for x in (F.sum(s).alias(f"{key}_{s}"), F.count_if(F.col(s) > 0).alias(f"{key}_{s}_kinds"))))
    ends = tri.groupBy("end").agg(*sums).select("end", F.expr(f"end >> {BITS}").alias("before"), F.expr(f"end & {mask}").alias("last"), *SIDES)
    ends = _step(ends)
    singles = _step(ends.groupBy("last").agg(*sums))
    whole = singles.agg(F.count("*").alias("size"), *(x for s in SIDES for x in (F.sum(s).alias(s), F.count_if(F.col(s) > 0).alias(f"{s}_kinds")))).first()
    # the lighter side is scaled as a whole, so that both have the target's mass
    scale = {"target": 1.0, "background": whole["target"] / whole["background"] if whole["target"] and whole["background"] else 1.0}

    def lower(side, level, below, total, kinds):
        kinds = F.greatest(kinds, F.lit(1))
        return (F.col(level) * scale[side] + kinds * below) / (total * scale[side] + kinds)

    for side in SIDES:
        least = F.lit(1.0 / max(whole["size"], 1))
        singles = singles.withColumn(f"{side}_1", lower(side, side, least, F.lit(whole[side] or 0), F.lit(whole[f"{side}_kinds"])))
    # one row a character: at most all of Unicode
    ends = ends.join(F.broadcast(singles.drop(*SIDES)), "last").join(F.broadcast(after(ends, "before")), "before")
    for side in SIDES:
        ends = ends.withColumn(f"{side}_2", lower(side, side, F.col(f"{side}_1"), F.col(f"before_{side}"), F.col(f"before_{side}_kinds")))
    tri = tri.join(ends.select("end", *(f"{s}_2" for s in SIDES)), "end").join(after(tri, "pair"), "pair")
    bits = [-F.log2(lower(s, s, F.col(f"{s}_2"), F.col(f"pair_{s}"), F.col(f"pair_{s}_kinds"))) for s in SIDES]
    return tri.select("cell", *(b.alias(s) for b, s in zip(bits, SIDES)), (F.col("target") + F.col("background")).alias("times"))


def losses(counts: np.ndarray) -> np.ndarray:
    """Bits of each symbol after each pair, by Witten-Bell interpolation down to a uniform model; counts[a, b, c]."""
    size = counts.shape[0]
    lower = np.full(size, 1.0 / size)
    for level in (counts.sum(axis=(0, 1)), counts.sum(axis=0), counts):
        total = level.sum(axis=-1, keepdims=True)
        kinds = np.maximum((level > 0).sum(axis=-1, keepdims=True), 1)
        lower = (level + kinds * lower) / (total + kinds)
    return -np.log2(lower).astype(np.float64)


def score(documents: DataFrame, target_ids: DataFrame, hot: int = HOT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, target_bits, background_bits, difference) of every document.

    ``target_ids`` has one column with the ids of the target. The counts take one pass over
    the texts, the scores another. Losses of the ``hot`` most frequent trigrams are broadcast.
    """
    spark = documents.sparkSession
    short_batches(spark)
    rows = documents.selectExpr(f"CAST(`{doc_id}` AS bigint) AS doc_id", f"`{text}` AS text")
    marked = target_ids.toDF("target_id").where("target_id IS NOT NULL").distinct()
    # labels grow with the corpus: a merge join whatever their size, so that the plan is one at every scale
    flagged = rows.join(marked.hint("merge"), F.col("doc_id") == F.col("target_id"), "left").select("text", F.col("target_id").isNotNull().alias("in_target"))
    lost = _step(trigram_losses(_step(trigram_counts(flagged))))
    all_hot = lost.count() <= hot
    first = (lost if all_hot else lost.orderBy(F.desc("times"), "cell").limit(hot)).drop("times").toPandas().sort_values("cell")
    table = spark.sparkContext.broadcast((first["cell"].to_numpy(np.int64), np.stack([first[s].to_numpy(float) for s in SIDES])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bits = table.value
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
            full = np.flatnonzero(tokens)
            sums = np.zeros((2, len(texts)))
            rare, times = [None] * len(texts), [None] * len(texts)
            if len(full):
                cells, starts = _trigrams([texts[i] for i in full])
                place = np.minimum(np.searchsorted(known, cells), max(len(known) - 1, 0))
                hit = known[place] == cells if len(known) else np.zeros(len(cells), bool)
                for side in (0, 1):
                    sums[side, full] = np.add.reduceat(np.where(hit, bits[side][place], 0.0) if len(known) else np.zeros(len(cells)), starts)
                if not hit.all():
                    for i, begin, end in zip(full, starts, [*starts[1:], len(cells)]):
                        rest = cells[begin:end][~hit[begin:end]]
                        if len(rest):
                            found, many = np.unique(rest, return_counts=True)
                            rare[i], times[i] = found.tolist(), many.tolist()
            lists = (pa.array(x, pa.list_(pa.int64())) for x in (rare, times))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tokens), pa.array(sums[0]), pa.array(sums[1]), *lists], ["doc_id", "n_tokens", *SIDES, "rare", "times"])

    told = map_batches(rows, run, "doc_id long, n_tokens long, target double, background double, rare array<long>, times array<long>")
    if not all_hot:
        told = cut_lineage(told.withColumn("row", F.monotonically_increasing_id()))
        pairs = told.where("rare IS NOT NULL").select("row", F.explode(F.arrays_zip("rare", "times")).alias("p")).select("row", F.col("p.rare").alias("cell"), F.col("p.times").alias("n"))
        more = pairs.join(lost.drop("times"), "cell").groupBy("row").agg(*(F.sum(F.col(s) * F.col("n")).alias(f"more_{s}") for s in SIDES))
        told = told.join(more, "row", "left")
        told = told.select("doc_id", "n_tokens", *((F.col(s) + F.coalesce(f"more_{s}", F.lit(0.0))).alias(s) for s in SIDES))
    means = [F.when(F.col("n_tokens") > 0, F.col(s) / F.col("n_tokens")) for s in SIDES]
    return told.select("doc_id", "n_tokens", *(m.alias(f"{s}_bits") for m, s in zip(means, SIDES)), (means[0] - means[1]).alias("difference"))
