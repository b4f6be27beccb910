"""Spelling variants: words at one edit, found by walking tries that are tables.

Every word is a path in two tries, one of its letters from the front and one from the back.
A trie is a distributed edge table (node, first, label, child): nodes are prefixes that branch
or end a word, named by a 64-bit hash, and an edge holds the letters between two of them. It also
says which letters follow its child and how many letters are left to ends of words below it, as
64-bit sets, so that a state which cannot go on or end there is not made.
The frontier holds states (word, what is left of it, node, edits). With no edit a word stays on
its own path; its first difference to a neighbour lies at one of its own nodes, where it takes
another word's edge by one replaced, inserted or deleted letter. From there states with one edit
join the edge table level by level and must match exactly; those that end with the word at the
end of another word are neighbours.

A difference in the back half is looked for in the front trie below the first half, one in the
front half in the back trie below the second half: all top levels, where every word would meet
every branch, are spared, and no pair is lost. Pairs found on both sides are told apart by
their common prefix, so none is counted twice; an exact comparison guards against hashes that
coincide.

Rounds end with the longest chain of branches in half a word. A word meets at most its own
nodes times the letters of the alphabet; nothing is paired within a group.

Nulls, ties, repeats: a null text has no words, a null id is written as an empty text, repeated
rows count each. Forms of equal n go to the smallest word in code-point order. An empty table
gives no rows; other columns are ignored. Words of any length are walked, one row a letter of
half the word.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import files_for, short_batches
from recordmill.session import cut_lineage

RUN = r"[A-Za-zÀ-ÿ]+"
FRONT, BACK = 0, 1
PRIME, MASK = 0x100000001B3, (1 << 64) - 1
SEEDS = (0xCBF29CE484222325, 0x9AE16A3B2F90404F)
ROWS_AT_ONCE = 8_192
NEXT_BIT = "CASE WHEN next = 0 THEN 0 ELSE 1 + next % 63 END"  # 0: a word ends here


def word_counts(documents: DataFrame, damage_every: int = 97, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """(word, n): the runs of letters in whole texts, one in ``damage_every`` with a letter deleted.

    Which ones is told by a checksum of id and run, so it is the same however rows are cut.
    """
    runs = documents.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"),
    )
    plain = F.translate("run", string.ascii_uppercase, string.ascii_lowercase)
    lower = runs.select("id", F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(plain).alias("run"))
    told = lower.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = told.select(F.when(F.col("h") % damage_every == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _walks(words: DataFrame, wide: bool) -> DataFrame:
    """The prefixes of each word on both sides that a word at one edit may share: node, next letter and letters left, or node, word and depth."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["word", "n", "side", "depth", "node"] if wide else ["node", "next", "left"]
        types = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64()] if wide else [pa.int64(), pa.int32(), pa.int32()]
        held: list[list] = [[] for _ in names]

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(held, types)], names)
            for values in held:
                values.clear()
            return made

        for given in batches:
            columns = given.to_pydict()
            for word, n in zip(columns["word"], columns["n"]):
                size = len(word)
                codes = [*map(ord, word)]
                for side, letters, first in ((FRONT, codes, (size - 1) // 2), (BACK, codes[::-1], size // 2)):
                    node = SEEDS[side]
                    for depth in range(size + 1):
                        if depth >= first:
                            told = node - (1 << 64) if node >> 63 else node
                            row = (word, n, side, depth, told) if wide else (told, letters[depth] if depth < size else 0, size - depth)
                            for values, value in zip(held, row):
                                values.append(value)
                            if len(held[0]) >= ROWS_AT_ONCE:
                                yield batch()
                        if depth < size:
                            node = (node ^ letters[depth]) * PRIME & MASK
                            node ^= node >> 29
        if held[0]:
            yield batch()

    return words.mapInArrow(run, "word string, n long, side int, depth int, node long" if wide else "node long, next int, left int")


def trie_paths(words: DataFrame) -> DataFrame:
    """(word, n, side, letters, stops): the nodes (depth, node, follow, sizes) on each word's own path, the last one ends the word."""
    short_batches(words.sparkSession)
    ends = _walks(words, False).groupBy("node").agg(
        F.min("next").alias("low"),
        F.max("next").alias("high"),
        F.expr(f"bit_or(shiftleft(1L, {NEXT_BIT}))").alias("follow"),
        F.expr("bit_or(shiftleft(1L, least(left, 63)))").alias("sizes"),
    )
    nodes = ends.where("low = 0 OR low <> high").select("node", "follow", "sizes")
    letters = F.when(F.col("side") == BACK, F.reverse("word")).otherwise(F.col("word"))
    return (
        _walks(words, True)
        .join(nodes, "node")
        .groupBy("word", "n", "side")
        .agg(F.sort_array(F.collect_list(F.struct("depth", "node", "follow", "sizes"))).alias("stops"))
        .select("word", "n", "side", letters.alias("letters"), "stops")
    )


def edge_table(paths: DataFrame) -> DataFrame:
    """(node, first, label, child, follow, sizes): the letters from each node to the next one on any word's path, and what comes after that."""
    steps = F.arrays_zip(F.slice("stops", F.lit(1), F.size("stops") - 1).alias("a"), F.slice("stops", F.lit(2), F.size("stops")).alias("b"))
    step = paths.where(F.size("stops") > 1).select("letters", F.explode(steps).alias("s")).select("letters", "s.a", "s.b")
    label = F.substring(F.col("letters"), F.col("a.depth") + 1, F.col("b.depth") - F.col("a.depth"))
    edges = step.select(F.col("a.node").alias("node"), label.alias("label"), F.col("b.node").alias("child"), "b.follow", "b.sizes").distinct()
    return edges.select("node", F.substring("label", 1, 1).alias("first"), "label", "child", "follow", "sizes")


def _hopeful(states: DataFrame) -> DataFrame:
    """States whose next letter follows their node and whose letters left are as many as some word's below it."""
    bit = NEXT_BIT.replace("next", "ascii(rest)")
    able = f"shiftright(follow, {bit}) & 1 = 1 AND shiftright(sizes, least(length(rest), 63)) & 1 = 1"
    return states.where(able).select("word", "n", "side", "rest", "node")


def _tail(text: str, start: Column | int, length: Column | None = None) -> Column:
    start = F.lit(start) if isinstance(start, int) else start
    return F.substring(F.col(text), start, F.length(text) if length is None else length)


def _first_edits(paths: DataFrame, edges: DataFrame) -> DataFrame:
    """States with one edit, just after it: each own node in the far half with each edge that another word takes there."""
    size = F.length("word")
    half = (size / 2).cast("int")
    own = paths.select("word", "n", "side", "letters", F.explode("stops").alias("at")).where(F.col("at.depth") >= F.when(F.col("side") == BACK, size - half).otherwise(half))
    own = own.select("word", "n", "side", _tail("letters", F.col("at.depth") + 1).alias("rest"), F.col("at.node").alias("node"))
    long = F.length("label")
    replaced = F.when((F.col("rest") != "") & (_tail("rest", 2, long - 1) == _tail("label", 2)), _tail("rest", long + 1))
    inserted = F.when(_tail("rest", 1, long - 1) == _tail("label", 2), _tail("rest", long))
    deleted = F.when(_tail("rest", 2, long) == F.col("label"), _tail("rest", long + 2))
    edited = own.join(edges, "node").where(F.col("first") != F.substring("rest", 1, 1))
    after = edited.select("word", "n", "side", F.explode(F.array_compact(F.array(replaced, inserted, deleted))).alias("rest"), F.col("child").alias("node"), "follow", "sizes")
    last_deleted = own.where(F.length("rest") == 1).select("word", "n", "side", F.lit("").alias("rest"), "node")
    return _hopeful(after).unionByName(last_deleted)


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of (word, n) rows whose words differ by one letter."""
    paths = cut_lineage(trie_paths(words), files_for(2 * words.count()))
    edges = cut_lineage(edge_table(paths))
    frontier = cut_lineage(_first_edits(paths, edges))
    states = frontier.count()
    ended = []
    while True:
        ended.append(frontier.where("rest = ''").select("word", "n", "side", "node"))
        going = frontier.where("rest <> ''").withColumn("first", F.substring("rest", 1, 1))
        met = going.join(edges, ["node", "first"]).where(F.startswith("rest", "label"))
        frontier = cut_lineage(_hopeful(met.select("word", "n", "side", _tail("rest", F.length("label") + 1).alias("rest"), F.col("child").alias("node"), "follow", "sizes")), files_for(states))
        states = frontier.count()  # a state meets one edge at most, so they never become more
        if not states:
            break
    last = F.element_at("stops", -1)["node"]
    words_at = paths.select(last.alias("node"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    found = ended[0]
    for more in ended[1:]:
        found = found.unionByName(more)
    half = (F.length("word") / 2).cast("int")
    both = (F.col("side") == BACK) & (_tail("word", 1, half) == _tail("near", 1, half))
    pairs = found.join(words_at, "node").where(~both & (F.levenshtein("word", "near", 1) == 1))
    return pairs.select("word", "n", "near", "near_n")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form) rows whose chains end; links double in length each round."""
    links = cut_lineage(forms.select("word", F.col("form").alias("root")))
    files = files_for(links.count())
    while True:
        onward = links.select(F.col("word").alias("at"), F.col("root").alias("next"))
        jumped = links.join(onward, links["root"] == onward["at"], "left")
        links = cut_lineage(jumped.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), files)
        if links.where("moved").isEmpty():
            return links.select("word", "root")
        links = links.drop("moved")


def variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct (word, n) rows.

    The form is the near word of largest n, if that is at least twice the word's own; n doubles
    at each step to a form, so chains end and are short.
    """
    words = cut_lineage(words)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    told = neighbours(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    form_n = -F.col("best.less")
    strong = form_n >= 2 * F.col("n")
    whole = words.join(told, "word", "left").select(
        "word", F.when(strong, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(strong, form_n).alias("form_n")
    )
    whole = cut_lineage(whole, files_for(words.count()))
    roots = _roots(whole.where("form IS NOT NULL").select("word", "form"))
    return whole.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


# Words, damaged ones and pairs by other means: a checksum made of list functions, and pairs that
# share a pattern with one letter left out or replaced by a sign.
SQL = r"""WITH RECURSIVE slots AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM (SELECT i,
 list_reduce(list_prepend(CAST(i AS BIGINT), list_transform(range(8), lambda k: CAST(k AS BIGINT))), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT id, run, count(*) AS n FROM runs GROUP BY 1, 2),
hexed AS (SELECT *, hex(encode(id || ':' || run)) AS x FROM counted),
hashed AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(length(x) // 2),
 lambda i: CAST(16 * (strpos('0123456789ABCDEF', substr(x, 2 * i + 1, 1)) - 1) + strpos('0123456789ABCDEF', substr(x, 2 * i + 2, 1)) - 1 AS BIGINT))), lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1]))) AS h FROM hexed, slots),
shown AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM shown WHERE length(word) >= 5 GROUP BY 1 HAVING sum(n) >= 3),
cut AS (SELECT word, i, substr(word, 1, i) AS head, substr(word, i + 2) AS tail FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
pairs AS (SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.head || '_' || a.tail = b.head || '_' || b.tail AND a.word <> b.word
 UNION SELECT a.word, b.word FROM cut a JOIN words b ON a.head || a.tail = b.word
 UNION SELECT b.word, a.word FROM cut a JOIN words b ON a.head || a.tail = b.word),
ranked AS (SELECT p.word, p.near, w.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
 row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, encode(p.near)) AS r FROM pairs p JOIN words w ON w.word = p.near),
told AS MATERIALIZED (SELECT w.word, CASE WHEN near_n >= 2 * n THEN near END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
 FROM words w LEFT JOIN (SELECT * FROM ranked WHERE r = 1) USING (word)),
chain AS (SELECT word, word AS at FROM told UNION ALL SELECT c.word, t.form FROM chain c JOIN told t ON t.word = c.at WHERE t.form IS NOT NULL)
SELECT t.word, t.form, c.at AS root, t.n, t.n_near, t.form_n FROM told t JOIN chain c USING (word) JOIN told e ON e.word = c.at WHERE e.form IS NULL"""
