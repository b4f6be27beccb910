"""Canonical digest lookup of licence texts.

A text is normalised by rules: case, copyright notices, punctuation, white space and
equivalent spellings. Its SHA-256 is looked up among the digests of known licences, made by
the same expression. Whole texts are compared, and so is every line as a text of its own:
a file that carries a licence statement in a line of its own is found as well.

Nulls, ties, repeats: a null text is taken as empty; a text or line with no word left has no
licence. Two known licences that normalise alike are one, under the smaller name. Repeated
rows are rows of their own. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.session import cut_lineage

# Lines that name a holder, and spellings that mean the same (after lower case).
HOLDER = r"copyright (\(c\)|©|[0-9]{4})|^[ \t]*(\(c\)|©)|all rights reserved"
# A notice goes up to the end of its sentence; a stop after an initial or a short form ends it only before a word that opens a sentence of its own.
SHORT_FORM = r"(?<!\b(inc|ltd|co|corp|llc|gmbh|jr|sr|dr|st|al|[a-z]))"
OPENING = r"(all rights reserved|released|licen[sc]ed|distributed|available|permission|redistribution|this|these|the|use|see|you)\b"
NOTICE = rf"(?m)((portions )?copyright (\(c\)|©|[0-9]{{4}})|^[ \t]*(\(c\)|©))[^\n]*?({SHORT_FORM}[.!?](?=\s)|[.!?](?=\s+{OPENING})|$)"
RESERVED = r"all rights reserved[.!]?"
SPELLINGS = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("sub-license", "sublicense"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("fulfill", "fulfil"),
    ("judgement", "judgment"),
    ("labour", "labor"),
    ("noninfringement", "non-infringement"),
    ("per cent", "percent"),
    ("programme", "program"),
    ("whilst", "while"),
    ("copyright holder", "copyright owner"),
    ("https", "http"),
)
# Statements and short texts by which a work says its licence.
KNOWN = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.\n"
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
        "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
        "THIS SOFTWARE.",
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n"
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
        "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
        "THIS SOFTWARE.",
    ),
)


def canonical_lines(text: Column) -> Column:
    """The text's lines in lower case and one spelling, words of letters and digits only; notices that name a holder are gone."""
    text = F.lower(F.coalesce(text, F.lit("")))
    bare = F.regexp_replace(F.regexp_replace(text, NOTICE, " "), RESERVED, " ")
    held = [text.contains(sign) for sign in ("copyright", "(c)", "©", "all rights reserved")]
    text = F.when(held[0] | held[1] | held[2] | held[3], bare).otherwise(text)
    for spelling, same in SPELLINGS:
        text = F.replace(text, F.lit(spelling), F.lit(same))
    return F.regexp_replace(text, r"[^\p{L}\p{N}\n]+", " ")


def run_on(text: Column) -> Column:
    """A canonical text whose lines run on."""
    return F.trim(F.regexp_replace(text, r"[ \n]+", " "))


def digest(run: Column) -> Column:
    """SHA-256 of a text that runs on; null where no word is left."""
    return F.when(run != "", F.sha2(run.cast("binary"), 256))


def known_digests(licences: DataFrame) -> DataFrame:
    """(digest, licence, size) of a table of (licence, text); one row per digest, the size in characters."""
    made = licences.select("licence", run_on(canonical_lines(F.col("text"))).alias("run"))
    made = made.select("licence", digest(F.col("run")).alias("digest"), F.length("run").alias("size")).where("digest IS NOT NULL")
    return made.groupBy("digest").agg(F.min("licence").alias("licence"), F.min("size").alias("size"))


def default_licences(spark: SparkSession) -> DataFrame:
    """The statements and texts of :data:`KNOWN`, and the full texts in the folder ``licences``: a file's name begins with its licence's."""
    names = {path.name.removesuffix(".txt"): path.read_text() for path in sorted(TEXTS.glob("*.txt"))}
    full = [(name if name in LICENCES else name.rpartition(".")[0], text) for name, text in names.items()]
    return spark.createDataFrame([*KNOWN, *full], "licence string, text string")


def scan(documents: DataFrame, licences: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, canonical_digest, licence, line_licences) for every document.

    ``licence`` is that of the whole text, ``line_licences`` those that a line alone states,
    each once, sorted and joined by commas; null where there is none. Lines are told by the
    text they stand in and not by an id, so rows without id or with the same one are looked
    at each for itself. Nothing wider than a digest is moved.
    """
    known = cut_lineage(known_digests(licences))
    sizes = None
    if known.count() <= BROADCAST_LICENCES:
        sizes = [r[0] for r in known.select("size").distinct().collect()]
        known = F.broadcast(known)
    known = known.select("digest", "licence")
    # blanks of a canonical line are single, so it runs on once it is trimmed; one as long as no licence is not hashed
    trimmed = F.transform(F.split("canonical", "\n"), lambda line: F.trim(line))
    could = F.array_distinct(trimmed if sizes is None else F.filter(trimmed, lambda line: F.length(line).isin(sizes)))
    made = documents.select(F.col(doc_id).alias("doc_id"), canonical_lines(F.col(text)).alias("canonical"))
    made = made.select(
        "doc_id",
        F.sha2(F.col("canonical").cast("binary"), 256).alias("same_text"),
        digest(run_on(F.col("canonical"))).alias("canonical_digest"),
        F.transform(could, digest).alias("lines"),
    )
    # each text is made canonical once: digests alone are kept
    made = cut_lineage(made)
    stated = made.select("same_text", F.explode("lines").alias("digest")).join(known, "digest").groupBy("same_text")
    stated = stated.agg(F.array_join(F.sort_array(F.collect_set("licence")), ",").alias("line_licences"))
    whole = made.select("doc_id", "same_text", "canonical_digest")
    whole = whole.join(known.withColumnRenamed("digest", "canonical_digest"), "canonical_digest", "left")
    found = whole.join(stated, "same_text", "left")
    return found.select("doc_id", "canonical_digest", "licence", "line_licences")


def scan_sql() -> str:
    """The default scan of ``documents`` in DuckDB's SQL."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    made = "t"
    for spelling, same in SPELLINGS:
        made = f"replace({made},{quoted(spelling)},{quoted(same)})"
    kept = f"array_to_string(list_filter(string_split(t,chr(10)), lambda x: NOT regexp_matches(x,{quoted(HOLDER)})),chr(10))"
    canon = f"""SELECT id, regexp_replace({made}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g') AS c FROM (SELECT id,
 CASE WHEN regexp_matches(t,'copyright|[(]c[)]|©|all rights reserved') THEN {kept} ELSE t END AS t FROM (SELECT id, lower(coalesce(t,'')) AS t FROM %s))"""
    dig = "CASE WHEN trim(regexp_replace(%s,'[ \\n]+',' ','g'))<>'' THEN sha256(trim(regexp_replace(%s,'[ \\n]+',' ','g'))) END"
    values = ",".join(f"({quoted(name)},{quoted(text)})" for name, text in KNOWN)
    return f"""WITH k AS (SELECT digest, min(id) AS licence FROM (SELECT id, {dig % ("c", "c")} AS digest FROM ({canon % f"(VALUES {values}) v(id,t)"}))
 WHERE digest IS NOT NULL GROUP BY 1),
d AS ({canon % "(SELECT doc_id AS id, text AS t FROM documents)"}),
l AS (SELECT c, string_agg(DISTINCT licence, ',' ORDER BY licence) AS line_licences
 FROM (SELECT c, {dig % ("x", "x")} AS digest FROM (SELECT c, unnest(string_split(c,chr(10))) AS x FROM (SELECT DISTINCT c FROM d))) JOIN k USING (digest) GROUP BY 1)
SELECT d.id AS doc_id, {dig % ("d.c", "d.c")} AS canonical_digest, licence, line_licences FROM d
 LEFT JOIN k ON k.digest = {dig % ("d.c", "d.c")} LEFT JOIN l ON l.c = d.c""".replace("\\\\", "\\")


TEXTS = Path(__file__).parent / "licences"
# the files' licences; another text of one has a word of its own after the name
LICENCES = ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense")
BROADCAST_LICENCES = 20_000  # rows of 100 bytes
