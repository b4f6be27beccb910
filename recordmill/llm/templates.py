"""Decontamination by question templates.

Texts become sequences of template tokens: words in lower case, with numbers, names and units
after numbers replaced by typed placeholders (``#``, ``@``, ``~``). Windows of template
tokens of documents and benchmark items are joined by hash. Matches on one diagonal form a
run; in a run each slot value of the item must stand for one value of the document all along,
so that a question with other numbers is found and a chance mix of numbers isn't.

Nulls, ties, repeats: a null text has no tokens and matches nothing; rows with a null id take
no part. An item of fewer tokens than the window is one window as it stands; one of fewer than
``min_item`` tokens says too little, it is met only by a document that holds nothing else. Windows that hold
under ``min_literals`` words besides placeholders (for a short item, as large a share of it)
are met as they stand only, in any case; those of numbers alone aren't met. Texts of one
item id are items of their own with a row each; repeated rows of a document or an item count
once. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.session import cut_lineage

# Units that become a placeholder after a number.
UNITS = (
    "km m cm mm mi miles mile ft feet inches kg g mg lb lbs pounds ounces oz l ml liters litres gallons s sec seconds min minutes "
    "h hours hour days day weeks week months month years year mph kmh percent dollars euros cents usd eur gbp degrees c f"
).split()
MARK = "\x01"  # stands before a capital letter that opens a sentence
BROADCAST_WINDOWS = 400_000  # rows of 40 bytes
BROADCAST_RUNS = 200_000


def marked_words(text: Column) -> Column:
    """The text's words as they stand, openings of sentences marked, each word between two spaces of its own."""
    text = F.coalesce(text, F.lit(""))
    text = F.when(text.rlike("[0-9][.,][0-9]"), F.regexp_replace(text, r"([0-9])[.,]([0-9])", "$1$2")).otherwise(text)
    text = F.regexp_replace(text, r"(^|[.!?:;|\n]\s*)(\p{Lu})", "$1" + MARK + "$2")
    return F.concat(F.lit(" "), F.regexp_replace(text, r"[^\p{L}\p{N}\x01]+", "  "), F.lit(" "))


def template(words: Column) -> Column:
    """The template tokens of :func:`marked_words`, each between two spaces."""
    words = F.when(words.rlike("[0-9]"), F.regexp_replace(words, r" [0-9][^ ]* ", " # ")).otherwise(words)
    words = F.regexp_replace(words, r" \p{Lu}\p{Ll}+ ", " @ ")
    units = F.regexp_replace(words, rf" #  ({'|'.join(UNITS)}) ", " #  ~ ")
    words = F.when(F.contains(words, F.lit(" # ")), units).otherwise(words)
    return F.lower(F.translate(words, MARK, ""))


def _tokens(words: Column) -> Column:
    return F.filter(F.split(words, " +"), lambda w: w != "")


def _templated(rows: DataFrame, row_id: str, text: str) -> DataFrame:
    """(id, slots, tokens): words without marks and their template tokens, of equal length."""
    made = rows.where(F.col(row_id).isNotNull()).select(F.col(row_id).alias("id"), marked_words(F.col(text)).alias("words"))
    return made.select("id", _tokens(F.translate("words", MARK, "")).alias("slots"), _tokens(template(F.col("words"))).alias("tokens"))


def _placeholder(token: Column) -> Column:
    return token.isin("#", "@", "~")


def _windows(tokens: Column, width: Column) -> Column:
    """Hashes of all windows of ``width`` tokens, in order."""
    last = F.size(tokens) - width + 1
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.xxhash64(F.slice(tokens, i, width))))


def _plain(slots: str) -> Column:
    return F.transform(slots, F.lower)


def item_windows(items: DataFrame, window: int, min_literals: int) -> DataFrame:
    """(item_id, item_key, item_pos, width, plain, hash): of template tokens where they hold words enough, else of the plain words."""
    width = F.least(F.lit(window), F.size("tokens"))
    sized = items.where(F.size("tokens") >= 1).withColumn("width", width)
    both = F.arrays_zip(_windows(F.col("tokens"), F.col("width")).alias("made"), _windows(_plain("slots"), F.col("width")).alias("given"))
    rows = sized.select("id", "key", "tokens", "width", F.posexplode(both).alias("item_pos", "hashes"))
    held = F.expr("slice(tokens, item_pos + 1, width)")
    enough = F.size(F.filter(held, lambda t: ~_placeholder(t))) >= F.least(F.ceil(F.lit(min_literals) * F.col("width") / window), F.col("width"))
    rows = rows.where(enough | F.exists(held, lambda t: t != "#")).withColumn("plain", ~enough)
    hashed = F.when(F.col("plain"), F.col("hashes.given")).otherwise(F.col("hashes.made"))
    return rows.select(F.col("id").alias("item_id"), F.col("key").alias("item_key"), "item_pos", "width", "plain", hashed.alias("hash"))


def _document_windows(made: DataFrame, kinds: list[tuple[int, bool]], min_item: int) -> DataFrame:
    """(id, width, plain, pos, hash): the windows of all ``kinds`` (width, plain) from one pass over the documents."""
    if any(plain for _, plain in kinds):
        made = made.withColumn("words", _plain("slots"))
    if len(kinds) == 1:
        (width, plain), = kinds
        rows = made.select("*", F.lit(width).alias("width"), F.lit(plain).alias("plain"))
    else:
        # only widths that fit; those of short items only where they are the whole text
        fit = lambda k: F.when(k["width"] < min_item, k["width"] == F.size("tokens")).otherwise(k["width"] <= F.size("tokens"))
        every = F.array(*[F.struct(F.lit(w).alias("width"), F.lit(plain).alias("plain")) for w, plain in sorted(kinds)])
        rows = made.select("*", F.inline(F.filter(every, fit)))
    if len(kinds) == 1 and width < min_item:
        rows = rows.where(F.size("tokens") == width)
    words = F.col("tokens")
    if any(plain for _, plain in kinds):
        words = F.when(F.col("plain"), F.col("words")).otherwise(words)
    size = F.lit(kinds[0][0]) if len(kinds) == 1 else F.col("width")
    return rows.select("id", "width", "plain", F.posexplode(_windows(words, size)).alias("pos", "hash"))


def matches(documents: DataFrame, benchmark: DataFrame, window: int = 8, min_literals: int = 5, min_item: int = 4, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, item_tokens, covered_tokens, changed_slots) of documents and items that share windows consistently.

    ``covered_tokens`` counts the item's tokens that lie in consistent runs; ``changed_slots``
    the slots there whose value is another one in the document.
    """
    texts = benchmark.select(F.col(item_id).alias("id"), F.col(text).alias("item_text")).distinct()
    keyed = texts.select(F.struct("id", F.xxhash64("item_text").alias("key")).alias("id"), "item_text").where("id.id IS NOT NULL")
    items = cut_lineage(_templated(keyed, "id", "item_text").select("id.id", "id.key", "slots", "tokens"))
    wanted = cut_lineage(item_windows(items, window, min_literals))
    facts = wanted.agg(F.count("*").alias("rows"), F.collect_set(F.struct("width", "plain")).alias("widths")).first()
    wanted = F.broadcast(wanted) if facts["rows"] <= BROADCAST_WINDOWS else wanted
    made = _templated(documents, doc_id, text)
    hits = _document_windows(made, [(w["width"], w["plain"]) for w in facts["widths"]] or [(window, False)], min_item).join(wanted, ["hash", "width", "plain"])
    runs = hits.groupBy(F.col("id").alias("doc_id"), "item_id", "item_key", (F.col("pos") - F.col("item_pos")).alias("shift"), "width", "plain").agg(F.sort_array(F.collect_set("item_pos")).alias("at"))
    runs = cut_lineage(runs)
    few = runs.count() <= BROADCAST_RUNS
    # texts are made into templates again only where a window was met
    met = runs.select(F.col("doc_id").alias("met_id")).distinct()
    named = documents.select(F.col(doc_id).alias("named_id"), F.col(text).alias("named_text"))
    picked = cut_lineage(named.join(F.broadcast(met) if few else met, F.col("named_id") == F.col("met_id")).select("named_id", "named_text"))
    texts = _templated(picked, "named_id", "named_text").toDF("doc_id", "doc_slots", "doc_tokens")
    seen = texts.join(F.broadcast(runs) if few else runs, "doc_id")
    seen = seen.join(items.select(F.col("id").alias("item_id"), F.col("key").alias("item_key"), "slots", "tokens"), ["item_id", "item_key"])
    covered = F.array_distinct(F.flatten(F.transform("at", lambda a: F.sequence(a, a + F.col("width") - 1))))
    seen = seen.withColumn("covered", covered)
    # equal hashes are held against the tokens or words themselves
    same = lambda i: F.get("tokens", i).eqNullSafe(F.get("doc_tokens", i + F.col("shift")))
    alike = lambda i: F.lower(F.get("slots", i)).eqNullSafe(F.lower(F.get("doc_slots", i + F.col("shift"))))
    seen = seen.withColumn("covered", F.when(F.col("plain"), F.filter("covered", alike)).otherwise(F.filter("covered", same)))
    pair = lambda i: F.struct(F.get("tokens", i).alias("kind"), F.get("slots", i).alias("asked"), F.get("doc_slots", i + F.col("shift")).alias("given"))
    slots = F.transform(F.filter("covered", lambda i: _placeholder(F.get("tokens", i))), pair)
    seen = seen.withColumn("slot_pairs", slots)
    one_value = F.size(F.array_distinct("slot_pairs")) == F.size(F.array_distinct(F.transform("slot_pairs", lambda p: F.struct(p["kind"], p["asked"]))))
    changed = F.filter("covered", lambda i: ~F.col("plain") & _placeholder(F.get("tokens", i)) & (F.get("slots", i) != F.get("doc_slots", i + F.col("shift"))))
    sound = seen.where(F.col("plain") | one_value).withColumn("changed_at", changed)
    tokens = sound.select("doc_id", "item_id", "item_key", F.size("tokens").alias("item_tokens"), F.explode("covered").alias("token"), "changed_at")
    told = tokens.groupBy("doc_id", "item_id", "item_key", "item_tokens", "token").agg(F.min(F.array_contains("changed_at", F.col("token"))).alias("changed"))
    return told.groupBy("doc_id", "item_id", "item_key", "item_tokens").agg(F.count("*").alias("covered_tokens"), F.count_if("changed").alias("changed_slots")).drop("item_key")


def contaminated(documents: DataFrame, benchmark: DataFrame, min_share: float = 0.5, **options) -> DataFrame:
    """The rows of :func:`matches` whose runs cover at least ``min_share`` of the item."""
    return matches(documents, benchmark, **options).where(F.col("covered_tokens") >= F.lit(min_share) * F.col("item_tokens"))


def contaminated_sql(window: int = 8, min_literals: int = 5, min_share: float = 0.5, min_item: int = 4) -> str:
    """:func:`contaminated` of ``documents`` and ``benchmark`` in DuckDB's SQL."""
    units = "|".join(UNITS)
    made = f"""SELECT id, list_filter(regexp_split_to_array(replace(w,chr(1),''),' +'), lambda x: x<>'') AS slots,
 list_filter(regexp_split_to_array(lower(replace(regexp_replace(regexp_replace(regexp_replace(w,' [0-9][^ ]* ',' # ','g'),' \\p{{Lu}}\\p{{Ll}}+ ',' @ ','g'),' #  ({units}) ',' #  ~ ','g'),chr(1),'')),' +'), lambda x: x<>'') AS tokens
 FROM (SELECT id, ' '||regexp_replace(regexp_replace(regexp_replace(coalesce(t,''),'([0-9])[.,]([0-9])','\\1\\2','g'),
 '(^|[.!?:;|\\n]\\s*)(\\p{{Lu}})', '\\1'||chr(1)||'\\2','g'),'[^\\p{{L}}\\p{{N}}\\x01]+','  ','g')||' ' AS w FROM (SELECT DISTINCT %s AS id, text AS t FROM %s WHERE %s IS NOT NULL))"""
    hold = "x IN ('#','@','~')"
    return f"""WITH i AS ({made % ("item_id", "benchmark", "item_id")}), d AS ({made % ("doc_id", "documents", "doc_id")}),
iw AS (SELECT id AS item_id, p AS item_pos, w AS width, array_to_string(tokens[p+1:p+w],' ') AS win
 FROM (SELECT id, tokens, least({window}, len(tokens)) AS w, unnest(range(0, greatest(len(tokens) - least({window}, len(tokens)) + 1, 0))) AS p FROM i WHERE len(tokens) >= 1)
 WHERE len(list_filter(tokens[p+1:p+w], lambda x: NOT {hold})) >= least({min_literals}, w)),
dw AS (SELECT id, width, p AS pos, array_to_string(tokens[p+1:p+width],' ') AS win
 FROM (SELECT id, tokens, width, unnest(range(0, greatest(len(tokens) - width + 1, 0))) AS p FROM d, (SELECT DISTINCT width FROM iw) WHERE width >= {min_item} OR width = len(tokens))),
r AS (SELECT id AS doc_id, item_id, pos - item_pos AS shift, width, list(DISTINCT item_pos) AS spots FROM dw JOIN iw USING (win, width) GROUP BY ALL),
t AS (SELECT DISTINCT doc_id, item_id, shift, width, a + k AS token FROM (SELECT *, unnest(spots) AS a FROM r), (SELECT unnest(range(0, {window})) AS k) WHERE k < width),
s AS (SELECT t.*, i.tokens[token+1] AS kind, i.slots[token+1] AS asked, d.slots[token+shift+1] AS given, len(i.tokens) AS item_tokens FROM t JOIN i ON i.id=item_id JOIN d ON d.id=doc_id),
g AS (SELECT doc_id, item_id, shift, width FROM s GROUP BY ALL
 HAVING count(DISTINCT CASE WHEN kind IN ('#','@','~') THEN kind||' '||asked||' '||given END) = count(DISTINCT CASE WHEN kind IN ('#','@','~') THEN kind||' '||asked END)),
f AS (SELECT doc_id, item_id, item_tokens, token, bool_and(kind IN ('#','@','~') AND asked <> given) AS changed FROM s JOIN g USING (doc_id, item_id, shift, width) GROUP BY ALL)
SELECT doc_id, item_id, CAST(item_tokens AS INTEGER) AS item_tokens, count(*) AS covered_tokens, count(*) FILTER (changed) AS changed_slots
 FROM f GROUP BY doc_id, item_id, f.item_tokens HAVING count(*) >= {min_share} * f.item_tokens""".replace("\\\\", "\\")
