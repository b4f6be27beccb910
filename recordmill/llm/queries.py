"""The corpus queries and, where SQL can say the same, their twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.llm import impact_search, language_crf, licenses, lm_scoring, main_text, pieces, pii_tagger, prefix_join, spelling_variants, templates, tokenizer_fst, warc, whitening
from recordmill.llm.common import table
from recordmill.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL twin if there is one."""

    def add(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            SQL[run.__name__] = sql
        return run

    return add


@query(
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
 WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
 FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
 FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""
)
def op1_impact_search(spark, sf_dir):
    return impact_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query(
    """WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE n >= 100 GROUP BY 1),
m AS (SELECT p.*, CASE WHEN n >= 100 AND first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to FROM p LEFT JOIN f USING (payload_digest))
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to FROM m"""
)
def op3_warc(spark, sf_dir):
    uri = scratch_dir(spark, "warc")
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), uri)
    return warc.read_archives(manifest, uri).drop("url")


@query(licenses.scan_sql())
def op4_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.default_licences(spark))


@query(templates.contaminated_sql())
def op10_templates(spark, sf_dir):
    return templates.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op5_token_counts(spark, sf_dir):
    return tokenizer_fst.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op6_pieces(spark, sf_dir):
    encoded = pieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.sha2(F.array_join("pieces", ",").cast("binary"), 256)
    return encoded.select("doc_id", F.size("pieces").alias("n_pieces"), digest.alias("pieces_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query()
def op2_lm_scoring(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    target = labels.where("quality = 1 AND coalesce(toxic, 0) = 0").select("doc_id")
    return lm_scoring.score(table(spark, sf_dir, "documents"), target)


@query()
def op8_language(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    predicted = language_crf.predict(documents, fold != 1)
    return predicted.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


@query()
def op9_prefix_join(spark, sf_dir):
    return prefix_join.join_components(table(spark, sf_dir, "documents"))


@query()
def op7_pii(spark, sf_dir):
    return pii_tagger.find(table(spark, sf_dir, "documents"))


@query(spelling_variants.SQL)
def op11_spelling_variants(spark, sf_dir):
    return spelling_variants.variants(spelling_variants.word_counts(table(spark, sf_dir, "documents")))


@query()
def op12_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query()
def op13_main_text(spark, sf_dir):
    return main_text.extract(table(spark, sf_dir, "pages"))
