"""Corpus operators against brute force, libraries, round trips and edge cases."""

import bisect
import collections
import hashlib
import pathlib
import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from recordmill import session
from recordmill.llm import common, impact_search, language_crf, licenses, lm_scoring, pieces, pii_tagger, prefix_join, spelling_variants, templates, tokenizer_fst, warc
from recordmill.llm.components import components

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, words int"
ODD = [None, "", " ", "\n\t ", "a", "12 345", "x" * 30_000, "Zoë said so 漢字 🤖", "a b c d", "A  B\nc d", "▁ x", "a<|endoftext|>b"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None, None, 0, 1) for i, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, rows[4], (None, "a b c d", "en", None, None, None)], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_every_dealt_query_is_registered():
    assert {int(n[2:].split("_")[0]) for n in entry.queries() if re.match(r"op\d+_", n)} == set(range(1, 14))
    assert "pipeline" in entry.queries()


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(0, 0.1, 12)]) for i in range(300)]
    rows += [(400, rows[0][1]), (401, rows[0][1]), (0, rows[0][1]), (402, None), (403, [float("nan")] * 12), (404, [None] * 12), (None, rows[1][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    q = {i: np.floor(np.float64(np.float32(v)) * 256).astype(int) for i, v in rows if i is not None and i not in (402, 403, 404)}
    want = set()
    for a in (x for x in q if x % 50 == 0):
        best = sorted(((-int(q[a] @ q[b]), b) for b in q if b != a))[:5]
        want |= {(a, r, b, -s) for r, (s, b) in enumerate(best, 1)}
    assert {tuple(r) for r in impact_search.top_k(frame, F.col("vec_id") % 50 == 0).collect()} == want
    assert impact_search.top_k(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(impact_search, "VECTOR_BLOCK", 40)
    rng = np.random.default_rng(5)
    vectors = np.floor(rng.normal(0, 0.2, (300, 8)) * 256) / 256
    vectors[100:140] = vectors[50]  # ties over all blocks
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    q = (vectors * 256).astype(int)
    want = set()
    for a in range(0, 300, 50):
        best = sorted((-int(q[a] @ q[b]), b) for b in range(300) if b != a)[:5]
        want |= {(a, r, b, -s) for r, (s, b) in enumerate(best, 1)}
    assert {tuple(r) for r in impact_search.top_k(frame, F.col("vec_id") % 50 == 0).collect()} == want


def test_a_walk_ends_early_and_proves_it():
    rng = np.random.default_rng(6)
    rows = np.floor(rng.normal(0, 1, (4000, 32)) * 256 * 0.75 ** np.arange(32)).astype(np.int64)
    frame = impact_search._build(pd.DataFrame({"vec_id": np.arange(4000), "q": list(rows), "block": 0}))
    index = impact_search.BlockIndex(next(frame.itertuples()))
    for own in range(0, 4000, 400):
        scores = rows @ rows[own]
        scores[own] = -(2**62)
        want = np.lexsort((np.arange(4000), -scores))[:5]
        for floor in (impact_search.NO_FLOOR, int(scores[want[-1]])):
            at, got = index.top(rows[own], own, 5, floor)
            assert at.tolist() == want.tolist() and got.tolist() == scores[want].tolist()
        assert len(index.top(rows[own], own, 5, int(scores[want[0]]) + 1)[0]) == 0
    assert index.walked < 0.5 * 30 * len(index.postings)


def test_archives_roll_and_read_back(spark, scratch):
    rows = [(i, f"http://h/{i}\r\nX: y é" if i % 3 else None, "p%d " % (i % 5) * 60 if i % 7 else None) for i in range(60)] + [(None, "u", "p1 " * 60), (1, "http://h/1", "p1 " * 60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("shard", F.lit(1))
    manifest = warc.write_archives(pages, scratch, shard_bytes=9_000, roll_bytes=900)
    assert manifest.count() > manifest.select("shard").distinct().count() > 1
    again = warc.write_archives(pages.repartition(7), scratch + "-b", shard_bytes=9_000, roll_bytes=900)
    sizes = lambda m: sorted((r["shard"], r["file"], r["records"], r["bytes"]) for r in m.collect())
    assert sizes(manifest) == sizes(again)
    first = {}
    for i, _, html in rows:
        if len(html or "") >= 100 and i is not None:
            first[html] = min(i, first.get(html, i))
    want = []
    for i, _, html in rows:
        to = first.get(html) if len(html or "") >= 100 and first.get(html) != i else None
        want.append((i, len(html or ""), hashlib.sha256((html or "").encode()).hexdigest(), "response" if to is None else "revisit", to))
    got = [tuple(r) for r in warc.read_archives(manifest, scratch).drop("url").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert warc.read_archives(warc.write_archives(pages.limit(0), scratch + "-c"), scratch + "-c").count() == 0


def test_shards_follow_bytes_whatever_the_ids(spark):
    rows = [(i if i else 10**15, "u", f"page {i} " * 100) for i in range(400)]
    rows += [(None, "u", f"no id {i} " * 100) for i in range(200)] + [(7, "u", f"seven {i} " * 100) for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    starts = warc.shard_starts(pages, 20_000)
    assert starts == sorted(set(starts)) == warc.shard_starts(pages.repartition(5), 20_000)
    held = collections.Counter()
    for page_id, _, html in rows:
        held[bisect.bisect_right(starts, warc._key(page_id, hashlib.sha256(html.encode()).hexdigest()))] += len(html) + 512
    assert set(held) == set(range(len(starts) + 1)) and max(held.values()) < 2 * 20_000
    same = spark.createDataFrame([(3, "u", "x" * 1000)] * 50 + [(4, "u", "y" * 1000)] * 50, "page_id long, url string, html string")
    assert len(warc.shard_starts(same, 5_000)) == 1
    assert warc.shard_starts(pages.where("page_id IS NULL"), 20_000) and not warc.shard_starts(pages.limit(0), 20_000)


def test_licences_by_text_and_line(spark, none):
    mit = "Copyright (c) 2020 Someone\nreleased under  the MIT LICENCE"
    rows = [(1, mit), (2, "Intro.\nLicensed under CC BY-NC 4.0\nmore"), (3, None), (4, "..."), (2, "Released under the MIT License."), (5, "nothing"), (None, mit), (None, "nothing"), (6, mit), (6, mit)]
    told = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string").withColumn("licence", F.lit(0)), licenses.default_licences(spark))
    got = sorted(((r["doc_id"], r["licence"], r["line_licences"]) for r in told.collect()), key=str)
    want = [(1, "MIT", "MIT"), (2, None, "CC-BY-NC-4.0"), (2, "MIT", "MIT"), (3, None, None), (4, None, None), (5, None, None), (None, "MIT", "MIT"), (None, None, None), (6, "MIT", "MIT"), (6, "MIT", "MIT")]
    assert got == sorted(want, key=str)
    assert licenses.scan(none, licenses.default_licences(spark)).count() == 0


def test_licences_by_full_texts_and_beside_notices(spark):
    texts = {path.stem: path.read_text() for path in licenses.TEXTS.glob("*.txt")}
    rows = [(name, "Copyright (c) 2019 J. R. Smith, Inc. All rights reserved.\n" + text.upper()) for name, text in texts.items()]
    rows += [("one line", "Copyright (c) 2020 X. Released under the MIT License."), ("company", "Copyright 2020 X Inc. Licensed under CC BY 4.0."), ("reserved", "A text, all rights reserved, without line breaks.")]
    told = licenses.scan(spark.createDataFrame(rows, "doc_id string, text string"), licenses.default_licences(spark))
    got = {r["doc_id"]: r for r in told.collect()}
    assert len(texts) > 10 and all(name.startswith(got[name]["licence"]) for name in texts)
    assert (got["one line"]["licence"], got["company"]["licence"], got["reserved"]["licence"]) == ("MIT", "CC-BY-4.0", None)
    assert got["reserved"]["canonical_digest"] == hashlib.sha256(b"a text without line breaks").hexdigest()


def test_licences_read_each_text_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        read.add(1)
        return text

    texts = ["a\nLicensed under  CC BY 4.0 \nb", "Released under the MIT License.", "x\n\n  \nThis file: released under the MIT License.\n"] * 5
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").select("doc_id", seen("text").alias("text"))
    got = {r["doc_id"]: (r["licence"], r["line_licences"]) for r in licenses.scan(rows, licenses.default_licences(spark)).collect()}
    assert got == {i: ((None, "CC-BY-4.0"), ("MIT", "MIT"), (None, None))[i % 3] for i in range(15)}
    assert read.value == 15


def test_many_licences_are_found_without_their_sizes(spark, monkeypatch):
    monkeypatch.setattr(licenses, "BROADCAST_LICENCES", 1)
    rows = spark.createDataFrame([(1, "Intro.\nLicensed under CC BY 4.0"), (2, "no")], "doc_id long, text string")
    assert {tuple(r)[::3] for r in licenses.scan(rows, licenses.default_licences(spark)).collect()} == {(1, "CC-BY-4.0"), (2, None)}


def test_token_counts_are_the_library_s(spark, docs, none):
    library, rng = Tokenizer.from_file(BPE), random.Random(1)
    texts = ["".join(rng.choice("abcstmdrvleSTRE'''  \n\té漢１2²½!?_<|>🤖") for _ in range(rng.randrange(60))) for _ in range(800)]
    texts += ["".join(map(chr, range(s, s + 256))) for s in range(0, 0xD800, 2048)] + [t or "" for t in ODD]
    mine = tokenizer_fst.CountTransducer(open(BPE, "rb").read()).counts(texts)
    assert mine.tolist() == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    got = tokenizer_fst.count_tokens(docs, BPE).collect()
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in got) == sorted((len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for t in [*ODD, ODD[4], "a b c d"])
    assert tokenizer_fst.count_tokens(none, BPE).count() == 0


def test_pieces_are_the_unigram_s_and_give_the_text(spark, docs, none):
    data, out = open(PIECES, "rb").read(), b""

    def number(n):
        low = bytes([n & 127 | (128 if n > 127 else 0)])
        return low + number(n >> 7) if n > 127 else low

    for field, value in pieces._fields(data):
        if field == 2:  # the same pieces as a unigram model, for the library to solve
            at = value.index(b"\x18\x02 \x80")
            value = value[:at] + b"\x18\x01" + value[at + 2 :]
        out += number(field << 3 | 2) + number(len(value)) + value
    library, codec, rng = sentencepiece.SentencePieceProcessor(model_proto=out), pieces.Codec(pieces.compile_model(data)), random.Random(2)
    texts = ["".join(rng.choice("abcdetheing  \n\té漢字🤖!?<0x>") for _ in range(rng.randrange(60))) for _ in range(800)]
    assert [codec.encode(t).tolist() for t in texts] == library.encode(texts)
    assert [codec.decode(codec.encode(t).tolist()) for t in texts] == texts
    encoded = pieces.encode(docs, PIECES)
    given = {(r["doc_id"], r["text"] or "") for r in docs.collect()}
    assert {(r["doc_id"], r["decoded"]) for r in encoded.collect()} == {(i, t.replace("▁", " ")) for i, t in given}
    assert {r["text"] for r in pieces.decode(encoded, PIECES).collect()} == {t.replace("▁", " ") for _, t in given}
    assert pieces.encode(none, PIECES).count() == 0


def test_scores_tell_target_from_background(spark, none):
    rows = [(i, "the cat sat on the mat " * 5 if i % 2 else "zzyx qqv wxk jjq " * 5) for i in range(40)] + [(40, None), (41, ""), (None, "the cat")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("difference", F.lit(1))
    target = spark.createDataFrame([(i,) for i in range(1, 30, 2)] + [(None,), (1,)], "doc_id long")
    told = {r["doc_id"]: r for r in lm_scoring.score(frame, target).collect()}
    assert all((told[i]["difference"] < 0) == bool(i % 2) for i in range(40))
    assert told[40]["n_tokens"] == told[41]["n_tokens"] == 0 and told[41]["difference"] is None
    assert told[3]["n_tokens"] == len(rows[3][1]) + 1
    assert lm_scoring.score(none, target.limit(0)).count() == 0
    even = lm_scoring.losses(np.zeros((4, 4, 4)))
    assert np.allclose(even, 2.0) and np.allclose(np.exp2(-lm_scoring.losses(np.random.default_rng(0).integers(0, 3, (4, 4, 4)))).sum(axis=2), 1)


@pytest.mark.parametrize("hot", [lm_scoring.HOT, 40, 0])
def test_scores_of_every_script_are_the_dense_table_s(spark, hot):
    rng, letters = random.Random(6), [chr(0x4E00 + i) for i in range(160)]
    rows = [(i, "".join(rng.choice(letters[:80] if i % 2 else letters[80:]) for _ in range(60))) for i in range(30)] + [(30, None), (None, "ab"), (3, "ab")]
    target = {i for i in range(1, 30, 2)}
    got = lm_scoring.score(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i,) for i in target], "doc_id long"), hot=hot).collect()
    codes = {c: k for k, c in enumerate(["", *sorted({c for _, t in rows for c in t or ""})])}
    counts = np.zeros((2, *[len(codes)] * 3))
    grams = lambda t: list(zip(["", "", *t], ["", *t], [*t, ""]))
    for i, t in rows:
        for gram in grams(t) if t else []:
            counts[(int(i not in target), *(codes[c] for c in gram))] += 1
    counts[1] *= counts[0].sum() / counts[1].sum()
    tables = [lm_scoring.losses(c) for c in counts]
    want = sorted((i or -1, *(np.mean([table[tuple(codes[c] for c in gram)] for gram in grams(t)]) for table in tables)) for i, t in rows if t)
    told = sorted((r["doc_id"] or -1, r["target_bits"], r["background_bits"]) for r in got if r["n_tokens"])
    assert len(got) == len(rows) and np.allclose(np.array(told), np.array(want))
    assert all((r["difference"] < -1) == bool(r["doc_id"] % 2) for r in got if r["n_tokens"] > 3)


def test_marginals_are_those_of_one_long_chain():
    rng = np.random.default_rng(3)
    lengths, moves = np.array([1, 64, 65, 200]), rng.normal(size=(3, 3))
    scores = rng.normal(size=(lengths.sum(), 3))
    got, at = language_crf.marginals(scores, lengths, moves), 0
    for size in lengths:
        e, t = np.exp(scores[at : at + size]), np.exp(moves)
        ahead, behind = [np.full(3, 1 / 3) @ t * e[0]], [np.ones(3)]
        for k in range(1, size):
            ahead.append(ahead[-1] / ahead[-1].sum() @ t * e[k])
        for k in range(size - 1, 0, -1):
            back = t @ (e[k] * behind[-1])
            behind.append(back / back.sum())
        both = np.array(ahead) * np.array(behind[::-1])
        assert np.allclose(got[at : at + size], both / both.sum(axis=1, keepdims=True))
        at += size


def test_languages_held_out_and_switched(spark, docs, none):
    frame = entry.queries()["op8_language"](spark, "/root/testdata/sf0.001")
    told = frame.join(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = told.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert held > 0.95
    sample = [(r["text"], r["lang"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    model = language_crf.fit(sample[:80])
    text = {lang: t for t, lang in sample[80:]}
    mixed = " ".join(text["de"].split()[:40]) + " " + " ".join(text["en"].split()[:40])
    words, told = language_crf.Labeller(model).words([mixed])
    label = [model.languages[k] for k in told.argmax(axis=1)]
    middle = len(language_crf.WORD.findall(" ".join(text["de"].split()[:40])))
    assert np.mean([x == "de" for x in label[:middle]]) > 0.9 and np.mean([x == "en" for x in label[middle:]]) > 0.9
    odd = language_crf.predict(docs.select("doc_id", "text", "lang"), F.lit(True)).collect()
    assert {r["lang_pred"] for r in odd if not re.search(r"[^\W\d_]", r["text"] or "")} == {"und"}
    assert language_crf.predict(none, F.lit(True)).count() == 0
    signs = docs.limit(1).select(F.lit(10**6).alias("doc_id"), F.explode(F.array(*map(F.lit, ("½ ² ①", "Ⅷ 3", "ª")))).alias("text"), F.lit(None).cast("string").alias("lang"))
    told = language_crf.predict(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").unionByName(signs), F.col("doc_id") != 10**6)
    assert {r["text"]: r["lang_pred"] == "und" for r in told.where("doc_id = 1000000").collect()} == {"½ ² ①": True, "Ⅷ 3": True, "ª": False}


def test_a_repeated_id_teaches_one_row_each_time_the_same(spark):
    rows = [(i % 5, f"text {i} of many", "ab"[i % 5 % 2]) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    told = [language_crf.training_sample(frame.repartition(n), F.lit(True), 10) for n in (1, 7)]
    assert told[0] == told[1] == [(min(t for i, t, _ in rows if i == k), "ab"[k % 2]) for k in range(5)]


def test_base_spans_against_plain_patterns():
    patterns = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))

    def plain(text):
        for kind, pattern in patterns:
            for found in re.finditer(pattern, text):
                digits = re.sub("[^0-9]", "", found[0])
                good = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in found[0].split(".")), "card": 16 <= len(digits) <= 19 and pii_tagger._luhn(digits), "phone": 8 <= len(digits) <= 15}
                if good[kind]:
                    yield kind, *found.span()

    rng = random.Random(4)
    for pool in ("ab1.@-+ ", "0123456789 -", "12.0", "+1 ().-2x", "a@b.c@d-"):
        for _ in range(2000):
            text = "".join(rng.choice(pool) for _ in range(rng.randrange(50)))
            assert pii_tagger.base_spans(text) == list(plain(text)), text
    assert pii_tagger.base_spans("a" * 200_000 + "1" * 200_000) == []


def test_personal_data_rows_and_masks(spark, docs, none):
    rows = [(i, f"word of ann.{i}@mail.example.com and +1 (206) 555-01{i:02d} at 10.0.0.{i}, ok", "x") for i in range(30)] + [(30, None, "x"), (31, "4111111111111111", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    told = {r["doc_id"]: r for r in pii_tagger.find(frame).collect()}
    assert (told[3]["n_email"], told[3]["n_phone"], told[3]["n_ip"], told[31]["n_card"]) == (1, 1, 1, 1)
    base = ",".join(f"{k}:{b}:{e}" for k, b, e in pii_tagger.base_spans(rows[3][1]))
    assert told[3]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and set(base.split(",")) <= set(told[3]["spans"].split(","))
    assert told[30]["spans"] == "" and told[30]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    masked = {r["doc_id"]: r["text"] for r in pii_tagger.mask(frame).collect()}
    assert masked[3].startswith("word of [EMAIL] and [PHONE] at [IP]") and masked[30] is None
    assert pii_tagger.find(docs).count() == docs.count() and pii_tagger.find(none).count() == 0


def test_training_windows_hold_every_kind_of_all_texts():
    table = "\n".join(f"{i} {i * 7} {i * 13}" for i in range(9000))
    spans = ["zz ann@mail.example.com", "zz 10.0.0.7 is up", "zz 4111111111111111", "zz call +1 206 555 0123"]
    picked = pii_tagger.training_windows([table, *spans], 300)
    assert len(picked) == 300 and {int(k) for _, told in picked for k in np.unique(told)} == set(range(pii_tagger.LABELS))
    few = pii_tagger.training_windows(spans, 300)
    assert len(few) == len(spans) * (1 + pii_tagger.REWRITINGS)  # short texts: a window each, as they stand and rewritten
    model = pii_tagger.fit([table, *spans * 20], epochs=1)
    assert model is not None


def test_rewritten_spans_are_labelled_where_they_stand():
    text = "zz ann@mail.example.com, 10.0.0.7; 4111 1111 1111 1111 or +1 206 555 0123 end"
    for turn in range(1, 40):
        now, told = pii_tagger.altered(text, pii_tagger.base_spans(text), turn)
        assert sorted(k for k, _, _ in told) == sorted(pii_tagger.KINDS)
        for kind, begin, end in told:
            assert pii_tagger.possible(kind, now[begin:end]), now[begin:end]
            assert now[begin - 1] in " ," and now[begin] != " " and now[end - 1] != " "
    assert not pii_tagger.possible("ip", "1 dot 2 dot 3 dot 256") and not pii_tagger.possible("card", "4111.1111.1111.1112") and not pii_tagger.possible("email", "thing. thing.")


@pytest.fixture(scope="module")
def tagger():
    """A reader trained on a sample of the given documents, and documents it has not seen that hold spans."""
    import duckdb

    texts = [r[0] for r in duckdb.sql("SELECT text FROM read_parquet('/root/testdata/sf0.1/documents.parquet') WHERE text IS NOT NULL ORDER BY hash(doc_id)").fetchall()]
    hinted = [t for t in texts if pii_tagger.HINT.search(t)]
    return pii_tagger.Reader(pii_tagger.fit(hinted[:400])), hinted[400:], texts[:1000]


def test_model_adds_rewritten_spans_and_leaves_other_texts_alone(tagger):
    reader, unseen, texts = tagger
    found = planted = wrong = 0
    for text in unseen:
        now, told = pii_tagger.altered(text, pii_tagger.base_spans(text), 99)
        base, spans = (lists[0] for lists in pii_tagger.all_spans(reader, [now], 0.8))
        assert set(base) <= set(spans) and base == pii_tagger.base_spans(now)
        added, gold = set(spans) - set(base), set(told) - set(base)
        planted, found = planted + len(gold), found + len(added & gold)
        wrong += sum(not any(b < end and begin < e for _, begin, end in told) for _, b, e in added)
    assert planted > 150 and found / planted > 0.5 and wrong <= found * 0.05
    base, spans = pii_tagger.all_spans(reader, texts, 0.8)
    assert sum(map(len, spans)) - sum(map(len, base)) <= 2


def test_whole_texts_are_decoded_as_one_chain(tagger, monkeypatch):
    reader, unseen, _ = tagger
    long = " ".join(pii_tagger.altered(t, pii_tagger.base_spans(t), 7)[0] for t in unseen[:12])
    texts = ["", *unseen[:40], "orble. " * 300, long, "1" * 500, long[: pii_tagger.STRIDE], long[: 2 * pii_tagger.STRIDE]]

    def plain(text):
        """All windows, emissions blended, Viterbi over every place of the text."""
        classes, size = pii_tagger.char_classes(text), len(text)
        total = np.zeros((size + pii_tagger.WINDOW, pii_tagger.LABELS), np.float32)
        for at in range(0, size, pii_tagger.STRIDE):
            line = np.full((1, pii_tagger.WINDOW), pii_tagger.PAD, np.uint8)
            line[0, : size - at] = classes[at : at + pii_tagger.WINDOW]
            told, share = reader.emissions(line)[:, :, 0], np.ones((pii_tagger.WINDOW, 1), np.float32)
            if at:
                share[: pii_tagger.OVERLAP] = pii_tagger.RAMP[..., 0]
            share[pii_tagger.STRIDE :] = 1 - pii_tagger.RAMP[..., 0]
            total[at : at + pii_tagger.WINDOW] += told * share
        if not size:
            return []
        whole = pii_tagger._decoded(reader, total[:size], np.array([0]), np.array([size]), lambda kind, b, e: pii_tagger.possible(kind, text[b:e]))
        return [(kind, b, e) for kind, b, e, sure in whole if sure >= 0.8]

    wanted = [plain(t) for t in texts]
    assert sum(map(len, wanted)) > 20
    for at_once in (1024, 5, 1):
        monkeypatch.setattr(pii_tagger, "WINDOWS_AT_ONCE", at_once)
        assert pii_tagger.model_spans(reader, texts, 0.8) == wanted


def test_runs_of_many_blocks_are_decoded_together(tagger, monkeypatch):
    reader, unseen, _ = tagger
    texts = [pii_tagger.altered(t, pii_tagger.base_spans(t), 7)[0] for t in unseen[:20]]
    wanted = pii_tagger.model_spans(reader, texts, 0.8)
    calls, decoded = [], pii_tagger._decoded
    monkeypatch.setattr(pii_tagger, "WINDOWS_AT_ONCE", 2)
    monkeypatch.setattr(pii_tagger, "_decoded", lambda reader, scores, *rest: calls.append(len(scores)) or decoded(reader, scores, *rest))
    assert pii_tagger.model_spans(reader, texts, 0.8) == wanted and len(calls) == 1
    monkeypatch.setattr(pii_tagger, "PLACES_AT_ONCE", 100)
    assert pii_tagger.model_spans(reader, texts, 0.8) == wanted and len(calls) > 2


def test_lean_emissions_are_those_of_the_model():
    rng = np.random.default_rng(6)
    h, w, n = pii_tagger.HIDDEN, pii_tagger.WIDTH, pii_tagger.LABELS
    model = pii_tagger._model([rng.normal(0, 0.5, s) for s in ((pii_tagger.PAD + 1, w), (w + h, 4 * h), (4 * h,), (w + h, 4 * h), (4 * h,), (2 * h, n), (n,), (n, n))])
    windows = rng.integers(0, pii_tagger.PAD + 1, (7, 50))
    assert np.allclose(pii_tagger.Reader(model).emissions(windows).transpose(2, 0, 1), pii_tagger.emissions(model, windows), atol=1e-4)


def test_tagger_gradient_is_the_slope():
    rng = np.random.default_rng(5)
    h, w, n = pii_tagger.HIDDEN, pii_tagger.WIDTH, pii_tagger.LABELS
    values = [rng.normal(0, 0.3, s) for s in ((pii_tagger.PAD + 1, w), (w + h, 4 * h), (4 * h,), (w + h, 4 * h), (4 * h,), (2 * h, n), (n,), (n, n))]
    x, y = rng.integers(0, 9, (2, 7)), rng.integers(0, n, (2, 7))

    def loss():
        model = pii_tagger._model(values)
        scores = pii_tagger.emissions(model, x)
        ahead = scores[:, 0]
        path = scores[[0, 1], 0, y[:, 0]]
        for t in range(1, 7):
            ahead = pii_tagger._logsum(ahead[:, :, None] + model.transitions, 1) + scores[:, t]
            path = path + scores[[0, 1], t, y[:, t]] + model.transitions[y[:, t - 1], y[:, t]]
        return float((pii_tagger._logsum(ahead, 1) - path).mean())

    for value, grad in zip(values, pii_tagger._gradients(values, x, y)):
        place = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        kept = value[place]
        value[place] = kept + 1e-5
        up = loss()
        value[place] = kept - 1e-5
        slope = (up - loss()) / 2e-5
        value[place] = kept
        assert slope == pytest.approx(grad[place], rel=1e-3)


def brute_components(rows, size=4, percent=85):
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets[i] = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} if words else set()
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= percent * len(sets[a] | sets[b]) and label[b] < label[a]:
                    label[a], changed = label[b], True
    return {(i, len(sets[i]), label[i]) for i in sets}


def near_copies(seed, n=140):
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(400)
    bases, rows = [[word() for _ in range(rng.randrange(3, 120))] for _ in range(4)], []
    for i in range(n):
        words = list(rng.choice(bases)) if rng.random() < 0.85 else [word() for _ in range(30)]
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = word()
        rows.append((i, " ".join(words).upper() if i % 9 == 0 else "\n".join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_prefix_join_against_all_pairs(spark, monkeypatch, seed):
    if seed == 2:
        monkeypatch.setattr(prefix_join, "OPEN_PAIRS", 0)
        monkeypatch.setattr(prefix_join, "LOOKED_AT", 2)
        monkeypatch.setattr(prefix_join, "BROADCAST_IDS", 0)
    rows = [*near_copies(seed), (900, None), (901, ""), (902, "a b"), (903, "A  b"), (904, "a b c")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("x"))
    assert {tuple(r) for r in prefix_join.join_components(frame).collect()} == brute_components(rows)


def test_tiles_of_a_hub_are_bounded(spark):
    pairs = spark.range(1, 40_001).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b")).union(spark.sql("SELECT 50000L, 50001L"))
    tiled = prefix_join._hub_tiles(pairs)
    assert tiled.groupBy("tile").count().agg(F.max("count")).first()[0] < 2 * prefix_join.TILE
    assert tiled.select("a", "b").exceptAll(pairs).isEmpty() and tiled.count() == 40_001


def test_prefix_join_with_repeated_and_missing_ids(spark, none):
    rows = [(5, "a b c d e"), (5, "a b c d e"), (5, "q r s t u"), (3, "q r s t u"), (None, "a b c d e"), (9, "z")]
    got = collections.Counter(tuple(r) for r in prefix_join.join_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == collections.Counter([(5, 2, 3), (5, 2, 3), (5, 2, 3), (3, 2, 3), (None, 2, None), (9, 1, 9)])
    assert prefix_join.join_components(none).count() == 0


def test_parities_never_differ_more_than_the_sets():
    rng = random.Random(4)
    for _ in range(200):
        one = {rng.getrandbits(64) for _ in range(rng.randrange(600))}
        two = {x for x in one if rng.random() < 0.9} | {rng.getrandbits(64) for _ in range(rng.randrange(60))}
        first, second = (prefix_join._parities(np.array(sorted(x), np.uint64)) for x in (one, two))
        assert sum((int(x) & (1 << 64) - 1).bit_count() for x in first ^ second) <= len(one ^ two)


def test_sketches_of_any_sizes_never_differ_more_than_the_sets():
    rng = random.Random(5)
    for most in (1, 60, 600, 3000):
        for _ in range(40):
            one = {rng.getrandbits(64) for _ in range(rng.randrange(1, most + 1))}
            two = {x for x in one if rng.random() < 0.9} | {rng.getrandbits(64) for _ in range(rng.randrange(1, most + 1))}
            first, second = (prefix_join._sketch(np.array(sorted(x), np.uint64)) for x in (one, two))
            assert prefix_join._unlike(first, second) == prefix_join._unlike(second, first) <= len(one ^ two)
    assert prefix_join._unlike(prefix_join._sketch(np.zeros(0, np.uint64)), prefix_join._sketch(np.array([5], np.uint64))) == 1


def test_long_texts_that_cannot_link_are_not_moved(spark, monkeypatch):
    """Two sets of 1,500 differ in at most 256 classes of 256, which ruled nothing out."""
    rng = random.Random(8)
    word = lambda: "w%d" % rng.randrange(10**6)
    common, base = [word() for _ in range(400)], [word() for _ in range(1500)]
    rows = [(1, common + [word() for _ in range(1100)]), (2, common + [word() for _ in range(1100)]), (3, base), (4, base[:-20])]
    moved, verify = [], prefix_join.verify
    monkeypatch.setattr(prefix_join, "verify", lambda tiled, *a: moved.extend((r["a"], r["b"]) for r in tiled.collect()) or verify(tiled, *a))
    got = prefix_join.join_components(spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string"))
    assert {(r["doc_id"], r["component_id"]) for r in got.collect()} == {(1, 1), (2, 2), (3, 3), (4, 3)}
    assert {tuple(sorted(p)) for p in moved} == {(3, 4)}


def test_lists_that_are_settled_are_put_aside(spark):
    # one in a single component, one of two members, one of three
    postings = spark.createDataFrame([(1, 10, 9, 0), (1, 11, 9, 0), (2, 10, 9, 1), (2, 12, 9, 0), (3, 10, 9, 2), (3, 11, 9, 2), (3, 12, 9, 1)], "token long, node long, n int, place int")
    labels = spark.createDataFrame([(10, 10), (11, 10)], "node long, component long")
    told = {(r["token"], r["node"]): r for r in prefix_join._open_lists(postings, labels, 0).collect()}
    assert set(told) == {(2, 10), (2, 12), (3, 10), (3, 11), (3, 12)}
    assert all((r["k"], r["left"], r["unmet"]) == ((2, 1, 1) if t == 2 else (3, 2, 2)) for (t, _), r in told.items())
    assert len({r["hub"] for (t, _), r in told.items() if t == 3}) == 1
    later = [r for r in prefix_join._open_lists(postings, labels, 1).collect() if r["token"] == 3]
    assert {r["unmet"] for r in later} == {3 - len({r["seat"] for r in later})}


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(100)] + [(300, 200), (200, 200), (None, 1)]
    got = {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(101)} | {(200, 200), (300, 200)}


def test_workers_drop_what_another_operator_kept(spark):
    docs = spark.range(0, 64, 1, 16).selectExpr("id AS doc_id", "concat('some words ', id) AS text")
    assert pieces.encode(docs, PIECES).where("size(pieces) > 0").count() == 64

    def held(batches):
        from recordmill.llm import pieces as here

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([here._codec.cache_info().currsize])], ["n"])

    told = common.map_batches(spark.range(0, 64, 1, 16), held, "n long")
    assert told.groupBy().max("n").first()[0] == 0


def _part_files(path):
    return len(list(pathlib.Path(path.removeprefix("file:")).glob("part-*")))


def test_steps_of_few_rows_are_few_files(spark):
    """A file is three processes on a local disk, so a step of a hundred rows must not be one a partition."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long").coalesce(1)
        words = spark.createDataFrame([(f"abc{a}{b}de", 3) for a in "fghijk" for b in "lmnopq"], "word string, n long").coalesce(1)
        for run, own in ((lambda: components(path), 0), (lambda: spelling_variants.neighbours(words), 3)):
            first = len(session._scratch)
            assert run().count()
            rounds = session._scratch[first + own :]
            assert rounds and max(_part_files(p) for p in rounds) == 1
        texts = spark.createDataFrame([(i, "".join(random.Random(i).choices("abcdefgh", k=80))) for i in range(60)], "doc_id long, text string")
        first = len(session._scratch)
        assert lm_scoring.score(texts, texts.select("doc_id").where("doc_id % 2 = 0")).count() == 60
        cores = spark.sparkContext.defaultParallelism
        assert cores < 40 and max(_part_files(p) for p in session._scratch[first:]) <= cores
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_templates_see_other_values_and_leave_the_rest(spark, none):
    item = "A train leaves Paris heading for Rome at 60 km per hour and after 3 hours it has used 40 kg of coal while Rome waits."
    other = "intro words. A train leaves Berlin heading for Oslo at 75 km per hour and after 5 hours it has used 90 kg of coal while Oslo waits. the end"
    mixed = other.replace("while Oslo", "while Madrid")
    rows = [(1, item), (2, other), (3, mixed), (4, "1 2 3 4 5 6 7 8 9 10 11 12"), (5, None), (None, item), (6, "A train leaves."), (1, item)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit(0))
    bench = spark.createDataFrame([(7, item), (8, None), (9, ""), (10, "5 6 7 8"), (None, item)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["changed_slots"]) for r in templates.contaminated(frame, bench).collect()}
    assert got == {(1, 7, 0), (2, 7, 6)}
    assert templates.contaminated(none, bench).count() == 0 and templates.contaminated(frame, bench.limit(0)).count() == 0


def test_templates_meet_copies_of_items_with_few_words(spark):
    sums, heading, second = "What is 12 times 15?", "The Fall Of Rome And The Rise Of Venice", "How many of the red apples are left over when all of them went home"
    rows = [(1, f"Well. {sums} Nobody knows."), (2, f"Well. {sums.replace('15', '16')} Nobody knows."), (3, f"on {heading.lower()} once more"), (4, second), (5, "12 15 16")]
    bench = spark.createDataFrame([(1, sums), (2, heading), (3, second), (3, "Why did the old man walk so far into the cold night alone"), (4, "12 15 16")], "item_id long, text string")
    got = {tuple(r) for r in templates.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert got == {(1, 1, 5, 5, 0), (3, 2, 9, 9, 0), (4, 3, 15, 15, 0)}
    both = bench.select(F.col("item_id").alias("doc_id"), "text").where("doc_id = 3")
    assert templates.contaminated(both, bench.where("item_id = 3")).count() == 2


def test_short_items_are_met_by_whole_texts_only(spark):
    bench = spark.createDataFrame([(1, "Dog"), (2, "the"), (3, "Why so late?"), (4, "when will the next train leave")], "item_id long, text string")
    rows = [(1, "I saw the dog. Why so late? the"), (2, "why so late"), (3, "The"), (4, "Tell me: when will the next train leave?"), (5, "dog the")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in templates.contaminated(frame, bench).collect()}
    assert got == {(2, 3), (3, 2), (4, 4)}
    alone = {(r["doc_id"], r["item_id"]) for r in templates.contaminated(frame, bench.where("item_id = 2")).collect()}
    assert alone == {(3, 2)}


def test_windows_of_all_widths_come_from_one_scan(spark):
    made = templates._templated(spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string"), "doc_id", "text")
    rows = templates._document_windows(made, [(5, False), (6, True), (4, False), (9, False), (2, False)], 4)
    assert sorted((r["width"], r["plain"]) for r in rows.collect()) == [(4, False)] * 3 + [(5, False)] * 2 + [(6, True)]
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") + rows._jdf.queryExecution().optimizedPlan().toString().count("LocalRelation") == 1


def test_pipeline_stages_keep_the_columns(spark, none):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("lang_pred", F.lit("x")).withColumn("named_id", F.lit(1))
    docs = docs.unionByName(docs.where("doc_id < 2"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, "/root/testdata/sf0.001")
        assert kept.columns == docs.columns, name
        assert stage(spark, none, "/root/testdata/sf0.001").count() == 0
        assert 0 < kept.count() <= docs.count()
        if name == "near_copies":
            assert kept.count() == kept.select("doc_id").distinct().count()
        docs = kept
    last = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert {(r["doc_id"], r["text"]) for r in last.collect()} == {(r["doc_id"], r["text"]) for r in docs.collect()}


def test_pipeline_keeps_one_of_each_group_by_five_words(spark):
    import corpus_pipeline

    rows = near_copies(3)
    first = lambda size, percent: {i for i, _, label in brute_components(rows, size, percent) if i == label}
    kept = corpus_pipeline.one_of_each_group(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert {r["doc_id"] for r in kept.collect()} == first(5, 80) != first(4, 85)
