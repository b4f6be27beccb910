"""Language of words and documents by a linear-chain conditional random field.

Each word is scored by its affixes, character n-grams (hashed) and membership in lexicons of
frequent words, with learned transitions between the languages of neighbours.
Forward-backward gives every word's marginals, so text that switches language is labelled word
by word; a document's language is the one with the largest mean marginal.

The model is fitted by the driver on a bounded sample, ``per_language`` whole documents of
each language chosen by a hash of the id; training chains are spliced from documents of
different languages, so that switches are seen. Everything else runs over all rows.

Long texts are cut into chunks of words whose transfer matrices are multiplied first, so
the messages are those of the whole text.

Nulls, ties, repeats: a null text, or one without a letter, is ``und`` with score 0. A row
without id, text or language teaches nothing; repeated rows are predicted one by one. Equal
means go to the first language in alphabetical order. With nothing to learn from all rows
are ``und``. More than ``MAX_LANGUAGES`` distinct values are an error. An empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from recordmill.llm.common import map_batches, short_batches

UNDETERMINED = "und"
MAX_LANGUAGES = 64
BUCKETS = 1 << 16
LEXICON = 400  # frequent words of each language
CHAIN = 48  # words of a training chain
CHUNK = 64
MAX_WORDS = 400_000
WORD = regex.compile(r"\p{L}+")
P = np.uint64(0x9E3779B97F4A7C15)


class Model(NamedTuple):
    languages: tuple[str, ...]
    weights: np.ndarray  # by hashed feature and language
    lexicon: dict[str, np.ndarray]
    transitions: np.ndarray


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * P
    return ((x ^ (x >> np.uint64(29))) * P >> np.uint64(40)).astype(np.int64) % BUCKETS


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all words one after another, and the word that each belongs to.

    Bigrams and trigrams of the word between edge marks, and the affixes of three letters.
    """
    line = np.frombuffer(("\x02" + "\x03\x02".join(words) + "\x03").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    begin = line == 2
    word = np.cumsum(begin) - 1
    two = line[:-1] * P + line[1:]
    three = two[:-1] * P + line[2:]
    four = three[:-1] * P + line[3:]
    same = [word[: len(x)] == word[len(line) - len(x) :] for x in (two, three, four)]
    affix = same[2] & (begin[: len(four)] | (line[3:] == 3))
    values = np.concatenate([two[same[0]], three[same[1]] + np.uint64(1), four[affix] + np.uint64(2)])
    owner = np.concatenate([word[: len(two)][same[0]], word[: len(three)][same[1]], word[: len(four)][affix]])
    return _mixed(values), owner


def emissions(words: list[str], model: Model) -> np.ndarray:
    """Scores of the languages for each word."""
    hashed, owner = features(words)
    out = np.stack([np.bincount(owner, weights=model.weights[hashed, k], minlength=len(words)) for k in range(len(model.languages))], axis=1)
    for i, w in enumerate(words):
        extra = model.lexicon.get(w)
        if extra is not None:
            out[i] += extra
    return out


def marginals(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Forward-backward over texts laid one after another; ``lengths`` has the words of each (at least 1)."""
    n, k = scores.shape
    parts = -(-lengths // CHUNK)
    first = np.concatenate([[0], np.cumsum(parts)[:-1]])  # a text's first chunk
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    text = np.repeat(np.arange(len(lengths)), lengths)
    offset = np.arange(n) - begins[text]
    row, column = first[text] + offset // CHUNK, offset % CHUNK
    lanes = int(parts.sum())
    emit, real = np.ones((CHUNK, lanes, k)), np.zeros((CHUNK, lanes), bool)
    emit[column, row] = np.exp(scores - scores.max(axis=1, keepdims=True))
    real[column, row] = True
    move = np.exp(transitions - transitions.max())
    scale = lambda x: x / x.sum(axis=-1, keepdims=True)
    if parts.max() > 1:  # transfer matrices of whole chunks
        transfer = np.tile(np.eye(k), (lanes, 1, 1))
        for t in range(CHUNK):
            stepped = (transfer.reshape(-1, k) @ move).reshape(lanes, k, k) * emit[t][:, None, :]
            stepped /= stepped.max(axis=(1, 2), keepdims=True)
            transfer = np.where(real[t][:, None, None], stepped, transfer)
    into, after = np.full((lanes, k), 1.0 / k), np.ones((lanes, k))
    for part in range(1, int(parts.max())):
        lane = first[parts > part] + part
        into[lane] = scale(np.einsum("li,lij->lj", into[lane - 1], transfer[lane - 1]))
        back = (first + parts - 1)[parts > part] - part
        after[back] = scale(np.einsum("lij,lj->li", transfer[back + 1], after[back + 1]))
    forward = np.empty((CHUNK, lanes, k))
    state = into
    for t in range(CHUNK):
        state = np.where(real[t][:, None], scale(state @ move * emit[t]), state)
        forward[t] = state
    for t in range(CHUNK - 1, -1, -1):
        forward[t] = scale(forward[t] * after)
        after = np.where(real[t][:, None], scale((emit[t] * after) @ move.T), after)
    return forward[column, row]


def _chains(texts: list[tuple[list[str], int]], rng: np.random.Generator) -> list[list[tuple[str, int]]]:
    """Training chains: runs of 8 to CHAIN words taken from the documents in a random order."""
    runs = []
    for words, label in texts:
        at = 0
        while at < len(words):
            size = int(rng.integers(8, CHAIN + 1))
            runs.append([(w, label) for w in words[at : at + size]])
            at += size
    rng.shuffle(runs)
    line = [x for run in runs for x in run]
    return [line[i : i + CHAIN] for i in range(0, len(line) - CHAIN + 1, CHAIN)]


def fit(texts: list[tuple[str, str]], epochs: int = 3, rate: float = 0.3, seed: int = 7) -> Model | None:
    """A model of (text, language) rows, by stochastic gradients of the chains' likelihood."""
    languages = tuple(sorted({lang for _, lang in texts}))
    if not languages:
        return None
    k, rng = len(languages), np.random.default_rng(seed)
    split = [(WORD.findall(text.lower()), languages.index(lang)) for text, lang in texts]
    counts = [Counter() for _ in languages]
    for words, label in split:
        counts[label].update(words)
    lexicon: dict[str, np.ndarray] = {}
    for label, counted in enumerate(counts):
        for word, _ in sorted(counted.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]:
            lexicon.setdefault(word, np.zeros(k))[label] = 1.0
    member = {w: v.copy() for w, v in lexicon.items()}
    strength = np.ones(k)  # learned weight of each language's lexicon
    weights, transitions = np.zeros((BUCKETS, k)), np.zeros((k, k))
    seen_w, seen_t, seen_s = np.full((BUCKETS, k), 1e-2), np.full((k, k), 1e-2), np.full(k, 1e-2)
    chains = _chains(split, rng)
    for _ in range(epochs):
        rng.shuffle(chains)
        for at in range(0, len(chains), 32):
            batch = chains[at : at + 32]
            words, labels = [w for c in batch for w, _ in c], np.array([y for c in batch for _, y in c])
            hashed, owner = features(words)
            scores = np.stack([np.bincount(owner, weights=weights[hashed, j], minlength=len(words)) for j in range(k)], axis=1)
            lex = np.stack([member.get(w, np.zeros(k)) for w in words])
            scores += lex * strength
            gold = np.eye(k)[labels]
            wrong = marginals(scores, np.full(len(batch), CHAIN), transitions) - gold
            grad = np.zeros_like(weights)
            for j in range(k):
                grad[:, j] = np.bincount(hashed, weights=wrong[owner, j], minlength=BUCKETS)
            grad = grad / len(words) * 8 + 1e-6 * weights
            pairs = _pair_gradient(scores, labels, len(batch), transitions) / len(words)
            lexed = (wrong * lex).sum(axis=0) / len(words)
            for value, total, step in ((weights, seen_w, grad), (transitions, seen_t, pairs), (strength, seen_s, lexed)):
                total += step**2
                value -= rate * step / np.sqrt(total)
    return Model(languages, weights, {w: v * strength for w, v in member.items()}, transitions)


def _pair_gradient(scores: np.ndarray, labels: np.ndarray, chains: int, transitions: np.ndarray) -> np.ndarray:
    """Expected less observed transitions of equally long chains."""
    k = scores.shape[1]
    emit = np.exp(scores - scores.max(axis=1, keepdims=True)).reshape(chains, CHAIN, k)
    move = np.exp(transitions - transitions.max())
    forward, backward = np.empty((CHAIN, chains, k)), np.ones((CHAIN, chains, k))
    state = np.full((chains, k), 1.0 / k)
    for t in range(CHAIN):
        state = (state @ move if t else state) * emit[:, t]
        state /= state.sum(axis=1, keepdims=True)
        forward[t] = state
    for t in range(CHAIN - 2, -1, -1):
        back = (emit[:, t + 1] * backward[t + 1]) @ move.T
        backward[t] = back / back.sum(axis=1, keepdims=True)
    joint = forward[:-1, :, :, None] * move * (emit.transpose(1, 0, 2)[1:] * backward[1:])[:, :, None, :]
    expected = (joint / joint.sum(axis=(2, 3), keepdims=True)).sum(axis=(0, 1))
    y = labels.reshape(chains, CHAIN)
    observed = np.zeros((k, k))
    np.add.at(observed, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
    return expected - observed


def training_sample(documents: DataFrame, learn_from: Column, per_language: int) -> list[tuple[str, str]]:
    """(text, language) of at most ``per_language`` documents of each language, by a hash of the id."""
    rows = documents.select("doc_id", "lang").where(learn_from & F.col("doc_id").isNotNull() & F.col("lang").isNotNull()).distinct()
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id")
    ids = [r[0] for r in rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_language).select("doc_id").limit(MAX_LANGUAGES * per_language + 1).collect()]
    if len(ids) > MAX_LANGUAGES * per_language:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    picked = documents.where(F.col("doc_id").isin(ids) & F.col("text").isNotNull() & F.col("lang").isNotNull() & learn_from)
    one = F.min(F.struct("text", "lang")).alias("one")  # of rows that repeat an id, the first
    told = sorted((r["doc_id"], r["one"]["text"], r["one"]["lang"]) for r in picked.groupBy("doc_id").agg(one).collect())
    return [(text, lang) for _, text, lang in told]


class Labeller:
    """Word and document labels with a fitted model; scores of words are remembered."""

    def __init__(self, model: Model):
        self.model, self.known, self.table = model, {}, np.zeros((0, len(model.languages)))

    def _scores(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > MAX_WORDS:
            known.clear()
            self.table = self.table[:0]
        fresh = list(set(words).difference(known))
        if fresh:
            known.update(zip(fresh, range(len(known), len(known) + len(fresh))))
            self.table = np.concatenate([self.table, emissions(fresh, self.model)])
        return self.table[[known[w] for w in words]]

    def words(self, texts: list[str | None]) -> tuple[list[list[str]], np.ndarray]:
        """The words of each text, and the marginals of all of them one after another."""
        found = [WORD.findall(t.lower()) if t else [] for t in texts]
        line = [w for words in found for w in words]
        if not line:
            return found, np.zeros((0, len(self.model.languages)))
        lengths = np.array([len(words) for words in found if words])
        return found, marginals(self._scores(line), lengths, self.model.transitions)

    def documents(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        found, told = self.words(texts)
        lengths = np.array([len(words) for words in found], np.int64)
        full = np.flatnonzero(lengths)
        names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if len(full):
            starts = np.concatenate([[0], np.cumsum(lengths[full])[:-1]])
            means = np.add.reduceat(told, starts) / lengths[full][:, None]
            for i, mean in zip(full, means):
                names[i] = self.model.languages[int(mean.argmax())]
                scores[i] = min(float(mean.max()), 1.0)
        return names, scores


def predict(documents: DataFrame, learn_from: Column, per_language: int = 150) -> DataFrame:
    """Every row of ``documents`` (with doc_id, text, lang) with ``lang_pred`` and ``lang_score`` appended."""
    spark = documents.sparkSession
    short_batches(spark)
    sample = training_sample(documents, learn_from, per_language)
    shared = spark.sparkContext.broadcast(fit(sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        labeller = Labeller(model) if model else None
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            names, scores = labeller.documents(texts) if labeller else ([UNDETERMINED] * len(texts), np.zeros(len(texts)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*batch.schema.names, "lang_pred", "lang_score"])

    schema = StructType([*documents.schema.fields, StructField("lang_pred", StringType()), StructField("lang_score", DoubleType())])
    return map_batches(documents, run, schema)
