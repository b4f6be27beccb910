"""SentencePiece encoding and decoding by Unigram Viterbi over a double-array trie.

A piece model is read from its file: pieces, log scores and kinds. The pieces become a
double-array trie over bytes, built once by the driver. Encoding finds the best-scoring path of
pieces; a character that no piece covers costs ten less than the worst piece and is written as
its bytes' pieces. White space is the marker U+2581, one is put before a text. Decoding joins
pieces and byte runs and turns markers into spaces.

Where no piece holds a marker after another character (checked on reading the model), the best
path of a text is that of its words one by one, so words are solved once and remembered; else
a text is solved as a whole. The memory for words is emptied when it is full.

Nulls, ties, repeats: a null or empty text has no pieces. Of equal scores the path whose last
piece begins first wins. A marker that stands in a text itself is read back as a space;
otherwise decoding gives the text again. Repeated rows are rows of their own; ids may be null.
An empty table gives no rows; other columns are ignored by :func:`encode`.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from recordmill.llm.common import kept, map_batches, short_batches

MARKER = "▁"
UNKNOWN_COST = 10.0
LOWEST = float("-inf")
MAX_WORDS = 800_000
# Kinds of pieces in the model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class Model(NamedTuple):
    """A compiled piece model; plain bytes, so that it is shared as it is."""

    base: bytes
    check: bytes
    value: bytes
    scores: tuple[float, ...]
    byte_ids: tuple[int, ...]
    surfaces: tuple[bytes, ...]
    unknown_id: int
    unknown_score: float
    by_words: bool


def _varint(data: bytes, at: int) -> tuple[int, int]:
    number = shift = 0
    while True:
        byte = data[at]
        at += 1
        number |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return number, at


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """The fields of a protocol buffer message: number, and its bytes or integer."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        if tag & 7 == 2:
            size, at = _varint(data, at)
            yield tag >> 3, data[at : at + size]
            at += size
        elif tag & 7 == 0:
            number, at = _varint(data, at)
            yield tag >> 3, number
        else:
            size = 4 if tag & 7 == 5 else 8
            yield tag >> 3, data[at : at + size]
            at += size


def read_pieces(data: bytes) -> list[tuple[str, float, int]]:
    """(piece, score, kind) of a model file, in order of ids."""
    pieces = []
    for number, value in _fields(data):
        if number == 1:
            told = dict(_fields(value))
            pieces.append((told[1].decode(), struct.unpack("<f", told.get(2, b"\0\0\0\0"))[0], told.get(3, NORMAL)))
    return pieces


def double_array(words: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, value) of a trie: the child of ``n`` by byte ``b`` is ``base[n] + b + 1`` if its check is ``n``.

    ``value`` is a word's number, or -1.
    """
    root: dict = {}
    for word, number in words.items():
        node = root
        for byte in word:
            node = node.setdefault(byte, {})
        node[-1] = number
    base, check, value = [0] * 258, [0] + [-1] * 257, [-1] * 258
    free, crowded, waiting = 258, 258, [(0, root)]  # places from 258 on suit any byte
    for at, node in waiting:  # grows while it is walked
        value[at] = node.get(-1, -1)
        codes = sorted(b + 1 for b in node if b >= 0)
        if not codes:
            continue
        while free < len(check) and check[free] >= 0:
            free += 1
        place = (free if len(codes) == 1 else max(free, crowded)) - codes[0]
        for tries in range(1 << 30):
            more = place + codes[-1] + 1 - len(check)
            if more > 0:
                base += [0] * more
                check += [-1] * more
                value += [-1] * more
            if all(check[place + code] < 0 for code in codes):
                break
            place += 1
        if tries > 32 and len(codes) > 1:
            crowded = place + codes[0]  # what lies before is too full to be tried again
        base[at] = place
        for code in codes:
            check[place + code] = at
            waiting.append((place + code, node[code - 1]))
    tail = [-1] * 257  # so that any byte's place can be looked at
    return np.array(base + [0] * 257, np.int32), np.array(check + tail, np.int32), np.array(value + tail, np.int32)


@lru_cache(2)
def compile_model(data: bytes) -> Model:
    """The double array and tables of a model file."""
    pieces = read_pieces(data)
    usable = {p.encode(): i for i, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER)}
    base, check, value = double_array(usable)
    normal = [score for _, score, kind in pieces if kind == NORMAL]
    best = max(normal)
    scores = [len(p.encode()) * best - 0.1 if kind == USER else score for p, score, kind in pieces]
    byte_ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
    unknown = next(i for i, (_, _, kind) in enumerate(pieces) if kind == UNKNOWN)
    surfaces = [bytes([int(p[3:5], 16)]) if kind == BYTE else p.encode() if kind in (NORMAL, USER) else b"" for p, _, kind in pieces]
    apart = not any(MARKER in p.lstrip(MARKER) for p, _, kind in pieces if kind in (NORMAL, USER))
    ids = tuple(byte_ids.get(f"<0x{b:02X}>", unknown) for b in range(256))
    return Model(base.tobytes(), check.tobytes(), value.tobytes(), tuple(scores), ids, tuple(surfaces), unknown, min(normal) - UNKNOWN_COST, apart)


class Codec:
    """Encodes and decodes with one model."""

    def __init__(self, model: Model):
        self.model = model
        self.base, self.check, self.value = (np.frombuffer(x, np.int32).tolist() for x in model[:3])
        self.words: dict[str, bytes] = {}

    def solve(self, text: str) -> bytes:
        """Ids of the best path through a marked text, as 32-bit numbers."""
        model, data = self.model, text.encode("utf-8", "replace")
        base, check, value, scores, size = self.base, self.check, self.value, model.scores, len(data)
        best, back, piece = [LOWEST] * (size + 1), [0] * (size + 1), [0] * (size + 1)
        best[0] = 0.0
        at = 0
        while at < size:
            lead = data[at]
            width = 1 if lead < 128 else 2 if lead < 224 else 3 if lead < 240 else 4
            here, node, end, single = best[at], 0, at, False
            while end < size:
                child = base[node] + data[end] + 1
                if check[child] != node:
                    break
                node, end = child, end + 1
                number = value[node]
                if number >= 0:
                    score = here + scores[number]
                    if score > best[end]:
                        best[end], back[end], piece[end] = score, at, number
                    single = single or end - at == width
            if not single:
                score, end = here + model.unknown_score, at + width
                if score > best[end]:
                    best[end], back[end], piece[end] = score, at, -1
            at += width
        out, end = [], size
        while end:
            begin = back[end]
            if piece[end] < 0:
                out.extend(model.byte_ids[b] for b in reversed(data[begin:end]))
            else:
                out.append(piece[end])
            end = begin
        return array("i", out[::-1]).tobytes()

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        marked = MARKER + text.replace(" ", MARKER)
        if not self.model.by_words:
            return np.frombuffer(self.solve(marked), np.int32)
        known, words = self.words, WORDS.findall(marked)
        if len(known) > MAX_WORDS:
            known.clear()
        for word in [w for w in words if w not in known]:
            known[word] = self.solve(word)
        return np.frombuffer(b"".join([known[word] for word in words]), np.int32)

    def decode(self, ids: list[int]) -> str:
        surfaces = self.model.surfaces
        text = b"".join([surfaces[i] for i in ids]).decode("utf-8", "replace").replace(MARKER, " ")
        return text[1:] if text[:1] == " " else text


WORDS = re.compile(f"{MARKER}+[^{MARKER}]*")


@kept(2)
def _codec(model: Model) -> Codec:
    return Codec(model)


def _shared(documents: DataFrame, model_path: str):
    with open(model_path, "rb") as file:
        return documents.sparkSession.sparkContext.broadcast(compile_model(file.read()))


def _lists(codec: Codec, texts: list[str | None]) -> tuple[list[np.ndarray], pa.Array]:
    ids = [codec.encode(t or "") for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    return ids, pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*ids, np.zeros(0, np.int32)])))


def encode(documents: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, pieces array<int>, decoded): the ids of every whole text, and the text that they give again."""
    short_batches(documents.sparkSession)
    shared = _shared(documents, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in batches:
            ids, pieces = _lists(codec, batch.column(1).to_pylist())
            decoded = pa.array([codec.decode(x.tolist()) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), pieces, decoded], ["doc_id", "pieces", "decoded"])

    rows = documents.selectExpr(f"CAST(`{doc_id}` AS bigint) AS doc_id", f"`{text}` AS text")
    return map_batches(rows, run, "doc_id long, pieces array<int>, decoded string")


def decode(encoded: DataFrame, model_path: str, pieces: str = "pieces") -> DataFrame:
    """(doc_id, text) of encoded documents."""
    short_batches(encoded.sparkSession)
    shared = _shared(encoded, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in batches:
            texts = pa.array([codec.decode(x or []) for x in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["doc_id", "text"])

    return map_batches(encoded.selectExpr("CAST(doc_id AS bigint) AS doc_id", f"`{pieces}` AS pieces"), run, "doc_id long, text string")
