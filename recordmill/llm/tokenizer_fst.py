"""Token counts of a byte-level BPE vocabulary by compiled finite-state transducers.

Two deterministic transducers are compiled from the vocabulary file. The first runs over
classes of characters and annotates its transitions with the cuts that the pre-tokenizer
makes, among them cuts one character back. A batch of texts is one long sequence of chunks;
every chunk first yields its state map (from each entry state to the exit state), maps are
composed by a parallel prefix scan, and then each chunk is run from its one true entry state.

The second runs over the bytes between cuts. Its states are made when they are first met:
a state is the set of live hypotheses (place in the trie of tokens, last token, tokens
owed), advanced a byte at a time; a token may follow another only if the merges leave the
pair apart. Of the tokens that all hypotheses owe, each transition emits the count. States
are shared by all texts and dropped together when there are too many, so memory is bounded.

Nulls, ties, repeats: a null text is empty and has no tokens; ids may be null or repeat, rows
are counted one by one. Special strings of the vocabulary are one token each wherever they
stand, as the library takes them by default. An empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from recordmill.llm.common import broadcast_bytes, short_batches

CHUNK = 256  # characters of a chunk
MAX_STATES = 200_000
MAX_PLACES = 300_000
MAX_WORDS = 500_000  # pieces whose count is kept

# --- cuts ----------------------------------------------------------------------------------

# Classes of characters. The letters named are those that end a contraction.
STMD, R, V, L, E, LETTER, NUMBER, APOSTROPHE, OTHER, SPACE, WHITE, EDGE = range(12)
# States: what the piece so far is. ONE_/MANY_: a run of white space of one or more characters,
# by whether its last one is the plain space that the next word takes along. QUOTE: an
# apostrophe that opens its piece; QUOTE_R, QUOTE_V, QUOTE_L: with that letter; DONE: a
# contraction that is complete. START: nothing yet.
START, WORD, DIGITS, MARKS, ONE_SPACE, ONE_WHITE, MANY_SPACE, MANY_WHITE, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L, DONE = range(13)
STATES = 16  # a power of two above the number of states
CUT, CUT_BACK = 1, 2  # a cut before this character, before the one before it


def _open(kind: int) -> int:
    """The state after the first character of a piece."""
    if kind <= LETTER:
        return WORD
    return {NUMBER: DIGITS, APOSTROPHE: QUOTE, OTHER: MARKS, SPACE: ONE_SPACE, WHITE: ONE_WHITE, EDGE: START}[kind]


def _move(state: int, kind: int) -> tuple[int, int]:
    """(next state, cuts) on a character of class ``kind``."""
    letter, mark, white = kind <= LETTER, kind in (APOSTROPHE, OTHER), kind in (SPACE, WHITE)
    cut = (_open(kind), CUT)
    if kind == EDGE:
        return START, CUT | (CUT_BACK if state in (QUOTE_R, QUOTE_V, QUOTE_L) else 0)
    if state in (START, DONE, ONE_WHITE):
        return (MANY_SPACE if kind == SPACE else MANY_WHITE, 0) if state == ONE_WHITE and white else cut
    if state in (ONE_SPACE, MANY_SPACE, MANY_WHITE):
        if white:
            return (MANY_SPACE if kind == SPACE else MANY_WHITE), 0
        if state == MANY_WHITE:
            return _open(kind), CUT | CUT_BACK
        return (MARKS if mark else _open(kind)), (CUT_BACK if state == MANY_SPACE else 0)
    if state == WORD:
        return (WORD, 0) if letter else cut
    if state == DIGITS:
        return (DIGITS, 0) if kind == NUMBER else cut
    if state == MARKS:
        return (MARKS, 0) if mark else cut
    if state == QUOTE:
        follows = {STMD: DONE, R: QUOTE_R, V: QUOTE_V, L: QUOTE_L}
        return (follows[kind], 0) if kind in follows else (MARKS, 0) if mark else cut
    if (state in (QUOTE_R, QUOTE_V) and kind == E) or (state == QUOTE_L and kind == L):
        return DONE, 0
    return (WORD, CUT_BACK) if letter else (_open(kind), CUT | CUT_BACK)


@lru_cache(1)
def _cut_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class of each code point, next state and cuts by class * STATES + state)."""
    kinds = np.full(0x110000, OTHER, np.uint8)
    for point in range(0x110000):
        category = unicodedata.category(chr(point))
        if category[0] == "L":
            kinds[point] = LETTER
        elif category[0] == "N":
            kinds[point] = NUMBER
        elif category[0] == "Z" or point in (9, 10, 11, 12, 13, 0x85):
            kinds[point] = WHITE
    for text, kind in (("stmd", STMD), ("r", R), ("v", V), ("l", L), ("e", E), ("'", APOSTROPHE), (" ", SPACE)):
        for char in text:
            kinds[ord(char)] = kind
    after, cuts = np.zeros(12 * STATES, np.uint8), np.zeros(12 * STATES, np.uint8)
    for kind in range(12):
        for state in range(13):
            after[kind * STATES + state], cuts[kind * STATES + state] = _move(state, kind)
    return kinds, after, cuts


def _entry_states(maps: np.ndarray) -> np.ndarray:
    """The state in which each chunk begins: the maps before it composed by a prefix scan, applied to START."""
    composed, step = maps.copy(), 1
    while step < len(composed):
        # the later map is applied to what the earlier one gives
        composed[step:] = np.take_along_axis(composed[step:], composed[:-step], axis=1)
        step *= 2
    return np.concatenate([[START], composed[:-1, START]]).astype(np.uint8)


def cut_places(kinds: np.ndarray) -> np.ndarray:
    """Places before which the pre-tokenizer cuts a sequence of character classes."""
    _, after, cuts = _cut_tables()
    size = len(kinds)
    rows = -(-size // CHUNK)
    padded = np.full(rows * CHUNK, EDGE, np.int16)
    padded[:size] = kinds
    steps = np.ascontiguousarray(padded.reshape(rows, CHUNK).T) * STATES
    maps = np.tile(np.arange(STATES, dtype=np.uint8), (rows, 1))
    for step in steps:
        maps = after[step[:, None] + maps]
    state, out = _entry_states(maps), np.empty((CHUNK, rows), np.uint8)
    for place, step in enumerate(steps):
        at = step + state
        out[place] = cuts[at]
        state = after[at]
    out = out.T.reshape(-1)[:size]
    marks = (out & CUT).astype(bool)
    marks[:-1] |= (out[1:] & CUT_BACK).astype(bool)
    return np.flatnonzero(marks)


# --- tokens --------------------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """The printable letters by which byte-level vocabularies write bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class CountTransducer:
    """Emitted-token counts of byte strings, by a transducer whose states are made on demand."""

    def __init__(self, vocabulary: bytes):
        told = json.loads(vocabulary)
        letters = _byte_letters()
        to_bytes = lambda text: bytes(letters[c] for c in text)
        self.special = sorted((t["content"] for t in told["added_tokens"]), key=len, reverse=True)
        merges = [m.split(" ") if isinstance(m, str) else m for m in told["model"]["merges"]]
        self.ranks = {(to_bytes(a), to_bytes(b)): i for i, (a, b) in enumerate(merges)}
        self.child: dict[int, int] = {}
        self.token = [None]
        skip = set(self.special)
        for text in told["model"]["vocab"]:
            if text not in skip:
                self._add(to_bytes(text))
        self.apart: dict[tuple, bool] = {}
        self.words: dict[str, int] = {}
        self._forget()

    def _add(self, token: bytes) -> None:
        node = 0
        for byte in token:
            key = node << 8 | byte
            if key not in self.child:
                self.child[key] = len(self.token)
                self.token.append(None)
            node = self.child[key]
        self.token[node] = token

    def _forget(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.places: list[tuple] = []
        self.follows: dict[int, tuple[int, ...]] = {}
        self._clear()

    def _clear(self) -> None:
        self.states: dict[tuple, int] = {}
        self.live: list[tuple] = []
        self.owed: list[int] = []
        self.after: dict[int, int] = {}
        self._state((self._place(0, None) << 8,))

    def _place(self, node: int, last: bytes | None) -> int:
        """The number of a place: a node of the trie, reached after the token ``last``."""
        key = (node, last)
        if key not in self.numbers:
            self.numbers[key] = len(self.places)
            self.places.append(key)
        return self.numbers[key]

    def _state(self, live: tuple) -> int:
        """The number of a state: hypotheses as place << 8 | tokens owed, sorted."""
        number = self.states.get(live)
        if number is None:
            number = self.states[live] = len(self.live)
            self.live.append(live)
            self.owed.append(next((x & 255 for x in live if self.places[x >> 8][0] == 0), 0))
        return number

    def _merged(self, text: bytes) -> list[bytes]:
        """The tokens of a short byte string by its merges, lowest rank first."""
        parts = [bytes([b]) for b in text]
        while len(parts) > 1:
            rank, at = min((self.ranks.get((a, b), 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _stays(self, last: bytes | None, token: bytes) -> bool:
        """Whether the merges of both together leave ``last`` and ``token`` as two tokens."""
        key = (last, token)
        if key not in self.apart:
            if len(self.apart) > 1_000_000:
                self.apart.clear()
            self.apart[key] = self._merged((last or b"") + token) == ([token] if last is None else [last, token])
        return self.apart[key]

    def _follow(self, place: int, byte: int) -> tuple[int, ...]:
        """Where one hypothesis goes: (place << 8 | tokens more), once within a token, once past its end."""
        node, last = self.places[place]
        node, out = self.child.get(node << 8 | byte), ()
        if node is not None:
            out = (self._place(node, last) << 8,)
            token = self.token[node]
            if token is not None and self._stays(last, token):
                out += (self._place(0, token) << 8 | 1,)
        self.follows[place << 8 | byte] = out
        return out

    def _step(self, state: int, byte: int) -> int:
        """Make the transition: next state and emitted tokens in one number."""
        live, follows = [], self.follows
        for x in self.live[state]:
            out = follows.get(x & ~255 | byte)
            for y in self._follow(x >> 8, byte) if out is None else out:
                live.append(y + (x & 255))
        emitted = min([x & 255 for x in live])
        live = [x - emitted for x in live]
        live.sort()
        made = self._state(tuple(live)) << 8 | emitted
        self.after[state << 8 | byte] = made
        return made

    def count(self, piece: str) -> int:
        """Tokens of one piece between cuts."""
        state = tokens = 0
        after = self.after
        for byte in piece.encode("utf-8", "surrogatepass"):
            made = after.get(state << 8 | byte)
            if made is None:
                made = self._step(state, byte)
            tokens += made & 255
            state = made >> 8
        tokens += self.owed[state]
        if len(self.places) > MAX_PLACES:
            self._forget()
        elif len(self.live) > MAX_STATES:
            self._clear()
        return tokens

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each whole text."""
        parts, owner, special = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            pieces = [text]
            for mark in self.special:
                if mark in text:
                    pieces = [q for p in pieces for q in p.split(mark)]
            special[i] = len(pieces) - 1
            parts += pieces
            owner += [i] * len(pieces)
        joined = "\n".join(parts) + "\n"  # the character after each text is no part of it
        lengths = np.array([len(p) for p in parts], np.int64)
        edges = np.cumsum(lengths + 1) - 1
        kinds = _cut_tables()[0][np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
        kinds[edges] = EDGE
        places = cut_places(kinds)
        bounds = np.append(places, len(joined)).tolist()
        pieces = [joined[begin:end] for begin, end in zip(bounds, bounds[1:])]
        if len(self.words) > MAX_WORDS:
            self.words.clear()
        known = self.words
        for piece in set(pieces).difference(known):
            known[piece] = self.count(piece)
        found = [known[piece] for piece in pieces]
        found = np.array(found, np.int64)
        found[kinds[places] == EDGE] = 0
        part = np.searchsorted(edges, places)
        per_part = np.bincount(part, weights=found, minlength=len(parts)).astype(np.int64)
        np.add.at(special, np.array(owner, np.int64), per_part)
        return special


@lru_cache(2)
def _compiled(vocabulary: bytes) -> CountTransducer:
    return CountTransducer(vocabulary)


def count_tokens(documents: DataFrame, vocabulary_path: str, limit: int = 512, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document; one pass, no shuffle."""
    spark = documents.sparkSession
    short_batches(spark)
    vocabulary = broadcast_bytes(spark, vocabulary_path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = _compiled(vocabulary.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            if texts:
                tokens = transducer.counts(texts)
                n_bytes = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(tokens, pa.int64()), pa.array(tokens > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = documents.selectExpr(f"CAST(`{doc_id}` AS bigint) AS doc_id", f"`{text}` AS text")
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
