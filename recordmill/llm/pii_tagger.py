"""Personal data by rules and by a character-level bidirectional LSTM with CRF transitions.

Rules find the base spans: e-mail addresses, IP addresses, card numbers, phone numbers. The
model is trained in numpy on the base spans of a bounded sample of documents, as they stand
and rewritten as people write them to keep rules from seeing them (:func:`rewritten`), next to
harmless look-alikes. It reads every character of every text in overlapping windows; where
two windows overlap their emissions are blended, nearer to a window's middle counting more,
and the text is decoded as one chain with "outside" before its first and after its last
character. At places where no way that leaves "outside" before and returns after can gain, by
a bound from sums of the labels' leads, the best path is outside; Viterbi runs between such
places only and finds the path of the whole chain. A decoded span is added if its mean marginal (given those certain
places) reaches ``min_confidence``, it can be of its kind (:func:`possible`) and it touches no base span.

Nulls, ties, repeats: a null text is empty and holds nothing; ids may be null or repeat, rows
are taken one by one. Base spans of different kinds may overlap. With no labelled span in
the sample there is no model and only base spans are found. Equal paths go to the label
listed first. An empty table gives no rows; extra columns stay in :func:`mask` and are ignored
by :func:`find`.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.llm.common import map_batches, short_batches

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
STRIDE, OVERLAP = 336, 48  # a window owns STRIDE characters and shares OVERLAP with the next
WINDOW = STRIDE + OVERLAP
HIDDEN, WIDTH = 12, 8
SAMPLE_ROWS = 400
MAX_WINDOWS = 3000  # of the sample that are trained on
TRAINED, TRAINED_STRIDE = 96, 48  # their length and distance
MAX_EMAIL = 254  # characters, by the standard
REWRITINGS = 4  # of each sampled text that holds a span

# Base patterns, each written so that a long run of its letters is read once.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
HINT = re.compile(r"[0-9@]")

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[Span]:
    free, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in LOCAL:
            begin -= 1
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield "email", begin, domain.end()
            free = domain.end()
        else:
            free = at + 1  # no local part reaches over an at sign
        at = text.find("@", free)


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if place % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans by the rules, by kind as listed and then by start."""
    if not HINT.search(text):
        return []
    spans = list(_emails(text))
    for found in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in found[0].split(".")):
            spans.append(("ip", *found.span()))
    for found in CARD.finditer(text):
        if 16 <= (size := found.end() - found.start() - found[0].count(" ") - found[0].count("-")) <= 19 and size and _luhn(re.sub("[ -]", "", found[0])):
            spans.append(("card", *found.span()))
    for found in PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in found[0]) <= 15:
            spans.append(("phone", *found.span()))
    return spans


# --- model ---------------------------------------------------------------------------------


class Model(NamedTuple):
    embed: np.ndarray
    forward: tuple[np.ndarray, np.ndarray]  # weights of input and state; biases
    backward: tuple[np.ndarray, np.ndarray]
    out: np.ndarray
    bias: np.ndarray
    transitions: np.ndarray


CLASSES = "@.-+() ,:;_%/\n[]"  # characters with a class of their own, after the digits and letters
PAD = 3 + 26 + len(CLASSES)
_ASCII = np.zeros(128, np.uint8)
_ASCII[ord("0") : ord("9") + 1] = 1
_ASCII[ord("a") : ord("z") + 1] = _ASCII[ord("A") : ord("Z") + 1] = np.arange(3, 29)
_ASCII[[ord(c) for c in CLASSES]] = np.arange(29, PAD)


def char_classes(text: str) -> np.ndarray:
    """0 is any other character, then digit, other Latin letter, the letters of either case, then the single ones."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = _ASCII[np.minimum(points, 127)]
    out[points > 126] = 0
    out[(points >= ord("\xc0")) & (points <= ord("ʯ"))] = 2
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _lstm(x: np.ndarray, cell: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, list]:
    """States [time, row, hidden] of inputs [time, row, width], and what the gradient needs."""
    weights, bias = cell
    state = memory = np.zeros((x.shape[1], HIDDEN))
    out, kept = np.empty((*x.shape[:2], HIDDEN)), []
    for t in range(len(x)):
        joined = np.concatenate([x[t], state], axis=1)
        gates = joined @ weights + bias
        i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(gates[:, 3 * HIDDEN :])
        before, memory = memory, f * memory + i * g
        squashed = np.tanh(memory)
        state = o * squashed
        out[t] = state
        kept.append((joined, i, f, o, g, before, squashed))
    return out, kept


def _lstm_gradient(given: np.ndarray, kept: list, cell: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    weights, _ = cell
    d_weights, d_bias = np.zeros_like(weights), np.zeros(weights.shape[1])
    d_x = np.empty((*given.shape[:2], WIDTH))
    d_state, d_memory = np.zeros(given.shape[1:]), np.zeros(given.shape[1:])
    for t in range(len(given) - 1, -1, -1):
        joined, i, f, o, g, before, squashed = kept[t]
        d_state = d_state + given[t]
        d_memory = d_memory + d_state * o * (1 - squashed**2)
        d_gates = np.concatenate([d_memory * g * i * (1 - i), d_memory * before * f * (1 - f), d_state * squashed * o * (1 - o), d_memory * i * (1 - g**2)], axis=1)
        d_weights += joined.T @ d_gates
        d_bias += d_gates.sum(axis=0)
        d_joined = d_gates @ weights.T
        d_x[t], d_state = d_joined[:, :WIDTH], d_joined[:, WIDTH:]
        d_memory = d_memory * f
    return d_x, d_weights, d_bias


def emissions(model: Model, windows: np.ndarray) -> np.ndarray:
    """Label scores [row, time, label] of class windows [row, time]."""
    x = model.embed[windows.T]
    ahead, _ = _lstm(x, model.forward)
    behind, _ = _lstm(x[::-1], model.backward)
    return (np.concatenate([ahead, behind[::-1]], axis=2) @ model.out + model.bias).transpose(1, 0, 2)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Powers of e by row with the largest at one, and the logarithm of what was divided out."""
    top = x.max(axis=-1, keepdims=True)
    return np.exp(x - top), top


def crf(scores: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals [row, time, label] and expected transition counts of equally long chains."""
    size, ways = scores.shape[1], np.exp(transitions)
    ahead, behind = np.empty_like(scores), np.zeros_like(scores)
    ahead[:, 0] = scores[:, 0]
    for t in range(1, size):
        part, top = _scaled(ahead[:, t - 1])
        ahead[:, t] = np.log(part @ ways) + top + scores[:, t]
    for t in range(size - 2, -1, -1):
        part, top = _scaled(scores[:, t + 1] + behind[:, t + 1])
        behind[:, t] = np.log(part @ ways.T) + top
    whole = _logsum(ahead[:, -1], 1)[:, None, None]
    left, left_top = _scaled(ahead[:, :-1])
    right, right_top = _scaled(scores[:, 1:] + behind[:, 1:])
    right *= np.exp(left_top + right_top - whole)
    expected = ways * (left.reshape(-1, LABELS).T @ right.reshape(-1, LABELS))
    return np.exp(ahead + behind - whole), expected


def labelled(size: int, spans: list[Span]) -> np.ndarray:
    """A label for each character; of overlapping spans the first listed stands."""
    out = np.zeros(size, np.int64)
    for kind, begin, end in spans:
        if not out[begin:end].any():
            out[begin:end] = 2 + 2 * KINDS.index(kind)
            out[begin] -= 1
    return out


# Ways to write a span that the rules do not see, and harmless texts that look like them.
AT = (" at ", "(at)", " (at) ", "[at]", " @ ", "@")
DOT = (" dot ", "(dot)", " . ", "[dot]", ".")
PHONE_SIGNS = ("-", " ", ".", "/")
IP_SIGNS = (" . ", "[.]", " dot ", "(dot)", ". ")
CARD_SIGNS = (".", "/", "_", "  ", " - ", ", ")
TLDS = ("com", "org", "net", "de", "fr", "es", "io", "co.uk")
DECOYS = ("at noon", "look at the dot", "dot matrix", "2024-05-17", "at 10:45", "3.14", "v1.2.3", "12,500", "1999/2000", "no. 42", "a (b) c", "x . y", "at home . then", "(1)", "17.05.2024", "[7]")


def rewritten(kind: str, span: str, pick: int, words: list[str] = []) -> str:
    """A base span as its writer might have put it to keep rules off: signs, spacing and words changed.

    With ``words`` of the text around, half of the addresses are of other names, hosts and digits.
    """
    other = words and pick // 64 % 2
    if kind == "email":
        local, _, host = span.partition("@")
        at, dot = AT[pick % len(AT)], DOT[pick // 8 % len(DOT)]
        if other:
            names = [words[(pick >> shift) % len(words)] for shift in (3, 5, 7, 9)]
            local = (names[0], f"{names[0]}.{names[1]}", f"{names[0]}{pick % 100}", f"{names[0]}{dot}{names[1]}")[pick // 128 % 4]
            host = names[2] + f".{names[3]}" * (pick // 512 % 2) + "." + TLDS[pick // 1024 % len(TLDS)]
        return local + (at if at + dot != "@." else " at ") + host.replace(".", dot)
    if other and kind != "card":
        span = re.sub("[0-9]+", lambda found: str((int(found[0]) + pick // (1 + found.start())) % (256 if kind == "ip" else 10 ** len(found[0]))).zfill(1 if kind == "ip" else len(found[0])), span)
    if kind == "ip":
        return IP_SIGNS[pick % len(IP_SIGNS)].join(span.split("."))
    digits = "".join(re.findall("[0-9]", span))
    if kind == "card":
        return CARD_SIGNS[pick % len(CARD_SIGNS)].join(digits[k : k + 4] for k in range(0, len(digits), 4))
    groups = re.findall("[0-9]+", span)
    sign = PHONE_SIGNS[pick % len(PHONE_SIGNS)]
    if pick // 8 % 3 == 0 and len(groups) > 2:
        return f"({groups[0]}) " + sign.join(groups[1:])
    return ("00" if pick // 8 % 3 == 1 else "") + sign.join(groups)


def altered(text: str, spans: list[Span], turn: int) -> tuple[str, list[Span]]:
    """The text with its spans rewritten, some next to a decoy, and where they are now."""
    out, told, size, at = [], [], 0, 0
    for kind, begin, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if begin < at:
            continue
        pick = zlib.crc32(f"{turn}:{begin}:{text[begin:end]}".encode("utf-8", "surrogatepass"))
        words = re.findall("[a-z]{3,12}", text[max(0, begin - 200) : begin].lower())
        new = rewritten(kind, text[begin:end], pick >> 4, words)
        decoy = f" {DECOYS[(pick >> 12) % len(DECOYS)]} "
        before = text[at:begin] + (decoy if pick % 4 == 3 else "")
        after = decoy if pick % 4 == 1 else ""
        told.append((kind, size + len(before), size + len(before) + len(new)))
        out += [before, new, after]
        size, at = size + len(before) + len(new) + len(after), end
    return "".join([*out, text[at:]]), told


def _examples(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows of the texts, and those of their rewritings that hold a span, with their labels."""
    for text in sorted(texts):
        spans = base_spans(text)
        for turn in range(1 + (REWRITINGS if spans else 0)):
            now, told = altered(text, spans, turn) if turn else (text, spans)
            classes, gold = char_classes(now), labelled(len(now), told)
            for at in range(0, max(1, len(now) - TRAINED_STRIDE), TRAINED_STRIDE):
                if turn and not gold[at : at + TRAINED].any():
                    continue
                line, labels = np.full(TRAINED, PAD, np.uint8), np.zeros(TRAINED, np.uint8)
                line[: len(now) - at] = classes[at : at + TRAINED]
                labels[: len(now) - at] = gold[at : at + TRAINED]
                yield line, labels


def training_windows(texts: list[str], max_windows: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Windows of all texts with their labels: all if there are at most ``max_windows``, else so many by a hash.

    Windows that hold a kind, for each kind, and windows without any have a fifth of the
    places each; what some leave goes to the others by the same hash.
    """
    best: list[list] = [[] for _ in range(1 + len(KINDS))]  # per kind, heaps of at most max_windows
    for place, (line, told) in enumerate(_examples(texts)):
        rank = zlib.crc32(place.to_bytes(8, "big") + line.tobytes())
        one = (-rank, -place, line, told)
        for kind in {int(k + 1) // 2 for k in np.unique(told)} - {0} or {0}:
            (heapq.heappush if len(best[kind]) < max_windows else heapq.heappushpop)(best[kind], one)
    ranked = [sorted(heap, key=lambda w: (-w[0], -w[1])) for heap in best]
    share = max(1, max_windows // len(ranked))
    chosen = {w[1]: w for line in ranked for w in line[:share]}
    for w in sorted((w for line in ranked for w in line[share:]), key=lambda w: (-w[0], -w[1])):
        if len(chosen) >= max_windows:
            break
        chosen.setdefault(w[1], w)
    return [(chosen[k][2].astype(np.int64), chosen[k][3].astype(np.int64)) for k in sorted(chosen, reverse=True)]  # as they stand in the texts


def fit(texts: list[str], epochs: int = 14, rate: float = 0.02, seed: int = 5, max_windows: int = MAX_WINDOWS) -> Model | None:
    """A model of the base spans of ``texts``, by Adam on the chains' likelihood over at most ``max_windows`` windows."""
    picked = training_windows(texts, max_windows)
    if not any(told.any() for _, told in picked):
        return None
    x_all, y_all, rng = np.array([line for line, _ in picked]), np.array([told for _, told in picked]), np.random.default_rng(seed)
    make = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    gates = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    values = [make(PAD + 1, WIDTH), make(WIDTH + HIDDEN, 4 * HIDDEN), gates.copy(), make(WIDTH + HIDDEN, 4 * HIDDEN), gates.copy(), make(2 * HIDDEN, LABELS), np.zeros(LABELS), np.zeros((LABELS, LABELS))]
    first, second, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    for epoch in range(epochs):
        order, pace = rng.permutation(len(x_all)), rate * (1 - epoch / epochs)
        for at in range(0, len(order), 48):
            rows = order[at : at + 48]
            for k, grad in enumerate(_gradients(values, x_all[rows], y_all[rows])):
                if not k:
                    step += 1
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad**2
                values[k] = values[k] - pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return _model(values)


def _model(v: list[np.ndarray]) -> Model:
    return Model(v[0], (v[1], v[2]), (v[3], v[4]), v[5], v[6], v[7])


def _gradients(values: list[np.ndarray], windows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean negative log likelihood, in the order of ``values``."""
    model, rows = _model(values), len(windows)
    x = model.embed[windows.T]
    ahead, kept = _lstm(x, model.forward)
    behind, kept_back = _lstm(x[::-1], model.backward)
    both = np.concatenate([ahead, behind[::-1]], axis=2)
    told, expected = crf((both @ model.out + model.bias).transpose(1, 0, 2), model.transitions)
    observed = np.zeros_like(expected)
    np.add.at(observed, (labels[:, :-1].ravel(), labels[:, 1:].ravel()), 1)
    wrong = ((told - np.eye(LABELS)[labels]) / rows).transpose(1, 0, 2)
    d_both = wrong @ model.out.T
    d_ahead, d_w1, d_b1 = _lstm_gradient(d_both[:, :, :HIDDEN], kept, model.forward)
    d_behind, d_w2, d_b2 = _lstm_gradient(d_both[::-1, :, HIDDEN:], kept_back, model.backward)
    d_embed = np.zeros_like(model.embed)
    np.add.at(d_embed, windows.T, d_ahead + d_behind[::-1])
    d_out = both.reshape(-1, 2 * HIDDEN).T @ wrong.reshape(-1, LABELS)
    return [d_embed, d_w1, d_b1, d_w2, d_b2, d_out, wrong.sum(axis=(0, 1)), (expected - observed) / rows]


# --- whole texts ---------------------------------------------------------------------------

WINDOWS_AT_ONCE = 512
PLACES_AT_ONCE = 1 << 18  # that are not clear, before their runs are decoded together
EDGE = 1000.0  # what the part of a text after a block can add to a way that reaches into the block
RAMP = ((np.arange(OVERLAP) + 0.5) / OVERLAP).astype(np.float32)[:, None, None]  # weight of a window in what it shares with the one before


def _ways_out(transitions: np.ndarray) -> tuple[float, float]:
    """(step, ends): a way that leaves "outside", has n other labels and returns gains at most ``ends + (n - 1) * step`` by its transitions.

    ``step`` is the largest mean of a cycle of other labels, the least that leaves no cycle a gain.
    """
    ways = transitions - transitions[0, 0]
    low, high = float(ways[1:, 1:].min()) - 1.0, float(ways[1:, 1:].max()) + 1.0
    for _ in range(40):
        middle = (low + high) / 2
        reach = inner = ways[1:, 1:] - middle
        for _ in range(LABELS):
            reach = np.maximum(reach, (reach[:, :, None] + inner[None]).max(axis=1))
        low, high = (middle, high) if reach.diagonal().max() > 0 else (low, middle)
    best = ways[0, 1:]
    for _ in range(LABELS):
        best = np.maximum(best, (best[:, None] + ways[1:, 1:] - high).max(axis=0))
    return high, float((best + ways[1:, 0]).max()) + 1e-3


class Reader:
    """The model as single floats: both directions step together, the sigmoids are tanh of half the sum."""

    def __init__(self, model: Model):
        half = np.concatenate([np.full(3 * HIDDEN, 0.5), np.ones(HIDDEN)])
        cells = (model.forward, model.backward)
        # of each direction, the columns for the character, for a one that carries the biases, and for the state
        # the state is held doubled, so what is taken from it is halved
        self.weights = np.stack([np.concatenate([w[:WIDTH], b[None], w[WIDTH:] / 2]).T * half[:, None] for w, b in cells]).astype(np.float32)
        self.embed = np.ascontiguousarray(model.embed.T, np.float32)
        self.out, self.bias = (model.out / 2).reshape(2, HIDDEN, LABELS).transpose(0, 2, 1).astype(np.float32), model.bias.astype(np.float32)[:, None]
        self.transitions = model.transitions.astype(np.float32)
        t = self.transitions
        self.step, self.ends = _ways_out(model.transitions)

    def emissions(self, windows: np.ndarray) -> np.ndarray:
        """Label scores [time, label, row] of class windows [row, time], as :func:`emissions` gives them otherwise turned.

        Rows come last, so the parts of the gates are whole stretches of memory.
        """
        rows, size = windows.shape
        places = np.ascontiguousarray(windows.T).astype(np.intp)
        memory, squashed = (np.zeros((2, HIDDEN, rows), np.float32) for _ in range(2))
        joined, gates = np.zeros((2, WIDTH + 1 + HIDDEN, rows), np.float32), np.empty((2, 4 * HIDDEN, rows), np.float32)
        joined[:, WIDTH] = 1
        state = joined[:, WIDTH + 1 :]
        told = np.empty((size, LABELS, rows), np.float32)
        told[:] = self.bias
        opened, entered = gates[:, : 3 * HIDDEN], gates[:, :HIDDEN]  # twice the sigmoids, once they are one more than the tanh
        for t in range(size):
            for way, at in enumerate((t, size - 1 - t)):
                self.embed.take(places[at], axis=1, out=joined[way, :WIDTH], mode="clip")
            np.matmul(self.weights, joined, out=gates)
            np.tanh(gates, out=gates)
            opened += 1
            memory *= gates[:, HIDDEN : 2 * HIDDEN]
            entered *= gates[:, 3 * HIDDEN :]
            memory += entered
            memory *= 0.5
            np.tanh(memory, out=squashed)
            np.multiply(gates[:, 2 * HIDDEN : 3 * HIDDEN], squashed, out=state)
            told[t] += self.out[0] @ state[0]
            told[size - 1 - t] += self.out[1] @ state[1]
        return told


def _going(sizes: np.ndarray) -> list[int]:
    """For each step, how many of the sizes, which fall, are longer than it."""
    return np.searchsorted(-sizes, -np.arange(int(sizes[0])), "left").tolist()


def _paths(scores: np.ndarray, begins: np.ndarray, sizes: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """The best label of every place of the runs, each with "outside" before and after; 0 elsewhere.

    Runs come longest first, so those that still go on at a step are the first ones.
    """
    path, best = np.zeros(len(scores), np.uint8), np.empty_like(scores)
    going = _going(sizes)
    best[begins] = now = scores[begins] + transitions[0]
    for t in range(1, len(going)):
        m = going[t]
        here = begins[:m] + t
        best[here] = now = (now[:m, :, None] + transitions).max(axis=1) + scores[here]
    ends, out = begins + sizes - 1, np.ascontiguousarray(transitions.T)
    label = (best[ends] + out[0]).argmax(axis=1)
    path[ends] = label
    for t in range(len(going) - 2, -1, -1):  # a run's last place is told; others follow from the label after them
        m = going[t + 1]
        here = begins[:m] + t
        path[here] = label[:m] = (best[here] + out[label[:m]]).argmax(axis=1)
    return path


def _sureness(scores: np.ndarray, begins: np.ndarray, sizes: np.ndarray, transitions: np.ndarray, path: np.ndarray) -> np.ndarray:
    """The marginal of the path's label at every place of the runs, which come longest first."""
    going = _going(sizes)
    ahead, behind, sure = np.zeros(scores.shape), np.zeros(scores.shape), np.zeros(len(scores))
    ways = np.exp(transitions)
    ahead[begins] = scores[begins] + transitions[0]
    behind[begins + sizes - 1] = transitions[:, 0]
    for t in range(1, len(going)):  # tops are dropped, so a long run stays in range
        here = begins[: going[t]] + t
        ahead[here] = np.log(_scaled(ahead[here - 1])[0] @ ways) + scores[here]
    for t in range(len(going) - 2, -1, -1):
        here = begins[: going[t + 1]] + t
        behind[here] = np.log(_scaled(scores[here + 1] + behind[here + 1])[0] @ ways.T)
    for begin, size in zip(begins, sizes):
        both = ahead[begin : begin + size] + behind[begin : begin + size]
        own = both[np.arange(size), path[begin : begin + size]]
        sure[begin : begin + size] = np.exp(own - _logsum(both, 1))
    return sure


def _decoded(reader: Reader, scores: np.ndarray, begins: np.ndarray, sizes: np.ndarray, fits: Callable[[str, int, int], bool]) -> Iterator[tuple[str, int, int, float]]:
    """(kind, begin, end, mean marginal) of the fitting spans on the best paths of runs that fill ``scores``."""
    order = np.argsort(-sizes, kind="stable")
    path = _paths(scores, begins[order], sizes[order], reader.transitions)
    spans = []
    for begin in np.flatnonzero(path % 2 == 1):
        run = int(np.searchsorted(begins, begin, "right")) - 1
        end, last = begin + 1, begins[run] + sizes[run]
        while end < last and path[end] == path[begin] + 1:
            end += 1
        kind = KINDS[path[begin] // 2]
        if fits(kind, int(begin), int(end)):
            spans.append((kind, int(begin), int(end), run))
    if spans:
        held = np.array(sorted({run for *_, run in spans}, key=lambda run: -sizes[run]))
        sure = _sureness(scores, begins[held], sizes[held], reader.transitions.astype(np.float64), path)
        yield from ((kind, begin, end, float(sure[begin:end].mean())) for kind, begin, end, _ in spans)


def _best_before(gain: np.ndarray, first: float) -> np.ndarray:
    """The largest sum, at least 0, of an unbroken line of gains that ends before each place."""
    sums = np.concatenate([[first], first + np.cumsum(gain)])
    return (sums - np.minimum(np.minimum.accumulate(sums), 0.0))[:-1]


def possible(kind: str, written: str) -> bool:
    """Whether a span that the model adds can be of its kind: its digits by the rules' own bounds, an address by its signs and length."""
    groups = re.findall("[0-9]+", written)
    digits = "".join(groups)
    if kind == "ip":
        return len(groups) == 4 and all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or "0") <= 255 for g in groups)
    if kind == "card":
        return 16 <= len(digits) <= 19 and _luhn(digits)
    if kind == "phone":
        return 8 <= len(digits) <= 15
    return len(written) <= MAX_EMAIL and all(re.search(sign, written, re.IGNORECASE) for sign in (r"@|\bat\b", r"\.|\bdot\b"))


def model_spans(reader: Reader, texts: list[str], min_confidence: float) -> list[list[Span]]:
    """Decoded spans of each text; memory is one block of windows, PLACES_AT_ONCE places that are not clear and a run of such.

    Runs are decoded step by step, all at once: the runs of many blocks take as many steps as their longest one.
    """
    out: list[list[Span]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    windows = -(-sizes // STRIDE)
    owner = np.repeat(np.arange(len(texts)), windows)
    at = (np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)) * STRIDE
    open_text, classes = -1, np.empty(0, np.uint8)
    waiting, held = [], 0  # scores, texts and places of what is not clear, and the lengths of its runs

    def read() -> None:
        nonlocal held
        if not waiting:
            return
        scores, whose, here, lengths = (np.concatenate(parts) for parts in zip(*waiting))
        waiting.clear()
        held = 0

        def fits(kind: str, b: int, e: int) -> bool:
            return possible(kind, texts[whose[b]][here[b] : here[b] + e - b])

        for kind, b, e, sure in _decoded(reader, scores, np.cumsum(lengths) - lengths, lengths, fits):
            if sure >= min_confidence:
                out[whose[b]].append((kind, int(here[b]), int(here[b]) + e - b))

    carried, tail = np.empty((0, LABELS), np.float32), np.zeros((OVERLAP, LABELS, 1), np.float32)
    for block in range(0, len(owner), WINDOWS_AT_ONCE):
        whose, begin = owner[block : block + WINDOWS_AT_ONCE], at[block : block + WINDOWS_AT_ONCE]
        more = block + len(whose) < len(owner) and at[block + len(whose)] > 0
        lines = np.full((len(whose), WINDOW), PAD, np.uint8)
        for row, (i, b) in enumerate(zip(whose.tolist(), begin.tolist())):
            if i != open_text:
                open_text, classes = i, char_classes(texts[i])
            piece = classes[b : b + WINDOW]
            lines[row, : len(piece)] = piece
        told = reader.emissions(lines)
        before = np.concatenate([tail, told[STRIDE:, :, :-1]], axis=2)
        tail = told[STRIDE:, :, -1:].copy()
        weight = np.where(begin > 0, RAMP, np.float32(1))
        told[:OVERLAP] = weight * told[:OVERLAP] + (1 - weight) * before
        # one line of places: those carried over, then what each window owns
        c = len(carried)
        lead = (told[:STRIDE, 1:].max(axis=1) - told[:STRIDE, 0]).T.ravel()
        gain = np.concatenate([carried[:, 1:].max(axis=1) - carried[:, 0], lead]) + np.float64(reader.step)
        inside = ((begin[:, None] + np.arange(STRIDE)) < sizes[whose][:, None]).ravel()
        gain[c:][~inside] = -EDGE
        reached = _best_before(gain, 0.0) + gain + _best_before(gain[::-1], EDGE if more else 0.0)[::-1]
        open_ = reached + reader.ends - reader.step >= 0
        open_[c:] &= inside
        first = np.zeros(len(gain) + 1, bool)  # places where a text begins
        first[c + np.flatnonzero(begin == 0) * STRIDE] = True
        first[-1] = True
        starts = np.flatnonzero(open_ & (first[:-1] | ~np.concatenate([[False], open_[:-1]])))
        ends = np.flatnonzero(open_ & (first[1:] | ~np.concatenate([open_[1:], [False]]))) + 1
        places = np.flatnonzero(open_)
        own = places[places >= c] - c
        scores = np.concatenate([carried[places[places < c]], told[own % STRIDE, :, own // STRIDE]])
        carried = carried[:0]
        if more and len(ends) and ends[-1] == len(gain):  # the run goes on in the next block
            going = int(ends[-1] - starts[-1])
            carried, scores, places = scores[-going:].copy(), scores[:-going], places[:-going]
            starts, ends = starts[:-1], ends[:-1]
        if not len(starts):
            continue
        rows = np.maximum(places - c, 0) // STRIDE
        here = begin[rows] + places - c - rows * STRIDE  # the places in their texts
        waiting.append((scores, whose[rows], here, ends - starts))
        held += len(here)
        if held >= PLACES_AT_ONCE:
            read()
    read()
    return out


def all_spans(reader: Reader | None, texts: list[str], min_confidence: float) -> tuple[list[list[Span]], list[list[Span]]]:
    """Base spans, and base and added spans, of each text."""
    base = [base_spans(text) for text in texts]
    if reader is None:
        return base, base
    out = []
    for spans, more in zip(base, model_spans(reader, texts, min_confidence)):
        begins, reach = [], [0]  # base spans by begin, and how far those up to each one reach
        for _, b, e in sorted(spans, key=lambda s: s[1]):
            begins.append(b)
            reach.append(max(reach[-1], e))
        added = [(k, b, e) for k, b, e in more if reach[bisect_right(begins, e - 1)] <= b]
        out.append(sorted([*spans, *added], key=lambda s: (KINDS.index(s[0]), s[1], s[2])))
    return base, out


def train(documents: DataFrame, sample_rows: int = SAMPLE_ROWS, max_windows: int = MAX_WINDOWS, doc_id: str = "doc_id", text: str = "text") -> Model | None:
    """A model of at most ``sample_rows`` documents with a digit or an at sign (others hold no base span), chosen by a hash of the id."""
    hinted = documents.select(F.col(doc_id).alias("i"), F.col(text).alias("t")).where(F.col("t").rlike("[0-9@]") & F.col(doc_id).isNotNull())
    # ids alone are sorted; only the chosen rows' texts come to the driver
    ids = [r["i"] for r in hinted.select("i").distinct().orderBy(F.xxhash64("i", F.lit(29)), "i").limit(sample_rows).collect()]
    rows = hinted.where(F.col("i").isin(ids)).groupBy("i").agg(F.min("t").alias("t")).collect()
    return fit([r["t"] for r in rows], max_windows=max_windows)


def _written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{begin}:{end}" for kind, begin, end in spans)


def find(documents: DataFrame, min_confidence: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans); the counts are of base spans."""
    short_batches(documents.sparkSession)
    model = train(documents, doc_id=doc_id, text=text)
    reader = documents.sparkSession.sparkContext.broadcast(model and Reader(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, spans = all_spans(reader.value, [t or "" for t in batch.column(1).to_pylist()], min_confidence)
            counts = [pa.array([sum(s[0] == kind for s in found) for found in base], pa.int64()) for kind in KINDS]
            digests = pa.array([hashlib.sha256(_written(found).encode()).hexdigest() for found in base], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, digests, pa.array([_written(s) for s in spans], pa.string())], names)

    names = ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"]
    rows = documents.selectExpr(f"CAST(`{doc_id}` AS bigint) AS doc_id", f"`{text}` AS text")
    return map_batches(rows, run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each stretch of spans replaced by its first kind in brackets."""
    out, at = [], 0
    for kind, begin, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if begin >= at:
            out += [text[at:begin], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask(documents: DataFrame, min_confidence: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with personal data masked in their text; all columns stay, null texts too."""
    short_batches(documents.sparkSession)
    model = train(documents, doc_id=doc_id, text=text)
    reader = documents.sparkSession.sparkContext.broadcast(model and Reader(model))
    place = documents.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            _, spans = all_spans(reader.value, [t or "" for t in texts], min_confidence)
            columns = list(batch.columns)
            columns[place] = pa.array([t and masked(t, s) for t, s in zip(texts, spans)], pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return map_batches(documents, run, documents.schema)
