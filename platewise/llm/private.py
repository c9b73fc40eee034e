"""Personal data: patterns with exact checks, and a character tagger that adds what the patterns miss.

Base spans follow fixed patterns (``base_spans``), leftmost and non-overlapping per kind, in time linear in the text. The tagger is a bidirectional LSTM over
character classes with CRF transitions over begin and inside tags of every kind, written and trained in numpy.

1. Labelled spans. A bounded part of the documents (at most ``WINDOWS`` windows of ``TRAINED`` characters, chosen by hash) with their base spans, and written
   forms that no pattern covers (``written``: addresses spelled with "at" and "dot", defanged or spaced IP addresses, numbers without a plus, cards with
   other separators) put into these windows and into filler text, beside numbers that are nothing (dates, versions, amounts, keys).
2. Training: maximum likelihood of the tag sequences, by the forward-backward sums of the CRF and back-propagation through time, Adam steps, a fixed seed.
3. Tagging. A text is cut into windows of ``WINDOW`` characters that overlap by ``OVERLAP``; all are run through the network, many at once, and decoded by
   Viterbi. Windows in which no path can beat "outside everywhere" (a bound on emissions and transitions shows it) need no decoding.
4. Reconciliation over the whole text: a character takes its tag from the window in which it lies further from the edge; runs of a kind are spans, also where they cross
   windows. A span that touches a base span yields to it. The rest are trimmed to their first and last letter or digit and must pass the exact check of
   their kind (``accepted``).

Nulls: a null text is an empty one and has no spans. Empty texts have none; very long texts are worked on in sections of ``SECTION`` characters with the overlap,
which gives the same windows. Repeated rows have equal spans. An empty table gives an empty result; a model trained without any document knows the written
forms only. Input columns are kept; the new column gets a free name.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import free_name, short_batches

KINDS = ("email", "ip", "card", "phone")
HIDDEN, TRAINED, WINDOWS, EPOCHS, BATCH = 10, 96, 2400, 16, 96
WINDOW, OVERLAP, SECTION, TOGETHER, TEXTS_AT_ONCE = 256, 32, 1 << 20, 1024, 1024
SPAN = "array<struct<kind:string,start:long,end:long,base:boolean>>"
Span = tuple[str, int, int]

_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_DIGITS = re.compile(r"[0-9]+")
_AT = re.compile(r"\s*(?:[\[({<]\s*(?:at|@)\s*[\])}>]|\sat\s|@)\s*", re.IGNORECASE)
_DOT = re.compile(r"\s*(?:[\[({<]\s*(?:dot|\.)\s*[\])}>]|\sdot\s|\.)\s*", re.IGNORECASE)
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP_MARKS = re.compile(r"[0-9]{1,3}(?:[ ]?[\[(]?\.[\])]?[ ]?[0-9]{1,3}){3}")
_CARD_MARKS = re.compile(r"[0-9]+(?:[ ._/-]{1,2}[0-9]+)*")
_PHONE_MARKS = re.compile(r"[+(0-9][0-9 ()./-]*[0-9]")


def digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def luhn(number: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(number)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def is_card(number: str) -> bool:
    return 13 <= len(number) <= 19 and luhn(number)


def is_ip(parts: list[str]) -> bool:
    return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Every ``@`` with the run of address characters before it, back to the last match at most, and the domain after it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-"):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        # What lies before this @ cannot begin a match at a later one.
        at = text.find("@", max(at + 1, end))


def base_spans(text: str | None) -> list[Span]:
    """Spans by pattern, ordered by kind and start, in code points."""
    if not text:
        return []
    found = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if _DIGITS.search(text):
        found += [("ip", *m.span()) for m in _IP.finditer(text) if is_ip(m[0].split("."))]
        found += [("card", *m.span()) for m in _CARD.finditer(text) if m.end() - m.start() >= 13 and is_card(digits(m[0]))]
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return found


def accepted(kind: str, text: str) -> bool:
    """Whether a tagged text has the parts that its kind must have."""
    if len(text) > 200:
        return False
    if kind == "email":
        return bool(_ADDRESS.fullmatch(_DOT.sub(".", _AT.sub("@", text))))
    if kind == "ip":
        return bool(_IP_MARKS.fullmatch(text)) and is_ip(_DIGITS.findall(text))
    if kind == "card":
        return bool(_CARD_MARKS.fullmatch(text)) and is_card(digits(text))
    # A bare run of digits may be any number.
    return bool(_PHONE_MARKS.fullmatch(text)) and not text.isdigit() and 9 <= len(digits(text)) <= 15


# Character classes: 0 pads, 1 digits, 2 capitals, 3 letters beyond ASCII, 4 all other characters, then a-z and ASCII marks one by one.
_MARKS = "abcdefghijklmnopqrstuvwxyz \n\t@.,:;!?-_+%()[]{}<>/\\\"'=#*&|$"
CLASSES = 5 + len(_MARKS)
_CLASS = np.full(128, 4, np.uint8)
_CLASS[48:58], _CLASS[65:91] = 1, 2
_CLASS[[ord(c) for c in _MARKS]] = np.arange(5, CLASSES)


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(points < 128, _CLASS[np.minimum(points, 127)], 3).astype(np.uint8)


def tags(spans: Iterable[Span], n: int) -> np.ndarray:
    """Tags of ``n`` characters: 0 outside, 2k + 1 the first character of a span of kind k, 2k + 2 the others."""
    out = np.zeros(n, np.int64)
    for kind, a, b in spans:
        k = KINDS.index(kind)
        out[max(a, 0):b] = 2 * k + 2
        if 0 <= a < n:
            out[a] = 2 * k + 1
    return out


N_TAGS = 2 * len(KINDS) + 1
#: Transitions that make no sense: into the inside of a kind from anything but this kind.
FORBIDDEN = np.array([[b > 0 and b % 2 == 0 and a not in (b, b - 1) for b in range(N_TAGS)] for a in range(N_TAGS)])


def bend(x: np.ndarray, work: np.ndarray) -> None:
    """``x / (1 + abs(x))`` in place: this bounded function stands for tanh, and half of it plus a half for the logistic function, at a tenth of their time."""
    np.abs(x, out=work)
    work += 1
    x /= work


@dataclass
class Tagger:
    """Weights: per direction input (4h, classes) and recurrent (4h, h), gates in the order input, forget, output, cell; emissions (tags, 2h); CRF scores."""

    inputs: list[np.ndarray]
    recurrent: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray
    moves: np.ndarray
    first: np.ndarray

    @staticmethod
    def fresh(hidden: int, seed: int) -> Tagger:
        draw = np.random.default_rng(seed)
        inputs = []
        for _ in range(2):
            x = draw.normal(0, 0.3, (4 * hidden, CLASSES))
            x[hidden:2 * hidden] += 1  # remember at first
            inputs.append(x)
        recurrent = [draw.normal(0, 1 / np.sqrt(hidden), (4 * hidden, hidden)) * 0.5 for _ in range(2)]
        bias = np.zeros((N_TAGS, 1))
        bias[0] = 2
        weights = [*inputs, *recurrent, draw.normal(0, 0.3, (N_TAGS, 2 * hidden)), bias, np.where(FORBIDDEN, -6.0, 0.0), np.zeros(N_TAGS)]
        weights = [np.ascontiguousarray(w, np.float32) for w in weights]
        return Tagger(weights[:2], weights[2:4], *weights[4:])

    def weights(self) -> list[np.ndarray]:
        return [*self.inputs, *self.recurrent, self.out, self.bias, self.moves, self.first]

    def emissions(self, codes: np.ndarray) -> np.ndarray:
        """Scores (length, tags, windows) of codes (length, windows)."""
        n, width = codes.shape
        h4, h = self.recurrent[0].shape
        places = codes.astype(np.intp)
        scores = np.empty((n, N_TAGS, width), np.float32)
        z, x = np.empty((h4, width), np.float32), np.empty((h4, width), np.float32)
        work, part = np.empty((h, width), np.float32), np.empty((N_TAGS, width), np.float32)
        for d in range(2):
            out = np.ascontiguousarray(self.out[:, d * h:(d + 1) * h])
            now, cell = np.zeros((h, width), np.float32), np.zeros((h, width), np.float32)
            for t in range(n) if d == 0 else range(n - 1, -1, -1):
                np.matmul(self.recurrent[d], now, out=z)
                np.take(self.inputs[d], places[t], axis=1, out=x, mode="clip")
                z += x
                bend(z, x)
                gates = z[:3 * h]
                gates *= 0.5
                gates += 0.5
                cell *= z[h:2 * h]
                np.multiply(z[:h], z[3 * h:], out=work)
                cell += work
                np.copyto(now, cell)
                bend(now, work)
                now *= z[2 * h:3 * h]
                if d == 0:
                    np.matmul(out, now, out=scores[t])
                    scores[t] += self.bias
                else:
                    np.matmul(out, now, out=part)
                    scores[t] += part
        return scores

    def decode(self, codes: np.ndarray) -> dict[int, np.ndarray]:
        """Best tags of the windows (columns of ``codes``) in which anything is tagged."""
        scores = self.emissions(codes)
        moves = np.where(FORBIDDEN, np.float32(-1e4), self.moves)
        # What a span gains over "outside" in its place: coming in, its characters, staying inside, going out. The running best of spans that end at each
        # character, per kind, bounds it; where none can gain anything, "outside" everywhere is a best path.
        begin, inner, plain = slice(1, None, 2), slice(2, None, 2), moves[0, 0]
        come = (moves[:, begin].max(0) - plain)[:, None]
        stay = (np.maximum(moves.diagonal()[inner], moves.diagonal(1)[begin]) - plain)[:, None]
        go = max(float((moves[1:, 0] - plain).max()), 0.0)
        first = (self.first[1:] - self.first[0])[:, None]
        run = np.maximum(scores[0, begin] + first[0::2], scores[0, inner] + first[1::2]) - scores[0, 0]
        best = run.copy()
        for t in range(1, len(scores)):
            run += stay
            run += scores[t, inner]
            np.maximum(run, scores[t, begin] + come, out=run)
            run -= scores[t, 0]
            np.maximum(best, run, out=best)
        some = np.nonzero(best.max(0) + go > -1e-3)[0]
        if not len(some):
            return {}
        scores = scores[:, :, some]
        n = len(scores)
        back = np.empty((n, *scores.shape[1:]), np.uint8)
        best = scores[0] + self.first[:, None]
        for t in range(1, n):
            paths = best[:, None, :] + moves[:, :, None]
            back[t] = paths.argmax(0)
            best = paths.max(0) + scores[t]
        path = np.empty((n, len(some)), np.uint8)
        path[-1] = best.argmax(0)
        every = np.arange(len(some))
        for t in range(n - 1, 0, -1):
            path[t - 1] = back[t, path[t], every]
        return {int(w): path[:, k] for k, w in enumerate(some) if path[:, k].any()}

    def gradients(self, codes: np.ndarray, gold: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean negative log likelihood of the gold tags (length, windows) and its gradients, in the order of ``weights``."""
        n, width = codes.shape
        h = self.recurrent[0].shape[1]
        eye, tag_eye = np.eye(CLASSES, dtype=np.float32), np.eye(N_TAGS, dtype=np.float32)
        kept = []
        for d in range(2):
            steps = range(n) if d == 0 else range(n - 1, -1, -1)
            now, cell, rows = np.zeros((h, width), np.float32), np.zeros((h, width), np.float32), [None] * n
            for t in steps:
                z = self.recurrent[d] @ now + self.inputs[d][:, codes[t]]
                z /= 1 + np.abs(z)
                gate, new = 0.5 * z[:3 * h] + 0.5, z[3 * h:]
                after = gate[h:2 * h] * cell + gate[:h] * new
                bent = after / (1 + np.abs(after))
                rows[t] = (now, cell, gate, new, bent)
                cell, now = after, gate[2 * h:] * bent
            kept.append(rows)
        states = [np.stack([r[2][2 * h:] * r[4] for r in rows]) for rows in kept]
        scores = np.matmul(self.out[:, :h], states[0]) + np.matmul(self.out[:, h:], states[1]) + self.bias

        def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
            top = x.max(axis, keepdims=True)
            return (np.log(np.exp(x - top).sum(axis, keepdims=True)) + top).squeeze(axis)

        moves = self.moves[:, :, None]
        ahead, behind = np.empty_like(scores), np.zeros_like(scores)
        ahead[0] = scores[0] + self.first[:, None]
        for t in range(1, n):
            ahead[t] = log_sum(ahead[t - 1][:, None] + moves, 0) + scores[t]
        for t in range(n - 2, -1, -1):
            behind[t] = log_sum(moves + (scores[t + 1] + behind[t + 1])[None], 1)
        whole = log_sum(ahead[-1], 0)
        share = np.exp(ahead + behind - whole)
        right = tag_eye[gold].transpose(0, 2, 1)
        d_scores = (share - right) / width
        d_moves = np.zeros_like(self.moves)
        gold_score = (scores * right).sum((0, 1)) + self.first[gold[0]]
        for t in range(1, n):
            both = np.exp(ahead[t - 1][:, None] + moves + (scores[t] + behind[t])[None] - whole)
            d_moves += both.sum(2)
            np.subtract.at(d_moves, (gold[t - 1], gold[t]), 1)
            gold_score = gold_score + self.moves[gold[t - 1], gold[t]]
        loss = float((whole - gold_score).mean())
        d_out = np.concatenate([np.einsum("tkb,thb->kh", d_scores, s, optimize=True) for s in states], 1)
        grads: list = [None, None, None, None, d_out, d_scores.sum((0, 2))[:, None], d_moves / width, d_scores[0].sum(1)]
        for d in range(2):
            d_states = np.matmul(self.out[:, d * h:(d + 1) * h].T, d_scores)
            d_input, d_recurrent = np.zeros_like(self.inputs[d]), np.zeros_like(self.recurrent[d])
            d_now, d_cell = np.zeros((h, width), np.float32), np.zeros((h, width), np.float32)
            for t in range(n - 1, -1, -1) if d == 0 else range(n):
                now, cell, gate, new, bent = kept[d][t]
                d_now = d_now + d_states[t]
                d_cell = d_cell + d_now * gate[2 * h:] * (1 - np.abs(bent)) ** 2
                d_gate = np.concatenate([d_cell * new, d_cell * cell, d_now * bent]) * 0.5 * (1 - np.abs(2 * gate - 1)) ** 2
                d_z = np.concatenate([d_gate, d_cell * gate[:h] * (1 - np.abs(new)) ** 2])
                d_input += d_z @ eye[codes[t]]
                d_recurrent += d_z @ now.T
                d_now, d_cell = self.recurrent[d].T @ d_z, d_cell * gate[h:2 * h]
            grads[d], grads[2 + d] = d_input, d_recurrent
        return loss, grads


def fit(examples: list[tuple[str, list[Span]]], hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = 5, rate: float = 0.02) -> Tagger:
    """Train on texts of at most ``TRAINED`` characters with their spans, in the order given, shuffled by the seed."""
    model = Tagger.fresh(hidden, seed)
    codes, gold = np.zeros((len(examples), TRAINED), np.uint8), np.zeros((len(examples), TRAINED), np.int64)
    for k, (text, spans) in enumerate(examples):
        own = classes(text[:TRAINED])
        codes[k, :len(own)], gold[k] = own, tags(spans, TRAINED)
    weights = model.weights()
    means, squares, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    draw = np.random.default_rng(seed)
    for epoch in range(epochs):
        order = draw.permutation(len(examples))
        for a in range(0, len(order), BATCH):
            rows = order[a:a + BATCH]
            _, grads = model.gradients(codes[rows].T, gold[rows].T)
            size = np.sqrt(sum(float((g * g).sum()) for g in grads))
            step += 1
            pace = rate * (1 - 0.9 * epoch / epochs)
            for w, g, m, s in zip(weights, grads, means, squares):
                g = g * min(1.0, 3.0 / max(size, 1e-9))
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                w -= pace * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
    return model


def _number(draw: random.Random, pattern: str) -> str:
    return "".join(str(draw.randrange(10)) if c == "d" else c for c in pattern)


def _card_number(draw: random.Random) -> str:
    start = _number(draw, "4dddddddddddddd")
    return next(start + c for c in "0123456789" if luhn(start + c))


def written(draw: random.Random) -> tuple[str | None, str]:
    """A piece of personal data in a form that no pattern covers, or one in a usual form, or something that is none (kind None)."""
    name = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randrange(3, 9)))
    host = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz0123456789-") for _ in range(draw.randrange(3, 9))).strip("-") or "h"
    tld = draw.choice(["com", "org", "net", "de", "example.com"])
    ip = [str(draw.randrange(256)) for _ in range(4)]
    card = _card_number(draw)
    four = [card[k:k + 4] for k in range(0, 16, 4)]
    kind = draw.choice(["email", "email", "ip", "card", "phone", "phone", None, None, None, None])
    if kind == "email":
        at = draw.choice([" [at] ", " (at) ", "[at]", " at ", " @ ", "(at)", "@"])
        return kind, name + draw.choice(["", f".{draw.choice('abc')}x", _number(draw, "dd")]) + at + host + draw.choice([" [dot] ", " (dot) ", " dot ", ".", ".", " . "]) + tld
    if kind == "ip":
        return kind, draw.choice([" . ", "[.]", "(.)", ".", "."]).join(ip)
    if kind == "card":
        return kind, draw.choice([".", "/", "  ", "_", " ", "-", ""]).join(four)
    if kind == "phone":
        return kind, _number(draw, draw.choice([
            "(ddd) ddd-dddd", "(ddd) ddddddd", "(0dd) dddd dddd", "0dd-dddd-dddd", "ddd-ddd-dddd", "ddd.ddd.dddd", "00dd ddd ddddddd", "+d (ddd) ddd-dddd", "+dd dd dddddddd"]))
    return None, _number(draw, draw.choice([
        "20dd-0d-0d", "1d.0d.20dd", "19dd", "version d.d", "d.d.d", "d,ddd.dd", "#dddddd", "dd:dd:dd", "dddddddddd", "dddddddddddd", "dd dd dd", "page ddd", "d.dd", "dddd-dddd", "ddd-ddd",
        f"AKIA{name.upper()}ddXdYdZ", f"token = \"{name}dd{host}dddd\"", f"password=dd{name}ddd", "ISBN d-ddd-ddddd-d", f"{name} at {host}", "at dot", "(ddd)", "v d.d.d-d", "dd%", "$d,ddd", "19dd-19dd"]))


def placed(text: str, spans: list[Span], draw: random.Random, items: int = 1) -> tuple[str, list[Span]]:
    """``text`` with written forms at blanks outside its spans, cut to ``TRAINED`` characters."""
    for _ in range(items):
        kind, item = written(draw)
        free = [k for k, c in enumerate(text) if c in " \n" and k < TRAINED - 20 and all(k < a or k >= b for _, a, b in spans)]
        if not free:
            return text, spans
        at = draw.choice(free) + 1
        end = draw.choice([" ", " ", ". ", ", ", "\n"])
        text = text[:at] + item + end + text[at:]
        grown = len(item) + len(end)
        spans = [(k, a + grown, b + grown) if a >= at else (k, a, b) for k, a, b in spans]
        if kind:
            spans = [*spans, (kind, at, at + len(item))]
    return text[:TRAINED], [(k, a, min(b, TRAINED)) for k, a, b in spans if a < TRAINED]


def filler(draw: random.Random) -> str:
    """Words without meaning, for windows that come from no document."""
    words = ["".join(draw.choice("aeioubcdfghklmnprstvw") for _ in range(draw.randrange(1, 10))) for _ in range(12)]
    return " " + draw.choice([" ", ". ", ", "]).join([" ".join(words[:6]), " ".join(words[6:])])


def examples(windows: list[tuple[str, list[Span]]], seed: int = 5) -> list[tuple[str, list[Span]]]:
    """Windows of documents as they are and with written forms in them, and filler text with written forms; always about as many, few documents or none."""
    draw = random.Random(seed)
    out = []
    for text, spans in windows:
        out.append((text[:TRAINED], [s for s in spans if s[1] < TRAINED]) if draw.random() < 0.6 else placed(text, spans, draw, draw.choice([1, 1, 2])))
    while len(out) < WINDOWS * 4 // 3:
        text, spans = draw.choice(windows) if windows and draw.random() < 0.5 else (filler(draw), [])
        out.append(placed(text, spans, draw, draw.choice([1, 2])))
    return out


def sampled_windows(docs: DataFrame, text: str = "text", windows: int = WINDOWS) -> list[tuple[str, list[Span]]]:
    """At most ``windows`` windows with their base spans, from a hashed part of the documents: round spans, round digits and anywhere, four of a document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for whole in batch.column(0).to_pylist():
                spans = base_spans(whole)
                draw = random.Random(len(whole))
                marks = [m.start() for m in _DIGITS.finditer(whole, 0, 200_000)]
                centres = [draw.choice(spans)[1] for _ in range(2)] if spans else []
                centres += [draw.choice(marks)] if marks else []
                for at in [*centres, draw.randrange(len(whole))][:4]:
                    start = max(0, at - draw.randrange(10, 70))
                    inside = [(k, max(a - start, 0), b - start) for k, a, b in spans if b > start and a < start + TRAINED]
                    # A window that begins inside a span would teach its rest as a whole one.
                    if not any(a < start < b for _, a, b in spans):
                        rows.append((whole[start:start + TRAINED], [f"{k}:{a}:{b}" for k, a, b in inside]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.list_(pa.string())))], names=["window", "spans"])

    short_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{text}`").alias("text"))
    every = max(1, rows.count() // windows)
    some = rows.filter(F.length("text") > 0).filter(F.pmod(F.xxhash64("text", F.lit(23)), F.lit(every)) == 0)
    found = some.mapInArrow(cut, "window string, spans array<string>").distinct().orderBy(F.xxhash64("window", F.lit(29)), "window", "spans").limit(windows)
    parsed = []
    for row in found.collect():  # at most ``windows`` rows of TRAINED characters
        parts = [s.split(":") for s in row["spans"]]
        parsed.append((row["window"], [(k, int(a), int(b)) for k, a, b in parts]))
    return parsed


def train(docs: DataFrame, text: str = "text", windows: int = WINDOWS, **options) -> Tagger:
    return fit(examples(sampled_windows(docs, text, windows)), **options)


def tagged_spans(model: Tagger, texts: list[str]) -> list[list[Span]]:
    """Spans that the tagger sees in each text, reconciled over its windows, before any check."""
    step = WINDOW - OVERLAP
    queue: dict[int, list[tuple[int, int, int, int, np.ndarray]]] = {}
    seen: list[dict[int, int]] = [{} for _ in texts]

    def run(padded: int) -> None:
        rows = queue.pop(padded, [])
        if not rows:
            return
        codes = np.zeros((padded, len(rows)), np.uint8)
        for k, (*_, own) in enumerate(rows):
            codes[:len(own), k] = own
        for k, path in model.decode(codes).items():
            number, at, a, b, _ = rows[k]
            for t in (np.nonzero(path[a:b])[0] + a).tolist():
                seen[number][at + t] = int(path[t])

    for number, text in enumerate(texts):
        # Whole windows; the last one lies back so far that it is whole too.
        starts = [*range(0, len(text) - WINDOW, step), max(len(text) - WINDOW, 0)] if text else []
        section, begin = np.zeros(0, np.uint8), 0
        for k, at in enumerate(starts):
            if at + WINDOW > begin + len(section) and begin + len(section) < len(text):
                begin, section = at, classes(text[at:at + max(SECTION, WINDOW)])
            own = section[at - begin:at - begin + WINDOW]
            # Of an overlap each window has the half that is further from its edge.
            a = (starts[k - 1] + WINDOW - at) // 2 if k else 0
            b = (at + WINDOW + starts[k + 1]) // 2 - at if k + 1 < len(starts) else len(own)
            padded = -(-len(own) // 64) * 64
            queue.setdefault(padded, []).append((number, at, a, b, own))
            if len(queue[padded]) >= TOGETHER:
                run(padded)
    for padded in sorted(queue):
        run(padded)
    return [list(_runs(own)) for own in seen]


def _runs(tagged: dict[int, int]) -> Iterator[Span]:
    """Spans of neighbouring characters with tags of one kind; a begin tag opens a new one."""
    start = last = kind = None
    for at in sorted(tagged):
        k = (tagged[at] - 1) // 2
        if start is not None and at == last + 1 and k == kind and tagged[at] % 2 == 0:
            last = at
            continue
        if start is not None:
            yield KINDS[kind], start, last + 1
        start, last, kind = at, at, k
    if start is not None:
        yield KINDS[kind], start, last + 1


def trimmed(text: str, a: int, b: int, left: str = "") -> tuple[int, int]:
    while a < b and not text[a].isalnum() and text[a] not in left:
        a += 1
    while b > a and not text[b - 1].isalnum():
        b -= 1
    return a, b


def all_spans(model: Tagger, texts: list[str | None]) -> list[list[tuple[str, int, int, bool]]]:
    """Base spans and those that the tagger adds, by kind as in ``KINDS``, then start."""
    texts = [t or "" for t in texts]
    out = []
    for text, tagged in zip(texts, tagged_spans(model, texts)):
        base = base_spans(text)
        taken = sorted((a, b) for _, a, b in base)
        found = [(k, a, b, True) for k, a, b in base]
        for kind, a, b in tagged:
            a, b = trimmed(text, a, b, "+(" if kind == "phone" else "")
            if a < b and not any(x < b and a < y for x, y in taken) and accepted(kind, text[a:b]):
                found.append((kind, a, b, False))
        out.append(sorted(found, key=lambda s: (KINDS.index(s[0]), s[1])))
    return out


def spans_of(model: Tagger, text: Column) -> Column:
    """Array of (kind, start, end, base): all spans of a text."""

    @F.pandas_udf(SPAN)
    def find(texts: pd.Series) -> pd.Series:
        found = all_spans(model, [t if isinstance(t, str) else None for t in texts])
        return pd.Series([[{"kind": k, "start": a, "end": b, "base": x} for k, a, b, x in spans] for spans in found])

    return find(text)


def find_private(docs: DataFrame, model: Tagger, text: str = "text", name: str = "private") -> tuple[DataFrame, str]:
    """``docs`` with a column of all spans; its name is returned too."""
    short_batches(docs.sparkSession, TEXTS_AT_ONCE)
    name = free_name(docs.columns, name)
    return docs.withColumn(name, spans_of(model, F.coalesce(F.col(f"`{text}`"), F.lit("")))), name


def of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans the first counts."""

    @F.pandas_udf("string")
    def replace(texts: pd.Series, found: pd.Series) -> pd.Series:
        out = []
        for whole, own in zip(texts, found):
            parts, end = [], 0
            for s in sorted(own if own is not None else (), key=lambda s: (s["start"], -s["end"])):
                if s["start"] >= end:
                    parts += [whole[end:s["start"]], f"<{s['kind'].upper()}>"]
                    end = s["end"]
            out.append(None if whole is None else "".join([*parts, whole[end:]]))
        return pd.Series(out)

    return replace(text, spans)
