"""Operator 3: personal data by a semi-Markov conditional random field over fixed base rules.

The base rules find e-mail addresses, IPv4 addresses, payment cards (Luhn) and phone numbers; their spans always
stay.  The model adds spans that the rules miss.  A text is cut into atoms (runs of a-z, runs of digits, single other
characters) around digits and "@"; every run of at most ``MAX_ATOMS`` atoms that could be an entity is a candidate
segment, described by features of the whole span: its shape, digit count, Luhn sum, octets, "@" and dots, and the
characters on either side.  Viterbi over segments chooses boundaries and types together; all else is single atoms of
no type; it goes from left to right and keeps the last MAX_ATOMS states, with a back pointer for each atom, so a
long run of digits costs time and memory in proportion.  The weights are trained by the gradient of the conditional likelihood (forward-backward over segments) on
a bounded sample of zones, labelled by the base rules.  A model span is added if it overlaps no base span and its
score beats that of the same atoms untyped by ``MARGIN``.

Defined cases: null text is empty; texts without a digit or "@" have no spans; spans are counted in code points, end
exclusive, and spans of different kinds may overlap; null and repeated doc_ids are kept row by row; an empty table
gives an empty result; clashing names cannot arise, as only doc_id and text are read and ``redact`` keeps the columns.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentalytics.llm.common import bounded_bytes, bounded_sample, fitted, slices, small_batches, text_array

KINDS = ("email", "ip", "card", "phone")
#: The base rules.
HOST = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

ATOM = re.compile(r"[A-Za-z]+|[0-9]+|[^\sA-Za-z0-9]")
TRIGGER, WORD = re.compile(r"[0-9@]"), re.compile(r"\S+")
#: Atoms of a segment at most, and white-space words kept on either side of a trigger.
MAX_ATOMS, AROUND = 24, 2
#: Bounds of training: documents, zones and passes over them; hashed weights of each type.
TRAIN_DOCS, TRAIN_ZONES, PASSES, RATE, DECAY, WIDTH = 1500, 1500, 10, 0.5, 1e-4, 1 << 12
MARGIN = 2.0
#: Segment texts whose scores a task remembers.
KNOWN = 50_000


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, led by their "@": the local part begins where its run of allowed characters does."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        host = HOST.match(text, at + 1) if start < at else None
        if host:
            end = host.end()
            yield start, end
        at = text.find("@", at + 1 if not host else end)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    out = [(0, s, e) for s, e in emails(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return out


class Atoms:
    """Where the atoms of a zone begin and end, 16 bytes each."""

    def __init__(self, text: str, start: int, end: int):
        self.starts, self.ends = array("q"), array("q")
        for m in ATOM.finditer(text, start, end):
            self.starts.append(m.start())
            self.ends.append(m.end())

    def __len__(self) -> int:
        return len(self.starts)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Atoms) and (self.starts, self.ends) == (other.starts, other.ends)

    def __getitem__(self, i: int) -> tuple[int, int]:
        return self.starts[i], self.ends[i]


def zones(text: str) -> Iterator[Atoms]:
    """Atoms of the words that hold a trigger and ``AROUND`` words beside them, run by run."""
    before: deque[int] = deque(maxlen=AROUND)  # where the last words begin
    start = end = None
    since = 0  # words after the last with a trigger
    for m in WORD.finditer(text):
        if TRIGGER.search(text, m.start(), m.end()):
            if start is not None and since >= 2 * AROUND:
                yield Atoms(text, start, end)
                start = None
            if start is None:
                start = before[0] if before else m.start()
            end, since = m.end(), 0
        elif start is not None:
            since += 1
            if since <= AROUND:
                end = m.end()
        before.append(m.start())
    if start is not None:
        yield Atoms(text, start, end)


def side(c: str) -> str:
    return "9" if "0" <= c <= "9" else "a" if c.isalpha() else "_" if c.isspace() or not c else c if c.isascii() else "u"


def shape(span: str) -> str:
    return re.sub(r"\s+", " ", re.sub(r"[0-9]+", "9", re.sub(r"[A-Za-z]+", "a", span)))


def span_features(text: str, start: int, end: int) -> np.ndarray:
    """Hashed features of a whole segment."""
    span = text[start:end]
    digits = re.sub(r"[^0-9]", "", span)
    parts = span.split(".")
    form = shape(span)
    names = [
        "bias", f"shape {form}", f"digits {min(len(digits), 20)}", f"atoms {min(len(form), 12)}",
        f"luhn {13 <= len(digits) <= 19 and luhn(digits)}", f"only {not re.search(r'[^0-9 -]', span)}",
        f"octets {len(parts) == 4 and all(p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts)}",
        f"at {span.count('@')} {bool(re.fullmatch(r'[^@\s]+@[^@\s]+[.][^@\s]+', span))}", f"plus {span[0] == '+'} {'+' in span[1:]}",
        f"space {min(span.count(' '), 3)} {chr(10) in span}", f"ends {side(span[0])}{side(span[-1])}",
        f"around {side(text[start - 1:start])}{side(text[end:end + 1])}", f"last {form[-3:]}", f"first {form[:3]}"]
    return np.array([zlib.crc32(n.encode()) % WIDTH for n in names])


def candidates(text: str, atoms: Atoms) -> list[tuple[int, int, np.ndarray]]:
    """(first atom, past the last, features) of all segments that could be an entity."""
    return [(i, j, span_features(text, atoms[i][0], atoms[j - 1][1])) for i, ends in enumerate(openings(text, atoms)) for j in ends]


def openings(text: str, atoms: Atoms) -> Iterator[list[int]]:
    """For each atom, past which atoms a segment that begins with it could end: with a digit or "@", from a letter,
    digit, "+" or "(" to a letter or digit, in one line; at most MAX_ATOMS on."""
    for i, start in enumerate(atoms.starts):
        out: list[int] = []
        c = text[start]
        if not (c.isascii() and (c.isalnum() or c in "+(")):
            yield out
            continue
        hot = spaced = 0
        for j in range(i, min(i + MAX_ATOMS, len(atoms))):
            s, e = atoms[j]
            if j > i and (gap := text[atoms[j - 1][1]:s]):
                spaced += 1
                if "\n" in gap or spaced > 4 or not (text[atoms[j - 1][0]].isdigit() or text[atoms[j - 1][0]] in "+()-") or not (text[s].isdigit() or text[s] in "()-"):
                    break
            hot = hot or text[s] == "@" or "0" <= text[s] <= "9"
            if hot and text[e - 1].isascii() and text[e - 1].isalnum():
                out.append(j + 1)
        yield out


class Model:
    """Weights of each kind; an untyped atom scores 0."""

    def __init__(self) -> None:
        self.weights = np.zeros((len(KINDS), WIDTH))

    def scores(self, segments: list) -> np.ndarray:
        return np.stack([self.weights[:, f].sum(axis=1) for _, _, f in segments]) if segments else np.zeros((0, len(KINDS)))

    def decode(self, text: str, atoms: Atoms) -> list[tuple[int, int, int, float]]:
        """The best segmentation of the atoms: its typed segments (kind, first, past the last, score).

        Atoms are taken from left to right; a segment is scored when its first atom comes, and only the values of the
        next MAX_ATOMS places are open, so that memory grows by one back pointer an atom.  Segments of the same text
        are scored once.
        """
        n = len(atoms)
        value, kind = np.zeros(MAX_ATOMS + 1), [0] * (MAX_ATOMS + 1)  # place j is at j modulo the ring's length
        from_, score = np.full(MAX_ATOMS + 1, -1), np.zeros(MAX_ATOMS + 1)
        back, kinds, scores = np.full(n + 1, -1, dtype=np.int64), np.zeros(n + 1, dtype=np.int8), np.zeros(n + 1)
        ring, so_far = MAX_ATOMS + 1, 0.0
        value[:] = -np.inf
        known: dict[tuple, tuple[float, int]] = {}
        for i, ends in enumerate(openings(text, atoms)):
            at = i % ring  # all segments that end here have been scored
            if value[at] > so_far:
                so_far = value[at]
                back[i], kinds[i], scores[i] = from_[at], kind[at], score[at]
            value[at] = -np.inf
            for j in ends:
                start, end = atoms[i][0], atoms[j - 1][1]
                key = (text[start:end], text[start - 1:start], text[end:end + 1])
                if (found := known.get(key)) is None:
                    s = self.weights[:, span_features(text, start, end)].sum(axis=1)
                    if len(known) >= KNOWN:
                        known.clear()
                    found = known[key] = (float(s.max()), int(s.argmax()))
                k = j % ring
                if so_far + found[0] > value[k]:
                    value[k], kind[k], from_[k], score[k] = so_far + found[0], found[1], i, found[0]
        if n and value[n % ring] > so_far:
            back[n], kinds[n], scores[n] = from_[n % ring], kind[n % ring], score[n % ring]
        out, j = [], n
        while j > 0:
            if back[j] < 0:
                j -= 1
            else:
                out.append((int(kinds[j]), int(back[j]), j, float(scores[j])))
                j = int(back[j])
        return out[::-1]

    def learn(self, n: int, segments: list, gold: dict[tuple[int, int], int], rate: float) -> None:
        """One step along the gradient of the conditional log likelihood of the gold segments."""
        if not segments:
            return
        scores = self.scores(segments)
        whole = np.logaddexp.reduce(scores, axis=1)
        before, after = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
        before[0] = after[n] = 0.0
        starting: dict[int, list[int]] = {}
        ending: dict[int, list[int]] = {}
        for k, (i, j, _) in enumerate(segments):
            starting.setdefault(i, []).append(k)
            ending.setdefault(j, []).append(k)
        for j in range(1, n + 1):
            before[j] = np.logaddexp.reduce([before[j - 1], *(before[segments[k][0]] + whole[k] for k in ending.get(j, ()))])
        for i in range(n - 1, -1, -1):
            after[i] = np.logaddexp.reduce([after[i + 1], *(after[segments[k][1]] + whole[k] for k in starting.get(i, ()))])
        self.weights *= 1 - rate * DECAY
        for (i, j, features), score in zip(segments, scores):
            expected = np.exp(before[i] + score + after[j] - before[n])
            step = -expected
            if (i, j) in gold:
                step[gold[i, j]] += 1
            if np.abs(step).max() > 1e-3:
                np.add.at(self.weights, (slice(None), features), rate * step[:, None])


def drawn_zones(texts: list[str], most: int) -> list[tuple[int, list]]:
    """At most ``most`` zones of these texts, in order, each with its text's number: one of every text before a second
    one of any, drawn at random within the text."""
    random, every, rank = np.random.default_rng(11), [], []
    for i, text in enumerate(texts):
        found = list(zones(text))
        every += [(i, atoms) for atoms in found]
        rank += random.permutation(len(found)).tolist()
    least = np.lexsort((random.random(len(rank)), rank))[:most]
    return [every[k] for k in np.sort(least)]


def train(texts: list[str], zones_at_most: int = TRAIN_ZONES) -> Model:
    """Fit a model to the base rules' spans in at most ``zones_at_most`` zones, drawn over all of these texts."""
    samples, spans, last = [], [], -1
    for which, atoms in drawn_zones(texts, zones_at_most):
        text = texts[which]
        if which != last:
            spans, last = base_spans(text), which
        starts, ends = {s: i for i, s in enumerate(atoms.starts)}, {e: i + 1 for i, e in enumerate(atoms.ends)}
        segments = candidates(text, atoms)
        known = {(i, j) for i, j, _ in segments}
        gold: dict[tuple[int, int], int] = {}
        taken = -1
        for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
            if s in starts and e in ends and s >= taken and (starts[s], ends[e]) in known:
                gold[starts[s], ends[e]], taken = kind, e
        samples.append((len(atoms), segments, gold))
    model, order = Model(), np.random.default_rng(7)
    for turn in range(PASSES):
        for k in order.permutation(len(samples)):
            model.learn(*samples[k], RATE / (1 + turn))
    return model


def all_spans(text: str, model: Model) -> tuple[list, list]:
    """Base spans, and all spans with those the model adds; each (kind, start, end) by kind, then start."""
    base = base_spans(text)
    taken = sorted((s, e) for _, s, e in base)
    starts = [s for s, _ in taken]
    reach = list(accumulate((e for _, e in taken), max))  # how far the spans up to this one go
    added = []
    for atoms in zones(text):
        for kind, i, j, score in model.decode(text, atoms):
            s, e = atoms[i][0], atoms[j - 1][1]
            before = bisect_left(starts, e)  # of spans that begin before this one's end
            if score >= MARGIN and not (before and reach[before - 1] > s):
                added.append((kind, s, e))
    return base, sorted(base + added)


def fit(docs: DataFrame, rows: int = TRAIN_DOCS) -> Model:
    """Train on at most ``rows`` documents that hold a digit or "@"."""
    some = bounded_sample(docs.select("doc_id", "text").where(F.col("text").rlike("[0-9@]")), "doc_id", rows)
    return fitted(bounded_bytes(some, "doc_id"), "doc_id", lambda rows: train(rows.column("text").to_pylist() if rows else []))


def named(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_<kind> and base (the base rules' spans), spans (all; kind:start:end, comma-joined), n_added."""
    small_batches(docs.sparkSession)
    weights = model.weights.astype(np.float32)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model()
        own.weights = weights
        for batch in slices(batches, "text"):
            texts = text_array(batch.column("text"))
            hot = pc.match_substring_regex(texts, "[0-9@]").to_pylist()
            rows = [all_spans(t.as_py(), own) if h else ([], []) for t, h in zip(texts, hot)]
            counts = [[sum(k == x for k, _, _ in base) for base, _ in rows] for x in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array([named(b) for b, _ in rows], pa.string()),
                 pa.array([named(a) for _, a in rows], pa.string()), pa.array([len(a) - len(b) for b, a in rows], pa.int64())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans", "n_added"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        search, f"doc_id long, {', '.join(f'n_{k} long' for k in KINDS)}, base string, spans string, n_added long")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each span replaced by its kind in brackets; overlapping spans by that of the first."""
    out, end = [], 0
    for s, e, kind in sorted((s, -e, k) for k, s, e in spans):
        e = -e
        if s >= end:
            out += [text[end:s], f"[{KINDS[kind].upper()}]"]
        end = max(end, e)
    return "".join(out) + text[end:]


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """The same columns with every span of the text masked; a long column n_chars follows the text's new length."""
    small_batches(docs.sparkSession)
    weights, names = model.weights.astype(np.float32), docs.columns
    lengths = [f.name for f in docs.schema.fields if f.name == "n_chars" and f.dataType.simpleString() == "bigint"]

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model()
        own.weights = weights
        for batch in slices(batches, "text"):
            column = batch.column("text")
            hot = pc.fill_null(pc.match_substring_regex(column, "[0-9@]"), False).to_pylist()
            texts = [masked(t.as_py(), all_spans(t.as_py(), own)[1]) if h else t.as_py() for t, h in zip(column, hot)]
            new = pa.array(texts, column.type)
            columns = {n: new if n == "text" else batch.column(i) for i, n in enumerate(names)}
            if lengths:
                changed = pa.array(hot)
                columns["n_chars"] = pc.if_else(changed, pc.cast(pc.utf8_length(new), pa.int64()), columns["n_chars"])
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return docs.mapInArrow(mask, docs.schema)
