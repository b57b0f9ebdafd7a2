"""Operator 9: a quality classifier by co-training.

Two views judge a document apart: its content (which of the telling words and symbol runs it has) and its page
metadata (source, language, length, and the make-up of its characters, lines and word repeats, in bins).  Each view has a logistic
model, trained on a bounded sample of labelled rows.  Over ``ROUNDS`` rounds each view labels the unlabelled rows of
a bounded pool that it is confident of, and the other view learns from them too.  Each view's scores are calibrated
on labelled rows held out; the views' log odds are then added, less the prior that both hold, and calibrated again.
This is done for two targets, low quality and toxic; a document is rejected if the probability of either is at least
``REJECT``, which lies above one half so that clean documents stay.

The models are small arrays that go to every task; all documents are scored, in Arrow batches, without a shuffle.

Defined cases: null text is empty; a null source or language is a value of its own; a doc_id labelled more than once
takes its worst label, and null doc_ids and labels are ignored; without labels of both kinds a target's score is 0
and rejects nothing; repeated rows get equal scores; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentalytics.llm.common import bounded_bytes, bounded_sample, fitted, slices, small_batches, split_words, text_array

#: Rows that one task trains on.
LABELLED_ROWS, POOL_ROWS = 6_000, 3_000
ROUNDS, CONFIDENT, HOLDOUT = 3, 0.97, 4
REJECT = 0.7
#: A word is told by the content view if its share of documents differs between the labels by so many deviations.
MIN_DOCS, MIN_DEVIATIONS, MAX_WORDS = 4, 4.0, 512
BINS = 12
TARGETS = ("low_quality", "toxic")
#: Cuts a run of letters off the symbols beside it.
EDGES = (r"(\pL)([^\pL\s])", r"([^\pL\s])(\pL)")
#: Character classes of the metadata view: letter case, digits, white space, line ends, others; bytes above 127 alone.
_CLASS = np.full(256, 5, np.uint8)
for _k, _chars in enumerate((range(65, 91), range(97, 123), range(48, 58), (32, 9, 13), (10,))):
    _CLASS[list(_chars)] = _k
_CLASS[128:] = 6


def content_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct lower-case letter and symbol runs, as by ``split_words``."""
    for pattern in EDGES:
        texts = pc.replace_substring_regex(texts, pattern, r"\1 \2")
    return split_words(pc.utf8_lower(texts))


def text_shape(texts: pa.Array, codes: np.ndarray, offsets_: np.ndarray) -> np.ndarray:
    """Numbers about a text's make-up: log length, share of each character class, line and word lengths; of its words
    (by ``content_words``), how many repeat the one before and how many are distinct."""
    n = np.diff(offsets_)
    doc = np.repeat(np.arange(len(n)), n)
    again = np.r_[False, (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])] if len(codes) else np.zeros(0, bool)
    again = np.bincount(doc, again, len(n)) / np.maximum(n, 1)
    width = int(codes.max(initial=0)) + 1
    distinct = np.bincount(np.unique(doc * width + codes) // width, minlength=len(n)) / np.maximum(n, 1)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    kinds, size = _CLASS[data], np.maximum(np.diff(offsets), 1)
    counts = np.stack([np.diff(np.r_[0, np.cumsum(kinds == k, dtype=np.int64)][offsets]) for k in range(7)], axis=1)
    lines, words = counts[:, 4] + 1, counts[:, 3] + counts[:, 4] + 1
    return np.column_stack([np.log1p(size), counts / size[:, None], np.log(size / lines), np.log(size / words), again, distinct])


@dataclass
class Meta:
    """The bins of the metadata view."""
    edges: list[np.ndarray]

    @classmethod
    def fit(cls, shape: np.ndarray) -> Meta:
        tails = np.array([0.01, 0.03, 0.05])
        at = np.r_[tails, np.linspace(0, 1, BINS + 1)[1:-1], 1 - tails]
        return cls([np.unique(np.quantile(c, at)) for c in shape.T])

    @property
    def width(self) -> int:
        return sum(len(e) + 1 for e in self.edges) + 128

    def features(self, shape: np.ndarray, source: list, lang: list) -> np.ndarray:
        """0/1 columns: a bin of each number, a hashed source and a hashed language."""
        out, at, row = np.zeros((len(shape), self.width), np.float32), 0, np.arange(len(shape))
        for edges, c in zip(self.edges, shape.T):
            out[row, at + np.searchsorted(edges, c, side="right")] = 1
            at += len(edges) + 1
        for half, values in enumerate((source, lang)):
            out[row, at + 64 * half + np.array([zlib.crc32(repr(v).encode()) % 64 for v in values], dtype=np.int64)] = 1
        return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 15) -> np.ndarray:
    """Weights and intercept (last), by Newton's method on the penalised likelihood."""
    x = np.column_stack([x, np.ones(len(x), x.dtype)]).astype(np.float64)
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], penalty)
    ridge[-1] = 1e-3
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(ridge), gradient)
        w -= step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-4:
            break
    return w


def log_odds(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1].astype(x.dtype) + w[-1]


@dataclass
class Target:
    """What scores one target: the words of the content view, both views' weights and calibrations."""
    words: dict[str, int]
    content: np.ndarray
    meta: np.ndarray
    calibration: np.ndarray  # slope and intercept of content, metadata, and both
    prior: float

    def score(self, content: np.ndarray, meta: np.ndarray) -> np.ndarray:
        c, m, both = self.calibration
        joint = (log_odds(content, self.content) * c[0] + c[1]) + (log_odds(meta, self.meta) * m[0] + m[1]) - self.prior
        return sigmoid(joint * both[0] + both[1])


def presence(words: list[str], codes: np.ndarray, offsets: np.ndarray, known: dict[str, int]) -> np.ndarray:
    """0/1: which of the known words each text has."""
    out = np.zeros((len(offsets) - 1, len(known)), np.float32)
    at = np.fromiter((known.get(w, -1) for w in words), np.int64, len(words))[codes]
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    out[doc[at >= 0], at[at >= 0]] = 1
    return out


def cut(texts: pa.Array) -> Iterator[pa.Array]:
    return (b.column(0) for b in slices([pa.RecordBatch.from_arrays([texts], names=["text"])], "text", 1 << 20))


def common_words(texts: pa.Array) -> tuple[tuple[list[str], np.ndarray, np.ndarray], np.ndarray]:
    """As ``content_words``, but each text's words once, and only words of ``MIN_DOCS`` texts; and the texts' shape.
    Made slice by slice, so that the sample's words never stand in memory as they are."""
    known: dict[str, int] = {}
    parts, sizes, shapes = [], [], []
    for some in cut(texts):
        words, codes, offsets = content_words(some)
        shapes.append(text_shape(some, codes, offsets))
        at = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        pairs = np.unique(doc * max(len(words), 1) + codes)
        parts.append(at[pairs % max(len(words), 1)].astype(np.int32))
        sizes.append(np.bincount(pairs // max(len(words), 1), minlength=len(offsets) - 1))
    codes, size = np.concatenate([*parts, np.empty(0, np.int32)]), np.concatenate([*sizes, np.empty(0, np.int64)]).astype(np.int64)
    often = np.bincount(codes, minlength=len(known)) >= MIN_DOCS
    new = np.cumsum(often) - 1
    stay = often[codes]
    offsets = np.r_[0, np.cumsum(stay)][np.r_[0, np.cumsum(size)]]
    return ([w for w, o in zip(known, often) if o], new[codes[stay]], offsets), np.concatenate(shapes)


def telling_words(words: list[str], codes: np.ndarray, offsets: np.ndarray, rows: np.ndarray, y: np.ndarray) -> dict[str, int]:
    """The words whose document shares differ most between the labels; each text has a word at most once."""
    label = np.full(len(offsets) - 1, -1)
    label[rows] = y
    of = np.repeat(label, np.diff(offsets))
    with_1, with_0 = (np.bincount(codes[of == v], minlength=len(words)) for v in (1, 0))
    n1, n0 = max((y == 1).sum(), 1), max((y == 0).sum(), 1)
    share = (with_1 + with_0 + 1) / (n1 + n0 + 2)
    deviations = np.abs(with_1 / n1 - with_0 / n0) / np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0))
    order = np.argsort(-deviations, kind="stable")[:MAX_WORDS]
    chosen = [i for i in order if deviations[i] >= MIN_DEVIATIONS and with_1[i] + with_0[i] >= MIN_DOCS]
    return {words[i]: k for k, i in enumerate(chosen)}


def calibrate(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slope and intercept of the log odds (Platt); no negative slope."""
    w = fit_logistic(z[:, None], y, penalty=0.1)
    return w if w[0] > 0 else np.array([0.0, np.log((y.sum() + 1) / ((1 - y).sum() + 1))])


def co_train(found: tuple, meta: np.ndarray, y: np.ndarray, held: np.ndarray) -> Target | None:
    """Train one target. y: 0, 1, or -1 for the unlabelled; held: rows for calibration only."""
    train = (y >= 0) & ~held
    if min((y[train] == 1).sum(), (y[train] == 0).sum()) < 2 or len(set(y[held & (y >= 0)])) < 2:
        return None
    pool = y < 0
    lent = {"content": np.where(train, y, -1), "meta": np.where(train, y, -1)}
    for turn in range(ROUNDS + 1):
        words = telling_words(*found, np.flatnonzero(lent["content"] >= 0), lent["content"][lent["content"] >= 0])
        x = {"content": presence(*found, words), "meta": meta}
        w = {v: fit_logistic(x[v][lent[v] >= 0], lent[v][lent[v] >= 0]) for v in x}
        if turn == ROUNDS:
            break
        for view, other in (("content", "meta"), ("meta", "content")):
            p = sigmoid(log_odds(x[view], w[view]))
            new = pool & (lent[other] < 0) & ((p >= CONFIDENT) | (p <= 1 - CONFIDENT))
            lent[other] = np.where(new, (p >= 0.5).astype(int), lent[other])
    # the views are calibrated on one half of the holdout and their sum on the other
    hold = held & (y >= 0)
    half = hold & (np.cumsum(hold) % 2 == 0)
    rest = hold & ~half if len(set(y[half])) == 2 and len(set(y[hold & ~half])) == 2 else hold
    half = half if rest is not hold else hold
    z = {v: log_odds(x[v], w[v]) for v in x}
    cal = {v: calibrate(z[v][half], y[half]) for v in x}
    prior = float(np.log((y[hold].sum() + 1) / ((1 - y[hold]).sum() + 1)))
    joint = sum(z[v][rest] * cal[v][0] + cal[v][1] for v in x) - prior
    return Target(words, w["content"], w["meta"], np.array([cal["content"], cal["meta"], calibrate(joint, y[rest])]), prior)


def fit(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS, pool_rows: int = POOL_ROWS):
    """(bins of the metadata view, a Target or None for each of TARGETS)."""
    small_batches(docs.sparkSession)
    worst = (labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg((1 - F.min("quality")).alias("low_quality"), F.max("toxic").alias("toxic")))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null")
    chosen = bounded_sample(worst, "doc_id", labelled_rows).unionByName(
        bounded_sample(ids.join(worst, "doc_id", "leftanti").distinct(), "doc_id", pool_rows), allowMissingColumns=True)
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"))
            .join(F.broadcast(chosen), "doc_id"))  # labelled_rows + pool_rows at most
    return fitted(bounded_bytes(one_row_an_id(rows), "doc_id"), "doc_id", train)


def one_row_an_id(rows: DataFrame) -> DataFrame:
    """The same row of each doc_id on every run: the one of least text hash."""
    rest = [c for c in rows.columns if c != "doc_id"]
    order = F.struct(F.xxhash64(*rest), *[F.col(c) for c in rest])
    return rows.groupBy("doc_id").agg(F.min_by(F.struct(*rest), order).alias("r")).select("doc_id", "r.*")


def train(rows: pa.Table | None):
    """(bins, targets) from rows with doc_id, text, source, lang and TARGETS (null: unlabelled)."""
    if rows is None:
        return Meta([]), [None] * len(TARGETS)
    texts = text_array(rows.column("text"))
    found, shape = common_words(texts)
    bins = Meta.fit(shape)
    meta = bins.features(shape, rows.column("source").to_pylist(), rows.column("lang").to_pylist())
    held = np.array([zlib.crc32(str(d).encode()) % HOLDOUT == 0 for d in rows.column("doc_id").to_pylist()], dtype=bool)
    return bins, [co_train(found, meta, rows.column(t).fill_null(-1).to_numpy().astype(np.int64), held) for t in TARGETS]


def score(docs: DataFrame, model, columns: list[str] | None = None, prefix: str = "") -> DataFrame:
    """The columns of ``docs`` (or those named) and p_low_quality, p_toxic, score (probability that neither holds)
    and keep, each under a prefix that keeps them apart from the columns of ``docs``."""
    small_batches(docs.sparkSession)
    bins, targets = model
    names = docs.columns if columns is None else columns
    new = [prefix + n for n in ("p_low_quality", "p_toxic", "score", "keep")]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text"):
            texts = text_array(batch.column("__text"))
            found = content_words(texts)
            shape = text_shape(texts, *found[1:])
            meta = bins.features(shape, batch.column("__source").to_pylist(), batch.column("__lang").to_pylist())
            p = [t.score(presence(*found, t.words), meta) if t else np.zeros(len(texts)) for t in targets]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(names))), *map(pa.array, p), pa.array((1 - p[0]) * (1 - p[1])), pa.array((p[0] < REJECT) & (p[1] < REJECT))],
                names=[*names, *new])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema.fields]
    read = docs.select(*names, F.col("text").alias("__text"), F.col("source").cast("string").alias("__source"), F.col("lang").cast("string").alias("__lang"))
    return read.mapInArrow(judge, ", ".join([*fields, *(f"{n} double" for n in new[:3]), f"{new[3]} boolean"]))
