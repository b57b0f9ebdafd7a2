"""Operator 6: language identification with spans of mixed-language text.

A word (a run of letters, lower case) is scored under each learned language by its hashed character 1- to 4-grams.
Its script, told by code point ranges, first narrows the candidates to the languages that use that script.  Viterbi
over the words with a penalty for each switch labels the spans; the document's language is the one with most letters
and its score their share of all letters.

The counts are learned from a bounded sample of labelled rows that are not held out; the model is one array that goes
to every task.  Viterbi runs over a slice of documents at once, a step for each word of the longest.

Defined cases: null text, empty text and text without letters are ``und`` with score 0; so is everything if no
language can be learned; a word in a script of no learned language favours none; on ties the language first in order
wins; a null doc_id is not held out and not learned from; repeated rows get equal results; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentalytics.llm.common import bounded_bytes, bounded_sample, fitted, slices, small_batches, split_words, text_array

TRAIN_ROWS = 6_000
TABLE, GRAMS = 1 << 16, 4
#: Log odds that one word can add or take, and what a change of language costs.
WORD_LIMIT, SWITCH = 6.0, 10.0
#: A language uses a script if it writes this share of its letters in it.
SCRIPT_SHARE = 0.02
SLICE = 8 << 20
UNKNOWN = "und"
#: First code points of script ranges; ranges of one script repeat its name.
SCRIPTS = [(0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
           (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"),
           (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0E00, "thai"),
           (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"),
           (0x1200, "ethiopic"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "hiragana"),
           (0x30A0, "katakana"), (0x3100, "han"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"),
           (0xFB00, "other"), (0x20000, "han"), (0x323B0, "other")]
SCRIPT_NAMES = sorted({n for _, n in SCRIPTS})
_STARTS = np.array([s for s, _ in SCRIPTS])
_SCRIPT = np.array([SCRIPT_NAMES.index(n) for _, n in SCRIPTS])


def letter_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    return split_words(pc.utf8_lower(pc.replace_substring_regex(texts, r"\PL+", " ")))


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams of words, ends marked: which word, which place of the table."""
    points = np.frombuffer(("\n" + "\n".join(words) + "\n").encode("utf-32-le"), np.uint32).astype(np.uint64)
    end = points == 10
    word = np.cumsum(end) - 1  # of the mark before it, for letters and their closing mark alike
    out, rolled = [], np.zeros(len(points), np.uint64)
    for n in range(1, GRAMS + 1):
        m = len(points) - n + 1
        if m <= 0:
            break
        rolled = rolled[:m] * np.uint64(1_000_003) + points[n - 1:]
        inner = end[1:].cumsum()  # marks strictly inside a gram must be none
        marks = (inner[n - 3:][:m] - np.r_[0, inner][:m]) if n > 2 else np.zeros(m, int)
        ok = (marks == 0) & ~(end[:m] & end[n - 1:n - 1 + m])
        at = np.flatnonzero(ok)
        key = (rolled[at] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - 16)
        out.append((word[at], key.astype(np.int64)))  # a gram's word is that of its first letter or mark
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def scripts(words: list[str]) -> np.ndarray:
    first = np.fromiter((ord(w[0]) if w else 0 for w in words), np.int64, len(words))
    return _SCRIPT[np.searchsorted(_STARTS, first, side="right") - 1]


@dataclass
class Languages:
    names: list[str]
    table: np.ndarray  # TABLE x languages: log probability of a gram
    uses: np.ndarray  # scripts x languages

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log odds of each word under each language, the best 0; at most WORD_LIMIT apart."""
        if not words:
            return np.zeros((0, len(self.names)), np.float32)
        word, key = grams(words)
        out = np.stack([np.bincount(word, self.table[key, k], len(words)) for k in range(len(self.names))], axis=1).astype(np.float64)
        out /= GRAMS / 2  # grams of a word overlap
        allowed = self.uses[scripts(words)]
        out[~allowed & allowed.any(axis=1)[:, None]] = -1e9
        out[~allowed.any(axis=1)] = 0
        return np.maximum(out - out.max(axis=1, keepdims=True), -WORD_LIMIT).astype(np.float32)


def learn(texts: pa.Array, langs: list[str]) -> Languages | None:
    names = sorted(set(langs))
    if not names:
        return None
    words, codes, offsets = letter_words(texts)
    lang = np.repeat([names.index(x) for x in langs], np.diff(offsets))
    counts = np.zeros((len(words), len(names)))
    np.add.at(counts, (codes, lang), 1)
    word, key = grams(words) if words else (np.zeros(0, int),) * 2
    table = np.stack([np.bincount(key, counts[word, k], TABLE) for k in range(len(names))], axis=1)
    table = np.log((table + 0.5) / (table + 0.5).sum(axis=0))
    letters = counts * np.array([[len(w)] for w in words]).reshape(-1, 1)
    by_script = np.zeros((len(SCRIPT_NAMES), len(names)))
    np.add.at(by_script, scripts(words), letters)
    return Languages(names, table.astype(np.float32), by_script >= SCRIPT_SHARE * np.maximum(by_script.sum(axis=0), 1))


def viterbi(scores: np.ndarray, codes: np.ndarray, offsets: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """The best language of every word, document by document, all documents a step at a time."""
    size = np.diff(offsets)
    order = np.argsort(-size, kind="stable")
    start, n_langs = offsets[:-1][order], scores.shape[1]
    active = np.searchsorted(-size[order], -np.arange(size.max(initial=0)), side="left")  # documents longer than t
    best = np.zeros((len(order), n_langs), np.float32)
    switched, leader = np.zeros((len(codes), n_langs), bool), np.zeros(len(codes), np.int16)
    for t, m in enumerate(active):
        at = start[:m] + t
        b = best[:m]
        top = b.argmax(axis=1)
        jump = b[np.arange(m), top] - (penalty if t else 0)
        switched[at], leader[at] = jump[:, None] > b, top
        best[:m] = np.maximum(b, jump[:, None]) + scores[codes[at]]
    path, now = np.zeros(len(codes), np.int16), best.argmax(axis=1)
    for t in range(len(active) - 1, -1, -1):
        m = active[t]
        at = start[:m] + t
        path[at] = now[:m]
        now[:m] = np.where(switched[at, now[:m]], leader[at], now[:m])
    return path


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, rows: int = TRAIN_ROWS) -> Languages | None:
    """Learn from at most ``rows`` labelled documents that are not held out."""
    usable = docs.where("doc_id is not null and text is not null and lang is not null").where(~held_out(F.col("doc_id")))
    some = bounded_sample(usable.select("doc_id", "text", F.col("lang").cast("string").alias("lang")), "doc_id", rows)
    return fitted(bounded_bytes(some, "doc_id"), "doc_id", lambda rows: learn(text_array(rows.column("text")), rows.column("lang").to_pylist()) if rows else None)


def label(docs: DataFrame, model: Languages | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, and spans: ``lang:first:past`` in words (runs of letters), comma-joined."""
    small_batches(docs.sparkSession)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            n = batch.num_rows
            words, codes, offsets = letter_words(text_array(batch.column("text")))
            if model is None:
                pred, share, spans = [UNKNOWN] * n, np.zeros(n), [""] * n
            else:
                path = viterbi(model.word_scores(words), codes, offsets)
                letters = np.fromiter(map(len, words), np.int64, len(words))[codes]
                doc = np.repeat(np.arange(n), np.diff(offsets))
                by = np.bincount(doc * len(model.names) + path, letters, n * len(model.names)).reshape(n, -1)
                total = by.sum(axis=1)
                pred = [model.names[k] if t else UNKNOWN for k, t in zip(by.argmax(axis=1), total)]
                share = by.max(axis=1) / np.maximum(total, 1)
                new = np.r_[True, (path[1:] != path[:-1]) | (doc[1:] != doc[:-1])] if len(path) else np.zeros(0, bool)
                first = np.flatnonzero(new)
                past = np.r_[first[1:], len(path)]
                parts: list[list[str]] = [[] for _ in range(n)]
                for d, k, a, b in zip(doc[first], path[first], first - offsets[doc[first]], past - offsets[doc[first]]):
                    parts[d].append(f"{model.names[k]}:{a}:{b}")
                spans = [",".join(p) for p in parts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(pred, pa.string()), pa.array(share, pa.float64()), pa.array(spans, pa.string())],
                names=["doc_id", "held_out", "lang_pred", "score", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        predict, "doc_id long, held_out boolean, lang_pred string, score double, spans string")
