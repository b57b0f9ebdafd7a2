"""Operator 1: token ids as flat unsigned binary files with 64-bit document offsets.

``write_token_files`` deals documents out by ranges of ``doc_id``; each task encodes its range and streams three
files: ``part-N.bin`` (ids, the narrowest unsigned little-endian type that holds the vocabulary), ``part-N.idx``
(int64, where each document begins in the part, one entry more than documents) and ``part-N.doc`` (int64 doc_id).
The ids before a part are the prefix sum of the counts of the parts before it; they are kept in the manifest, one
row a file.  ``read_token_files`` maps the files into memory, a task for each.

A task writes under its attempt's name and renames at the end, so a repeated or speculative task replaces a file by
an equal one.  The folder is the shared one of spark.checkpoint.dir unless given.

Defined cases: null text is empty text (the end id alone); an empty text has one id; null doc_ids come first
and each part's manifest row counts them; repeated doc_ids are kept, ordered by a hash of their text; an empty table has no files; other columns are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from unicodedata import normalize

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rentalytics.llm.common import (partitions, ranges, shared_folder, slices, small_batches, split_words,
                                     text_array)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
#: Words whose ids a task remembers, and their length; longer words are encoded each time.
CACHE_WORDS, CACHE_CHARS = 250_000, 64
#: New words encoded at a time.
LOT = 2000
#: Ids that a reading task takes, about: tasks and the files they may write go by the ids, not by the shuffle partitions.
READ_IDS = 4 << 20
#: An ASCII letter before ASCII punctuation that no special token and no contraction has: pieces of this vocabulary end there.
#: After other letters they need not, as some (Turkish dotted capital I, Hindi letters with a nukta) end in a combining mark
#: once normalised and lowered, which makes one piece with the punctuation.
BREAK = r"([A-Za-z])([!-&(-/:;=?-@\[-`{}~])"


class Encoder:
    """Encodes batches of texts with a tokenizer whose pieces span neither white space nor the end of a run of
    letters, and which lowers case: each distinct word once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives each task one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.start, self.size = np.empty(1 << 16, np.uint32), np.empty(1 << 15, np.int64), np.empty(1 << 15, np.int64)
        self.words = self.ids = 0

    @property
    def id_type(self) -> np.dtype:
        return np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")

    def add(self, ids: np.ndarray, size: np.ndarray) -> None:
        """Append the ids of new words to the tables, which double as they fill."""
        def grown(a: np.ndarray, n: int) -> np.ndarray:
            return a if n <= len(a) else np.concatenate([a, np.empty(max(n - len(a), len(a)), a.dtype)])
        w, n = self.words, self.ids
        self.flat, self.start, self.size = grown(self.flat, n + len(ids)), grown(self.start, w + len(size)), grown(self.size, w + len(size))
        self.flat[n:n + len(ids)] = ids
        self.size[w:w + len(size)] = size
        self.start[w:w + len(size)] = n + np.cumsum(size) - size
        self.words, self.ids = w + len(size), n + len(ids)

    def learn(self, words: list[str]) -> None:
        """Encode new words.  A word of a-z is one piece, spelled alike in bytes, so the model takes it as it is; of
        other words of letters many go into one text, as each is one piece there; the rest are texts of their own."""
        plain, letters, others = [], [], []
        for w in words:
            if w.isascii():
                (plain if w.isalpha() and w.islower() else others).append(w)
            else:
                (letters if w.isalpha() and normalize("NFC", w).lower().isalpha() else others).append(w)
        spell = self.tokenizer.model.tokenize
        self.note(plain, [[t.id for t in spell(w)] for w in plain])
        for lo in range(0, len(letters), LOT):
            lot = letters[lo:lo + LOT]
            got = self.tokenizer.encode(" ".join(lot), add_special_tokens=False)
            self.known.update(zip(lot, range(self.words, self.words + len(lot))))
            self.add(np.array(got.ids, np.uint32), np.bincount(np.array(got.word_ids, np.int64), minlength=len(lot)))
        self.note(others, [e.ids for e in self.tokenizer.encode_batch(others, add_special_tokens=False)] if others else [])

    def note(self, words: list[str], ids: list[list[int]]) -> None:
        self.known.update(zip(words, range(self.words, self.words + len(words))))
        self.add(np.array([i for each in ids for i in each], np.uint32), np.fromiter(map(len, ids), np.int64, len(ids)))

    def encode(self, texts: pa.Array, end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        texts = pc.replace_substring_regex(texts, BREAK, r"\1 \2")
        if not pc.any(pc.match_substring(texts, "<|")).as_py():  # special tokens are told by case
            texts = pc.ascii_lower(texts)
        words, codes, offsets = split_words(texts)
        if len(self.known) > CACHE_WORDS:
            self.forget()
        self.learn([w for w in words if w not in self.known])
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        for w in words:
            if len(w) > CACHE_CHARS:
                del self.known[w]
        size = self.size[at][codes]
        ids = self.flat[ranges(self.start[at][codes], size)]
        counts = np.diff(np.r_[0, np.cumsum(size)][offsets])
        if end_id is None:
            return ids, counts
        out = np.full(len(ids) + len(counts), end_id, dtype=np.uint32)
        out[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
        return out, counts + 1


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def file_system(uri: str) -> tuple[pa.fs.FileSystem, str]:
    if uri.startswith("file:") or "://" not in uri:
        return pa.fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pa.fs.FileSystem.from_uri(uri)


def read_array(uri: str, kind: np.dtype, start: int = 0, count: int = -1) -> np.ndarray:
    """Part of a flat file: mapped into memory where the file is local, else read by range."""
    fs, path = file_system(uri)
    size = fs.get_file_info(path).size // kind.itemsize
    count = size - start if count < 0 else count
    if not count:
        return np.empty(0, kind)
    if isinstance(fs, pa.fs.LocalFileSystem):
        return np.memmap(path, dtype=kind, mode="r", offset=start * kind.itemsize, shape=(count,))
    with fs.open_input_file(path) as f:
        f.seek(start * kind.itemsize)
        return np.frombuffer(f.read(count * kind.itemsize), dtype=kind)


def part_file(folder: str, part: int, kind: str) -> str:
    return f"{folder}/part-{part:06d}.{kind}"


def write_token_files(docs: DataFrame, folder: str | None = None, tokenizer: str = TOKENIZER,
                      end_id: int = END_ID) -> DataFrame:
    """Write the files; return the manifest, one row a file: part, n_docs, n_null (of them without doc_id), n_tokens, base (ids of all parts before)."""
    spark = small_batches(docs.sparkSession)
    folder = folder or shared_folder(spark, "tokens")
    ranged = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
              .repartitionByRange(partitions(spark), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
              .select("doc_id", "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, enc = TaskContext.get(), encoder(tokenizer)
        part = task.partitionId()
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        temporary = {k: f"{part_file(root, part, k)}.{task.taskAttemptId()}" for k in ("bin", "idx", "doc")}
        files = {k: fs.open_output_stream(p) for k, p in temporary.items()}
        files["idx"].write(np.zeros(1, "<i8").tobytes())
        n_docs = n_null = n_tokens = 0
        for batch in slices(batches, "text"):
            ids, counts = enc.encode(text_array(batch.column("text")), end_id)
            files["bin"].write(ids.astype(enc.id_type).tobytes())
            files["idx"].write((n_tokens + np.cumsum(counts)).astype("<i8").tobytes())
            files["doc"].write(batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            n_docs, n_null, n_tokens = n_docs + len(counts), n_null + batch.column("doc_id").null_count, n_tokens + len(ids)
        for k, f in files.items():
            f.close()
            if n_docs:
                fs.move(temporary[k], part_file(root, part, k))
            else:
                fs.delete_file(temporary[k])
        if n_docs:
            yield pa.RecordBatch.from_pydict({"part": [part], "n_docs": [n_docs], "n_null": [n_null], "n_tokens": [n_tokens], "id_type": [enc.id_type.str]})

    path = f"{folder}/manifest"
    written = ranged.mapInArrow(write, "part long, n_docs long, n_null long, n_tokens long, id_type string")
    # one row a part: dealt to one file, not to as many tiny ones (each of which starts a child of the executor to set its mode)
    written.repartition(1).write.parquet(f"{folder}/counts")
    counts = spark.read.parquet(f"{folder}/counts")
    # one row a file: the one window over all of them stays small
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts.select("*", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"),
                  F.lit(folder).alias("folder")).write.parquet(path)
    return spark.read.parquet(path)


def read_token_files(manifest: DataFrame) -> DataFrame:
    """A row for each document, from the files alone: doc_id, start (ids of all documents before it), n_tokens, ids
    (little-endian unsigned 32-bit)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at = [part_file(row["folder"], row["part"], k) for k in ("bin", "idx", "doc")]
                offsets, doc_ids = read_array(at[1], np.dtype("<i8")), read_array(at[2], np.dtype("<i8"))
                group = offsets[:-1] // (1 << 20)  # about a million ids at a time
                cuts = np.r_[np.flatnonzero(np.r_[True, group[1:] != group[:-1]]), len(doc_ids)]
                for lo, hi in zip(cuts[:-1], cuts[1:]):
                    ids = read_array(at[0], np.dtype(row["id_type"]), int(offsets[lo]), int(offsets[hi] - offsets[lo])).astype("<u4")
                    inner = offsets[lo:hi + 1] - offsets[lo]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(doc_ids[lo:hi], mask=np.arange(lo, hi) < row["n_null"]),
                        pa.array(row["base"] + offsets[lo:hi]), pa.array(np.diff(inner)),
                        pa.array([ids[a:b].tobytes() for a, b in zip(inner[:-1], inner[1:])], pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"])

    size = manifest.agg(F.count(F.lit(1)).alias("files"), F.sum("n_tokens").alias("ids")).first()
    tasks = max(1, min(size.files, -(-(size.ids or 0) // READ_IDS)))
    return (manifest.repartition(tasks)
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary"))
