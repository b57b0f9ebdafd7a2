"""Operators 1 and 8: exact round trips against the tokenizer on whole texts."""

import random
import string
from unicodedata import category, normalize

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from rentalytics.llm import packing, tokens

ODD = ["<|endoftext|>", "a<|ENDOFTEXT|>b <|startoftext|>x", "don't I'LL we've'd.'s,", "İstanbul ÉCOLE ΣΑΣ.", "x" * 5000, "a..,b  c d e",
       "日本語テキスト、です。", "éà.b", "'s't'", "a'.b'.", "ﬁ.½,²", "́abc", " ", "", "x|y<z a<b", "क़ख़ कि", "a\x0bb\x0cc\xa0d"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokens.TOKENIZER)


def test_encoder_equals_whole_texts(tokenizer):
    rng = random.Random(1)
    pool = list("aAé'.,!| <>\n12sdt-ÀßΣ")
    texts = ODD + ["".join(rng.choices(pool, k=rng.randrange(60))) for _ in range(3000)]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    enc = tokens.Encoder(tokens.TOKENIZER)
    for _ in range(2):  # with and without known words
        ids, counts = enc.encode(pa.array(texts), None)
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def same_ids(tokenizer, texts):
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    ids, counts = tokens.Encoder(tokens.TOKENIZER).encode(pa.array(texts), None)
    cut = np.split(ids, np.cumsum(counts)[:-1])
    return [t for t, w, i in zip(texts, want, cut) if w != i.tolist()]


def test_every_letter_beside_every_punctuation_mark(tokenizer):
    marks = [c for c in string.printable if not c.isalnum() and not c.isspace()]
    letters = [chr(c) for c in range(0x110000) if category(chr(c))[0] == "L"]
    assert len(letters) > 100_000 and len(marks) == 32
    for lo in range(0, len(letters), 10_000):
        # the letter stands between every two marks that follow one another, so before and after each
        assert not same_ids(tokenizer, ["".join(f"{m}{x}" for m in marks) + marks[0] for x in letters[lo:lo + 10_000]])


def test_letters_that_end_in_a_mark(tokenizer):
    """Letters that change when normalised or lowered, combining marks, and what may compose with punctuation."""
    rng = random.Random(9)
    odd = [chr(c) for c in range(0x110000) if category(chr(c))[0] == "L" and category(normalize("NFC", chr(c)).lower()[-1])[0] != "L"]
    assert "\u0130" in odd and "\u0958" in odd and len(odd) > 50
    pool = odd + list("\u0301\u0307\u0338\u093c\u0327") * 6 + list("aAiIé )(.,'!<>=|-12") * 6 + ["\u1100", "\u1161", "\u11a8", "Σ", "\u0915"] * 4
    assert not same_ids(tokenizer, ["".join(rng.choices(pool, k=rng.randrange(1, 40))) for _ in range(20_000)])


def expected(tokenizer, docs):
    return [(r.doc_id, tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]) for r in docs.collect()]


def test_files_round_trip(spark, odd_docs, tokenizer):
    rows = tokens.read_token_files(tokens.write_token_files(odd_docs)).collect()
    want = expected(tokenizer, odd_docs)
    key = lambda x: (x[0] is not None, x[0] or 0)
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in rows), key=lambda x: (key(x), x[1])) == \
        sorted(want, key=lambda x: (key(x), x[1]))
    rows.sort(key=lambda r: r.start)
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1]]
    ids = [r.doc_id for r in rows]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:])


def test_least_doc_id_is_not_null(spark):
    docs = spark.createDataFrame([(-(1 << 63), "a"), (None, "b c"), (None, None), (5, "d")], "doc_id long, text string")
    rows = sorted(tokens.read_token_files(tokens.write_token_files(docs)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, None, -(1 << 63), 5]


def test_files_of_nothing(no_docs):
    assert tokens.read_token_files(tokens.write_token_files(no_docs)).count() == 0


def check_packing(pieces, want, capacity):
    by_doc, by_sequence = {}, {}
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, ids))
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert sum(len(x) for v in by_doc.values() for _, x in v) == sum(len(ids) for _, ids in want)
    padding = 0
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return by_doc, padding


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing_keeps_every_id_once(odd_docs, tokenizer, capacity):
    want = expected(tokenizer, odd_docs)
    by_doc, padding = check_packing(packing.pack(odd_docs, capacity).collect(), want, capacity)
    assert padding == 0
    for doc_id, ids in want:
        if [d for d, _ in want].count(doc_id) == 1:
            pieces = sorted(by_doc[doc_id, len(ids)])
            assert [s for s, _ in pieces] == [0, *np.cumsum([len(x) for _, x in pieces])[:-1]]
            assert [i for _, x in pieces for i in x] == ids


def test_packing_of_nothing(no_docs):
    assert packing.pack(no_docs).count() == 0


def test_fill_is_the_best_subset_sum():
    rng = random.Random(2)
    for _ in range(300):
        counts = {rng.randrange(1, 30): rng.randrange(1, 5) for _ in range(rng.randrange(1, 6))}
        space = rng.randrange(0, 60)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1) if s + n * k <= space}
        taken = packing.fill(space, counts)
        assert all(0 < c <= counts[n] for n, c in taken.items())
        assert sum(n * c for n, c in taken.items()) == max(sums)


@pytest.mark.parametrize("seed", range(25))
def test_plan_places_every_remainder(seed):
    rng = random.Random(seed)
    capacity = rng.choice([8, 32, 100, 128])
    counts = {rng.randrange(1, capacity): rng.randrange(1, 40) for _ in range(rng.randrange(0, 20))}
    rows, sequences = packing.plan_windows(counts, capacity)
    places, filled = packing.Places(rows), {}
    for n, c in counts.items():
        for rank in range(c):
            got = list(places.pieces(n, rank))
            assert [g[0] for g in got] == [0, *np.cumsum([g[1] for g in got])[:-1]] and sum(g[1] for g in got) == n
            for _, length, sequence, offset in got:
                filled.setdefault(sequence, []).append((offset, length))
    assert set(filled) == set(range(sequences))
    short = []
    for places_ in filled.values():
        at = 0
        for offset, length in sorted(places_):
            assert offset == at
            at += length
        if at != capacity:
            short.append(at)
    assert all(x & (x - 1) == 0 and x < capacity for x in short) and len(short) == len(set(short))


def test_hot_length_takes_few_plan_rows():
    rows, sequences = packing.plan_windows({700: 10_000_000, 648: 10_000_000, 13: 5}, 2048)
    assert len(rows) < 200 and sequences >= 10_000_000 * 1348 // 2048


def test_small_files_and_reading_tasks_go_by_ids(spark, tmp_path, monkeypatch):
    rows = spark.range(64).selectExpr("id as doc_id", "concat('some words of ', id) as text")
    manifest = tokens.write_token_files(rows, str(tmp_path / "t"))
    files = manifest.count()
    assert files > 1
    assert len(list((tmp_path / "t" / "counts").glob("part-*.parquet"))) == 1
    read = tokens.read_token_files(manifest)
    assert read.rdd.getNumPartitions() == 1 and read.count() == 64
    monkeypatch.setattr(tokens, "READ_IDS", 1)
    more = tokens.read_token_files(manifest)
    assert more.rdd.getNumPartitions() == files
    assert sorted(read.collect()) == sorted(more.collect())
