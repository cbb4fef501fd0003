"""Counts, encodings and packed pieces against the tokenizers library."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from procurelytics.llm import packing, tokens, trie_bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, ids string, n_tokens string"
ODD = ["", None, "a", " ", "\n\n  x", "don't 'LL y'all're", "x²½ Ⅷ 中文字 é̂ \x1c\x85  z 　", "a<|endoftext|>b <|startoftext|>c<|endoftext|>", "😀🇫🇷 ÄÖ ẞ ΟΔΥΣΣΕΥΣ İx", "aaaaaaaaaaaaaaaa ababababab", "\x00\x01",
       "no_spaces_" * 300, "word " * 3000, "The tHE the.", "1234567 12 3", "tion" * 2000]


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


def corpus():
    rng = random.Random(4)
    parts = ["th", "er", "an", "é", "tion", " ", " ", "\n", ".", "12", "'s", "ß", "ING", "ou", "  ", "-", "ñ"]
    return ODD + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 900))) for _ in range(60)]


@pytest.fixture(scope="module")
def frame(spark):
    texts = corpus()
    rows = [(i * 3 - 5, t, "", None) for i, t in enumerate(texts)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_counts(frame):
    rows, df = frame
    t = library(tokens.VOCABULARY)
    want = {i: (len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False).ids)) for i, x, *_ in rows}
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in tokens.token_rows(df).collect()}
    assert got == {i: (*w, w[1] > 1024) for i, w in want.items()}


def test_counts_in_many_chunks_and_with_small_memory(frame, monkeypatch):
    # nested functions of a task read these from the module of the worker, so they are set there by the plain functions
    monkeypatch.setattr(tokens, "CHUNK_CHARS", 500)
    monkeypatch.setattr(tokens, "HELD_SUMS", 10)
    rows, _ = frame
    import pyarrow as pa
    from types import SimpleNamespace

    monkeypatch.setattr(tokens, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 2)))
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] or "" for r in rows])], names=["doc_id", "text"])
    made = pa.Table.from_batches(list(tokens._frequencies(iter([batch])))).sort_by("token")
    sums = pa.Table.from_batches(list(tokens._weighted(tokens.VOCABULARY)(iter(made.to_batches(max_chunksize=50)))))
    t, found = library(tokens.VOCABULARY), {}
    for chunk in set(sums.column("chunk").to_pylist()):
        part = sums.filter(pa.compute.equal(sums.column("chunk"), chunk))
        found |= {r["doc_id"]: r["n_tokens"] for r in tokens._totals(part).to_pylist()}
    assert len(set(sums.column("chunk").to_pylist())) > 5
    assert found == {i: len(t.encode(x or "", add_special_tokens=False).ids) for i, x, *_ in rows}


def test_words_encode_and_decode_as_the_library(frame):
    rows, df = frame
    t = library(trie_bpe.VOCABULARY)
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in trie_bpe.encoding_rows(df).collect()}
    for i, x, *_ in rows:
        ids = t.encode(x or "", add_special_tokens=False).ids
        text = t.decode(ids, skip_special_tokens=False)
        assert got[i] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()), repr(x)[:80]


def test_memory_and_block_bounds_change_nothing(monkeypatch):
    texts = [t or "" for t in corpus()]
    want = trie_bpe.WordBpe().encode(texts)
    monkeypatch.setattr(trie_bpe, "REMEMBERED", 5)
    monkeypatch.setattr(trie_bpe, "PAIRS", 3)
    monkeypatch.setattr(trie_bpe, "BLOCK_CHARS", 50)
    small = trie_bpe.WordBpe()
    assert [b"".join(small.encode([p])[0] for p in trie_bpe._pieces(t)) for t in texts] == want


def test_a_very_long_word_takes_memory_of_its_length():
    import tracemalloc

    rng = random.Random(6)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(200_000)), "a" * 300_000, "z" + "é" * 100_000]
    bpe, t = trie_bpe.WordBpe(), library(trie_bpe.VOCABULARY)
    tracemalloc.start()
    got = bpe.encode(words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [t.encode(w, add_special_tokens=False).ids for w in words]
    assert peak < 300e6


def test_few_tokens_are_tried_at_a_prefix():
    class Counted(dict):
        tried = 0

        def get(self, *key):
            Counted.tried += 1
            return dict.get(self, *key)

    rng = random.Random(8)
    words = {"".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(rng.randint(1, 16))) for _ in range(3000)}
    bpe, t = trie_bpe.WordBpe(), library(trie_bpe.VOCABULARY)
    bpe.inner = Counted(bpe.inner)
    got = bpe.encode_words(words)
    assert all(np.frombuffer(got[w], "<u4").tolist() == t.encode(w, add_special_tokens=False).ids for w in words if w.isalpha())
    prefixes = {w[:n] for w in words for n in range(1, len(w))}
    assert Counted.tried < 4 * len(prefixes)


def test_packed_pieces(frame):
    rows, df = frame
    t = library(tokens.VOCABULARY)
    ids = {i: np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4") for i, x, *_ in rows}
    pieces, taken, filled = packing.packing_rows(df).collect(), defaultdict(list), defaultdict(list)
    for p in pieces:
        assert zlib.crc32(ids[p["doc_id"]][p["start"] : p["start"] + p["length"]].tobytes()) == p["ids_crc32"] and p["doc_tokens"] == len(ids[p["doc_id"]])
        taken[p["doc_id"]].append((p["start"], p["length"]))
        filled[p["sequence_id"]].append((p["offset"], p["length"]))
    for spans, ends in ((taken, {i: len(v) for i, v in ids.items()}), (filled, None)):
        for k, v in spans.items():
            at = 0
            for start, length in sorted(v):
                assert start == at and length > 0
                at += length
            assert at == ends[k] if ends else at <= 1024
    assert set(taken) == set(ids)


def test_windows_are_filled_as_well_as_any_subset_can():
    rng = random.Random(1)
    for _ in range(30):
        lengths = [rng.randint(1, 20) for _ in range(8)]
        counts = {k: lengths.count(k) for k in lengths}
        chosen = packing._fill(counts, 21)
        best = max(s for m in range(1, 256) for s in [sum(x for i, x in enumerate(lengths) if m >> i & 1)] if s <= 21 and any(m >> i & 1 and x == max(lengths) for i, x in enumerate(lengths)))
        assert sum(k * n for k, n in chosen.items()) == best and all(n <= counts[k] for k, n in chosen.items())
    lengths = [rng.randint(1, 1023) for _ in range(4000)]
    sequence, offset, n = packing.fill_windows(lengths)
    assert n <= sum(lengths) / 1024 * 1.01 + 1 and len(sequence) == len(offset) == 4000


def test_repeated_rows_missing_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b", "", ""), (1, "a b", "", ""), (None, "c", None, None)], SCHEMA)
    empty = spark.createDataFrame([], SCHEMA)
    for f, n in ((tokens.token_rows, 3), (trie_bpe.encoding_rows, 3), (packing.packing_rows, 3)):
        assert sorted(str(r["doc_id"]) for r in f(df).collect()) == ["1", "1", "None"] and f(df).count() == n and f(empty).count() == 0


def test_very_long_runs_of_blanks(spark):
    texts = [" " * 1_000_000, "a" + " " * 999_999 + "b\n" + "\n" * 300_000 + " é", "x " * 200_000]
    df, t = spark.createDataFrame([(i, x, "", None) for i, x in enumerate(texts)], SCHEMA), library(tokens.VOCABULARY)
    want = [t.encode(x, add_special_tokens=False).ids for x in texts]
    encode = tokens.byte_encoder()
    assert [list(encode(x)) for x in texts] == want
    assert {r["doc_id"]: r["n_tokens"] for r in tokens.token_rows(df).collect()} == {i: len(w) for i, w in enumerate(want)}
    assert {r["doc_id"]: r["doc_tokens"] for r in packing.packing_rows(df).collect()} == {i: len(w) + 1 for i, w in enumerate(want)}
