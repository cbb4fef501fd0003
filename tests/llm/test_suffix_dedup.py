"""Removed bytes against brute force."""

import hashlib
import random

import pytest

from procurelytics.llm import suffix_dedup

SCHEMA = "doc_id long, text string, raw string"


def brute(docs, length=50):
    first, out = {}, {}
    for doc, raw in sorted((d, (t or "").encode()) for d, t in docs):
        for s in range(len(raw) - length + 1):
            first.setdefault(raw[s : s + length], doc)
    for doc, raw in ((d, (t or "").encode()) for d, t in docs):
        covered = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if first[raw[s : s + length]] < doc:
                covered[s : s + length] = b"\1" * length
        spans = sum(1 for i, c in enumerate(covered) if c and not (i and covered[i - 1]))
        out[doc] = (len(raw), sum(covered), spans, bytes(b for b, c in zip(raw, covered) if not c))
    return out


def corpus():
    rng = random.Random(9)
    syllables = ["the", "on", "é", "er ", "an ", "ti", "of ", "re", "ß"]
    text = lambda n: "".join(rng.choice(syllables) for _ in range(n))
    shared = [text(n) for n in (8, 14, 17, 25, 60, 200)]
    docs = []
    for i in range(60):
        parts = [text(rng.randint(0, 60)) for _ in range(3)]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            parts.insert(rng.randrange(len(parts)), s[rng.randrange(10) :])
        docs.append((i * 2, "".join(parts)))
    docs += [(200, docs[7][1]), (201, docs[7][1]), (1, docs[9][1]), (203, None), (204, ""), (205, "x" * 49), (206, "x" * 49), (207, "ab" * 90), (208, "b" + "ab" * 40), (209, "\0" * 70), (210, "\0" * 60 + "\1")]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("many, windows", [(256, 250_000), (0, 300)])
def test_matches_brute_force(spark, monkeypatch, many, windows):
    monkeypatch.setattr(suffix_dedup, "MANY_CHUNKS", many)
    monkeypatch.setattr(suffix_dedup, "SORTED_WINDOWS", windows)
    monkeypatch.setattr(suffix_dedup, "SCAN_BYTES", 100)
    docs = corpus()
    got = {r[0]: (r[1], r[2], r[3], bytes(r[4])) for r in suffix_dedup.remove_repeats(spark.createDataFrame([(*d, "") for d in docs], SCHEMA)).collect()}
    want = brute(docs)
    assert got == want and sum(w[1] > 0 for w in want.values()) > 20


def test_repeated_ids_missing_ids_and_empty_table(spark):
    long = "abcdefghij" * 6
    rows = [(1, long, ""), (1, long, ""), (None, long, None), (2, "é" + long, ""), (3, None, "")]
    got = sorted((str(r[0]), r[1], r[2], r[3]) for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [("1", 60, 0, 0), ("2", 62, 60, 1), ("3", 0, 0, 0), ("None", 60, 0, 0)]
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
    left = suffix_dedup.without_repeats(spark.createDataFrame(rows, SCHEMA))
    assert left.columns == ["doc_id", "text", "raw"]
    assert sorted((str(r[0]), r[1]) for r in left.collect() if r[1]) == [("1", long), ("1", long), ("2", "é"), ("None", long)]


ODD = "doc_id int, `of.text` array<string>, text string, n_chars long, raw string, missing boolean, left date"


def test_the_other_columns_go_along_with_the_one_shuffle_of_texts(spark):
    long, own = "abcdefghij" * 6, "klmnopqrst" * 7
    rows = [(1, ["p"], long, 7, "r", True, None), (2, None, f"{long}é", -1, None, None, None), (2, ["q", None], None, 8, "s", False, None),
            (3, [], own, 9, None, True, None), (3, ["u"], None, None, "t", True, None), (4, None, long, 5, None, None, None), (5, None, f" {own}\n", 1, None, None, None),
            (6, None, None, 4, "", False, None), (7, None, "", None, None, None, None), (None, ["v"], long, 6, "w", True, None), (8, None, f"{long[:59]}😀", 60, None, None, None)]
    left = suffix_dedup.without_repeats(spark.createDataFrame(rows, ODD))
    assert left.columns == ["doc_id", "of.text", "text", "n_chars", "raw", "missing", "left"] and left.schema["doc_id"].dataType.simpleString() == "int"
    # of 2 the text with the least SHA-256 counts for both rows, of 3 too; 4 and 5 have nothing but repeats and white space
    changed = {2: None, 3: None}
    for doc, texts in ((2, [f"{long}é", ""]), (3, [own, ""])):
        changed[doc] = min(texts, key=lambda t: hashlib.sha256(t.encode()).digest())
    got = sorted((tuple(r) for r in left.collect()), key=str)
    want = []
    for doc, *rest in rows:
        if doc == 4 or (doc == 5 and changed[3] == own):
            continue
        one = [doc, *rest]
        if (doc == 2 and changed[2]) or doc == 8:
            one[2:4] = ["é", 1] if doc == 2 else ["😀", 1]
        want.append(tuple(one))
    assert got == sorted(want, key=str)
    # a join back to the documents would send their texts a second time
    assert "LeftOuter" not in left._jdf.queryExecution().optimizedPlan().toString()
