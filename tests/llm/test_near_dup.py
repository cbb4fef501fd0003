"""Near copies against all pairs by brute force."""

import os
import random
import re

import numpy as np
import pytest

from procurelytics.llm import near_dup
from procurelytics.session import shared_folder

SCHEMA = "doc_id long, text string, component string"


def brute(docs, size, percent=80):
    sets = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                r, s = root(a), root(b)
                parent[max(r, s)] = min(r, s)
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    docs, n = [], 0
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(15, 120))]
        for _ in range(6):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 12))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            docs.append((n, " ".join(copy)))
            n += rng.randint(1, 3)
    docs += [(n, None), (n + 1, ""), (n + 2, " \n\t"), (n + 3, "One"), (n + 4, "one"), (n + 5, "É x"), (n + 6, "é x"), (n + 7, "A\tb"), (n + 8, "a b")]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("size", [2, 5])
def test_matches_brute_force(spark, size):
    docs = corpus()
    got = {r[0]: (r[1], r[2]) for r in near_dup.near_components(spark.createDataFrame([(*d, "x") for d in docs], SCHEMA), size).collect()}
    assert got == brute(docs, size)


def test_repeated_ids_missing_ids_and_empty_table(spark):
    rows = [(1, "a b c d", ""), (1, "a b c d", ""), (None, "a b c d", ""), (2, "A b c d", ""), (3, None, None)]
    assert {tuple(r) for r in near_dup.near_components(spark.createDataFrame(rows, SCHEMA)).collect()} == {(1, 3, 1), (2, 3, 1), (3, 0, 3)}
    assert near_dup.near_components(spark.createDataFrame([], SCHEMA)).count() == 0
    kept = near_dup.keep_one_of_each(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "component"] and sorted(str(r[0]) for r in kept.collect()) == ["1", "1", "3", "None"]


def test_only_the_ids_that_go_stay_stored(spark):
    folder = shared_folder(spark).split(":")[-1]
    before = set(os.listdir(folder))
    kept = near_dup.keep_one_of_each(spark.createDataFrame([(i, f"a b c d e f g h {i % 3} i j k l m n", "") for i in range(9)], SCHEMA), 2)
    assert len(set(os.listdir(folder)) - before) == 1
    assert sorted(r[0] for r in kept.collect()) == [0, 1, 2]


def test_sketch_merges_and_estimates():
    rng = np.random.default_rng(1)
    ids = rng.integers(-(2**62), 2**62, 1500)
    a, b = ids[:1200], ids[300:]
    one = lambda x: near_dup.sketch(x, np.zeros(len(x), int), 1)[0]
    assert (np.maximum(one(a), one(b)) == one(ids)).all()
    assert abs(near_dup.joint_similarity(one(a), one(b), 1200, 1200) - 900 / 1500) < 0.12
    assert near_dup.joint_similarity(one(a), one(a), 1200, 1200) > 0.99


def group_of_copies(members, words, seed):
    """Copies of one text with words replaced, dropped or added, some edits on top of others' edits."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(words)]
    texts = [base]
    for _ in range(members - 1):
        copy = list(rng.choice(texts) if rng.random() < 0.3 else base)
        for _ in range(rng.randint(0, words // 9)):
            k, word = rng.randrange(len(copy)), f"e{rng.randrange(60) if rng.random() < 0.3 else rng.random()}"
            copy[k : k + 1] = {0: [], 1: [copy[k], word]}.get(rng.randrange(6), [word])
        texts.append(copy)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("size, few", [(2, 0), (2, 16), (5, 0)])
def test_crowded_groups_match_brute_force(spark, monkeypatch, size, few):
    monkeypatch.setattr(near_dup, "FEW_OUTSIDE", few)
    docs = group_of_copies(150, 60, 5) + [(1000 + i, t) for i, t in group_of_copies(60, 25, 6)] + [(3000 + i, t) for i, t in corpus() if t]
    got = {r[0]: (r[1], r[2]) for r in near_dup.near_components(spark.createDataFrame([(*d, "x") for d in docs], SCHEMA), size).collect()}
    assert got == brute(docs, size)


def test_unlike_copies_are_not_all_compared(spark, monkeypatch):
    docs, compared, likely = group_of_copies(500, 100, 7), [], near_dup._likely

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return likely(pairs, *rest)

    monkeypatch.setattr(near_dup, "_likely", counted)
    got = {r[0]: r[2] for r in near_dup.near_components(spark.createDataFrame([(*d, "x") for d in docs], SCHEMA)).collect()}
    assert sum(i != c for i, c in got.items()) > 200
    assert sum(compared) < 20 * len(docs), compared


def test_sketches_take_bounded_memory():
    import tracemalloc

    rng = np.random.default_rng(5)
    sizes = np.array([0, 3, 900_000, 0, 40, 600_000, 1, 0])
    values = rng.integers(-(2**63), 2**63 - 1, sizes.sum())
    want = near_dup.sketch(values, np.repeat(np.arange(len(sizes)), sizes), len(sizes))
    tracemalloc.start()
    got = near_dup._levels(values, np.cumsum(sizes))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (got[sizes > 0] == want[sizes > 0]).all() and peak < 40e6


def test_workers_give_memory_back_at_the_end(monkeypatch):
    from procurelytics.llm import common

    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    assert list(common.giving_back(lambda batches: (b + 1 for b in batches))([1, 2])) == [2, 3] and calls == [1]
    monkeypatch.undo()
    common.give_back()
