"""Whole-document packing against the tokenizers library, enumeration and the lower bound."""

import random
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from procurelytics.llm import bin_slack
from test_tokens import SCHEMA, corpus, library

pytest.importorskip("public_tokenizers")


def fill_of(counts, capacity):
    """The best fill with the longest piece, over all subsets."""
    items = sorted((k for k, n in counts.items() for _ in range(n)), reverse=True)
    rest = items[1:]
    return max(items[0] + sum(c) for n in range(len(rest) + 1) for c in combinations(rest, n) if items[0] + sum(c) <= capacity)


def test_bins_are_as_full_as_any_subset():
    rng = random.Random(4)
    for _ in range(200):
        counts = defaultdict(int)
        for _ in range(rng.randint(1, 9)):
            counts[rng.randint(1, 30)] += 1
        chosen = bin_slack.fullest_bin(counts, 30)
        assert sum(k * n for k, n in chosen) == fill_of(counts, 30)
        assert all(n <= counts[k] for k, n in chosen) and chosen[0][0] == max(counts)


def bins_of(plan, counts, capacity):
    bins, ranks = defaultdict(list), defaultdict(set)
    for length, low, high, number, first, at in plan:
        for r in range(low, high):
            assert r not in ranks[length]
            ranks[length].add(r)
            bins[first + (r - low) // number].append((at + (r - low) % number * length, length))
    assert {k: len(v) for k, v in ranks.items()} == {k: n for k, n in counts.items() if n}
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def best(items, capacity):
    """The least number of bins, by search."""
    items = sorted(items, reverse=True)

    def fits(n):
        def place(i, rooms):
            if i == len(items):
                return True
            return any(place(i + 1, rooms[:k] + (rooms[k] - items[i],) + rooms[k + 1 :]) for k in range(n) if rooms[k] >= items[i] and rooms[k] not in rooms[:k])
        return place(0, (capacity,) * n)

    return next(n for n in range(1, len(items) + 1) if fits(n))


def test_plans_are_near_the_best():
    rng, ours, least = random.Random(6), 0, 0
    for _ in range(60):
        items = [rng.randint(1, 20) for _ in range(rng.randint(1, 11))]
        counts = {k: items.count(k) for k in items}
        n = bins_of(bin_slack.plan_bins(counts, 20), counts, 20)
        ours, least = ours + n, least + best(items, 20)
    assert ours <= least * 1.02


@pytest.mark.parametrize("draw", [lambda r: r.randint(1, 2048), lambda r: min(2048, int(r.expovariate(1 / 300)) + 1), lambda r: r.choice([683, 683, 700, 1, 2048])])
def test_many_pieces_need_no_more_than_their_sum_or_their_halves(draw):
    rng = random.Random(1)
    items = [draw(rng) for _ in range(30_000)]
    counts = {k: items.count(k) for k in set(items)}
    n = bins_of(bin_slack.plan_bins(counts, 2048), counts, 2048)
    assert max(sum(x > 1024 for x in items), sum(items) / 2048) <= n <= max(sum(x > 1024 for x in items), sum(items) / 2048) * 1.004 + 12000 * (683 in counts and counts[683] > 9000)


def test_hot_lengths_in_closed_form():
    assert len(bin_slack.plan_bins({683: 3 * 10**9, 1365: 10**9, 1: 5}, 2048)) < 10


@pytest.mark.parametrize("parts", [1, 5])
def test_pieces_are_the_library_s_ids(spark, parts):
    rows = [(i * 3 - 5, t, "", None) for i, t in enumerate([*corpus(), "word " * 9000, "a b", "a b", "word " * 2047, "word " * 2048])]
    rows += [(900 + i, "same text here", "", None) for i in range(50)]
    df, t = spark.createDataFrame(rows, SCHEMA).repartition(parts), library("byte_bpe_50k.json")
    ids = {i: np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4") for i, x, *_ in rows}
    taken, bins = defaultdict(list), defaultdict(list)
    for p in bin_slack.bin_slack_rows(df).collect():
        part = ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert zlib.crc32(part.tobytes()) == p["ids_crc32"] and p["doc_tokens"] == len(ids[p["doc_id"]])
        taken[p["doc_id"]].append((p["piece"], p["start"], p["length"]))
        bins[p["sequence_id"]].append((p["offset"], p["length"]))
    assert set(taken) == set(ids)
    for i, spans in taken.items():
        spans.sort()
        assert [s[0] for s in spans] == list(range(-(-len(ids[i]) // 2048))) and all(s[2] == 2048 for s in spans[1:])
        assert [s[1] for s in spans] == list(np.cumsum([0, *[s[2] for s in spans[:-1]]])) and sum(s[2] for s in spans) == len(ids[i])
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= sum(map(len, ids.values())) / 2048 * 1.05 + 2


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, "a b", "", ""), (1, "a b", "", ""), (None, None, None, None)], SCHEMA)
    got = bin_slack.bin_slack_rows(df).collect()
    assert sorted((str(r["doc_id"]), r["piece"], r["length"]) for r in got) == [("1", 0, 3), ("1", 0, 3), ("None", 0, 1)]
    ids = {(r["doc_id"], r["length"]): np.frombuffer(r["ids"], "<u2").tolist() for r in bin_slack.pack_whole(df).collect()}
    assert ids == {(1, 3): [64, 275, 0], (None, 1): [0]}
    assert {r["sequence_id"] for r in got} == {0} and sorted(r["offset"] for r in got) == [0, 3, 6]
    assert bin_slack.bin_slack_rows(spark.createDataFrame([], SCHEMA)).count() == 0
