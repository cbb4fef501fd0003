"""Conversation repair against enumeration and against a plain Dijkstra search."""

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from procurelytics.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, gone string, kept string"
STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def moves(state, code):
    """Edits of one row in ``state``: letter, cost, next state (None: the row is not passed)."""
    initial, must_go, cut = " sua"[code & 3], code & 4, bool(code & 8)
    new = "a" if state == "u" else "u"
    yield "D", 3, state, True
    yield "I", 2, new, False
    if not must_go:
        yield "R", 2 + cut, new, True
        if (state, initial) in STEP:
            yield "K", cut, STEP[state, initial], True


def dijkstra(codes):
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if i == len(codes) and state in ("", "a"):
            return cost, audit
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i < len(codes):
            for letter, c, nxt, passed in moves(state, codes[i]):
                heapq.heappush(heap, (cost + c, audit + letter, i + passed, nxt))
        else:
            heapq.heappush(heap, (cost + 2, audit + "I", i, "a" if state == "u" else "u"))


def enumerate_all(codes):
    """Every edit string of up to 2n + 2 letters that gives the pattern."""
    best = None
    for n in range(0, 2 * len(codes) + 3):
        for audit in itertools.product("DIKR", repeat=n):
            cost, i, roles = 0, 0, ""
            for letter in audit:
                if letter == "I":
                    cost, roles = cost + 2, roles + ("a" if roles[-1:] == "u" else "u")
                    continue
                if i == len(codes):
                    break
                code, i = codes[i], i + 1
                if letter == "D":
                    cost += 3
                    continue
                if code & 4:
                    break
                cost += bool(code & 8) + (2 if letter == "R" else 0)
                roles += " sua"[code & 3] if letter == "K" else "a" if roles[-1:] == "u" else "u"
            else:
                if i == len(codes) and re.fullmatch("(s?(ua)+)?", roles):
                    best = min(best or (cost, "".join(audit)), (cost, "".join(audit)))
    return best


def test_edits_equal_enumeration():
    for n in range(3):
        for codes in itertools.product(range(16), repeat=n):
            assert repair.cheapest_edits(bytes(codes)) == enumerate_all(codes), codes


@pytest.mark.parametrize("block", [1, 3, 32])
def test_edits_equal_dijkstra(monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(400):
        kinds = rng.sample(range(16), rng.randint(1, 16))
        codes = bytes(rng.choice(kinds) for _ in range(rng.randint(0, 40)))
        assert repair.cheapest_edits(codes) == dijkstra(codes), list(codes)


def test_long_conversation_in_linear_time():
    rng = random.Random(9)
    codes = bytes(rng.choice([2, 3, 2, 3, 6, 10, 1, 0]) for _ in range(20_000))
    cost, audit = repair.cheapest_edits(codes)
    assert audit.count("I") + len(codes) == len(audit) and cost > 0
    rest = [c for c in audit if c != "I"]
    assert all(e == "D" for e, c in zip(rest, codes) if c & 4)


def test_prices_keep_the_dual_bound_and_end_tight():
    rng = random.Random(3)
    levels = repair._levels(bytes(rng.choice([0, 1, 2, 3, 5, 6, 10, 11]) for _ in range(20)))
    behind = repair._auction([repair.END_ARCS], [0])[:4]
    assert behind == [0, 4, 2, 0]
    price = repair._auction(levels, behind)
    for node in range(len(levels) * 4):
        for _, cost, ahead, q in levels[node // 4][node % 4]:
            assert price[node] <= cost + price[node - node % 4 + ahead * 4 + q]


def brute(rows):
    """The contract, one conversation at a time, with sorted lists and Dijkstra."""
    groups = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        groups[conv] += [] if kind == 0 else [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, group in groups.items():
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        turns, seen, codes = [t for t, *_ in group if t is not None], set(), []
        counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in group:
            shown = text.strip("\x20\t\n\x0b\x0c\r")
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            codes.append(max(" sua".find(role[:1]), 0) if role else 0)
            codes[-1] |= {"blank": 4, "duplicate": 4, "truncated": 8, None: 0}[fault]
        cost, audit = dijkstra(codes)
        roles, parts, i = "", [], 0
        for letter in audit:
            role, text = (None, "") if letter == "I" else group[i][1:]
            i += letter != "I"
            if letter == "D":
                continue
            role = role if letter == "K" else "assistant" if roles[-1:] == "u" else "user"
            roles += role[0]
            parts.append(f"{role}:{text}")
        assert re.fullmatch("(s?(ua)+)?", roles)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(group, group[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(parts).encode()).hexdigest())
    return out


def rows_of(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[n] for n in names) for r in rows}


def odd_rows():
    rng = random.Random(8)
    texts = ["Fine.", "Fine.", "cut off", "", None, " \t\n", "Why?", "a!b?c.", "x" * 50_000 + ".", "ü é!", ". \x0b"]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "unknown"]
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts), None, "x") for _ in range(600)]
    rows += [(1000 + i, 0, "user", "One.", None, None) for i in range(60)]  # some lose their only row
    return rows + rows[:5]


def test_rows_equal_the_contract(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    want, got = brute(rows), rows_of(repair.repair_rows(df))
    assert got == want and any(a[6] == "" for a in got.values())
    empty = ("", hashlib.sha256().hexdigest())
    assert any(a[-2:] == empty and a[:6] == (0,) * 6 for a in got.values())


def test_one_hot_conversation_and_empty_table(spark):
    rng = random.Random(2)
    rows = [(7, i, rng.choice(["user", "assistant"]), rng.choice([f"Text {i}.", "Again.", "cut"]), None, None) for i in range(4000)] + [(i, 0, "user", "Hi.", None, None) for i in range(100, 130)]
    assert rows_of(repair.repair_rows(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert repair.repair_rows(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repaired_rows_follow_the_pattern(spark):
    rows = [(1, 0, "assistant", "Hello.", None, None), (1, 1, "user", "Why?", None, None), (2, 5, "system", "Be kind.", None, None), (2, 6, "user", "Go.", None, None), (2, 7, "assistant", "Gone.", None, None), (2, 8, "assistant", "Gone.", None, None)]
    given = repair.as_given(spark.createDataFrame(rows, SCHEMA))
    out = repair.repaired_rows(given, repair.audit(given)).orderBy("conv_id", "place").collect()
    assert [(r["conv_id"], r["role"], r["text"]) for r in out] == [
        (1, "user", ""), (1, "assistant", "Hello."), (1, "user", "Why?"), (1, "assistant", ""),
        (2, "system", "Be kind."), (2, "user", "Go."), (2, "assistant", "Gone.")]
