"""The manifest against a tree built by plain recursion, and against its SQL."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

import oracle
from procurelytics.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climb(nodes, i=None):
    """Root, and the siblings of leaf ``i`` on the way, by plain lists."""
    way = []
    while len(nodes) > 1:
        runs = [nodes[k : k + 2] for k in range(0, len(nodes), 2)]
        if i is not None:
            way += [n for k, n in enumerate(runs[i // 2]) if k != i % 2]
            i //= 2
        nodes = [h(*run) for run in runs]
    return nodes[0], way


def digest(row, n_chars):
    values = [row[0], row[3], row[2], n_chars, row[1]]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def brute(rows):
    parts = defaultdict(list)
    for row in rows:
        parts[row[2]].append((row[0] is not None, row[0] or 0, digest(row, row[4]), row))
    names = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    for name in names:
        parts[name].sort(key=lambda r: r[:3])
    subroots = [climb([r[2] for r in parts[name]])[0] for name in names]
    root, out = climb(subroots)[0], []
    for k, name in enumerate(names):
        leaves = [r[2] for r in parts[name]]
        for i, (_, _, leaf, row) in enumerate(parts[name]):
            way = climb(leaves, i)[1] + climb(subroots, k)[1]
            bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[4] is not None
            found = digest(row, row[4] + 1) if bad else leaf
            folded = climb([*subroots[:k], climb([*leaves[:i], found, *leaves[i + 1 :]])[0], *subroots[k + 1 :]])[0]
            assert (folded == root) == (not bad)
            out.append((row[0], leaf, subroots[k], root, h(*way), folded, not bad))
    return out


NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def check(spark, rows):
    got = [tuple(r[n] for n in NAMES) for r in merkle.manifest_rows(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute(rows)))


def corpus(n, langs):
    rng = random.Random(n)
    return [(i * 3, rng.choice(["", None, "text é", "x" * 5000]), rng.choice(langs), rng.choice([None, "s"]), rng.choice([None, i]), "own", None) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 150])
def test_equals_plain_recursion(spark, n):
    check(spark, corpus(n, [None, "", "de", "en", "en", "en", "fr", "zz", "é"]))


def test_repeated_rows_missing_ids_and_empty_table(spark):
    rows = corpus(20, ["a", None]) + [(None, "t", "a", None, 1, None, None)] * 3 + [(3, "t", "a", None, 1, None, None)] * 2
    check(spark, rows)
    assert merkle.manifest_rows(spark.createDataFrame([], SCHEMA)).count() == 0


def test_many_chunks_and_rounds(spark, monkeypatch):
    # chunks of four leaves: the tree of 150 rows takes four rounds, and so do 20 parts
    monkeypatch.setattr(merkle, "CHUNK", 4)
    rows = corpus(37, [str(i) for i in range(20)])
    parts = defaultdict(list)
    for i, row in enumerate(corpus(149, ["x"])):
        parts["x"].append(digest(row, row[4]))
    # tasks read CHUNK from the module of the worker, so rounds are built here by the plain functions
    import pyarrow as pa

    def up(digests):
        rounds, n = [digests], len(digests)
        while n > 1:
            made = []
            for at in range(0, n, 4):
                piece = rounds[-1][at : at + 4]
                table = pa.table({"tree": ["x"] * len(piece), "position": list(range(at + 1, at + 1 + len(piece))), "n_rows": [n] * len(piece), "digest": piece})
                made.append(merkle._root_of(table).column("digest")[0].as_py())
            rounds.append(made)
            n = len(made)
        return rounds

    for digests in (parts["x"], parts["x"][:16], parts["x"][:17], [digest(r, r[4]) for r in rows]):
        rounds = up(digests)
        root = climb(digests)[0]
        assert rounds[-1] == [root]
        for i in range(len(digests)):
            way, place, folded = [], i, h("other")
            for nodes in rounds[:-1]:
                chunk = place // 4
                tree = merkle.Subtree([d.encode() for d in nodes[chunk * 4 : chunk * 4 + 4]], 2 if len(nodes) > 4 else None)
                way += [a + b for a, b in tree.siblings(place % 4)]
                folded = tree.fold(place % 4, folded.encode()).decode()
                place = chunk
            assert [w.decode() for w in way if w] == climb(digests, i)[1]
            assert folded == climb([*digests[:i], h("other"), *digests[i + 1 :]])[0]


def test_wider_trees(monkeypatch):
    monkeypatch.setattr(merkle, "ARITY", 3)
    leaves = [h(str(i)).encode() for i in range(11)]
    tree = merkle.Subtree(leaves)
    for i in range(11):
        changed = [*leaves[:i], b"other", *leaves[i + 1 :]]
        assert tree.fold(i, b"other") == merkle.Subtree(changed).root and tree.fold(i, leaves[i]) == tree.root
        up = merkle.Upward([{"left": a.decode(), "right": b.decode()} for a, b in tree.siblings(i)])
        assert up.fold(b"other") == merkle.Subtree(changed).root


def test_chunked_table_equals_its_sql(spark):
    """5,000 rows of one part are two chunks: the second round and the way down are run."""
    docs = spark.range(5000).selectExpr("id * 2 AS doc_id", "concat('t', id) AS text", "if(id % 10 < 8, 'hot', concat('p', id % 9)) AS lang", "'s' AS source", "id AS n_chars", "1 AS leaf", "2 AS tree")
    import duckdb

    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    assert oracle.compare(spark, con, None, "op12", lambda s, d: merkle.manifest_rows(docs), merkle.SQL)[0] is None
