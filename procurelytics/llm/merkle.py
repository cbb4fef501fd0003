"""Merkle manifest of a table as a tree of SHA-256 midstates.

A parent hashes its children one after another and keeps, for every child slot, a copy of its hash state
before that child.  A changed leaf is folded to the root without hashing what stands left of it: the
matching state is resumed, takes the replacement and then the siblings to the right.

The leaves of a tree are numbered in order over the whole table.  Aligned runs of CHUNK leaves are whole
subtrees, each built in one task; their roots are the leaves of the next round, until one is left.
Coming down, a chunk gets the siblings on its way to the root and folds all its leaves at once."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from procurelytics.operators.ordering import in_order
from procurelytics.session import cut_lineage

ARITY = 2
#: Leaves of the subtree that one task builds: a power of the arity.
CHUNK = 4096
PATH = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def _height(n: int) -> int:
    height = 0
    while n > 1:
        n, height = n // ARITY, height + 1
    return height


class Subtree:
    """Digests (lowercase hex) by level and, for every node, its parent's state before it."""

    def __init__(self, leaves: list[bytes], height: int | None = None):
        self.levels, self.states = [leaves], []
        while len(self.levels[-1]) > 1 if height is None else len(self.states) < height:
            nodes, states, parents = self.levels[-1], [], []
            for i in range(0, len(nodes), ARITY):
                state = hashlib.sha256()
                for child in nodes[i : i + ARITY]:
                    states.append(state.copy())
                    state.update(child)
                parents.append(state.hexdigest().encode())
            self.levels.append(parents)
            self.states.append(states)

    @property
    def root(self) -> bytes:
        return self.levels[-1][0]

    def siblings(self, i: int) -> list[tuple[bytes, bytes]]:
        """Level by level, what stands left and right of the way from leaf ``i`` to the root."""
        out = []
        for nodes in self.levels[:-1]:
            first = i - i % ARITY
            out.append((b"".join(nodes[first:i]), b"".join(nodes[i + 1 : first + ARITY])))
            i //= ARITY
        return out

    def fold(self, i: int, digest: bytes) -> bytes:
        """The root if leaf ``i`` were ``digest``."""
        for nodes, states in zip(self.levels, self.states):
            state = states[i].copy()
            state.update(digest)
            for right in nodes[i + 1 : i - i % ARITY + ARITY]:
                state.update(right)
            digest, i = state.hexdigest().encode(), i // ARITY
        return digest


class Upward:
    """The way from a chunk's root to the root of all, with the states before the way."""

    def __init__(self, path):
        self.siblings = [(p["left"].encode(), p["right"].encode()) for p in path]
        self.states = [(hashlib.sha256(left), right) for left, right in self.siblings]

    def fold(self, digest: bytes) -> bytes:
        for before, right in self.states:
            state = before.copy()
            state.update(digest)
            state.update(right)
            digest = state.hexdigest().encode()
        return digest


# --- leaves -----------------------------------------------------------------------------
def field(value: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*columns: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


# --- rounds -----------------------------------------------------------------------------
_NODES = "tree string, position long, n_rows long, digest string"


def _subtree(table: pa.Table, digest="digest") -> tuple[Subtree, pa.Table]:
    table = table.sort_by("position")
    n = table.column("n_rows")[0].as_py()
    return Subtree([d.encode() for d in table.column(digest).to_pylist()], _height(CHUNK) if n > CHUNK else None), table


def _root_of(table: pa.Table) -> pa.Table:
    tree, table = _subtree(table)
    first = table.slice(0, 1)
    chunk, n = (first.column("position")[0].as_py() - 1) // CHUNK, first.column("n_rows")[0].as_py()
    return pa.table({"tree": first.column("tree"), "position": [chunk + 1], "n_rows": [-(-n // CHUNK)], "digest": [tree.root.decode()]})


def _chunk() -> Column:
    return F.floor((F.col("position") - 1) / CHUNK)


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """Nodes of every round, from the given ones to one root per tree; all are stored."""
    most, out = nodes.agg(F.max("n_rows")).first()[0] or 0, [nodes.select("tree", "position", "n_rows", "digest")]
    while True:
        chunks = out[-1].withColumn("chunk", _chunk()).groupBy("tree", "chunk")
        out.append(cut_lineage(chunks.applyInArrow(_root_of, _NODES)))
        most = -(-most // CHUNK)
        if most <= 1:
            return out


_WAYS = "tree string, position long, subroot string, root string, path array<struct<left:string,right:string>>"


def _way_down(nodes: pa.Table, above: pa.Table) -> pa.Table:
    """The ways of a chunk's nodes: their siblings in it, then the way of the chunk."""
    if not nodes.num_rows:
        return pa.table({"tree": pa.array([], pa.string()), "position": pa.array([], pa.int64()), "subroot": pa.array([], pa.string()), "root": pa.array([], pa.string()), "path": pa.array([], PATH)})
    tree, nodes = _subtree(nodes)
    rest = above.column("path")[0].as_py()
    paths = [[{"left": a.decode(), "right": b.decode()} for a, b in tree.siblings(i)] + rest for i in range(nodes.num_rows)]
    same = {c: pa.array([above.column(c)[0].as_py()] * nodes.num_rows, pa.string()) for c in ("subroot", "root")}
    return pa.table({"tree": nodes.column("tree"), "position": nodes.column("position"), **same, "path": pa.array(paths, PATH)})


def _ways(rounds: list[DataFrame], top: DataFrame) -> DataFrame:
    """The ways of the nodes of the first round but one, from the ways of the last round's roots."""
    ways = top
    for nodes in reversed(rounds[1:-1]):
        own = nodes.withColumn("chunk", _chunk()).groupBy("tree", "chunk")
        above = ways.withColumn("chunk", F.col("position") - 1).groupBy("tree", "chunk")
        ways = cut_lineage(own.cogroup(above).applyInArrow(_way_down, _WAYS))
    return ways


PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _proofs(nodes: pa.Table, above: pa.Table) -> pa.Table:
    """Proof and folded root of each leaf of a chunk."""
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    out = {n: [] for n in names}
    if nodes.num_rows:
        tree, nodes = _subtree(nodes, "leaf")
        up, subroot, root = Upward(above.column("path")[0].as_py()), above.column("subroot")[0].as_py(), above.column("root")[0].as_py()
        rest = b"".join(a + b for a, b in up.siblings)
        for i, given in enumerate(nodes.column("found").to_pylist()):
            folded = up.fold(tree.fold(i, given.encode())).decode()
            proof = hashlib.sha256(b"".join(a + b for a, b in tree.siblings(i)) + rest).hexdigest()
            for name, value in zip(names[2:], (subroot, root, proof, folded, folded == root)):
                out[name].append(value)
        out["doc_id"], out["leaf"] = nodes.column("doc_id"), nodes.column("leaf")
    types = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
    return pa.table({n: c if isinstance(c, pa.ChunkedArray) else pa.array(c, t) for (n, c), t in zip(out.items(), types)})


def verify(leaves: DataFrame) -> DataFrame:
    """Builds the manifest of ``leaves`` (doc_id, part, leaf, found) and checks every row against it.

    ``leaf`` is the digest of the row as recorded, ``found`` as it is now.  Leaves of one ``part`` (NULL is a
    part) ascend by doc_id, NULL first, then by leaf; parts ascend by name, NULL first.  Returns doc_id,
    leaf, subroot, root, proof_sha256, folded_root, verified for every row, repeated ones too.  No
    part, however large, is in one task: a task holds CHUNK leaves."""
    tree = F.coalesce(F.concat(F.lit("+"), F.col("part").cast("string")), F.lit(""))  # NULL first
    rows = leaves.select("doc_id", tree.alias("tree"), "leaf", "found", F.monotonically_increasing_id().alias("spread"))
    numbered = cut_lineage(in_order(rows, ["doc_id", "leaf", "spread"], by="tree").drop("rank", "spread"))
    rounds = _rounds(numbered.withColumn("digest", F.col("leaf")))
    subroots = rounds[-1].select(F.col("tree").alias("part_tree"), F.col("digest").alias("subroot"))
    parts = cut_lineage(in_order(subroots, "part_tree").select("part_tree", F.lit("").alias("tree"), "position", "n_rows", F.col("subroot").alias("digest")))
    upper = _rounds(parts)
    empty = F.array().cast("array<struct<left:string,right:string>>")
    top = upper[-1].select("tree", "position", F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"), empty.alias("path"))
    # the ways of the parts' roots, then of the chunks below them
    in_parts = _ways([None, *upper], top).select("position", "root", "path")
    mine = parts.join(in_parts, "position").select(F.col("part_tree").alias("tree"), F.lit(1).cast("long").alias("position"), F.col("digest").alias("subroot"), "root", "path")
    ways = _ways(rounds, mine)
    own = numbered.withColumn("chunk", _chunk()).groupBy("tree", "chunk")
    above = ways.withColumn("chunk", F.col("position") - 1).groupBy("tree", "chunk")
    return own.cogroup(above).applyInArrow(_proofs, PROOFS)


def manifest_rows(docs: DataFrame) -> DataFrame:
    """The contract's rows: the manifest of ``documents``, checked after tampering with n_chars.

    NULL fields and empty texts have digests of their own; a row without doc_id is not tampered with;
    other columns are not read; an empty table gives no rows.  Texts are hashed where they are read and
    never shuffled."""
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    tampered = leaf_digest(*columns[:3], F.try_add(F.col("n_chars"), F.lit(1)), columns[4])
    leaf = leaf_digest(*columns)
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return verify(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").alias("part"), leaf.alias("leaf"), F.when(hit, tampered).otherwise(leaf).alias("found")))


def _sql_leaf(n_chars: str) -> str:
    fields = ["doc_id", "source", "lang", n_chars, "text"]
    parts = [f"coalesce(CAST(strlen(CAST({f} AS VARCHAR)) AS VARCHAR) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields]
    return f"sha256({' || '.join(parts)})"


SQL = f"""
WITH RECURSIVE table_of_crc AS (
SELECT list(c ORDER BY i) AS t FROM (
  SELECT i, list_reduce([CAST(i AS BIGINT), 1, 2, 3, 4, 5, 6, 7, 8], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))) AS c FROM range(256) r(i))),
leaves AS (
SELECT doc_id, lang, {_sql_leaf('n_chars')} AS leaf, {_sql_leaf('n_chars + 1')} AS bad,
       xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc FROM documents CROSS JOIN table_of_crc),
numbered AS (
SELECT doc_id, lang, leaf, CASE WHEN crc % 7 = 0 THEN bad ELSE leaf END AS found,
       row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
lower_nodes AS (
SELECT lang, 0 AS depth, idx, n, leaf AS h FROM numbered
UNION ALL SELECT lang, depth + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM lower_nodes WHERE n > 1 GROUP BY lang, depth, idx // 2, n),
subroots AS (
SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM lower_nodes WHERE n = 1),
upper_nodes AS (
SELECT 0 AS depth, idx, n, subroot AS h FROM subroots
UNION ALL SELECT depth + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM upper_nodes WHERE n > 1 GROUP BY depth, idx // 2, n),
lower_fold AS (
SELECT lang, idx AS leaf_idx, 0 AS depth, idx, n, found AS h, '' AS seen FROM numbered
UNION ALL SELECT f.lang, leaf_idx, f.depth + 1, f.idx // 2, (f.n + 1) // 2,
  sha256(CASE WHEN s.h IS NULL THEN f.h WHEN f.idx % 2 = 0 THEN f.h || s.h ELSE s.h || f.h END), seen || coalesce(s.h, '')
FROM lower_fold f LEFT JOIN lower_nodes s ON s.lang IS NOT DISTINCT FROM f.lang AND s.depth = f.depth AND s.idx = xor(f.idx, 1) WHERE f.n > 1),
upper_fold AS (
SELECT f.lang, leaf_idx, 0 AS depth, p.idx, p.n, f.h, f.seen FROM lower_fold f JOIN subroots p ON p.lang IS NOT DISTINCT FROM f.lang WHERE f.n = 1
UNION ALL SELECT f.lang, leaf_idx, f.depth + 1, f.idx // 2, (f.n + 1) // 2,
  sha256(CASE WHEN s.h IS NULL THEN f.h WHEN f.idx % 2 = 0 THEN f.h || s.h ELSE s.h || f.h END), seen || coalesce(s.h, '')
FROM upper_fold f LEFT JOIN upper_nodes s ON s.depth = f.depth AND s.idx = xor(f.idx, 1) WHERE f.n > 1)
SELECT doc_id, leaf, subroot, root, sha256(seen) AS proof_sha256, f.h AS folded_root, f.h = root AS verified
FROM numbered l JOIN upper_fold f ON f.lang IS NOT DISTINCT FROM l.lang AND f.leaf_idx = l.idx AND f.n = 1
JOIN subroots p ON p.lang IS NOT DISTINCT FROM l.lang CROSS JOIN (SELECT h AS root FROM upper_nodes WHERE n = 1)
"""
