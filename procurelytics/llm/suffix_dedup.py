"""Removal of repeated byte strings by longest-previous-factor arrays.

A position is removed if the LENGTH bytes that cover it also start in a document with a smaller id.
Sorting all positions of a corpus is not needed: only windows whose least hashed word of WORD bytes
(their anchor, which equal windows share) occurs twice can be equal.

1. Texts are dealt out in chunks.  Each chunk sends, per hash range, the fingerprints of its anchors.
2. Each range answers with a bit per fingerprint: whether it occurs in more than one place.
3. Each chunk cuts the runs of windows that have a repeated anchor, and sends every distinct run once
   with the least document that holds it.
4. Each anchor range sorts the windows of its runs in suffix order.  In that order equal windows are
   neighbours: the previous or next smaller document within a stretch of common prefixes of at least
   LENGTH bytes exists exactly where the longest previous factor reaches LENGTH.  The answer is the
   least document per window.
5. Each chunk marks the windows with a smaller document and removes the bytes they cover."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F, types as T

from procurelytics.llm.common import bounded_batches, give_back

LENGTH, WORD = 50, 24
#: Bytes of text that one chunk is meant to hold, and bytes that are scanned at a time.
CHUNK_BYTES, SCAN_BYTES = 12_000_000, 1 << 18
#: Windows that one run may have; longer runs are cut.
RUN_WINDOWS = 4096
#: Windows around an anchor that more chunks than this hold are dealt out one by one, by content.
MANY_CHUNKS = 256
#: Windows that are sorted at a time, unless one anchor has more.
SORTED_WINDOWS = 250_000
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _anchors(raw: np.ndarray) -> np.ndarray:
    """Of each window: the least hash of its words (equal windows have equal anchors)."""
    n = len(raw) - WORD + 1
    with np.errstate(over="ignore"):
        eight = np.lib.stride_tricks.as_strided(raw, (len(raw) - 7, 8), (1, 1)).copy().view("<u8").reshape(-1)
        h = eight[:n] * _M1
        h ^= h >> np.uint64(29)
        h += eight[8 : 8 + n]
        h *= _M2
        h ^= h >> np.uint64(32)
        h += eight[16 : 16 + n]
        h *= _M3
        h ^= h >> np.uint64(30)
        h *= _M1
        h ^= h >> np.uint64(31)
    # least of `words` neighbours by doubling
    words, width = LENGTH - WORD + 1, 1
    while width * 2 <= words:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    if width < words:
        h = np.minimum(h[: len(h) - (words - width)], h[words - width :])
    return h


def _runs(raw: np.ndarray):
    """(first window, windows, anchor) of the maximal runs of windows with one anchor."""
    starts, counts, anchors = [], [], []
    for at in range(0, len(raw) - LENGTH + 1, SCAN_BYTES):
        part = raw[at : at + SCAN_BYTES + LENGTH - 1]
        if len(part) < LENGTH:
            break
        a = _anchors(part)
        first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
        size = np.diff(np.append(first, len(a)))
        if size.max() > RUN_WINDOWS:
            pieces = [(f + k, min(RUN_WINDOWS, s - k)) for f, s in zip(first, size) for k in range(0, s, RUN_WINDOWS)]
            first, size = np.array([p[0] for p in pieces]), np.array([p[1] for p in pieces])
        starts.append(first + at)
        counts.append(size)
        anchors.append(a[first])
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(starts), np.concatenate(counts), np.concatenate(anchors)


def _chosen(table: pa.Table) -> list[int]:
    """Rows of a chunk in id order; of rows that repeat an id the one with the least digest."""
    ids, raws = table.column("doc_id").to_pylist(), table.column("raw")
    best: dict[int, int] = {}
    for i, doc in enumerate(ids):
        if doc not in best or _digest(raws[i]) < _digest(raws[best[doc]]):
            best[doc] = i
    return [best[doc] for doc in sorted(best)]


def _digest(raw) -> bytes:
    return hashlib.sha256(raw.as_buffer()).digest()


def _scan(table: pa.Table, copies: pa.Table):
    """Documents of a chunk in id order with their runs, without those equal to an earlier one."""
    ids, raws, skipped = table.column("doc_id"), table.column("raw"), set(copies.column("copy").to_pylist())
    for i in _chosen(table):
        doc, raw = ids[i].as_py(), np.frombuffer(raws[i].as_buffer(), np.uint8)
        if len(raw) >= LENGTH and doc not in skipped:
            yield doc, raw, _runs(raw)


def _ranges(anchors: np.ndarray, n: int) -> np.ndarray:
    """The hash range of an anchor.  Least hashes are small, so they are mixed first."""
    with np.errstate(over="ignore"):
        return ((anchors * _M2) >> np.uint64(40)) % np.uint64(n)


def _prints(anchors: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((anchors * _M3) >> np.uint64(32)).astype(np.uint32)


def _least_documents(windows: np.ndarray, document: np.ndarray) -> np.ndarray:
    """Of windows (bytes) in suffix order: the least document among those with LENGTH common bytes."""
    padded = np.zeros((len(windows), 56), np.uint8)
    padded[:, :LENGTH] = windows
    keys = padded.view(">u8").astype(np.uint64)
    order = np.lexsort([document, *(keys[:, i] for i in range(6, -1, -1))])
    ranked = keys[order]
    # the common prefix with the one before is shorter than LENGTH: a stretch begins
    begins = np.flatnonzero(np.concatenate([[True], (ranked[1:] != ranked[:-1]).any(1)]))
    least = np.minimum.reduceat(document[order], begins)
    out = np.empty(len(windows), np.int64)
    out[order] = np.repeat(least, np.diff(np.append(begins, len(windows))))
    return out


def _listed(chunk: pa.Table, copies: pa.Table, ranges: int):
    """A chunk's distinct anchors ordered by range and fingerprint, where each range begins, and
    which of them two of its documents share."""
    seen = [np.unique(anchors) for _, _, (_, _, anchors) in _scan(chunk, copies)]
    every, count = np.unique(np.concatenate(seen or [np.empty(0, np.uint64)]), return_counts=True)
    where = _ranges(every, ranges)
    order = np.lexsort([_prints(every), where])
    return every[order], np.searchsorted(where[order], np.arange(ranges + 1)), count[order] > 1


def _table(rows, names: str, kinds) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    give_back()
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names.split())


_INT, _LONG, _BINARY = pa.int32(), pa.int64(), pa.binary()


def _pack(bits: np.ndarray) -> bytes:
    return np.packbits(bits).tobytes()


def _unpack(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).astype(bool)


def _bytes(text: str):
    """The UTF-8 bytes of a text column; NULL is empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("raw")


def _removed(named: DataFrame, shown, schema) -> DataFrame:
    """Steps 1 to 5 on rows (doc_id, raw) with ids, which may carry more columns: what ``shown`` makes of a
    chunk's rows and of its documents (doc_id, n_bytes, n_removed, n_spans, kept).  Rows are dealt out
    once, for all steps."""
    spark = named.sparkSession
    bounded_batches(spark)
    total = named.agg(F.sum(F.length("raw"))).collect()[0][0] or 0
    chunks = max(2 * spark.sparkContext.defaultParallelism, math.ceil(total / CHUNK_BYTES))
    chunk = F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).cast("int").alias("chunk")
    digests = named.select("doc_id", F.sha2("raw", 256).alias("d")).groupBy("doc_id").agg(F.min("d").alias("d"))
    firsts = digests.groupBy("d").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    same = digests.join(firsts, "d").where("first < doc_id").select(F.col("doc_id").alias("copy"), chunk.alias("at"))
    dealt = named.select("*", chunk).groupBy("chunk")

    def mark(key, table: pa.Table, same: pa.Table) -> pa.Table:
        """Step 1."""
        every, bounds, twice = _listed(table, same, chunks)
        prints, number = _prints(every), key[0].as_py()
        return _table([(r, number, prints[a:b].tobytes(), _pack(twice[a:b])) for r, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])) if b > a],
                      "range chunk prints twice", (_INT, _INT, _BINARY, _BINARY))

    def answer(table: pa.Table) -> pa.Table:
        """Step 2: for each list, which fingerprints are repeated and which many chunks hold."""
        lists = [np.frombuffer(p.as_py(), np.uint32) for p in table.column("prints")]
        _, where, count = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        out, at = [], 0
        for number, r, one, twice in zip(table.column("chunk").to_pylist(), table.column("range").to_pylist(), lists, table.column("twice")):
            held = count[where[at : at + len(one)]]
            out.append((number, r, _pack((held > 1) | _unpack(twice.as_py(), len(one))), _pack(held > MANY_CHUNKS)))
            at += len(one)
        return _table(out, "chunk range repeated many", (_INT, _INT, _BINARY, _BINARY))

    def cut(key, table: pa.Table, other: pa.Table) -> pa.Table:
        """Step 3: the distinct runs with repeated anchors, by range."""
        same = other.filter(pa.compute.is_valid(other.column("copy"))) if other.num_rows else other
        answers = other.filter(pa.compute.is_valid(other.column("range"))) if other.num_rows else other
        every, bounds, _ = _listed(table, same, chunks)
        repeated, many = np.zeros(len(every), bool), np.zeros(len(every), bool)
        for r, one, two in zip(answers.column("range").to_pylist(), answers.column("repeated"), answers.column("many")):
            a, b = bounds[r], bounds[r + 1]
            repeated[a:b], many[a:b] = _unpack(one.as_py(), b - a), _unpack(two.as_py(), b - a)
        held, common = np.sort(every[repeated]), np.sort(every[repeated & many])
        runs: dict[int, tuple[dict, list, list]] = {}
        if len(held):
            for doc, raw, (starts, counts, anchors) in _scan(table, same):
                hit = held[np.minimum(np.searchsorted(held, anchors), len(held) - 1)] == anchors
                starts, counts, anchors = starts[hit], counts[hit], anchors[hit]
                if len(common):
                    apart = common[np.minimum(np.searchsorted(common, anchors), len(common) - 1)] == anchors
                    for s in (x for a, n in zip(starts[apart].tolist(), counts[apart].tolist()) for x in range(a, a + n)):
                        one = raw[s : s + LENGTH].tobytes()
                        mixed = int.from_bytes(hashlib.blake2b(one, digest_size=8).digest(), "little")
                        known, keys, holders = runs.setdefault(mixed % chunks, ({}, [], []))
                        k = known.setdefault(one, len(known))
                        if k == len(keys):
                            keys.append((mixed >> 1, doc))
                        holders.append((k, doc, s))
                    starts, counts, anchors = starts[~apart], counts[~apart], anchors[~apart]
                for s, n, r, a in zip(starts.tolist(), counts.tolist(), _ranges(anchors, chunks).tolist(), (anchors >> np.uint64(1)).tolist()):
                    known, keys, holders = runs.setdefault(r, ({}, [], []))
                    one = raw[s : s + n + LENGTH - 1].tobytes()
                    # documents come in id order: the first holder of a run is the least
                    k = known.setdefault(one, len(known))
                    if k == len(keys):
                        keys.append((a, doc))
                    holders.append((k, doc, s))
        number = key[0].as_py()
        return _table([(r, number, list(known), np.array(keys, "<i8").tobytes(), np.array(holders, "<i8").tobytes()) for r, (known, keys, holders) in runs.items()],
                      "range chunk runs keys holders", (_INT, _INT, pa.list_(_BINARY), _BINARY, _BINARY))

    def settle(table: pa.Table) -> pa.Table:
        """Step 4 of one range: removed stretches (document, first window, windows) per chunk."""
        runs, least, anchor, place = {}, [], [], []
        for texts, keys in zip(table.column("runs"), table.column("keys")):
            here = []
            for one, (a, doc) in zip(texts.as_py(), np.frombuffer(keys.as_py(), "<i8").reshape(-1, 2).tolist()):
                k = runs.setdefault(one, len(runs))
                if k == len(least):
                    least.append(doc)
                    anchor.append(a)
                least[k] = min(least[k], doc)
                here.append(k)
            place.append(np.array(here, np.int64))
        texts, least, anchor = list(runs), np.array(least, np.int64), np.array(anchor, np.int64)
        sizes = np.array([len(t) - LENGTH + 1 for t in texts], np.int64)
        # a run alone with its anchor has no equal windows in others: its least document counts throughout
        smallest, lowest = [None] * len(texts), least.copy()
        _, group, members = np.unique(anchor, return_inverse=True, return_counts=True)
        order = np.flatnonzero(members[group] > 1)
        order = order[np.argsort(anchor[order], kind="stable")]
        # equal windows share the anchor, so runs are sorted a few anchors at a time
        last = np.flatnonzero(np.append(anchor[order][1:] != anchor[order][:-1], True)) + 1 if len(order) else order
        filled, a = np.cumsum(sizes[order]), 0
        while a < len(order):
            b = int(last[max(np.searchsorted(filled[last - 1], (filled[a - 1] if a else 0) + SORTED_WINDOWS, side="right") - 1, np.searchsorted(last, a, side="right"))])
            part = order[a:b]
            views = np.concatenate([np.lib.stride_tricks.sliding_window_view(np.frombuffer(texts[k], np.uint8), LENGTH) for k in part])
            found = np.split(_least_documents(views, np.repeat(least[part], sizes[part])), np.cumsum(sizes[part])[:-1])
            for k, f in zip(part.tolist(), found):
                smallest[k], lowest[k] = f, f.min()
            a = b
        out = []
        for number, here, blob in zip(table.column("chunk").to_pylist(), place, table.column("holders")):
            held = np.frombuffer(blob.as_py(), "<i8").reshape(-1, 3)
            run, doc = here[held[:, 0]], held[:, 1]
            whole = least[run] < doc
            gone = [np.column_stack([doc[whole], held[whole, 2], sizes[run[whole]]])]
            for i in np.flatnonzero(~whole & (lowest[run] < doc)).tolist():
                hit = smallest[run[i]] < doc[i]
                edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
                gone.append(np.column_stack([np.full(len(edge) // 2, doc[i]), held[i, 2] + edge[::2], edge[1::2] - edge[::2]]))
            out.append((number, np.concatenate(gone).astype("<i8").tobytes()))
        return _table(out, "chunk gone", (_INT, _BINARY))

    def remove(table: pa.Table, other: pa.Table) -> pa.Table:
        """Step 5 of one chunk."""
        found = np.concatenate([np.empty((0, 3), np.int64), *(np.frombuffer(g.as_py(), "<i8").reshape(-1, 3) for g in other.column("gone") if g.is_valid)])
        found = found[np.argsort(found[:, 0], kind="stable")]
        copied = set(other.column("copy").to_pylist()) - {None}
        ids, raws, out = table.column("doc_id"), table.column("raw"), []
        for i in _chosen(table):
            doc, raw = ids[i].as_py(), np.frombuffer(raws[i].as_buffer(), np.uint8)
            if doc in copied and len(raw) >= LENGTH:
                out.append((doc, len(raw), len(raw), 1, b""))
                continue
            a, b = np.searchsorted(found[:, 0], [doc, doc + 1])
            if a == b:
                out.append((doc, len(raw), 0, 0, raw.tobytes()))
                continue
            step = np.zeros(len(raw) + 1, np.int64)
            np.add.at(step, found[a:b, 1], 1)
            np.add.at(step, found[a:b, 1] + found[a:b, 2] + LENGTH - 1, -1)
            covered = np.cumsum(step[:-1]) > 0
            spans = int(np.count_nonzero(covered[1:] & ~covered[:-1])) + int(covered[0])
            out.append((doc, len(raw), int(covered.sum()), spans, raw[~covered].tobytes()))
        return shown(table, out)

    marks = dealt.cogroup(same.groupBy("at")).applyInArrow(mark, "range int, chunk int, prints binary, twice binary")
    answers = marks.groupBy("range").applyInArrow(answer, "chunk int, range int, repeated binary, many binary")
    runs = dealt.cogroup(answers.withColumnRenamed("chunk", "at").unionByName(same, allowMissingColumns=True).groupBy("at")).applyInArrow(cut, "range int, chunk int, runs array<binary>, keys binary, holders binary")
    gone = runs.groupBy("range").applyInArrow(settle, "chunk int, gone binary")
    return dealt.cogroup(gone.withColumnRenamed("chunk", "at").unionByName(same, allowMissingColumns=True).groupBy("at")).applyInArrow(remove, schema)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): the UTF-8 bytes of each whole text without those
    covered by a LENGTH-byte string that also starts in a document with a smaller id.

    NULL and empty texts, and texts shorter than LENGTH bytes, stay as they are.  Rows that repeat an
    id give one row, of which the text with the least SHA-256 counts.  Rows without id have no order:
    they neither remove nor lose anything and keep a row each.  Other columns are not read; an empty
    table gives no rows.

    A text equal to one with a smaller id is settled without a scan, by digest: all of it goes if it
    has LENGTH bytes.  Documents are dealt out by id, so a large group of copies is spread; a run held
    by many documents is sent once per chunk.  Windows around a word that very many chunks hold are
    dealt out by their own content instead of by that word."""

    def shown(table: pa.Table, out: list) -> pa.Table:
        return _table(out, "doc_id n_bytes n_removed n_spans kept", (_LONG, _LONG, _LONG, _LONG, _BINARY))

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), _bytes(text))
    done = _removed(rows.where("doc_id is not null"), shown, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    zero = F.lit(0).cast("long")
    return done.unionByName(rows.where("doc_id is null").select("doc_id", F.length("raw").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.col("raw").alias("kept")))


def repeat_rows(docs: DataFrame) -> DataFrame:
    """What was removed per document and a digest of what is left."""
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated passages taken out of text and n_chars set to match; documents of
    which only white space is left go.  A character that was cut in part goes as a whole.  A text of
    which nothing is removed, NULL or empty too, stays as it is, as do rows without id; rows that
    repeat an id share one text."""

    def shown(table: pa.Table, out: list) -> pa.Table:
        left = {doc: kept.decode("utf-8", "ignore") for doc, _, removed, _, kept in out if removed}
        texts = pa.array([left.get(doc) for doc in table.column("doc_id").to_pylist()], pa.string())
        give_back()
        return table.select(["doc_id", "raw", "missing", "row"]).append_column("left", texts)

    # all columns go along with the one shuffle of the texts: a join would send every text once more
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    named = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), _bytes("text"), F.col("text").isNull().alias("missing"), row)
    found = _removed(named, shown, T.StructType([*named.schema.fields, T.StructField("left", T.StringType())]))
    found = found.where(F.col("left").isNull() | F.col("left").rlike(r"[^\x20\x09-\x0D]")).sortWithinPartitions("doc_id")
    own = {"text": F.when(~F.col("missing"), F.col("raw").cast("string"))} | {c: F.col(f"row.`{c}`") for c in docs.columns if c != "text"}
    changed = {"text": F.col("left"), "n_chars": F.length("left").cast("bigint")}
    out = found.select(*[(F.when(F.col("left").isNotNull(), changed[c]).otherwise(own[c]) if c in changed else own[c]).alias(c) for c in docs.columns])
    return out.unionByName(docs.where("doc_id is null"))
