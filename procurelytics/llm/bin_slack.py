"""Packing whole documents into as few sequences as possible by minimum bin slack.

Only lengths matter to a packing, and there are at most ``capacity`` of them.  So the lengths of all pieces
are counted, one task fills bin after bin from these counts (the longest piece left, and the set of
others that a bitset of reachable sums shows to come closest to the capacity), and a bin is repeated as
often as the counts allow.  The plan says, per length, which ranks go to which bins; a piece's rank among those
of its length is its place in its task plus the number in the tasks before it.  Texts are read once."""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from procurelytics.llm.common import bounded_batches, whole_text
from procurelytics.llm.tokens import byte_encoder
from procurelytics.session import cut_lineage

CAPACITY = 2048
#: What ends every document.
END_ID = 0
#: Bytes of ids of one Arrow batch.
BATCH_BYTES = 8_000_000


# --- bins ---------------------------------------------------------------------------------
def fullest_bin(counts: dict[int, int], capacity: int) -> list[tuple[int, int]]:
    """(length, number) of the fullest bin that holds the longest piece left.  Bit s of ``sums`` says
    that pieces looked at so far can fill s; a length counts in doubling steps up to what is there.
    Backtracking leaves a length out wherever longer ones reach the same sum."""
    longest = max(counts)
    room = capacity - longest
    mask, sums, trail = (1 << (room + 1)) - 1, 1, []
    for length in sorted(counts, reverse=True):
        there = min(counts[length] - (length == longest), room // length)
        step = 1
        while there and not sums >> room & 1:
            step = min(step, there)
            trail.append((sums, length, step))
            sums |= sums << length * step & mask
            there, step = there - step, step * 2
    fill, chosen = sums.bit_length() - 1, {longest: 1}
    for before, length, step in reversed(trail):
        if not before >> fill & 1:
            chosen[length] = chosen.get(length, 0) + step
            fill -= length * step
    return sorted(chosen.items(), reverse=True)


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank behind the last, number a bin, first bin, offset of the first of them) for
    all pieces.  Ranks of a length count from 0.  A repeated bin uses a length up, or nearly, so there
    are at most a few bins per length that differ, whatever the counts."""
    left, used, bins, plan = {k: n for k, n in counts.items() if n}, dict.fromkeys(counts, 0), 0, []
    while left:
        chosen = fullest_bin(left, capacity)
        times, at = min(left[length] // n for length, n in chosen), 0
        for length, n in chosen:
            plan.append((length, used[length], used[length] + n * times, n, bins, at))
            used[length] += n * times
            at += length * n
            left[length] -= n * times
            if not left[length]:
                del left[length]
        bins += times
    return plan


# --- rows -----------------------------------------------------------------------------------
PIECES = "doc_id long, piece int, start long, length long, ids binary, ids_crc32 long, doc_tokens long, task long, place long"
_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                     ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("task", pa.int64()), ("place", pa.int64())])


def pieces(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document: one, or several of ``capacity`` ids of which the first may be shorter.
    ``ids`` are little-endian unsigned 16-bit numbers, which hold this vocabulary; ``ids_crc32`` is the checksum of
    the same ids as 32-bit numbers.  ``place`` counts the pieces of the same length in the same task."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        encode, task = byte_encoder(), TaskContext.get().partitionId()
        places, out, held = {}, [], 0

        def frame():
            made = pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), _PIECES)], schema=_PIECES)
            out.clear()
            return made

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py()), np.uint32(END_ID)).astype("<u4")
                start = 0
                for piece in range(-(-len(ids) // capacity)):
                    length = (len(ids) - 1) % capacity + 1 if piece == 0 else capacity
                    places[length] = places.get(length, -1) + 1
                    own = ids[start : start + length]
                    out.append((doc, piece, start, length, own.astype("<u2").tobytes(), crc32(own.tobytes()), len(ids), task, places[length]))
                    start += length
                    held += length * 2
                if held >= BATCH_BYTES:
                    yield frame()
                    held = 0
        if out:
            yield frame()

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text("text").alias("text"))
    return source.mapInArrow(run, PIECES)


_PLAN = "length long, low long, high long, number long, bin long, at long"


def _planned(capacity: int):
    def run(counts: pa.Table) -> pa.Table:
        rows = plan_bins(dict(zip(counts.column("length").to_pylist(), counts.column("n").to_pylist())), capacity)
        return pa.table({c.split()[0]: pa.array(list(v), pa.int64()) for c, v in zip(_PLAN.split(", "), zip(*rows))})

    return run


_STRETCH = pa.list_(pa.struct([(n, pa.int64()) for n in ("low", "high", "shift", "number", "bin", "at")]))
_STRETCHES = "length long, task long, stretches array<struct<low:long,high:long,shift:long,number:long,bin:long,at:long>>"


def _stretches(spans: pa.Table, plan: pa.Table) -> pa.Table:
    """One length: for every task the parts of the plan that its places fall in."""
    plan = plan.sort_by("low").to_pydict()
    lows, highs = np.array(plan["low"], np.int64), np.array(plan["high"], np.int64)
    tasks, out = spans.column("task"), []
    for first, n in zip(spans.column("first").to_pylist(), spans.column("n").to_pylist()):
        a, b = int(np.searchsorted(highs, first, "right")), int(np.searchsorted(lows, first + n, "left"))
        out.append([{"low": plan["low"][i] - first, "high": plan["high"][i] - first, "shift": first - plan["low"][i],
                     "number": plan["number"][i], "bin": plan["bin"][i], "at": plan["at"][i]} for i in range(a, b)])
    return pa.table({"length": spans.column("length"), "task": tasks, "stretches": pa.array(out, _STRETCH)})


def pack_whole(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pack all documents into as few sequences of at most ``capacity`` ids as the bins find.

    One row per piece: doc_id, piece, start, length, ids and ids_crc32 (see ``pieces``), doc_tokens,
    sequence_id, offset.  A NULL or empty text is one piece that holds the end id alone; a NULL doc_id
    stays NULL; repeated rows are packed as separate documents; other columns are not read; an empty
    table gives no rows.  The pieces are stored once: a task that runs again finds the same places."""
    stored = cut_lineage(pieces(docs, capacity))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    spans = stored.groupBy("length", "task").agg(F.count("*").alias("n")).withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    spans = cut_lineage(spans)
    plan = spans.groupBy("length").agg(F.sum("n").alias("n")).withColumn("all", F.lit(0)).groupBy("all").applyInArrow(_planned(capacity), _PLAN)  # at most ``capacity`` rows
    found = spans.groupBy("length").cogroup(plan.groupBy("length")).applyInArrow(_stretches, _STRETCHES)
    mine = F.filter("stretches", lambda s: (F.col("place") >= s["low"]) & (F.col("place") < s["high"]))
    rows = stored.join(found, ["length", "task"]).withColumn("_s", F.get(mine, F.lit(0)))
    rank = F.col("place") + F.col("_s.shift")
    return rows.select(
        "doc_id", "piece", "start", "length", "ids", "ids_crc32", "doc_tokens",
        (F.col("_s.bin") + F.floor(rank / F.col("_s.number"))).alias("sequence_id"),
        (F.col("_s.at") + rank % F.col("_s.number") * F.col("length")).alias("offset"),
    )


def bin_slack_rows(docs: DataFrame) -> DataFrame:
    """The packed pieces with the checksum of their ids; the ids themselves stay where they were stored."""
    return pack_whole(docs).drop("ids")
