"""Packing token sequences with minimum bin slack.

Documents are cut into full windows and one remainder.  Each task packs the remainders of its own
partition in blocks of BLOCK pieces: from the counts of the lengths that are left, a bitset
subset-sum finds the multiset that fills a window closest to capacity, the choice is backtracked and
repeated as often as the counts allow.  Nothing is shuffled and a task holds one block of ids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from procurelytics.llm.common import bounded_batches, giving_back, whole_text
from procurelytics.llm.tokens import byte_encoder

CAPACITY = 1024
#: What ends every document.
END_ID = 0
#: Remainders that are packed together; more leave less padding at the end of a block.
BLOCK = 8192
SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
OUT = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of the given lengths that comes closest to ``capacity`` and holds the longest
    length left: a bit per reachable sum, counts taken in powers of two, then backtracked."""
    longest = max(counts)
    room, reach, steps = capacity - longest, 1, []
    for length in sorted(counts, reverse=True):
        if length > room:
            continue
        left, take = min(counts[length] - (length == longest), room // length), 1
        while left > 0:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= reach << (length * take)
            left, take = left - take, take * 2
        if reach >> room & 1:
            break
    reach &= (1 << (room + 1)) - 1
    total, chosen = reach.bit_length() - 1, {longest: 1}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen


def fill_windows(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[int], list[int], int]:
    """Sequence number and offset of each piece, and the number of sequences."""
    waiting: dict[int, list[int]] = {}
    for i, length in enumerate(lengths):
        waiting.setdefault(length, []).append(i)
    counts = {length: len(w) for length, w in waiting.items()}
    sequence, offset, n = [0] * len(lengths), [0] * len(lengths), 0
    while counts:
        chosen = _fill(counts, capacity)
        for _ in range(min(counts[k] // c for k, c in chosen.items())):
            at = 0
            for length in sorted(chosen, reverse=True):
                for _ in range(chosen[length]):
                    i = waiting[length].pop()
                    sequence[i], offset[i], at = n, at, at + length
            n += 1
        for length in chosen:
            counts[length] = len(waiting[length])
            if not counts[length]:
                del counts[length]
    return sequence, offset, n


def pack(docs: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` ids.

    One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset.  A NULL or empty text is one piece that holds the end id alone; a NULL
    doc_id stays NULL; repeated rows are packed as separate documents; other columns are not read;
    an empty table gives no rows.  A sequence number carries its partition in the upper bits, so a
    task that runs again gives the same rows."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        encode = byte_encoder()
        base, made = TaskContext.get().partitionId() << 40, 0
        rest, out = [], []

        def frame(rows):
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), SCHEMA)], schema=SCHEMA)

        def placed():
            nonlocal made
            sequence, offset, n = fill_windows([r[2] for r in rest], capacity)
            rows = [(*r, base + made + q, o) for r, q, o in zip(rest, sequence, offset)]
            made += n
            rest.clear()
            return frame(rows)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py()), np.uint32(END_ID))
                for start in range(0, len(ids), capacity):
                    part = ids[start : start + capacity]
                    row = (doc, start, len(part), part.astype("<u4").tobytes(), len(ids))
                    if len(part) < capacity:
                        rest.append(row)
                    else:
                        out.append((*row, base + made, 0))
                        made += 1
                if len(out) >= 4000:
                    yield frame(out)
                    out = []
                if len(rest) >= block:
                    yield placed()
        if out:
            yield frame(out)
        if rest:
            yield placed()

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text("text").alias("text"))
    return source.mapInArrow(giving_back(run), OUT)


def packing_rows(docs: DataFrame) -> DataFrame:
    """The packed pieces with a checksum of their ids."""
    return pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
