"""Byte-level BPE: pre-tokens, their pieces, and token counts.

Counting: the pieces of a pre-token are counted once per distinct pre-token of the corpus and
multiplied into the per-document frequencies; no ids are made."""

from __future__ import annotations

import re
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from procurelytics.llm.common import bounded_batches, whole_text

VOCABULARY = "byte_bpe_50k.json"
END_OF_TEXT, END_OF_TEXT_ID = "<|endoftext|>", 50256
#: The library's pre-token pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts whose characters are all below U+0250: letters and numbers are listed by range.
_L = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_N = "0-9²³¹¼-¾"
_S = "\t-\r \u0085 "
_LATIN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_BEYOND = re.compile("[^\x00-ɏ]")
_ANY = regex.compile(PATTERN)


#: Longer texts are cut into pre-tokens step by step.
LONG = 4_000_000


def pre_tokens(text: str):
    pattern = _ANY if _BEYOND.search(text) else _LATIN
    return pattern.findall(text) if len(text) <= LONG else (m.group() for m in pattern.finditer(text))


def split_special(text: str) -> list[str]:
    """Text between the library's special string, which it finds inside texts by default."""
    return text.split(END_OF_TEXT)


def _ranks(vocabulary: str):
    """Merge ranks by bytes, from the vocabulary file."""
    import json

    import public_tokenizers

    with open(public_tokenizers.path(vocabulary), encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    return {bytes(byte_of[c] for c in token): i for token, i in vocab.items()}


_ENCODERS: dict = {}


def _encoding(vocabulary: str):
    """One encoder per worker."""
    if vocabulary not in _ENCODERS:
        import tiktoken

        _ENCODERS[vocabulary] = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=_ranks(vocabulary), special_tokens={})
    return _ENCODERS[vocabulary]


#: Runs of white space from this length on are too deep for the library's pattern matcher.
DEEP_RUN = 100_000
_DEEP = re.compile(r"\s{%d}" % DEEP_RUN)


def _ids_of(encoding, text: str) -> bytes:
    """The ids of a text without special strings."""
    if len(text) < DEEP_RUN or not _DEEP.search(text):
        return array("I", encoding.encode_ordinary(text)).tobytes()
    return b"".join(array("I", encoding._encode_single_piece(piece.encode("utf-8"))).tobytes() for piece in pre_tokens(text))


def byte_encoder(vocabulary: str = VOCABULARY):
    """text -> ids (uint32); nothing is kept between texts."""
    encoding = _encoding(vocabulary)
    end = END_OF_TEXT_ID.to_bytes(4, "little")

    def encode(text: str) -> np.ndarray:
        return np.frombuffer(end.join(_ids_of(encoding, part) for part in split_special(text)), dtype="<u4")

    return encode


#: A chunk of documents that share one set of postings; positions in it fit 16 bits.
CHUNK_CHARS, CHUNK_DOCS = 24_000_000, 60_000
#: Document sums one task holds before it hands them on.
HELD_SUMS = 4_000_000
_POSTING = np.dtype([("doc", "<u2"), ("n", "<u2")])


def _pairs(docs: np.ndarray, n: np.ndarray) -> bytes:
    """(document, number) pairs of 16 bits each; a larger number takes several pairs."""
    parts = []
    while len(docs):
        pair = np.empty(len(docs), _POSTING)
        pair["doc"], pair["n"] = docs, np.minimum(n, 65535)
        parts.append(pair.tobytes())
        n = n - np.minimum(n, 65535)
        docs, n = docs[n > 0], n[n > 0]
    return b"".join(parts)


def _frequencies(batches):
    """Rows (pre-token, chunk, postings); the empty pre-token carries the chunk's documents."""
    base, number = TaskContext.get().partitionId() << 32, 0
    ids, sizes, chars, postings = [], [], 0, {}

    def rows():
        chunk = base + number
        tokens, blobs = [b""], [np.array([[-1 if i is None else i, i is None, s] for i, s in zip(ids, sizes)], "<i8").tobytes()]
        for token, flat in postings.items():
            tokens.append(token.encode("utf-8"))
            blobs.append(array("I", flat).tobytes())
            if len(tokens) == 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.binary()), pa.array([chunk] * len(tokens), pa.int64()), pa.array(blobs, pa.binary())], names=["token", "chunk", "postings"])
                tokens, blobs = [], []
        if tokens:
            yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.binary()), pa.array([chunk] * len(tokens), pa.int64()), pa.array(blobs, pa.binary())], names=["token", "chunk", "postings"])

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text, at = text.as_py(), len(ids)
            ids.append(doc)
            sizes.append(len(text.encode("utf-8")))
            chars += len(text)
            parts = split_special(text)
            counts = Counter()
            for part in parts:
                counts.update(pre_tokens(part))
            if len(parts) > 1:
                counts[END_OF_TEXT] += len(parts) - 1
            for token, n in counts.items():
                known = postings.get(token)
                if known is None:
                    known = postings[token] = []
                while n > 65535:  # a pair holds 16 bits of each number
                    known.append(at | 65535 << 16)
                    n -= 65535
                known.append(at | n << 16)
            if chars >= CHUNK_CHARS or len(ids) >= CHUNK_DOCS:
                yield from rows()
                number += 1
                ids, sizes, chars, postings = [], [], 0, {}
    if ids:
        yield from rows()


def _weighted(vocabulary: str):
    """Over rows sorted by pre-token: pieces counted once per distinct one, times its postings."""

    def run(batches):
        encoding = _encoding(vocabulary)
        last, pieces, held, sums = None, 0, 0, {}

        def out():
            chunks, blobs = [], []
            for chunk, total in sums.items():
                docs = np.flatnonzero(total)
                chunks.append(chunk)
                blobs.append(_pairs(docs, total[docs]))
            return pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), pa.array([False] * len(chunks)), pa.array(blobs, pa.binary())], names=["chunk", "is_docs", "data"])

        for batch in batches:
            docs_rows = []
            for token, chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                blob = blob.as_py()
                if not token:
                    docs_rows.append((chunk, blob))
                    continue
                if token != last:
                    last = token
                    pieces = 1 if token == END_OF_TEXT.encode() else len(encoding._encode_single_piece(token))
                pair = np.frombuffer(blob, _POSTING)
                total, top = sums.get(chunk), int(pair["doc"].max()) + 1
                if total is None or len(total) < top:
                    grown = np.zeros(max(top, 1024 if total is None else 2 * len(total)), np.int64)
                    held += len(grown)
                    if total is not None:
                        grown[: len(total)] = total
                        held -= len(total)
                    total = sums[chunk] = grown
                np.add.at(total, pair["doc"], pair["n"].astype(np.int64) * pieces)
            if docs_rows:
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in docs_rows], pa.int64()), pa.array([True] * len(docs_rows)), pa.array([b for _, b in docs_rows], pa.binary())], names=["chunk", "is_docs", "data"])
            if held > HELD_SUMS:
                yield out()
                held, sums = 0, {}
        if sums:
            yield out()

    return run


def _totals(table: pa.Table) -> pa.Table:
    """One chunk: its documents with the sums of their pieces."""
    is_docs, data = table.column("is_docs").to_pylist(), table.column("data")
    docs = np.frombuffer(next(d.as_py() for k, d in zip(is_docs, data) if k), "<i8").reshape(-1, 3)
    total = np.zeros(len(docs), np.int64)
    for k, d in zip(is_docs, data):
        if not k:
            pair = np.frombuffer(d.as_py(), _POSTING)
            np.add.at(total, pair["doc"], pair["n"].astype(np.int64))
    return pa.table([pa.array(docs[:, 0], mask=docs[:, 1] == 1), pa.array(docs[:, 2]), pa.array(total)], names=["doc_id", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every whole text.

    Per chunk of documents, a pre-token carries the list of (document, frequency) pairs.  All lists
    of a pre-token meet in one task, which counts its pieces once and multiplies; a frequent
    pre-token has one row per chunk, not one per document.  The sums go back to their chunk.  A NULL
    or empty text has no tokens; a NULL doc_id stays NULL; repeated rows each get a row; other
    columns are not read; an empty table gives no rows."""
    bounded_batches(docs.sparkSession, 10_000)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text("text").alias("text"))
    postings = source.mapInArrow(_frequencies, "token binary, chunk long, postings binary")
    by_token = postings.repartition(F.when(F.col("token") == F.lit(b""), F.col("chunk")).otherwise(F.xxhash64("token"))).sortWithinPartitions("token")
    sums = by_token.mapInArrow(_weighted(vocabulary), "chunk long, is_docs boolean, data binary")
    return sums.groupBy("chunk").applyInArrow(_totals, "doc_id long, n_bytes long, n_tokens long")


def token_rows(docs: DataFrame, limit: int = 1024) -> DataFrame:
    return count_tokens(docs).withColumn("over_limit", F.col("n_tokens") > limit)
