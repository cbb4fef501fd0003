"""Word BPE by prefix-sharing traversal.

The distinct words of a block, sorted, are the leaves of their trie in depth-first order.  The walk
keeps one state per depth of the current path: the last token of the prefix's encoding and where that
token starts.  The last token of a longer prefix is the one suffix token that stays apart from the last
token before it, so words that share a prefix share its states."""

from __future__ import annotations

import json
import re
import struct
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from procurelytics.llm.common import bounded_batches, whole_text

VOCABULARY = "word_bpe_49k.json"
#: The library's pattern for words; what lies between is dropped.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_L = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_N = "0-9²³¹¼-¾"
_S = "\t-\r \u0085 "
_LATIN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")
_BEYOND = re.compile("[^\x00-ɏ]")
_ANY = regex.compile(PATTERN)
#: Last bytes of a token by which the lengths to try are looked up.
ENDING = 4
#: Words and token pairs a worker remembers, and characters it handles at a time.
REMEMBERED, PAIRS, BLOCK_CHARS = 400_000, 1_000_000, 2_000_000


def _lengths(tokens: dict[bytes, int]) -> dict[bytes, tuple[int, ...]]:
    """Lengths of the tokens by their last ENDING bytes, the longest first, and all shorter ones; where no
    token has an ending, only shorter tokens fit."""
    found: dict[bytes, set[int]] = {}
    for token in tokens:
        if len(token) >= ENDING:
            found.setdefault(token[-ENDING:], set(range(1, ENDING))).add(len(token))
    return {end: tuple(sorted(n, reverse=True)) for end, n in found.items()}


class WordBpe:
    """One vocabulary with what a worker remembers of it; results do not depend on the memory."""

    def __init__(self, vocabulary: str = VOCABULARY):
        import public_tokenizers

        with open(public_tokenizers.path(vocabulary), encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        plain_bytes = lambda token: bytes(byte_of[c] for c in token)
        self.inner, self.final = {}, {}
        for token, i in vocab.items():
            if token.endswith(end):
                self.final[plain_bytes(token[: -len(end)])] = i
            else:
                self.inner[plain_bytes(token)] = i
        self.inner_lengths, self.final_lengths = _lengths(self.inner), _lengths(self.final)
        self.rank, self.parts, self.made = {}, {}, {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            whole, pair = vocab[left + right], (vocab[left], vocab[right])
            self.rank[pair], self.parts[whole], self.made[whole] = rank, pair, rank
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.shown = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.known: dict[str, bytes] = {}
        self.apart: dict[tuple[int, int], bool] = {}

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether ``a`` followed by ``b`` is left as it is.  Merges are undone backwards, the later
        one first: a merge across the border that ranks before the one undone would have come first.
        Equal ranks go from left to right."""
        known = self.apart.get((a, b))
        if known is not None:
            return known
        key, limit, made = (a, b), len(self.rank) + 1, self.made
        while True:
            across = self.rank.get((a, b))
            if across is not None and across < limit:
                apart = False
                break
            made_a, made_b = made.get(a, -1), made.get(b, -1)
            if made_a < 0 and made_b < 0:
                apart = True
                break
            if made_a > made_b:
                limit, a = made_a, self.parts[a][1]
            else:
                limit, b = made_b + 1, self.parts[b][0]
        if len(self.apart) >= PAIRS:
            self.apart.clear()
        self.apart[key] = apart
        return apart

    def encode_words(self, words) -> dict[str, bytes]:
        """Encodings of distinct words by a depth-first walk over their trie.  A depth keeps two numbers;
        the encoding is read backwards from the end of a word, each token's start being the depth of the one before."""
        out, path, last, starts = {}, b"", [None], [0]
        inner, final, known, short = self.inner, self.final, self.apart.get, range(ENDING - 1, 0, -1)
        for word in sorted(words):  # code points sort as their bytes do
            raw = word.encode("utf-8")
            token = final.get(raw)
            if token is not None:  # a whole word comes first in every search
                out[word] = token.to_bytes(4, "little")
                continue
            size, shared = len(raw), min(len(raw) - 1, len(path))
            if raw[:shared] != path[:shared]:
                shared = 0
                while raw[shared] == path[shared]:
                    shared += 1
            del last[shared + 1 :], starts[shared + 1 :]
            get, lengths = inner.get, self.inner_lengths.get
            for depth in range(shared + 1, size + 1):
                if depth == size:
                    get, lengths = final.get, self.final_lengths.get
                # the longest token that ends here and stays apart from the one before it
                for n in lengths(raw[depth - ENDING : depth], short) if depth >= ENDING else short:
                    start = depth - n
                    if start < 0:
                        continue
                    token = get(raw[start:depth])
                    if token is None:
                        continue
                    if not start:
                        break
                    before = last[start]
                    if before is not None:
                        apart = known((before, token))
                        if self.stay_apart(before, token) if apart is None else apart:
                            break
                else:
                    token, start = None, 0
                last.append(token)
                starts.append(start)
            path, codes, at = raw[:-1], [], size
            while at and last[at] is not None:
                codes.append(last[at])
                at = starts[at]
            out[word] = struct.pack(f"<{len(codes)}I", *codes[::-1])
        return out

    def words(self, text: str) -> list[str]:
        """Words of text without special strings: composed, lower case, white space dropped."""
        text = unicodedata.normalize("NFC", text)
        text = text.lower() if "Σ" not in text else "".join(c.lower() for c in text)
        return (_ANY if _BEYOND.search(text) else _LATIN).findall(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """ids of each text as little-endian unsigned 32-bit integers."""
        split = [[(part, None) if i % 2 else (part, self.words(part)) for i, part in enumerate(self.split_special.split(t))] for t in texts]
        wanted = set().union(*(w for parts in split for _, w in parts if w))
        fresh = wanted.difference(self.known)
        if len(self.known) + len(fresh) > REMEMBERED:
            self.known.clear()
            fresh = wanted
        self.known.update(self.encode_words(fresh))
        get = self.known.__getitem__
        return [b"".join(self.special[p].to_bytes(4, "little") if w is None else b"".join(map(get, w)) for p, w in parts) for parts in split]

    def decode(self, ids: bytes) -> str:
        """The tokens of the ids, special ones too, joined by blanks: the file names no decoder."""
        return " ".join(map(self.shown.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_WORKER: dict[str, WordBpe] = {}


def _pieces(text: str):
    """A long text in parts cut at blanks, which no word crosses."""
    while len(text) > BLOCK_CHARS:
        cut = max(text.rfind(" ", 0, BLOCK_CHARS), text.rfind("\n", 0, BLOCK_CHARS))
        if cut <= 0:
            cut = min((c for c in (text.find(" ", BLOCK_CHARS), text.find("\n", BLOCK_CHARS)) if c > 0), default=0)
        if not cut:
            break
        yield text[:cut]
        text = text[cut:]
    yield text


def encode_decode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers) and decoded (the text of those ids).

    A NULL or empty text has no ids and decodes to the empty text; a NULL doc_id stays NULL;
    repeated rows each get a row; other columns are not read; an empty table gives no rows.
    Special strings inside texts become their ids, as the library does by default."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        bpe = _WORKER.get(vocabulary) or _WORKER.setdefault(vocabulary, WordBpe(vocabulary))

        def out(ids, texts):
            codes = bpe.encode(texts) if sum(map(len, texts)) <= BLOCK_CHARS else [b"".join(bpe.encode([p])[0] for p in _pieces(t)) for t in texts]
            decoded = [bpe.decode(c) for c in codes]
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(codes, pa.binary()), pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])

        for batch in batches:
            ids, texts, chars = [], [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                if texts and chars + len(text) > BLOCK_CHARS:
                    yield out(ids, texts)
                    ids, texts, chars = [], [], 0
                ids.append(doc)
                texts.append(text)
                chars += len(text)
            if texts:
                yield out(ids, texts)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text("text").alias("text"))
    return source.mapInArrow(run, "doc_id long, ids binary, decoded string")


def encoding_rows(docs: DataFrame) -> DataFrame:
    """The number of ids and digests of ids and decoded text."""
    return encode_decode(docs).select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
