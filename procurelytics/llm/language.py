"""Language by compression: one zstandard raw-content dictionary per language; the language whose
dictionary gives the smallest encoding wins, and narrow wins are rejected."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from procurelytics.llm.common import bounded_batches, giving_back, whole_text

UNKNOWN = "und"
#: Bound of the training sample: documents per language, and bytes of dictionary built from them.
SAMPLE_DOCS, DICTIONARY_BYTES = 64, 65_536
#: Whole texts are compressed in blocks of this size, so that the dictionary matters throughout.
BLOCK_BYTES, LEVEL = 4096, 6
#: A win by less than this share of the winner's size is narrow.
MIN_MARGIN = 0.02


_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """Lower-case letters; all else counts as a blank."""
    return _OTHER.sub(" ", text.lower())


def held_out(doc_id="doc_id"):
    """The rows that no training uses."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn_dictionaries(docs: DataFrame, docs_per_language: int = SAMPLE_DOCS, size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Language -> raw content, from a bounded sample of the labelled rows that are not held out:
    per language the ``docs_per_language`` rows whose ids hash lowest, each giving an equal share of
    at most ``size`` bytes.  Rows without id, text or language teach nothing.  Ids are ranked first
    (the rank limit prunes below the shuffle); only the chosen texts are read for the dictionaries."""
    labelled = docs.where(~held_out() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.length("text") > 0))
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    chosen = labelled.select("lang", "doc_id", F.xxhash64("doc_id").alias("h")).withColumn("r", F.row_number().over(order)).where(F.col("r") <= docs_per_language)
    share = size // docs_per_language
    ids = sorted({r["doc_id"] for r in chosen.select("doc_id").collect()})  # at most docs_per_language per language
    # at most docs_per_language * share characters per language reach the driver
    parts = labelled.where(F.col("doc_id").isin(ids)).groupBy("lang", "doc_id").agg(F.min(F.substring("text", 1, share)).alias("part"))
    texts: dict[str, list] = {}
    for row in parts.collect():
        texts.setdefault(row["lang"], []).append((row["doc_id"], letters(row["part"]).encode("utf-8")[:share]))
    return {lang: b"\n".join(p for _, p in sorted(found)[:docs_per_language]) for lang, found in sorted(texts.items())}


def identify(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and lang_accepted.

    A NULL text, a text without letter, and any text when nothing was learned are ``und`` with score
    0 and not accepted.  Ties go to the language that sorts first.  The score is the margin over the
    runner-up as a share of the runner-up's size (1 when only one language was learned).  One row out
    per row in; other columns pass through, apart from columns with the three added names, which are
    replaced; an empty table stays empty.  Blocks are compressed one at a time, so a long text needs
    no more memory than its own bytes."""
    bounded_batches(docs.sparkSession)
    added = ["lang_pred", "score", "lang_accepted"]
    names = [c for c in docs.columns if c not in added]
    out = docs.select(*[F.col(f"`{c}`") for c in names]).schema
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)  # bounded: see learn_dictionaries

    def run(batches):
        import zstandard

        coders = []
        for lang, raw in shared.value.items():
            known = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=LEVEL)
            coders.append((lang, zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False)))

        def judge(text):
            if text is None or not coders or not any(map(str.isalpha, text)):
                return UNKNOWN, 0.0, False
            raw = letters(text).encode("utf-8")
            blocks = [raw[i : i + BLOCK_BYTES] for i in range(0, len(raw), BLOCK_BYTES)]
            sizes = sorted((sum(len(coder.compress(b)) for b in blocks), lang) for lang, coder in coders)
            best, lang = sizes[0]
            score = 1.0 if len(sizes) == 1 else (sizes[1][0] - best) / sizes[1][0]
            return lang, score, score >= min_margin

        for batch in batches:
            found = [judge(t.as_py()) for t in batch.column("_text_to_judge")]
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *columns], names=[*names, *added])

    from pyspark.sql import types as T

    schema = T.StructType([*out.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("lang_accepted", T.BooleanType())])
    source = docs.select(*[F.col(f"`{c}`") for c in names], F.col("text").cast("string").alias("_text_to_judge"))
    return source.mapInArrow(giving_back(run), schema)


def language_rows(docs: DataFrame) -> DataFrame:
    """The prediction of every document, learned from the rows that are not held out."""
    known = learn_dictionaries(docs.select("doc_id", "text", "lang"))
    return identify(docs.select("doc_id", "text"), known).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "lang_accepted")


def keep_identified(docs: DataFrame) -> DataFrame:
    """Documents whose language is found by a clear margin, in the columns of ``docs``."""
    known = learn_dictionaries(docs.select("doc_id", "text", "lang"))
    names = docs.columns
    taken = {c: f"_own_{c}" for c in ("lang_pred", "score", "lang_accepted") if c in names}
    found = identify(docs.withColumnsRenamed(taken), known)
    return found.where("lang_accepted").select(*[F.col(f"`{taken.get(c, c)}`").alias(c) for c in names])
