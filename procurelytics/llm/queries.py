"""The registered queries of the training-data operators, with their SQL where SQL can say the same."""

from __future__ import annotations

from procurelytics.llm import bin_slack, language, merkle, near_dup, packing, quality, repair, suffix_dedup, tokens, trie_bpe, voronoi, warc, wrapper
from procurelytics.llm.common import table

QUERIES = {
    "op1_exact_search": lambda spark, folder: voronoi.search_rows(table(spark, folder, "embeddings")),
    "op2_html_extraction": lambda spark, folder: wrapper.page_rows(table(spark, folder, "pages")),
    "op3_suffix_dedup": lambda spark, folder: suffix_dedup.repeat_rows(table(spark, folder, "documents")),
    "op4_token_counts": lambda spark, folder: tokens.token_rows(table(spark, folder, "documents")),
    "op7_quality_rules": lambda spark, folder: quality.quality_rows(table(spark, folder, "documents")),
    "op5_near_dup": lambda spark, folder: near_dup.near_dup_rows(table(spark, folder, "documents")),
    "op6_warc": lambda spark, folder: warc.warc_rows(table(spark, folder, "pages")),
    "op8_bpe_encoding": lambda spark, folder: trie_bpe.encoding_rows(table(spark, folder, "documents")),
    "op9_language_id": lambda spark, folder: language.language_rows(table(spark, folder, "documents")),
    "op11_conversation_repair": lambda spark, folder: repair.repair_rows(table(spark, folder, "conversations")),
    "op12_merkle_manifest": lambda spark, folder: merkle.manifest_rows(table(spark, folder, "documents")),
    "op13_best_fit_packing": lambda spark, folder: bin_slack.bin_slack_rows(table(spark, folder, "documents")),
    "op10_packing": lambda spark, folder: packing.packing_rows(table(spark, folder, "documents")),
}
ORACLES = {"op1_exact_search": voronoi.SQL, "op6_warc": warc.SQL, "op7_quality_rules": quality.SQL, "op12_merkle_manifest": merkle.SQL}
