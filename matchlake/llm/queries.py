"""Registered queries of this folder, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from . import (chat_format, conversation_repair, decontaminate, html_extract, mixing, ngram_join, quality_rules, secret_scan,
               sharding, spelling_groups, toxicity, url_filter, vector_dedup)
from .common import table
from .oracles import ORACLES  # noqa: F401

QUERIES = {
    "op1_toxic_segments": lambda spark, sf: toxicity.report(table(spark, sf, "documents"), table(spark, sf, "labels")),
    "op2_source_mix": lambda spark, sf: mixing.report(table(spark, sf, "documents")),
    "op3_ngram_join": lambda spark, sf: ngram_join.report(table(spark, sf, "documents")),
    "op4_sampled_splitters": lambda spark, sf: sharding.report(table(spark, sf, "documents")),
    "op5_url_words": lambda spark, sf: url_filter.report(table(spark, sf, "pages")),
    "op6_secret_ledger": lambda spark, sf: secret_scan.report(table(spark, sf, "documents")),
    "op7_decontaminate": lambda spark, sf: decontaminate.report(
        table(spark, sf, "documents"), table(spark, sf, "benchmark")),
    "op8_html_blocks": lambda spark, sf: html_extract.report(table(spark, sf, "pages")),
    "op9_chat_examples": lambda spark, sf: chat_format.report(table(spark, sf, "conversations")),
    "op10_quality_votes": lambda spark, sf: quality_rules.report(table(spark, sf, "documents")),
    "op11_int8_tiles": lambda spark, sf: vector_dedup.report(table(spark, sf, "embeddings")),
    "op12_grammar_repair": lambda spark, sf: conversation_repair.report(table(spark, sf, "conversations")),
    "op13_partenum": lambda spark, sf: spelling_groups.report(table(spark, sf, "documents")),
}


