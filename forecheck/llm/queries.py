"""Registered queries of the subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from forecheck.llm import oracle
from forecheck.llm.bpe_replay import op5_bpe_replay
from forecheck.llm.chat_format import op4_chat_format
from forecheck.llm.decontamination import op2_decontamination
from forecheck.llm.hard_negatives import op12_hard_negatives
from forecheck.llm.jaccard_join import op7_jaccard_join
from forecheck.llm.lexical_search import op11_bag_search
from forecheck.llm.license_scan import op6_license_scan
from forecheck.llm.packing import op13_packing
from forecheck.llm.prefix_free_dedup import op3_prefix_free_dedup
from forecheck.llm.repetition import op1_repetition
from forecheck.llm.toxicity import op8_toxicity
from forecheck.llm.url_rules import op10_url_rules
from forecheck.llm.warc_seekable import op9_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repetition": op1_repetition,
    "op2_decontamination": op2_decontamination,
    "op3_prefix_free_dedup": op3_prefix_free_dedup,
    "op4_chat_format": op4_chat_format,
    "op5_bpe_replay": op5_bpe_replay,
    "op6_license_scan": op6_license_scan,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_toxicity": op8_toxicity,
    "op9_warc": op9_warc,
    "op10_url_rules": op10_url_rules,
    "op11_bag_search": op11_bag_search,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_packing": op13_packing,
}

ORACLE_SQL: dict[str, str] = {
    "op1_repetition": oracle.OP1_REPETITION,
    "op2_decontamination": oracle.OP2_DECONTAMINATION,
    "op3_prefix_free_dedup": oracle.OP3_PREFIX_FREE_DEDUP,
    "op4_chat_format": oracle.OP4_CHAT_FORMAT,
    "op7_jaccard_join": oracle.OP7_JACCARD_JOIN,
    "op9_warc": oracle.OP9_WARC,
    "op10_url_rules": oracle.OP10_URL_RULES,
    "op11_bag_search": oracle.OP11_BAG_SEARCH,
    "op12_hard_negatives": oracle.OP12_HARD_NEGATIVES,
}
