"""The queries of the training-data operators, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from forecourt.llm import (
    chat,
    covertree,
    decontaminate,
    extract_html,
    hardneg,
    mixing,
    neardup,
    passages,
    periodic,
    quality,
    suffixes,
    tokens,
    urls,
)

REGISTERED: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": urls.query,
    "op2_entropy_mix": mixing.query,
    "op3_decontaminate": decontaminate.query,
    "op4_quality_rules": quality.query,
    "op5_token_files": tokens.query,
    "op6_near_duplicates": neardup.query,
    "op7_chat_format": chat.query,
    "op8_html_text": extract_html.query,
    "op9_suffix_dedup": suffixes.query,
    "op10_passage_dedup": passages.query,
    "op11_hard_negatives": hardneg.query,
    "op12_vector_duplicates": covertree.query,
    "op13_word_runs": periodic.query,
    "pipeline": corpus_pipeline.run,
}

# Where there is none, tests hold the query against a brute-force version.
ORACLES: dict[str, str] = {
    "op3_decontaminate": decontaminate.ORACLE_SQL,
    "op6_near_duplicates": neardup.ORACLE_SQL,
    "op7_chat_format": chat.ORACLE_SQL,
    "op9_suffix_dedup": suffixes.ORACLE_SQL,
    "op10_passage_dedup": passages.ORACLE_SQL,
    "op11_hard_negatives": hardneg.ORACLE_SQL,
    "op12_vector_duplicates": covertree.ORACLE_SQL,
    "op13_word_runs": periodic.ORACLE_SQL,
}
