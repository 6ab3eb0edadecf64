"""Registered queries of the operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from salesloom.llm import oracle
from salesloom.llm.collocations import op13_collocations
from salesloom.llm.decontaminate import op7_decontaminate
from salesloom.llm.html_text import op8_html_text
from salesloom.llm.lattice import op9_sentencepiece
from salesloom.llm.minhash_dedup import op1_minhash_dedup
from salesloom.llm.pii import op2_pii
from salesloom.llm.quality import op4_quality
from salesloom.llm.ranked_search import op11_ranked_search
from salesloom.llm.secrets import op3_secrets
from salesloom.llm.sharding import op6_sharding
from salesloom.llm.token_counts import op5_token_counts
from salesloom.llm.toxicity import op10_toxicity
from salesloom.llm.warc import op12_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_minhash_dedup, op2_pii, op3_secrets, op4_quality, op5_token_counts, op6_sharding,
        op7_decontaminate, op8_html_text, op9_sentencepiece, op10_toxicity,
        op11_ranked_search, op12_warc, op13_collocations)
} | {"pipeline": corpus_pipeline.run}

ORACLE_SQL: dict[str, str] = oracle.QUERIES
