"""Queries of the pipeline operators, with the SQL that checks them where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracles
from .chat import ORACLE_OP5, op5_chat_format
from .embedding_dups import op8_embedding_dups
from .html_text import op6_html_text
from .jaccard import op1_ngram_jaccard
from .licenses import ORACLE_OP13, op13_license_scan
from .mixing import ORACLE_OP7, op7_mix_sources
from .phrases import ORACLE_OP11, op11_phrase_mining
from .pieces import op2_sentencepiece
from .quality_model import op9_quality_classifier
from .quality_rules import op4_quality_rules
from .secrets import op3_secret_scan
from .spelling import ORACLE_OP12, op12_spelling_variants
from .token_counts import op10_token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_secret_scan": op3_secret_scan,
    "op4_quality_rules": op4_quality_rules,
    "op5_chat_format": op5_chat_format,
    "op6_html_text": op6_html_text,
    "op7_mix_sources": op7_mix_sources,
    "op8_embedding_dups": op8_embedding_dups,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_token_counts": op10_token_counts,
    "op11_phrase_mining": op11_phrase_mining,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_license_scan": op13_license_scan,
}

ORACLE_SQL: dict[str, str] = {
    "op1_ngram_jaccard": oracles.OP1,
    "op3_secret_scan": oracles.OP3,
    "op4_quality_rules": oracles.OP4,
    "op5_chat_format": ORACLE_OP5,
    "op7_mix_sources": ORACLE_OP7,
    "op8_embedding_dups": oracles.OP8,
    "op11_phrase_mining": ORACLE_OP11,
    "op12_spelling_variants": ORACLE_OP12,
    "op13_license_scan": ORACLE_OP13,
}
