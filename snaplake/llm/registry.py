"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chat import op7_prefix_tree_chat
from .decontaminate import op3_template_leaks
from .extract import op11_sql, op11_tag_path_text
from .lm import op5_backoff_automaton
from .media import op2_media_chunks
from .merkle import op13_merkle_intervals
from .packing import op9_vector_best_fit
from .pii import op10_pii_disclosure
from .simhash import op8_simhash_components
from .structure import op12_run_length_repair
from .toxicity import op1_toxicity_noisy_or
from .urls import op6_sql, op6_url_rules
from .windows import op4_superkmer_repeats

QUERIES = (
    op1_toxicity_noisy_or,
    op2_media_chunks,
    op3_template_leaks,
    op4_superkmer_repeats,
    op5_backoff_automaton,
    op6_url_rules,
    op7_prefix_tree_chat,
    op8_simhash_components,
    op9_vector_best_fit,
    op10_pii_disclosure,
    op11_tag_path_text,
    op12_run_length_repair,
    op13_merkle_intervals,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op6_url_rules": op6_sql(), "op11_tag_path_text": op11_sql()}
