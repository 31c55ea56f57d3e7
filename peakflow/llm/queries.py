"""Registered queries of this subpackage, each over its whole tables, and the SQL of those that have it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from peakflow.llm import collocations, decontaminate, warc
from peakflow.llm.byte_bpe import op13_byte_bpe
from peakflow.llm.collocations import op11_phrase_collocations
from peakflow.llm.cotraining import op6_cotraining
from peakflow.llm.decontaminate import op1_benchmark_decontamination
from peakflow.llm.jaccard_join import op5_ngram_jaccard_join
from peakflow.llm.langid import op8_language_id
from peakflow.llm.ngram_lm import op4_deleted_interpolation
from peakflow.llm.packing import op9_best_two_fit_packing
from peakflow.llm.periodic_runs import op12_periodic_runs
from peakflow.llm.quality_rules import op2_quality_divergence
from peakflow.llm.substring_dedup import op10_substring_dedup
from peakflow.llm.url_rules import op7_association_url_filter
from peakflow.llm.warc import op3_warc_transactions

_QUERIES = (
    op1_benchmark_decontamination, op2_quality_divergence, op3_warc_transactions, op4_deleted_interpolation,
    op5_ngram_jaccard_join, op6_cotraining, op7_association_url_filter, op8_language_id, op9_best_two_fit_packing,
    op10_substring_dedup, op11_phrase_collocations, op12_periodic_runs, op13_byte_bpe,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {fn.__name__: fn for fn in _QUERIES} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_benchmark_decontamination": decontaminate.OP1_SQL, "op3_warc_transactions": warc.OP3_SQL,
        "op11_phrase_collocations": collocations.OP11_SQL,
    }
