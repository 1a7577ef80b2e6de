"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from chronofold.llm.bpe import op4_bpe_round_trip
from chronofold.llm.exact_dedup import OP8_SQL, op8_exact_dedup
from chronofold.llm.fingerprints import bands_near_duplicates, op1_fingerprints
from chronofold.llm.html_text import op7_html_extraction
from chronofold.llm.language_id import op6_language_id
from chronofold.llm.minhash_join import op10_near_dedup
from chronofold.llm.packing import op9_best_fit_packing
from chronofold.llm.quality import op2_quality
from chronofold.llm.secrets import op3_secret_scan
from chronofold.llm.token_counts import op5_token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_quality": op2_quality,
    "op3_secret_scan": op3_secret_scan,
    "op4_bpe_round_trip": op4_bpe_round_trip,
    "op5_token_counts": op5_token_counts,
    "op6_language_id": op6_language_id,
    "op7_html_extraction": op7_html_extraction,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_near_dedup": op10_near_dedup,
    "pipeline": corpus_pipeline.run,
    "bands_near_duplicates": bands_near_duplicates,
}

ORACLE_SQL: dict[str, str] = {"op8_exact_dedup": OP8_SQL}
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
