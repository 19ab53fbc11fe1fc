"""The subpackage's queries and their SQL, as __spark_entry__.py adds them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import chunkprint, decontaminate, filter_audit, html_blocks, jaccard, language, lexical, mixing, packed_ids, secrets, simhash, toxicity, url_filter


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": simhash.op1_simhash,
        "op2_chunk_fingerprint": chunkprint.op2_chunk_fingerprint,
        "op3_source_mix": mixing.op3_source_mix,
        "op4_url_filter": url_filter.op4_url_filter,
        "op5_decontaminate": decontaminate.op5_decontaminate,
        "op6_secret_scan": secrets.op6_secret_scan,
        "op7_html_text": html_blocks.op7_html_text,
        "op8_language": language.op8_language,
        "op9_toxicity": toxicity.op9_toxicity,
        "op10_packed_ids": packed_ids.op10_packed_ids,
        "op11_ranked_search": lexical.op11_ranked_search,
        "op12_filter_audit": filter_audit.op12_filter_audit,
        "op13_jaccard_join": jaccard.op13_jaccard_join,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_source_mix": mixing.OP3_SQL, "op4_url_filter": url_filter.OP4_SQL, "op11_ranked_search": lexical.OP11_SQL, "op12_filter_audit": filter_audit.OP12_SQL}
