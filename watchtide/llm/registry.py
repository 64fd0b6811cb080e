"""Queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from watchtide.llm import (conversations, fingerprints, html_text, importance, masked_lm, mixing, packing,
                           sharding, simhash_ring, spelling, templates, url_trust, warc)
from watchtide.llm.common import table

DOC = ("doc_id", "text")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc_segments": lambda s, d: warc.op1_warc(table(s, d, "pages")),
        "op2_masked_lm": lambda s, d: masked_lm.op2_pseudo_likelihood(table(s, d, "documents", *DOC)),
        "op3_importance_resampling": lambda s, d: importance.resample(table(s, d, "documents", *DOC), table(s, d, "labels"), errors=0.0),
        "op4_template_decontamination": lambda s, d: templates.contaminated(table(s, d, "documents", *DOC), table(s, d, "benchmark")),
        "op5_pigeonring_simhash": lambda s, d: simhash_ring.op5_near_duplicates(table(s, d, "documents", *DOC)),
        "op6_weighted_simhash": lambda s, d: fingerprints.op6_fingerprints(table(s, d, "documents", *DOC)),
        "op7_stratified_shards": lambda s, d: sharding.op7_shards(table(s, d, "documents", *DOC, "source")),
        "op8_block_rules": lambda s, d: html_text.op8_extract(table(s, d, "pages")),
        "op9_link_trust": lambda s, d: url_trust.op9_filter(table(s, d, "pages")),
        "op10_hash_threshold_mix": lambda s, d: mixing.op10_mix(table(s, d, "documents", *DOC, "source")),
        "op11_window_packing": lambda s, d: packing.op11_pack(table(s, d, "documents", *DOC)),
        "op12_spelling_variants": lambda s, d: spelling.op12_variants(table(s, d, "documents", *DOC)),
        "op13_conversation_repair": lambda s, d: conversations.op13_repair(table(s, d, "conversations")),
    }


def oracle_sql() -> dict[str, str]:
    """The others hash with functions DuckDB lacks, train models or walk links; tests/llm holds
    them against brute force."""
    return {
        "op1_warc_segments": """
            WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                              sha256(coalesce(html, '')) AS payload_digest FROM pages),
                 f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
            SELECT page_id, payload_bytes, payload_digest,
                   CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
                   CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
            FROM f""",
    }
