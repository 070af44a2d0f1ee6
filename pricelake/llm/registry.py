"""Queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from . import decontaminate, exact_dedup, langid, lmscore, mixing, near_dedup, pii, runs, secrets, tokens, urls, variants, warc

QUERIES = {
    "op1_near_duplicates": near_dedup.query,
    "op2_pii": pii.query,
    "op3_url_filter": urls.query,
    "op4_lm_scores": lmscore.query,
    "op5_token_shards": tokens.query,
    "op6_secrets": secrets.query,
    "op7_decontamination": decontaminate.query,
    "op8_exact_dedup": exact_dedup.query,
    "op9_language_id": langid.query,
    "op10_source_mixing": mixing.query,
    "op11_warc_archive": warc.query,
    "op12_spelling_variants": variants.query,
    "op13_periodic_runs": runs.query,
}

SQL = {
    "op1_near_duplicates": near_dedup.SQL,
    "op4_lm_scores": lmscore.SQL,
    "op3_url_filter": urls.SQL,
    "op7_decontamination": decontaminate.SQL,
    "op8_exact_dedup": exact_dedup.SQL,
    "op10_source_mixing": mixing.SQL,
    "op11_warc_archive": warc.SQL,
    "op12_spelling_variants": variants.SQL,
    "op13_periodic_runs": runs.SQL,
}
