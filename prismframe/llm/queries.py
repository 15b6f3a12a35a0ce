"""Registry of the corpus operators' queries and of the SQL for those that SQL can express."""

from . import decontamination, html_extraction, line_dedup, mixing, near_duplicates, quality, secrets, sharding, token_counts, url_filter

QUERIES = {
    "op1_token_counts": token_counts.query,
    "op2_line_dedup": line_dedup.query,
    "op3_secret_scan": secrets.query,
    "op4_ngram_jaccard_join": near_duplicates.query,
    "op5_sharding": sharding.query,
    "op6_quality_rules": quality.query,
    "op7_html_extraction": html_extraction.query,
    "op8_decontamination": decontamination.query,
    "op9_url_filter": url_filter.query,
    "op10_mixing": mixing.query,
}
ORACLES = {"op2_line_dedup": line_dedup.SQL, "op4_ngram_jaccard_join": near_duplicates.SQL, "op9_url_filter": url_filter.SQL}
