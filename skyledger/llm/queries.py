"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from . import bpe, decontaminate, fill_middle, filter_audit, language, near_copies, neighbours, oracles, passages, quality, scoring, secrets, token_counts, token_files

QUERIES = {
    "op1_bpe": bpe.query,
    "op2_language_id": language.query,
    "op3_token_counts": token_counts.query,
    "op4_secret_scans": secrets.query,
    "op5_substring_dedup": passages.query,
    "op6_token_files": token_files.query,
    "op7_near_copies": near_copies.query,
    "op8_benchmark_decontamination": decontaminate.query,
    "op9_lm_scoring": scoring.query,
    "op10_nearest_neighbours": neighbours.query,
    "op11_quality": quality.query,
    "op12_fill_middle": fill_middle.query,
    "op13_filter_audit": filter_audit.query,
}
ORACLES: dict[str, str] = oracles.ORACLES
