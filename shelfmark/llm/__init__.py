"""Operators of a training-data pipeline, and their queries."""

from __future__ import annotations

from importlib import import_module

MODULES = ("substring_dedup", "packing", "token_files", "byte_bpe", "quality_rules", "sharding", "weighted_fingerprints", "secret_scan", "near_dedup", "html_text", "fill_in_middle", "lm_scoring", "divergence_audit")


def load():
    from shelfmark.llm.common import ORACLE, QUERIES

    for name in MODULES:
        import_module(f"shelfmark.llm.{name}")
    return dict(QUERIES), dict(ORACLE)
