"""The registered queries of the operators and their check SQL."""

from __future__ import annotations

from riskspark.llm import bpe, chat, decontamination, pieces, quality_classifier, rules, runs, sharding, simhash, suffix_dedup, toxicity, wavelet, whitening

MODULES = (sharding, suffix_dedup, bpe, decontamination, quality_classifier, rules, toxicity, wavelet, simhash, chat, runs, whitening, pieces)

QUERIES = {name: f for module in MODULES for name, f in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
