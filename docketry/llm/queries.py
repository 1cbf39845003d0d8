"""The queries of all operators of this folder, and their SQL where there is any."""

from __future__ import annotations

from docketry.llm import (
    bpe,
    chat_parts,
    fertility,
    learned_partitions,
    periodic_runs,
    prefix_trie,
    quality_qda,
    simhash_tiles,
    toxic_crf,
    url_globs,
    var_packing,
    vertical_jaccard,
    zstd_language,
)

MODULES = (
    quality_qda,
    bpe,
    learned_partitions,
    url_globs,
    fertility,
    chat_parts,
    zstd_language,
    vertical_jaccard,
    var_packing,
    toxic_crf,
    periodic_runs,
    prefix_trie,
    simhash_tiles,
)


def queries() -> dict:
    return {name: run for module in MODULES for name, run in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
