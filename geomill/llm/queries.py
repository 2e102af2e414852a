"""The registered queries of this package: opN_<name>, and their SQL where SQL can express them."""

from __future__ import annotations

from geomill.llm import chat_format, chunk_bpe, exact_dedup, hard_negatives, language_id, line_clean, merkle_manifest, near_dedup, ngram_trie, quality_rules, simhash, source_mix, token_output

MODULES = (token_output, exact_dedup, chunk_bpe, source_mix, ngram_trie, line_clean, near_dedup, language_id, quality_rules, chat_format, hard_negatives, merkle_manifest, simhash)


def queries() -> dict:
    return {name: f for m in MODULES for name, f in vars(m).items() if name.startswith("op") and name[2].isdigit() and f.__module__ == m.__name__}


def oracle_sql() -> dict[str, str]:
    return {name: m.ORACLE for m in MODULES for name in queries() if getattr(m, name, None) and hasattr(m, "ORACLE")}
