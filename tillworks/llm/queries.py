"""Queries of this package and their SQL."""

from __future__ import annotations

from tillworks.llm import chat, decontamination, divergence, hard_negatives, language, line_chunks, mixing, secrets, sharding, shingle_join, simhash, token_files, vector_file
from tillworks.llm.common import Query

_OPERATORS = [
    (decontamination.op1_decontamination, decontamination.SQL),
    (vector_file.op2_vector_file, vector_file.SQL),
    (simhash.op3_simhash, None),  # no XXH64 in SQL
    (line_chunks.op4_line_chunks, line_chunks.SQL),
    (token_files.op5_token_files, None),  # no tokenizer in SQL
    (secrets.op6_secrets, None),  # no vocabulary in SQL
    (sharding.op7_sharding, None),  # iterative
    (chat.op8_chat, chat.SQL),
    (mixing.op9_mixing, None),  # drawn
    (language.op10_language, None),  # learned
    (hard_negatives.op11_hard_negatives, hard_negatives.SQL),
    (shingle_join.op12_shingle_join, shingle_join.SQL),
    (divergence.op13_divergence, divergence.SQL),
]


def queries() -> dict[str, Query]:
    return {fn.__name__: fn for fn, _ in _OPERATORS}


def oracle_sql() -> dict[str, str]:
    return {fn.__name__: sql for fn, sql in _OPERATORS if sql is not None}
