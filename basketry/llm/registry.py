"""The numbered queries and their SQL."""

from __future__ import annotations

from basketry.llm import (
    chats, decontaminate, infill, langid, licenses, packing, pii, quality, rollups, simhash, toxicity, urls,
    variants,
)

MODULES = (licenses, packing, decontaminate, simhash, quality, langid, rollups, urls, pii, chats, infill, variants, toxicity)


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
