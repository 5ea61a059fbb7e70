"""Queries of the text-corpus operators."""

from __future__ import annotations

from parlance.llm import chat_queries, doc_queries

MODULES = [chat_queries, doc_queries]


def queries():
    return {k: q for m in MODULES for k, q in m.queries().items()}


def oracle_sql():
    return {k: q for m in MODULES for k, q in m.oracle_sql().items()}
