"""Queries of the engine, each with its SQL twin."""

from __future__ import annotations


def queries() -> dict:
    from kindred.plans import q_linkage, q_marts, q_register, q_relational, q_text  # noqa: F401  register
    from kindred.plans.catalogue import QUERIES

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from kindred.plans.catalogue import ORACLES

    queries()
    return dict(ORACLES)
