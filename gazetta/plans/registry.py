"""Registered queries over the reference's operators, each with its SQL twin where SQL can state it."""

from __future__ import annotations

from gazetta.plans import audits, entity, events, linking, lists, products

QUERIES: dict = {**audits.QUERIES, **entity.QUERIES, **events.QUERIES, **linking.QUERIES, **lists.QUERIES, **products.QUERIES}
SQL: dict[str, str] = {**audits.SQL, **entity.SQL, **events.SQL, **linking.SQL, **lists.SQL, **products.SQL}
