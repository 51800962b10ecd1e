"""All registered queries. Importing a plan module registers its queries."""

from __future__ import annotations

from opslake.plans import catalog, corpus, lake, operations, search, streams, telemetry  # noqa: F401


def queries():
    return dict(catalog.QUERIES)


def oracle_sql():
    return dict(catalog.ORACLES)
