"""Every operator as a named query over the test tables, with equivalent SQL where there is any."""

from __future__ import annotations

from docketry.catalog import certificates, cleaning, evaluation, features, flows, lookups, models, sampling

MODULES = (cleaning, sampling, lookups, evaluation, features, models, certificates, flows)


def queries() -> dict:
    return {name: run for module in MODULES for name, run in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
