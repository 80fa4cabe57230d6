"""Queries and their oracle SQL, by name."""

from __future__ import annotations

import functools

from strandline.plans.views import Views, oracle
from strandline.sources.ship import ship

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    """Registers a function of Views as query ``name``."""

    def add(f):
        @functools.wraps(f)
        def run(spark, sf_dir):
            ship(spark)
            return f(Views(spark, sf_dir))

        QUERIES[name] = run
        if sql:
            SQL[name] = oracle(sql)
        return f

    return add
