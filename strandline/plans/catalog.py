"""All queries of the library and their oracle SQL."""

from __future__ import annotations

from strandline.plans import builds, catalogue, extensions, grading, registry, report, scoring, sites  # noqa: F401  (they register their queries)


def queries():
    return dict(registry.QUERIES)


def oracle_sql():
    return dict(registry.SQL)
