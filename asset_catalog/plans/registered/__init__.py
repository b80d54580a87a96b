"""One query per operator, on data derived from the given tables."""

from asset_catalog.plans.registered import catalog, children, requests, rewriting, scans, selecting

_PARTS = (scans, rewriting, selecting, catalog, children, requests)


def all_queries() -> dict:
    return {name: query for part in _PARTS for name, query in part.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
