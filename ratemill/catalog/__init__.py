"""Registered queries by name."""


def all_queries() -> dict:
    from ratemill.catalog import file_queries, lifecycle, model_queries, quality, rating, registry, workload  # noqa: F401
    return dict(registry.QUERIES)


def all_sql() -> dict:
    all_queries()
    from ratemill.catalog import registry
    return dict(registry.SQL)
