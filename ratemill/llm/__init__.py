"""Operators for large training corpora, and their registered queries."""


def llm_queries() -> dict:
    from ratemill.llm import queries, registry  # noqa: F401
    return dict(registry.QUERIES)


def llm_sql() -> dict:
    from ratemill.llm import queries, registry  # noqa: F401
    return dict(registry.SQL)
