"""Complete queries over the test tables."""


def all_queries():
    """Every registered query by name."""
    from plantroom.plans import catalog_queries, point_queries, reading_queries, staging_queries  # noqa: F401
    from plantroom.plans.registry import QUERIES

    return dict(QUERIES)
