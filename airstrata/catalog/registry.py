"""Registry of named queries."""

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    """Register ``function(spark, folder) -> DataFrame`` and its reference SQL."""

    def register(function):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register
