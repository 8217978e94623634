"""Registration helper shared by the query groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.plans.oracle import sql


class Group:
    def __init__(self):
        self.queries: dict = {}
        self.oracles: dict[str, str] = {}

    def query(self, name: str, oracle: str | None = None, *needs: str):
        def add(fn):
            self.queries[name] = fn
            if oracle is not None:
                self.oracles[name] = sql(oracle, *needs)
            return fn

        return add


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Rounds sums whose last bits depend on the order of addition."""
    return df.withColumns({c: F.round(c, digits) for c in columns})
