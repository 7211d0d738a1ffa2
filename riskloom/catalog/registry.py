"""Registered queries: one per operator, each with its DuckDB oracle.

Every query reads the supplied tables (through the views in ``views``), so
its work grows with them; none runs on fixed input.  Double columns that
come out of aggregations are rounded to 6 digits on both sides
(``round_cols``) because the engines sum in different orders.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog.views import table, view, view_sql


@dataclass
class Entry:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    round_cols: list[str] = field(default_factory=list)
    operators: str = ""

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(spark, sf_dir)
        if self.round_cols:
            df = df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in self.round_cols})
        return df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        if not self.round_cols:
            return self.sql
        rep = ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in self.round_cols)
        return f"SELECT * REPLACE ({rep}) FROM ({self.sql}) AS q"


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None, round_cols=(), operators: str = ""):
    def deco(fn):
        REGISTRY[name] = Entry(name, fn, sql, list(round_cols), operators)
        return fn
    return deco


__all__ = ["REGISTRY", "Entry", "register", "table", "view", "view_sql"]
