"""Queries of this library and the SQL that gives the same rows in DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.views import VIEWS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: bool = True) -> Callable[[Query], Query]:
    """Register a function under ``name``; ``sql`` may use the views and, after a first line ``WITH``, its own CTEs."""

    def register(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = f
        if sql is not None:
            text = sql.strip()
            if views:
                text = f"WITH {VIEWS.strip()}, {text[4:].lstrip()}" if text.upper().startswith("WITH") else f"WITH {VIEWS.strip()} {text}"
            ORACLES[name] = text
        return f

    return register


def places(column: str) -> int:
    """Decimals that a double column is compared at; scores are small decimals, which 6 places would often cut at a tie."""
    return 9 if "score" in column or "satisf" in column else 6


def rounded(df: DataFrame) -> DataFrame:
    """Double columns rounded, for comparison between engines; never minus zero."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.round(c, places(c)) + F.lit(0.0) for c, t in df.dtypes if t == "double"})


def rounded_positive(df: DataFrame) -> DataFrame:
    """``rounded`` for tables whose doubles aren't negative, in doubles: ``round`` makes a decimal of every value."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.expr(f"floor(`{c}` * 1e{places(c)} + 0.5D) / 1e{places(c)}") for c, t in df.dtypes if t == "double"})


def rounded_double(name: str, places: int):
    """A double column rounded half away from 0 in doubles; never minus zero."""
    from pyspark.sql import functions as F

    return F.expr(f"signum(`{name}`) * (floor(abs(`{name}`) * 1e{places} + 0.5D) / 1e{places}) + 0D").alias(name)


def sql_round(*columns: str) -> str:
    return ", ".join(f"round({c}, {places(c)}) + 0.0::DOUBLE AS {c}" for c in columns)
