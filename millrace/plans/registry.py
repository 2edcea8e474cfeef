"""Registration of queries and the relations that they share with their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..workers import spread, written

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def relation(spark: SparkSession, sf_dir: str, sql: str, dealt: bool = False) -> DataFrame:
    """A relation in SQL that Spark and DuckDB both read; tables stand in braces.

    dealt: the tables' rows are dealt to all cores and written first. A table of short rows is one file that one task reads, and Spark pushes
    filters, however heavy, through a shuffle down to that task, but not through what is written.
    """
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in sql}
    if dealt:
        used = {t: written(spread(rows, rows.columns[0])) for t, rows in used.items()}
    return spark.sql(sql, **used)


def register(name: str, run: Callable[..., DataFrame], sql: str | None = None, dealt: bool = False, **inputs: str) -> None:
    """run gets one DataFrame for each relation of inputs; the SQL may name them as tables. dealt: see relation()."""
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(**{k: relation(spark, sf_dir, v, dealt) for k, v in inputs.items()})

    QUERIES[name] = query
    if sql is not None:
        plain = {t: t for t in TABLES}
        given = ", ".join(f"{k} AS ({v.format(**plain)})" for k, v in inputs.items())
        ORACLES[name] = f"WITH {given} {sql}" if not sql.startswith("WITH ") else f"WITH {given}, {sql[5:]}"
