"""Database tables as sources. Connection settings come from the caller, never from the code."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def from_clause(table_or_query: str, alias: str = "q") -> str:
    """A table name as it is; a query, also one that begins with `WITH`, as a derived table."""
    text = table_or_query.strip().rstrip(";")
    if re.match(r"(select|with|values)\b", text, re.IGNORECASE):
        return f"({text}) {alias}"
    return text


def read_jdbc(
    spark: SparkSession,
    url: str,
    table_or_query: str,
    props: Mapping[str, str] | None = None,
    partition: tuple[str, object, object, int] | None = None,
) -> DataFrame:
    """Scan a table or a query.

    `partition` = (column, lower, upper, tasks) reads in parallel ranges; without it the whole
    result comes through one task, which suits top-k queries pushed down to the database.
    """
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", from_clause(table_or_query))
        .options(**(props or {}))
    )
    if partition is not None:
        column, lower, upper, tasks = partition
        reader = (
            reader.option("partitionColumn", column)
            .option("lowerBound", str(lower))
            .option("upperBound", str(upper))
            .option("numPartitions", str(tasks))
        )
    return reader.load()
