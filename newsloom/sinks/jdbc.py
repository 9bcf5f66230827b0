"""Database tables as sinks, for any JDBC driver on the class path."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType

from .files import Sink

MODES = ("append", "overwrite")


def flat_arrays(df: DataFrame) -> DataFrame:
    """Arrays as comma-separated text: most databases have no array type."""
    arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, ArrayType)]
    return df.withColumns({name: F.concat_ws(",", name) for name in arrays})


def jdbc_writer(
    df: DataFrame, table: str, mode: str = "append", url: str = "", props: Mapping[str, str] | None = None
):
    """The configured writer. Overwriting empties the table and keeps its definition."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).options(**(props or {}))
    if mode == "overwrite":
        writer = writer.option("truncate", "true")
    return writer.mode(mode)


def write_jdbc(
    df: DataFrame,
    table: str,
    mode: str = "append",
    url: str = "",
    props: Mapping[str, str] | None = None,
    arrays: bool = False,
) -> None:
    """Append to or replace a table; `arrays=True` for a database with array columns.

    Spark opens one connection per partition: `numPartitions` in `props` bounds them.
    """
    jdbc_writer(df if arrays else flat_arrays(df), table, mode, url, props).save()


def jdbc_sink(table: str, mode: str = "append", url: str = "", props: Mapping[str, str] | None = None) -> Sink:
    return lambda df, batch_id: write_jdbc(df, table, mode, url, props)
