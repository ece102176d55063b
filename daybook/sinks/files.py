"""File and search-index export."""

from __future__ import annotations

from pyspark.sql import DataFrame

from daybook.sources.search import CONNECTOR, READ_OPTIONS, resource


def export_csv(df: DataFrame, path: str, mode: str = "append", **options: str) -> None:
    """CSV with a header in each file; files follow the frame's partitions, in parallel."""
    df.write.mode(mode).option("header", True).options(**options).csv(path)


def export_json_docs(df: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON document per line, as an index would take them; NULL fields are written."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def export_index(
    df: DataFrame,
    nodes: str,
    index: str,
    writers: int | None = None,
    options: dict[str, str] | None = None,
) -> None:
    """Append documents to a search index; ``writers`` bounds the load put on it."""
    rows = df.repartition(writers) if writers else df
    settings = {"es.nodes": nodes, "es.port": READ_OPTIONS["es.port"]} | (options or {})
    rows.write.format(CONNECTOR).options(**settings).mode("append").save(resource(index))
