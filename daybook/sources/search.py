"""Search-index scans through the connector the user puts on the class path."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

CONNECTOR = "org.elasticsearch.spark.sql"

# Connector settings for reading.
READ_OPTIONS = {
    "es.port": "9200",
    "es.mapping.date.rich": "false",
    "es.scroll.size": "10000",
    "es.input.max.docs.per.partition": "1000000",
    "es.http.timeout": "5m",
    "es.scroll.keepalive": "10m",
}


def resource(index: str, doc_type: str = "_doc") -> str:
    """``index`` or ``index:type`` as the connector's ``index/type``."""
    name, _, own_type = index.strip().partition(":")
    return f"{name}/{own_type or doc_type}"


def scan(
    spark: SparkSession, nodes: str, index: str, options: dict[str, str] | None = None
) -> DataFrame:
    """All documents of an index.  Date fields come as text, so day predicates compare text;
    the connector turns them into range queries."""
    settings = READ_OPTIONS | {"es.nodes": nodes, "pushdown": "true"} | (options or {})
    return spark.read.format(CONNECTOR).options(**settings).load(resource(index))


def reader(spark: SparkSession, nodes: str, **options: str) -> Callable[[str], DataFrame]:
    return lambda index: scan(spark, nodes, index, options)
