"""Differences between an incoming frame and the table it goes to."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import text
from daybook.session import quoted


def new_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    """Columns the frame has and the table lacks; names compare without case."""
    known = {n.lower() for n in schema.names}
    return [c for c in df.columns if c.lower() not in known]


def missing_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    """Columns the table has and the frame lacks."""
    known = {c.lower() for c in df.columns}
    return [n for n in schema.names if n.lower() not in known]


def add_new_columns(df: DataFrame, table: str) -> list[str]:
    """Append the frame's new columns to the table as STRING; older rows read NULL there."""
    added = new_columns(df, df.sparkSession.table(quoted(table)).schema)
    if added:
        columns = ", ".join(f"`{c}` STRING" for c in added)
        df.sparkSession.sql(f"ALTER TABLE {quoted(table)} ADD COLUMNS ({columns})")
    return added


def drop_new_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.drop(*new_columns(df, schema))


def _filler(data_type: T.DataType) -> Column:
    return F.lit("") if isinstance(data_type, T.StringType) else F.lit(None).cast(data_type)


def fill_missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the table's columns the frame lacks: empty text, or NULL of the column's type."""
    fillers = {n: _filler(schema[n].dataType) for n in missing_columns(df, schema)}
    return df.withColumns(fillers) if fillers else df


def in_table_order(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame's columns cast and ordered as the table's, ready for a positional insert."""
    return df.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def align_to_target(
    df: DataFrame, schema: T.StructType, extra: Mapping[str, Column] | None = None, blank_as_null: bool = False
) -> DataFrame:
    """Only the target's columns, in its order and types, in lower case; missing ones NULL.

    ``extra`` columns, computed on the frame as it was, are put behind them.  With
    ``blank_as_null`` blank text is NULL whatever the target's type is.
    """
    present = {f.name.lower(): f.dataType for f in df.schema.fields}

    def column(field: T.StructField) -> Column:
        name = field.name.lower()
        source = F.col(f"`{name}`") if name in present else F.lit(None)
        if blank_as_null and isinstance(present.get(name), T.StringType):
            source = text.blank_to_null(source)  # before a cast could refuse it
        return source.cast(field.dataType).alias(name)

    added = [c.alias(name) for name, c in (extra or {}).items()]
    return df.select([column(f) for f in schema.fields] + added)


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column comments; columns not in the map get an empty one."""

    def column(field: T.StructField) -> Column:
        metadata = dict(field.metadata) | {"comment": comments.get(field.name, "")}
        return F.col(f"`{field.name}`").alias(field.name, metadata=metadata)

    return df.select([column(f) for f in df.schema.fields])


# Column types of tables created in a relational store.
_RELATIONAL_TYPES = (
    (T.StringType, "varchar(256)"),
    (T.DateType, "varchar(128)"),
    (T.TimestampType, "varchar(128)"),
    (T.TimestampNTZType, "varchar(128)"),
    (T.IntegerType, "int"),
    (T.LongType, "bigint"),
    (T.DoubleType, "decimal(16,4)"),
    (T.FloatType, "decimal(16,4)"),
    (T.DecimalType, "decimal(16,4)"),
)
_OTHER_RELATIONAL_TYPE = "text"
# Fixed value: storage of tables created in a MySQL store.
_TABLE_OPTIONS = "ENGINE=InnoDB DEFAULT CHARSET=utf8"


def relational_type(data_type: T.DataType) -> str:
    for kind, name in _RELATIONAL_TYPES:
        if isinstance(data_type, kind):
            return name
    return _OTHER_RELATIONAL_TYPE


def create_table_statement(table: str, schema: T.StructType) -> str:
    """``CREATE TABLE IF NOT EXISTS`` for a MySQL store, with the fields' comments."""

    def column(field: T.StructField) -> str:
        comment = str(field.metadata.get("comment", "")).replace("\\", "\\\\").replace("'", "''")
        return f"  `{field.name}` {relational_type(field.dataType)} COMMENT '{comment}'"

    body = ",\n".join(column(f) for f in schema.fields)
    return f"CREATE TABLE IF NOT EXISTS {table} (\n{body}\n) {_TABLE_OPTIONS}"


def create_table_column_types(schema: T.StructType) -> str:
    """The same types for the JDBC writer's ``createTableColumnTypes``.

    ``text`` is no Spark type; STRING makes the dialect choose its own text type.
    """

    def kind(data_type: T.DataType) -> str:
        return relational_type(data_type).replace(_OTHER_RELATIONAL_TYPE, "string")

    return ", ".join(f"`{f.name}` {kind(f.dataType)}" for f in schema.fields)


def to_relational(df: DataFrame) -> DataFrame:
    """Values as a created relational table holds them: days and times as text, fractions as
    decimal(16,4), nested values as JSON, everything else that has no column type as text."""

    def value(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        kind = relational_type(field.dataType)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        elif isinstance(field.dataType, T.BooleanType):
            c = c.cast("int").cast("string")
        elif kind.startswith("varchar") or kind == _OTHER_RELATIONAL_TYPE:
            c = c.cast("string")
        elif kind.startswith("decimal"):
            c = c.cast(kind)
        return c.alias(field.name, metadata=field.metadata)

    return df.select([value(f) for f in df.schema.fields])
