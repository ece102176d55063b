"""Column types that grow: the least type that holds what a table has and what a batch brings.

Types form a lattice: byte, short, int, long, decimal, double, text; float below double; date below timestamp; text above
all.  A table's column moves up to the least type above both sides, so that no value is refused or cut; a batch of a
narrower type is cast to the table's.  Whole numbers and decimals above 15 digits lose digits as doubles; with ``exact`` they
become text instead.  Nested types grow by element, value and field; those of another shape become JSON text.

Where the reader takes the old files for the new type (a wider integer, more decimal digits, float to double), an external
table is only described anew in the catalog and no file is written.  Other tables are rewritten once, whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators import drift, partitions
from daybook.session import quoted
from daybook.sinks import locations, warehouse

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = dict(zip(_WHOLE, (3, 5, 10, 20)))  # that hold any value; Spark's reader asks for 20 for a long
_NUMBERS = (*_WHOLE, T.DecimalType, T.FloatType, T.DoubleType)
_NESTED = (T.ArrayType, T.MapType, T.StructType)
_MOST_DIGITS = 38
_DOUBLE_DIGITS = 15


def _decimal_digits(kind: T.DataType) -> tuple[int, int]:
    """Digits before and after the point."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    return _DIGITS[type(kind)], 0


def _number(a: T.DataType, b: T.DataType, exact: bool) -> T.DataType:
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda kind: _DIGITS[type(kind)])
    floating = [kind for kind in (a, b) if isinstance(kind, (T.FloatType, T.DoubleType))]
    others = [kind for kind in (a, b) if kind not in floating]
    if not floating:
        before, after = (max(pair) for pair in zip(_decimal_digits(a), _decimal_digits(b)))
        if before + after <= _MOST_DIGITS:
            return T.DecimalType(before + after, after)
    elif not others:
        return T.DoubleType() if a != b else a
    elif isinstance(others[0], (T.ByteType, T.ShortType)):
        return floating[0]
    lossy = any(sum(_decimal_digits(kind)) > _DOUBLE_DIGITS for kind in others)
    return T.StringType() if exact and lossy else T.DoubleType()


def _nested(a: T.DataType, b: T.DataType, exact: bool) -> T.DataType:
    text = T.StringType()

    def inner(x: T.DataType, y: T.DataType) -> T.DataType | None:
        wider = common_type(x, y, exact)
        to_text = isinstance(wider, T.StringType) and (isinstance(x, _NESTED) or isinstance(y, _NESTED))
        return None if to_text else wider  # a cast inside a value could not write JSON

    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        element = inner(a.elementType, b.elementType)
        return T.ArrayType(element, a.containsNull or b.containsNull) if element else text
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        # keys that grow could fall together
        value = inner(a.valueType, b.valueType) if a.keyType == b.keyType else None
        return T.MapType(a.keyType, value, a.valueContainsNull or b.valueContainsNull) if value else text
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        if [n.lower() for n in a.names] != [n.lower() for n in b.names]:
            return text
        kinds = [inner(x.dataType, y.dataType) for x, y in zip(a, b)]
        if None in kinds:
            return text
        return T.StructType([T.StructField(x.name, k, x.nullable or y.nullable) for x, y, k in zip(a, b, kinds)])
    return text


def common_type(a: T.DataType, b: T.DataType, exact: bool = False) -> T.DataType:
    """The least type that holds values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, _NUMBERS) and isinstance(b, _NUMBERS):
        return _number(a, b, exact)
    times = (T.DateType, T.TimestampNTZType, T.TimestampType)
    if isinstance(a, times) and isinstance(b, times):
        return max(a, b, key=lambda kind: times.index(type(kind)))
    if isinstance(a, _NESTED) or isinstance(b, _NESTED):
        return _nested(a, b, exact)
    if isinstance(a, T.BinaryType) or isinstance(b, T.BinaryType):
        raise ValueError(f"{a.simpleString()} and {b.simpleString()} have no common type: bytes need not be text")
    return T.StringType()


def as_type(column: Column, held: T.DataType, wanted: T.DataType) -> Column:
    """The column as a type at or above its own; nested values as text are JSON, NULL fields included."""
    if held == wanted:
        return column
    if isinstance(wanted, T.StringType) and isinstance(held, _NESTED):
        return F.to_json(column, {"ignoreNullFields": "false"})
    return column.cast(wanted)


def read_as_is(held: T.DataType, wanted: T.DataType) -> bool:
    """Whether Parquet files written as one type are read right as the other.

    Decimals read as doubles come without their point, longs are not read as doubles, and a date as a time needs a zone.
    """
    if held == wanted:
        return True
    if isinstance(held, T.FloatType):
        return isinstance(wanted, T.DoubleType)
    if isinstance(wanted, T.DoubleType):
        return isinstance(held, _WHOLE) and not isinstance(held, T.LongType)
    if isinstance(wanted, _WHOLE) and isinstance(held, _WHOLE):
        return _DIGITS[type(held)] <= _DIGITS[type(wanted)]
    if isinstance(wanted, T.DecimalType) and isinstance(held, (*_WHOLE, T.DecimalType)):
        before, after = _decimal_digits(held)
        # the reader asks for an int's ten digits, however short the column is
        before = max(before, 10) if isinstance(held, _WHOLE) else before
        return before <= wanted.precision - wanted.scale and after <= wanted.scale
    return False


def widened(held: T.StructType, batch: T.StructType, by: Sequence[str] = (), exact: bool = False) -> T.StructType:
    """The held columns with the types that also hold the batch's; partition columns stay."""
    brought = {f.name.lower(): f.dataType for f in batch}
    fixed = {c.lower() for c in by}

    def field(f: T.StructField) -> T.StructField:
        kind = f.dataType
        if f.name.lower() in brought and f.name.lower() not in fixed:
            kind = common_type(kind, brought[f.name.lower()], exact)
        return T.StructField(f.name, kind, f.nullable, f.metadata)

    return T.StructType([field(f) for f in held])


def _cast(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame's columns in the types that the schema has for their names."""
    wanted = {f.name.lower(): f.dataType for f in schema}

    def column(f: T.StructField) -> Column:
        to = wanted.get(f.name.lower(), f.dataType)
        return as_type(F.col(f"`{f.name}`"), f.dataType, to).alias(f.name, metadata=f.metadata)

    return df.select([column(f) for f in df.schema])


def widen(spark: SparkSession, table: str, batch: T.StructType, *, exact: bool = False) -> dict[str, str]:
    """Let the table's columns hold what the batch's do; the columns that have grown, with their new types.

    Rows, partitions, comments and properties stay.  A failure leaves the table as it was, but for one while a managed table by
    day is overwritten, whose rows are in the shared folder by then.
    """
    schema = spark.table(quoted(table)).schema
    held = partitions.described(spark, table)
    by = held.get("partition_columns", [])
    wider = widened(schema, batch, by, exact)
    grown = {new.name: new.dataType.simpleString() for old, new in zip(schema, wider) if old.dataType != new.dataType}
    if not grown:
        return {}
    if held.get("bucket_columns"):
        raise ValueError(f"{table} is bucketed: its buckets would not fit columns of other types")
    if held.get("type") == "MANAGED":
        _rewrite_managed(spark, table, wider, held)
        return grown
    kept = held["provider"] == "parquet" and all(read_as_is(o.dataType, n.dataType) for o, n in zip(schema, wider))
    _redefine(spark, table, schema, wider, held, rewrite=not kept)
    return grown


def _rewrite_managed(spark: SparkSession, table: str, wider: T.StructType, held: Mapping) -> None:
    by = [c.lower() for c in held.get("partition_columns", [])]
    if by not in ([], ["dt"]):
        raise ValueError(f"{table} is managed and partitioned by more than dt")
    rows = _cast(spark.table(quoted(table)), wider)
    warehouse.replace_table(rows, table, fmt=held["provider"], partition_by_day=bool(by), clean=False)
    for key, value in held.get("table_properties", {}).items():
        spark.sql(f"ALTER TABLE {quoted(table)} SET TBLPROPERTIES ({_text(key)} = {_text(value)})")
    if held.get("comment"):
        spark.sql(f"COMMENT ON TABLE {quoted(table)} IS {_text(held['comment'])}")


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _pairs(values: Mapping[str, str]) -> str:
    return ", ".join(f"{_text(k)} = {_text(v)}" for k, v in values.items())


def _define(spark: SparkSession, table: str, schema: T.StructType, held: Mapping, place: str, folders: Mapping[str, str]) -> None:
    """Create the external table over files that are there, its partitions included."""

    def column(f: T.StructField) -> T.StructField:
        comment = f.metadata.get("comment", "").replace("\\", r"\\")  # toDDL leaves them
        metadata = {k: v for k, v in f.metadata.items() if k in ("CURRENT_DEFAULT", "EXISTS_DEFAULT")}
        return T.StructField(f.name, f.dataType, f.nullable, metadata | ({"comment": comment} if comment else {}))

    by = held.get("partition_columns", [])
    parts = [
        f"CREATE TABLE {quoted(table)} ({T.StructType([column(f) for f in schema]).toDDL()}) USING {held['provider']}",
        f"OPTIONS ({_pairs(held['storage_properties'])})" if held.get("storage_properties") else "",
        f"PARTITIONED BY ({', '.join(f'`{c}`' for c in by)})" if by else "",
        f"LOCATION {_text(place)}",
        f"COMMENT {_text(held['comment'])}" if held.get("comment") else "",
        f"TBLPROPERTIES ({_pairs(held['table_properties'])})" if held.get("table_properties") else "",
    ]
    spark.sql(" ".join(p for p in parts if p))
    for name, folder in folders.items():
        spark.sql(
            f"ALTER TABLE {quoted(table)} ADD IF NOT EXISTS PARTITION ({partitions._spec(name)}) LOCATION {_text(folder)}"
        )
    spark.catalog.refreshTable(quoted(table))


def _redefine(
    spark: SparkSession, table: str, schema: T.StructType, wider: T.StructType, held: Mapping, rewrite: bool
) -> None:
    """Describe an external table anew, over its own files or over rewritten ones; its old files go last."""
    by, place = held.get("partition_columns", []), held["location"]
    names = [r["partition"] for r in partitions.list_partitions(spark, table).collect()] if by else []
    folders = {name: locations.partition_location(spark, table, name) for name in names}
    new_place, new_folders = place, folders
    if rewrite:
        new_place = locations.place_beside(place)
        writer = _cast(spark.table(quoted(table)), wider).write.format(held["provider"])
        try:
            (writer.partitionBy(*by) if by else writer).save(new_place)
        except Exception:
            locations.delete(spark, new_place)
            raise
        new_folders = locations._folders(spark, new_place, len(by)) if by else {}
    spark.sql(f"DROP TABLE {quoted(table)}")  # external: its files stay
    try:
        _define(spark, table, wider, held, new_place, new_folders)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(table)}")
        _define(spark, table, schema, held, place, folders)
        if rewrite:
            locations.delete(spark, new_place)
        raise
    if rewrite:
        for folder in {place, *folders.values()}:
            locations.delete(spark, folder)


def replace_days(df: DataFrame, table: str, days: Sequence[str], *, exact: bool = False, **options) -> DataFrame:
    """:func:`warehouse.replace_days`, with the table's columns widened first to hold the frame's."""
    spark = df.sparkSession
    if warehouse.table_exists(spark, table):
        widen(spark, table, df.schema, exact=exact)
        held = spark.table(quoted(table)).schema
        known = T.StructType([f for f in held if f.name.lower() != "dt"])
        drift_free = {n.lower() for n in drift.new_columns(df, held)}
        # new columns are text in the table, nested ones JSON
        text = [T.StructField(f.name, T.StringType()) for f in df.schema if f.name.lower() in drift_free]
        df = _cast(df, T.StructType([*known, *text]))
    return warehouse.replace_days(df, table, days, **options)
