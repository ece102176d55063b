from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators import drift, frames, summaries


def test_stamps(spark):
    df = spark.range(2)
    assert frames.stamp_day(df, "2024-01-15").columns == ["id", "dt"]
    assert frames.stamp_day(df, "2024-01-15", first=True).columns == ["dt", "id"]
    stamped = frames.stamp_export_time(frames.stamp_day(df, "2024-01-15"), "2024-01-16 00:00:00")
    assert [tuple(r) for r in stamped.collect()] == [
        (0, "2024-01-15", "2024-01-16 00:00:00"),
        (1, "2024-01-15", "2024-01-16 00:00:00"),
    ]
    again = frames.stamp_day(stamped, "2024-01-17")
    assert again.columns == ["id", "last_update_time", "dt"]


def test_clean_text_leaves_other_types(spark):
    schema = "s string, `a.b` string, n int, l array<string>, m map<string,string>, b binary"
    rows = [("x\r\ny", "\n", 1, ["p\nq"], {"k": "v\n"}, bytearray(b"\n")), (None,) * 6]
    df = spark.createDataFrame(rows, schema)
    cleaned = frames.clean_text(df)
    assert cleaned.schema == df.schema
    assert [tuple(r) for r in cleaned.collect()] == [
        ("xy", "", 1, ["p\nq"], {"k": "v\n"}, bytearray(b"\n")),
        (None,) * 6,
    ]


def test_blanks_in_chosen_columns_only(spark):
    df = spark.createDataFrame([(" ", " ", 1)], "a string, b string, n int")
    assert tuple(frames.blanks_to_null(df, ["A", "n"]).first()) == (None, " ", 1)
    assert tuple(frames.blanks_to_null(df).first()) == (None, None, 1)


def test_allow_list_multiplies_by_its_duplicates(spark):
    rows = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "org int, v string")
    allowed = spark.createDataFrame([(1,), (1,), (3,), (9,)], "org int")
    joined = frames.join_allow_list(rows, "org", allowed, "org")
    assert joined.columns == ["org", "v"]
    assert sorted(tuple(r) for r in joined.collect()) == [(1, "x"), (1, "x"), (3, "z")]


def test_unions(spark):
    first = spark.createDataFrame([(1, 2, 3)], "col0 int, col1 int, col2 int")
    second = spark.createDataFrame([(4, 5, 6)], "col1 int, col2 int, col0 int")
    by_position = frames.union_by_position(first, second)
    assert by_position.columns == ["col0", "col1", "col2"]
    assert [tuple(r) for r in by_position.collect()] == [(1, 2, 3), (4, 5, 6)]
    by_name = frames.union_by_name(first, second)
    assert [tuple(r) for r in by_name.collect()] == [(1, 2, 3), (6, 4, 5)]


def test_column_sets_compare_without_case(spark):
    df = spark.createDataFrame([(1, 2)], "A int, age int")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("a", "c", "d")])
    assert drift.new_columns(df, schema) == ["age"]
    assert drift.missing_columns(df, schema) == ["c", "d"]
    assert drift.drop_new_columns(df, schema).columns == ["A"]


def test_fill_by_type(spark):
    schema = T.StructType.fromDDL("a int, s string, n int, t timestamp")
    filled = drift.fill_missing_columns(spark.createDataFrame([(1,)], "a int"), schema)
    assert tuple(filled.first()) == (1, "", None, None)
    assert [f.dataType for f in filled.schema] == [f.dataType for f in schema]


def test_align(spark):
    df = spark.createDataFrame([("7", "x", 1)], "ID string, other string, Rank int")
    schema = T.StructType.fromDDL("rank bigint, Id int, missing date")
    aligned = drift.align_to_target(df, schema, {"_o": F.col("other")})
    assert aligned.columns == ["rank", "id", "missing", "_o"]
    assert tuple(aligned.first()) == (1, 7, None, "x")


def test_comments_fill_up_with_empty(spark):
    df = drift.with_comments(spark.range(1).withColumn("x", F.lit(1)), {"id": "the key"})
    assert [f.metadata["comment"] for f in df.schema.fields] == ["the key", ""]


EVERY_TYPE = (
    "s string, d date, t timestamp, u timestamp_ntz, i int, l bigint, f float, g double, "
    "m decimal(10,2), b boolean, y tinyint, a array<int>, k map<string,int>, z struct<q:int>"
)


def test_relational_types():
    schema = T.StructType.fromDDL(EVERY_TYPE)
    assert [drift.relational_type(f.dataType) for f in schema] == (
        ["varchar(256)"] + ["varchar(128)"] * 3 + ["int", "bigint"] + ["decimal(16,4)"] * 3
    ) + ["text"] * 5
    types = drift.create_table_column_types(schema)
    parsed = T.StructType.fromDDL(types)
    assert parsed.names == schema.names


def test_create_statement_quotes_comments():
    schema = T.StructType(
        [
            T.StructField("id", T.LongType(), metadata={"comment": "it's"}),
            T.StructField("v", T.BooleanType()),
        ]
    )
    assert drift.create_table_statement("t", schema) == (
        "CREATE TABLE IF NOT EXISTS t (\n  `id` bigint COMMENT 'it''s',\n  `v` text COMMENT ''\n) "
        "ENGINE=InnoDB DEFAULT CHARSET=utf8"
    )


def test_relational_values(spark):
    row = spark.sql(
        "SELECT 'x' AS s, date'2024-01-15' AS d, timestamp'2024-01-15 01:02:03' AS t, "
        "1.23456D AS g, true AS b, 7Y AS y, array(1, 2) AS a, map('k', 1) AS k, 5 AS i"
    )
    stored = drift.to_relational(row)
    assert [str(v) for v in stored.first()] == [
        "x",
        "2024-01-15",
        "2024-01-15 01:02:03",
        "1.2346",
        "1",
        "7",
        "[1,2]",
        '{"k":1}',
        "5",
    ]


def test_word_count(spark):
    words = spark.createDataFrame([("a b c",), (" a\tb\nd ",), ("",), (None,)], "line string")
    counts = {r["word"]: r["n"] for r in summaries.word_count(words, "line").collect()}
    assert counts == {"a": 2, "b": 2, "c": 1, "d": 1}


def test_last_value_and_latest_row(spark):
    df = spark.createDataFrame(
        [("k", "old", 1), ("k", "new", 3), ("k", "mid", 2), ("j", None, 5)],
        "key string, value string, at int",
    )
    last = summaries.last_value_by_key(df, "key", "value", "at")
    assert {r["key"]: r["value"] for r in last.collect()} == {"k": "new", "j": None}
    rows = summaries.latest_rows(df, ["key"], ["at"])
    assert rows.columns == df.columns
    assert sorted(tuple(r) for r in rows.collect()) == [("j", None, 5), ("k", "new", 3)]


def test_latest_row_with_a_map(spark):
    df = spark.createDataFrame(
        [("k", {"a": 1}, 1), ("k", {"b": 2}, 2), ("j", None, 1)], "key string, m map<string,int>, at int"
    )
    rows = summaries.latest_rows(df, ["key"], ["at"])
    assert sorted((r["key"], r["m"], r["at"]) for r in rows.collect()) == [
        ("j", None, 1),
        ("k", {"b": 2}, 2),
    ]
