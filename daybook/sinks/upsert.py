"""Insert-or-update by key on a warehouse table."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from daybook.operators import drift, partitions
from daybook.operators.frames import required
from daybook.operators.summaries import latest_rows
from daybook.session import quoted, session_settings, staged
from daybook.sinks import keyfilter
from daybook.sinks.warehouse import merging, replace_by_name, sized


def upsert(
    df: DataFrame,
    table: str,
    keys: list[str],
    order_by: list[str],
    blank_as_null: bool = True,
    key_filter: bool = False,
) -> DataFrame:
    """Insert the frame's rows, replacing rows of equal key.

    The frame is brought to the table's columns (missing ones become NULL) and blank text
    to NULL; of several rows with one key the last by ``order_by`` counts.  ``order_by``
    may name columns the table does not have.  A NULL key is an error.

    A partitioned table is rewritten only in the partitions that receive a row or hold one
    that is replaced.  An unpartitioned managed one is written anew beside the old one and
    takes its name, comment and properties.  An external one is staged and overwritten in place.

    With ``key_filter`` filters of the keys are kept beside a partitioned table (:mod:`daybook.sinks.keyfilter`): only
    partitions that can hold a key of the batch are read to find those that do.
    """
    spark = df.sparkSession
    target = spark.table(quoted(table))
    keys = [k.lower() for k in keys]
    order = {f"_order_{n}": F.col(c) for n, c in enumerate(order_by)}
    batch = drift.align_to_target(df, target.schema, order, blank_as_null)
    latest = latest_rows(batch, keys, list(order)).drop(*order)
    latest = latest.withColumns({k: required(k) for k in keys})
    with staged(latest) as new:
        by = [c.lower() for c in partitions.partition_columns(spark, table)]
        if by:
            filtered = key_filter and not set(by) <= set(keys)  # such keys name their partition themselves
            hits = keyfilter.possible(new, table, keys, by) if filtered else None
            within = target if hits is None else keyfilter.of_partitions(target, by, hits)
            _rewrite_partitions(target, within, new, table, keys, by)
            if filtered:
                keyfilter.refresh(spark, table, keys, by)
        else:
            _rewrite(target, new, table, keys)
    return spark.table(quoted(table))


def _merged(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    # The planner knows the staged keys' real size: it broadcasts them below its limit
    # and otherwise shuffles both sides, splitting hot partitions at run time.
    return old.join(new.select(*keys), keys, "left_anti").select(*old.columns).unionByName(new)


def _rewrite_partitions(
    target: DataFrame, within: DataFrame, new: DataFrame, table: str, keys: list[str], by: list[str]
) -> None:
    """Rewrite the partitions that receive a row or hold one that is replaced, in one dynamic overwrite.

    Unless the keys name the whole partition, finding those that hold one scans the keys of all rows of ``within``: the
    target, or the part of it that can hold a key.
    """
    spark = target.sparkSession
    touched = new.select(*by)
    if not set(by) <= set(keys):
        touched = touched.union(within.join(new.select(*keys), keys, "left_semi").select(*by))
    # one row per partition, as text with the catalog's stand-in for NULL
    names = F.struct(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(partitions.NO_DAY)).alias(c) for c in by])
    found = [tuple(r["p"]) for r in touched.select(names.alias("p")).distinct().collect()]
    if not found:
        return
    held = keyfilter.of_partitions(target, by, [list(p) for p in found])
    rows = drift.in_table_order(_merged(held, new, keys), target.schema)
    seen = Observation()
    # A dynamic overwrite may read the partitions it replaces: their files go at commit, not before.
    observed = sized(rows, by_day=len({p[0] for p in found}) > 1).observe(seen, F.collect_set(names).alias("filled"))
    settings = {"spark.sql.sources.partitionOverwriteMode": "dynamic"} | merging(by_day=len(found) > 1)
    with session_settings(spark, settings):
        observed.write.mode("overwrite").insertInto(quoted(table))
    emptied = set(found) - {tuple(p) for p in seen.get["filled"]}
    levels = ["/".join(f"{c}={quote(v, safe='')}" for c, v in zip(by, p)) for p in sorted(emptied)]
    partitions.drop_named(spark, table, levels)


def _rewrite(target: DataFrame, new: DataFrame, table: str, keys: list[str]) -> None:
    merged = drift.in_table_order(_merged(target, new, keys), target.schema)
    spark = target.sparkSession
    held = partitions.described(spark, table)
    if held.get("type") != "MANAGED":
        # External files stay where they are: stage the result, then overwrite in place.
        whole = {"spark.sql.sources.partitionOverwriteMode": "static"}
        with staged(merged) as rows, session_settings(spark, whole):
            rows.write.mode("overwrite").insertInto(quoted(table))
        return
    replace_by_name(merged, table, held["provider"])
