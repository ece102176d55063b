"""daybook: keep a day-partitioned warehouse in step with operational stores, on Spark.

Every operator takes and returns DataFrames or columns; sinks write once and
return the table they wrote.  Sub-packages:

* ``functions``  column expressions for days, times and text
* ``sources``    relational, search-index, file and warehouse scans, and day predicates
* ``operators``  stamping, cleaning, schema drift, changed days, summaries, partitions
* ``sinks``      day / range / table replacement, upsert, relational and file export
* ``plans``      the jobs that put these together
"""

from daybook.model import (
    LoadStrategy,
    SaveMode,
    TablePair,
    check_day,
    choose_day_match_strategy,
    choose_strategy,
    days_between,
    pair_tables,
    parse_save_mode,
    require_text,
)

__all__ = [
    "LoadStrategy",
    "SaveMode",
    "TablePair",
    "check_day",
    "choose_day_match_strategy",
    "choose_strategy",
    "days_between",
    "pair_tables",
    "parse_save_mode",
    "require_text",
]
