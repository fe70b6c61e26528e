"""Group counts, and their join-back onto every click.

Seven counts say how often a click's address, app, system and device occur together with its hour and day. A click with
a null in any key of any group has no match and is dropped, but it still counts in the groups whose keys it does have.

Three methods give the same rows:

``split`` (default; ``join`` where no group contains ``ip``)
    Six of the seven groups contain ``ip``. Clicks are shuffled by ``ip`` once and those six counts are windows over
    that one partitioning. An ``ip`` so frequent that its clicks should not meet in one task stays out of that shuffle:
    its clicks are aggregated to one row per distinct combination of keys, the counts are sums over those rows, and they
    come back to the clicks by a join on the full combination. A count without ``ip`` is aggregated and joined back.
``join``
    The clicks are reduced to cells, the distinct combinations of all keys with their number, which are written. Every count
    is a sum over the cells, joined back to the cells, and one join on the full combination brings all of them to the clicks:
    those are aggregated once and shuffled once, whatever the number of groups.
``window``
    All clicks of one group, hot or not, go to one task. For data known to be even.

Aggregations are partial before their shuffle and joins are spread (see ``joins``), so that with ``split`` and ``join``
no key, however frequent, brings its clicks together in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickcast.operators.joins import HOT_ROWS, at_hand, broadcast_rows, frequent_keys, join_few, not_broadcast, spread_join
from clickcast.session import stored

Groups = Mapping[str, Sequence[str]]

# The name of each count and the keys it groups by, in output order.
GROUPS: Groups = {
    "ip_h_dev": ("ip", "hour", "device"),
    "ip_h_app": ("ip", "hour", "app"),
    "ip_h_os": ("ip", "hour", "os"),
    "ip_day_h": ("ip", "day", "hour"),
    "ip_os_dev": ("ip", "os", "device"),
    "nipApp": ("ip", "day", "hour", "app"),
    "app_day_h_dev": ("app", "day", "hour", "device"),
}

# On request only.
OPTIONAL_GROUPS: Groups = {"nipAppOs": ("ip", "day", "hour", "app", "os")}


def group_counts(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows per distinct combination of ``keys``. Null is a value of its own."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def add_group_count(df: DataFrame, keys: Sequence[str], name: str, method: str = "join") -> DataFrame:
    """One group's count on every row; rows with a null key are dropped. Columns keep their order."""
    if method == "window":
        counted = _drop_null_keys(_windows(df, {name: keys}, F.count("*")), keys)
    elif method == "join":
        rows = _drop_null_keys(df, keys)
        counted = _join_back(rows, stored(_table(rows, keys, name, F.count("*")), name), keys, HOT_ROWS)
    else:
        raise ValueError(f"unknown method {method!r}")
    return counted.select(*df.columns, name)


def hot_values(df: DataFrame, column: str = "ip", rows: int = HOT_ROWS) -> DataFrame:
    """The values of ``column`` with at least ``rows`` rows, as a table of that column that is at hand.

    Runs a job: it reads one column and aggregates it before the shuffle. No more values than ``rows`` goes into all rows.
    """
    counted = group_counts(df.filter(F.col(column).isNotNull()), [column], "n")
    return at_hand(frequent_keys(counted, "n", rows).select(column))


def click_features(
    df: DataFrame,
    groups: Groups = GROUPS,
    method: str = "split",
    counts_from: DataFrame | None = None,
    hot: DataFrame | Sequence | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Prepared clicks (see ``prepare_clicks``) with all group counts appended in the order of ``groups``.

    ``counts_from`` counts over another table, such as the training split, and gives 0 for combinations it lacks.
    ``hot`` names the frequent addresses, in a column ``ip`` or a list, if they are known already; otherwise ``split``
    finds those with ``hot_rows``.
    """
    # Rows that only receive counts and rows that only count go through the same plan.
    rows, total = df, F.count("*")
    if counts_from is not None:
        total = F.sum("_counts")
        receiving = df.withColumns({"_counts": F.lit(0), "_kept": F.lit(True)})
        counting = counts_from.select(*_all_keys(groups)).withColumns({"_counts": F.lit(1), "_kept": F.lit(False)})
        rows = receiving.unionByName(counting, allowMissingColumns=True)

    if method == "join" or (method == "split" and not any("ip" in keys for keys in groups.values())):
        counted = _from_cells(rows, groups, total, hot_rows) if groups else _received(rows)
    elif method == "window":
        counted = _received(with_all_keys(_windows(rows.repartition("ip"), groups, total), groups))
    elif method == "split":
        counted = _split(rows, groups, total, hot, hot_rows)
    else:
        raise ValueError(f"unknown method {method!r}")
    return counted.select(*df.columns, *groups)


def with_all_keys(df: DataFrame, groups: Groups = GROUPS) -> DataFrame:
    """The rows ``click_features`` keeps: those with no null in any group's keys."""
    return _drop_null_keys(df, _all_keys(groups)) if groups else df


def _all_keys(groups: Groups) -> list[str]:
    return list(dict.fromkeys(k for keys in groups.values() for k in keys))


def _drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def _received(df: DataFrame) -> DataFrame:
    return df.filter("_kept") if "_kept" in df.columns else df


def _windows(df: DataFrame, groups: Groups, total: Column) -> DataFrame:
    for name, keys in groups.items():
        df = df.withColumn(name, total.over(Window.partitionBy(*keys)))
    return df


def _table(rows: DataFrame, keys: Sequence[str], name: str, total: Column) -> DataFrame:
    return rows.groupBy(*keys).agg(total.alias(name), F.count("*").alias("_rows"))


def _join_back(df: DataFrame, table: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """``df`` with the counts of ``table``, which is at hand: whether any combination is frequent decides the plan."""
    frequent = frequent_keys(table, "_rows", hot_rows).drop("_rows")
    if frequent.isEmpty():
        return df.join(table.drop("_rows"), list(keys))
    return spread_join(df, table.drop("_rows"), frequent, keys)


def _split(
    rows: DataFrame, groups: Groups, total: Column, hot: DataFrame | Sequence | None, hot_rows: int
) -> DataFrame:
    by_ip = {name: keys for name, keys in groups.items() if "ip" in keys}
    others = {name: keys for name, keys in groups.items() if "ip" not in keys}
    tables = {name: stored(_table(_drop_null_keys(rows, keys), keys, name, total), name) for name, keys in others.items()}
    # A click without an address is in no group by address and is dropped in the end. Dropped here, the nulls do not
    # meet in one task. Nulls in other keys are dropped after they are counted.
    addressed = rows.filter(F.col("ip").isNotNull())
    if hot is None:
        hot = hot_values(addressed, rows=hot_rows)
    elif not isinstance(hot, DataFrame):
        hot = rows.sparkSession.createDataFrame([(str(v),) for v in hot], "ip string")
    hot = hot.select(F.col("ip").cast(rows.schema["ip"].dataType)).distinct()
    any_hot = not hot.isEmpty()
    even = addressed
    if any_hot:
        marked = join_few(addressed, hot.withColumn("_hot", F.lit(True)), ["ip"]).select(*addressed.columns, "_hot")
        even, frequent = (marked.filter(c).drop("_hot") for c in ("_hot is null", "_hot"))

    counted = _received(with_all_keys(_windows(even.repartition("ip"), by_ip, total), groups))
    for name, keys in others.items():
        counted = _join_back(counted, tables[name], keys, hot_rows)
    if any_hot:
        counted = counted.unionByName(_join_cells(frequent, groups, by_ip, tables, total, hot_rows))
    return counted


def _cells(rows: DataFrame, groups: Groups, total: Column) -> DataFrame:
    """The distinct combinations of all keys, nulls included, with what they count and how many rows they have: written."""
    return stored(_table(rows, _all_keys(groups), "_total", total), "cells")


def _with_sums(cells: DataFrame, groups: Groups, summed: Groups) -> DataFrame:
    """Cells without a null, each with the sums of the groups ``summed``; null keys count where they are not among the keys.

    Sums are aggregated before their shuffle and joined back to the cells, so that no address brings its clicks together.
    """
    with_sums, most = with_all_keys(cells, groups).drop("_rows"), cells.count()
    for name, group in summed.items():
        table = _drop_null_keys(cells, group).groupBy(*group).agg(F.sum("_total").alias(name))
        with_sums = with_sums.join(not_broadcast(table, most), list(group))
    return with_sums.drop("_total")


def _on_rows(rows: DataFrame, with_sums: DataFrame, cells: DataFrame, groups: Groups, hot_rows: int) -> DataFrame:
    """The sums of the cells on the rows, frequent cells spread.

    If ``hot_rows`` makes more cells frequent than can be broadcast, those below ``HOT_ROWS`` are not: so many rows may meet.
    """
    keys, whole = _all_keys(groups), with_all_keys(cells, groups)
    with_sums = stored(with_sums, "cell-sums")
    most = broadcast_rows(len(with_sums.columns) + 1)
    frequent = frequent_keys(whole, "_rows", hot_rows).select(*keys)
    found = frequent.limit(most + 1).count()
    if found > most and hot_rows < HOT_ROWS:
        frequent = frequent_keys(whole, "_rows", HOT_ROWS).select(*keys)
        found = frequent.limit(most + 1).count()
    received, known = _received(with_all_keys(rows, groups)), not_broadcast(with_sums, with_sums.count())
    if not found:
        return received.join(known, keys)
    few = frequent.hint("merge") if found > most else frequent
    return spread_join(received, known, with_sums.join(few, keys, "left_semi"), keys)


def _from_cells(rows: DataFrame, groups: Groups, total: Column, hot_rows: int) -> DataFrame:
    cells = _cells(rows, groups, total)
    return _on_rows(rows, _with_sums(cells, groups, groups), cells, groups, hot_rows)


def _join_cells(
    df: DataFrame, groups: Groups, by_ip: Groups, tables: Mapping[str, DataFrame], total: Column, hot_rows: int
) -> DataFrame:
    """Counts for rows with few distinct ``ip``, each frequent; ``tables`` has the counts without ``ip``, over all rows."""
    cells = _cells(df, groups, total)
    with_sums = _with_sums(cells, groups, by_ip)
    for name, table in tables.items():
        with_sums = with_sums.join(table.drop("_rows"), list(groups[name]))
    return _on_rows(df, with_sums, cells, groups, hot_rows)
