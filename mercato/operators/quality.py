"""Constraint audits: Spark tables declare no constraints, so violations are queried for."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mercato.functions import times
from mercato.sources.schemas import NOW, Rules

REPORT = ("table_name", "rule", "subject", "violations")


def _violated(condition: Column) -> Column:
    """A check holds when it is true or unknown."""
    return ~F.coalesce(condition, F.lit(True))


def _too_long(column: str, limit: int) -> Column:
    return F.coalesce(F.char_length(F.col(column)) > limit, F.lit(False))


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.filter(F.col(column).isNull())


def check_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys on several rows, with their row count; a NULL in the key exempts the row."""
    return (
        df.dropna(subset=list(key))
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def check_foreign_key(
    df: DataFrame, column: str, parent: DataFrame, parent_key: str = "id"
) -> DataFrame:
    """Values without a parent row, with their row count.

    Rows are counted per value before the join, so a frequent value costs one row.
    """
    counted = (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    return counted.join(parent.select(F.col(parent_key).alias(column)), column, "left_anti")


def count_orphans(df: DataFrame, parents: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows without a parent per referring column, in one row with a column for each.

    ``parents`` maps each column to its parent's frame and key.  All references of the table come from
    one scan: a row gives a (column, value) pair per reference, pairs are counted before they move, and
    one anti-join holds the distinct ones against the keys of all parents.
    """
    names = list(parents)
    values = [F.struct(F.lit(i).alias("_of"), F.col(c).cast("string").alias("_value")) for i, c in enumerate(names)]
    pairs = df.select(F.inline(F.array(*values))).filter(F.col("_value").isNotNull())
    counted = pairs.groupBy("_of", "_value").agg(F.count(F.lit(1)).alias("_rows"))
    keys = reduce(
        DataFrame.unionByName,
        [
            parent.select(F.lit(i).alias("_of"), F.col(key).cast("string").alias("_value"))
            for i, (parent, key) in enumerate(parents.values())
        ],
    )
    orphans = counted.join(keys, ["_of", "_value"], "left_anti")
    sums = [F.coalesce(F.sum(F.when(F.col("_of") == i, F.col("_rows"))), F.lit(0)) for i in range(len(names))]
    return orphans.agg(*[total.alias(c) for total, c in zip(sums, names, strict=True)])


def check_expression(df: DataFrame, condition: str | Column) -> DataFrame:
    """Rows for which the condition is false."""
    return df.filter(_violated(F.expr(condition) if isinstance(condition, str) else condition))


def check_length(df: DataFrame, column: str, limit: int) -> DataFrame:
    """Rows whose text has more than ``limit`` characters."""
    return df.filter(_too_long(column, limit))


def apply_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Fill columns the frame does not have; an explicit NULL stays NULL."""
    absent = {name: value for name, value in defaults.items() if name not in df.columns}
    return df.withColumns(absent) if absent else df


def declared_defaults(
    rules: Rules, schema: StructType, now: dt.datetime | str
) -> dict[str, Column]:
    """The columns a table declares a default for, in their types; ``now`` is when the rows arrive."""
    found = {}
    for name, literal in rules.defaults.items():
        value = times.ntz(now) if literal == NOW else F.expr(literal)
        found[name] = value.cast(schema[name].dataType)
    return found


def _report(counts: DataFrame, table: str, lines: Sequence[tuple[str, str, str]]) -> DataFrame:
    """A line per (rule, subject, column) of a frame with one row of counts."""
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(rule).alias("rule"),
            F.lit(subject).alias("subject"),
            F.col(column).alias("violations"),
        )
        for rule, subject, column in lines
    ]
    return counts.select(F.inline(F.array(*rows)))


def audit(tables: Mapping[str, DataFrame], rules: Mapping[str, Rules]) -> DataFrame:
    """Violations per declared rule of the tables named in ``rules``.

    ``tables`` also holds the parents that foreign keys refer to.  All row rules of a table are counted
    in one scan, all of its references in another; a unique rule reports keys, a foreign key reports rows.
    """
    parts: list[DataFrame] = []
    for name, declared in rules.items():
        df = tables[name]
        row_rules = [("not_null", c, F.col(c).isNull()) for c in declared.not_null]
        row_rules += [("check", c, _violated(F.expr(e))) for c, e in declared.checks.items()]
        row_rules += [("length", c, _too_long(c, n)) for c, n in declared.lengths.items()]
        if row_rules:
            counted = df.agg(*[F.count_if(bad).alias(f"n{i}") for i, (_, _, bad) in enumerate(row_rules)])
            lines = [(rule, subject, f"n{i}") for i, (rule, subject, _) in enumerate(row_rules)]
            parts.append(_report(counted, name, lines))
        for key in declared.unique:
            repeated = check_unique(df, key).agg(F.count(F.lit(1)).alias("n"))
            parts.append(_report(repeated, name, [("unique", "+".join(key), "n")]))
        if declared.foreign:
            parents = {}
            for column, parent in declared.foreign.items():
                table, _, key = parent.partition(".")
                parents[column] = (tables[table], key or "id")
            parts.append(_report(count_orphans(df, parents), name, [("foreign_key", c, c) for c in parents]))
    return reduce(DataFrame.unionByName, parts)


def line_totals(items: DataFrame) -> DataFrame:
    """Sum of the lines per order."""
    value = F.col("quantity") * F.col("unit_price")
    return items.groupBy("order_id").agg(F.sum(value).cast("decimal(20,2)").alias("line_total"))


def _with_line_total(orders: DataFrame, items: DataFrame) -> DataFrame:
    totals = line_totals(items).withColumnRenamed("order_id", "id")
    none = F.lit(0).cast("decimal(20,2)")
    return orders.join(totals, "id", "left").withColumn(
        "line_total", F.coalesce("line_total", none)
    )


def reconcile_order_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with their total replaced by the sum of their lines, in the column's own type."""
    total = F.col("line_total").cast(orders.schema["total_amount"].dataType).alias("total_amount")
    columns = [total if c == "total_amount" else F.col(c) for c in orders.columns]
    return _with_line_total(orders, items).select(*columns)


def total_mismatches(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders whose total differs from the sum of their lines."""
    return (
        _with_line_total(orders, items)
        .filter(~F.col("total_amount").eqNullSafe(F.col("line_total")))
        .select("id", "total_amount", "line_total")
    )
