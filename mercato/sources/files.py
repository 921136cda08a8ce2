"""File layouts: where an index would help a database, the order of rows in files helps Spark."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions import times


_MONTH_ID = T.StructField("month_id", T.IntegerType())


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table; with a declared schema no file footer is read for inference."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def listing(spark: SparkSession, folder: str) -> tuple[tuple, ...]:
    """Per table below ``folder`` its name, time, number of files and bytes: a few calls each."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/*")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in system.globStatus(path) or ():
        summary = system.getContentSummary(status.getPath())
        found.append(
            (status.getPath().getName(), status.getModificationTime(), summary.getFileCount(), summary.getLength())
        )
    return tuple(sorted(found))


def month_id(date_id: str) -> Column:
    """yyyymm of a yyyymmdd column."""
    return F.call_function("div", F.col(date_id), F.lit(100)).cast("int")


def rebalanced(df: DataFrame, partition: str, derived: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows of a value side by side: small parts merged, hot values split.

    ``derived`` columns are told from the others of their row: they do not move but are computed behind the exchange.
    """
    derived = dict(derived or {})
    moved = df.drop(*derived).hint("rebalance", F.col(partition))
    return moved.select(*[derived[c].alias(c) if c in derived else c for c in df.columns])


def write_partitioned(
    df: DataFrame, partition: str, path: str, mode: str = "errorifexists", derived: Mapping[str, Column] | None = None
) -> None:
    """One folder per value; rebalancing merges small files and splits hot values."""
    rebalanced(df, partition, derived).write.mode(mode).partitionBy(partition).parquet(path)


def write_by_month(df: DataFrame, ts: str, path: str) -> None:
    """Partition by calendar month of ``ts`` in a column ``month_id``."""
    number = (F.year(ts) * 100 + F.month(ts)).cast("int")
    write_partitioned(df.withColumn("month_id", number), "month_id", path)


def read_by_month(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table written by ``write_by_month``, with its partition column."""
    return read_table(spark, path, T.StructType([*schema.fields, _MONTH_ID]))


def one_month(table: DataFrame, ts: str, year: int, month: int) -> DataFrame:
    """One month of a table partitioned by ``month_id``: only its folder is read."""
    only = F.col("month_id") == year * 100 + month
    return table.filter(only & times.in_month(F.col(ts), year, month)).drop("month_id")


def write_clustered(
    df: DataFrame, columns: Sequence[str], path: str, bloom: str | None = None
) -> None:
    """Range-partition and sort by ``columns``, so min/max statistics skip files and row groups.

    ``bloom`` adds a Bloom filter on a column looked up by equality.
    """
    writer = df.repartitionByRange(*columns).sortWithinPartitions(*columns).write
    if bloom is not None:
        writer = writer.option(f"parquet.bloom.filter.enabled#{bloom}", "true")
    writer.parquet(path)


# Bits of every column's place on the curve.
CURVE_BITS = 8


def curve_bounds(df: DataFrame, columns: Sequence[str]) -> dict[str, list]:
    """Per column at most 2**CURVE_BITS - 1 values that part its rows evenly: a few hundred values each.

    Numbers and moments are parted by approximate quantiles; texts by those of their most frequent values.
    """
    steps = 1 << CURVE_BITS
    points = [i / steps for i in range(1, steps)]
    bounds = {}
    numeric = [c for c in columns if not isinstance(df.schema[c].dataType, T.StringType)]
    if numeric:
        kinds = {c: df.schema[c].dataType for c in numeric}
        placed = [F.percentile_approx(_place(c, kinds[c]), points, 10_000).alias(c) for c in numeric]
        row = df.agg(*placed).first()
        bounds.update({c: sorted(set(row[c] or [])) for c in numeric})
    for c in columns:
        if c not in bounds:
            often = df.filter(F.col(c).isNotNull()).groupBy(c).count().orderBy(F.desc("count"), c).limit(steps - 1)
            bounds[c] = sorted(r[0] for r in often.collect())
    return bounds


def _place(column: str, kind: T.DataType) -> Column:
    """A column as a number in the same order."""
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return times.micros(F.col(column))
    return F.unix_date(column) if isinstance(kind, T.DateType) else F.col(column)


def curve(df: DataFrame, bounds: dict[str, list]) -> Column:
    """The place on a space-filling curve: the bits of every column's part, interleaved."""

    def passed(name: str, values: list) -> Column:
        """How many of the bounds lie at or below the column's value; none for NULL."""
        if not values:
            return F.lit(0).cast("bigint")
        place, bounds = _place(name, df.schema[name].dataType), F.sort_array(F.lit(values))
        # Halving: a row meets as many bounds as there are bits, not all of them.
        steps = F.lit([1 << bit for bit in reversed(range(len(values).bit_length()))])
        return F.aggregate(
            steps,
            F.lit(0),
            lambda found, step: found + F.when(F.get(bounds, found + step - 1) <= place, step).otherwise(0),
        ).cast("bigint")

    parts = [passed(name, values) for name, values in bounds.items()]
    place = F.lit(0).cast("bigint")
    for bit in range(CURVE_BITS):
        for number, part in enumerate(parts):
            one = F.shiftright(part, bit).bitwiseAND(F.lit(1))
            place = place.bitwiseOR(F.shiftleft(one, bit * len(parts) + number))
    return place


def write_on_curve(df: DataFrame, bounds: dict[str, list], path: str, files: int) -> None:
    """Files of rows that are neighbours in all of the columns at once, so that ranges of each skip files.

    ``files`` is what the readers should be able to skip: at least some dozens.
    """
    placed = df.withColumn("_place", curve(df, bounds))
    placed.repartitionByRange(files, "_place").sortWithinPartitions("_place").drop("_place").write.parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> None:
    """A table bucketed and sorted by ``key``: joins and groupings on it need no exchange."""
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(table)
    )


def first_per_key(rows: DataFrame, key: Sequence[str], first: str) -> DataFrame:
    """The row with the smallest ``first`` per key: a map-side combinable aggregate, no window."""
    rest = [c for c in rows.columns if c not in key]
    picked = rows.groupBy(*key).agg(F.min_by(F.struct(*rest), F.col(first)).alias("_row"))
    return picked.select(*key, "_row.*").select(*rows.columns)


def insert_ignore(target: DataFrame, rows: DataFrame, key: Sequence[str], first: str) -> DataFrame:
    """Rows to append so that ``key`` stays unique: the first per key by ``first``, if still absent.

    A NULL in the key conflicts with nothing, so such rows are all appended.
    """
    exempt = rows.filter(reduce(Column.__or__, [F.col(c).isNull() for c in key]))
    picked = first_per_key(rows.dropna(subset=list(key)), key, first)
    absent = picked.join(target.select(*key), list(key), "left_anti").select(*rows.columns)
    return absent.unionByName(exempt)


def create_tables(
    spark: SparkSession, database: str, schemas: dict[str, T.StructType], root: str
) -> None:
    """Empty Parquet tables with declared schemas below ``root``, where they do not exist yet."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}'")
    for name, schema in schemas.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")
