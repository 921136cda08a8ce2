"""Loading the star: every load is a complete new version, published last.

A load writes into a fresh folder below ``root`` and appends its name to the version list only
when all tables are complete.  A failed or repeated load therefore never shows half a star, and no
path is read and overwritten at once.

Each version has a manifest: which load wrote every month folder of the facts and every dimension, with
a digest of the rows.  ``incremental_refresh`` compares digests and writes only what changed; the rest of
its manifest names folders of earlier loads.  ``remove_superseded`` deletes what no manifest that counts
names any more.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato import scratch
from mercato.sources.files import month_id, read_table, write_bucketed, write_partitioned
from mercato.sources.schemas import STAR
from mercato.sources.shop import Shop
from mercato.warehouse import star
from mercato.warehouse.history import scd2_apply

PROFILE = ("full_name", "email", "gender", "city")
FACTS = ("fct_orders", "fct_order_items")
MONTH = "month_id"
# The folder of rows without a day.
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
MANIFEST = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField(MONTH, T.IntegerType()),
        T.StructField("source", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("digest", T.StringType()),
    ]
)


class Star:
    """One version below ``root``; a published one never changes, so its tables are opened once."""

    def __init__(self, spark: SparkSession, root: str, version: str):
        self.spark, self.root, self.version = spark, root, version
        self._open: dict[str, DataFrame] = {}

    def path(self, table: str, source: str | None = None) -> str:
        return f"{self.root}/{source or self.version}/{table}"

    @cached_property
    def manifest(self) -> list[Row]:
        """(table, month_id, source, row_count, digest) of every part; some hundred rows."""
        return read_table(self.spark, self.path("manifest"), MANIFEST).collect()

    def table(self, name: str) -> DataFrame:
        """The declared columns; ``fact`` shows the facts' month folders too."""
        if name not in self._open:
            if name in FACTS:
                self._open[name] = self.fact(name).select(*STAR[name].names)
            else:
                source = next(r["source"] for r in self.manifest if r["table"] == name)
                self._open[name] = read_table(self.spark, self.path(name, source), STAR[name])
        return self._open[name]

    def fact(self, name: str) -> DataFrame:
        """A fact with the month folder its rows lie in, as ``month_id``, whichever load wrote the folder."""
        months: dict[str, list[str]] = {}
        for r in self.manifest:
            if r["table"] == name:
                folder = r["month_id"] if r["month_id"] is not None else NO_MONTH
                months.setdefault(r["source"], []).append(f"{self.path(name, r['source'])}/{MONTH}={folder}")
        schema = _with_month(name)
        parts = [
            self.spark.read.schema(schema).option("basePath", self.path(name, source)).parquet(*paths)
            for source, paths in sorted(months.items())
        ]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schema)

    def fact_on_days(self, name: str, days: DataFrame) -> DataFrame:
        """A fact's rows on some of ``dim_date``'s days, with their attributes.

        The join names the month as well: what is filtered in the dimension prunes the fact's folders
        while the query runs.
        """
        return self.fact(name).join(days.withColumn(MONTH, month_id("date_id")), [MONTH, "date_id"]).drop(MONTH)

    def bucketed(self, name: str, key: str = "order_id") -> DataFrame:
        """A fact once more, in as many buckets by ``key`` as shuffles have partitions.

        Facts bucketed alike are joined on the key without an exchange.
        """
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        table = f"{name}_{self.version.replace('-', '_')}_{buckets}"
        if not self.spark.catalog.tableExists(table):
            write_bucketed(self.table(name), table, key, buckets, f"{self.path(name)}_by_{key}_{buckets}")
        return self.spark.table(table)


def _with_month(name: str) -> T.StructType:
    return T.StructType([*STAR[name].fields, T.StructField(MONTH, T.IntegerType())])


def versions(spark: SparkSession, root: str) -> list[str]:
    """Published versions, the latest first."""
    listed = spark.read.schema("version string, published_at double").parquet(f"{root}/versions")
    return [r["version"] for r in listed.orderBy(F.desc("published_at"), F.desc("version")).collect()]


def published(spark: SparkSession, root: str) -> Star:
    """The latest complete version."""
    return Star(spark, root, versions(spark, root)[0])


def _digests(name: str, rows: DataFrame) -> DataFrame:
    """Rows and a digest of their content, which their order does not change, per month of a fact."""
    whole = F.xxhash64(*STAR[name].names)
    again = F.xxhash64(F.lit(1), *STAR[name].names)
    content = F.concat_ws("-", F.sum(whole.cast("decimal(20,0)")), F.bit_xor(again))
    month = F.col(MONTH) if name in FACTS else F.lit(None).cast("int").alias(MONTH)
    counted = rows.groupBy(month.alias(MONTH)).agg(F.count(F.lit(1)).alias("row_count"), content.alias("digest"))
    return counted.select(F.lit(name).alias("table"), MONTH, "row_count", "digest")


class _Load:
    """A version in the making, over an earlier one whose unchanged parts it takes over."""

    def __init__(self, spark: SparkSession, root: str, before: Star | None):
        self.star = Star(spark, root, f"load-{uuid.uuid4().hex}")
        self.known = {(r["table"], r[MONTH]): r for r in before.manifest} if before else {}
        self.star.manifest = []

    def store(self, name: str, df: DataFrame, derived: Mapping[str, Column] | None = None) -> DataFrame:
        """Writes what is new of a table and returns it as the version will show it.

        ``derived`` tells columns of a fact from its others; they do not move to the month folders.
        """
        rows = df.select(*STAR[name].names)
        rows = rows.withColumn(MONTH, month_id("date_id")) if name in FACTS else rows
        mine = self.star.version
        found, changed = [], None
        if any(table == name for table, _ in self.known):
            changed = []
            for r in _digests(name, rows).collect():
                old = self.known.get((name, r[MONTH]))
                same = old and (old["row_count"], old["digest"]) == (r["row_count"], r["digest"])
                changed += [] if same else [r[MONTH]]
                found.append(Row(**{**r.asDict(), "source": old["source"] if same else mine}))
        if changed is None or changed:
            if name in FACTS:
                months = None if changed is None else reduce(Column.__or__, [F.col(MONTH).eqNullSafe(F.lit(m)) for m in changed])
                wanted = rows if months is None else rows.filter(months)
                write_partitioned(wanted, MONTH, self.star.path(name), derived=derived)
            else:
                rows.write.parquet(self.star.path(name))
        if changed is None:
            schema = _with_month(name) if name in FACTS else STAR[name]
            written = read_table(self.star.spark, self.star.path(name), schema)
            found = [Row(**{**r.asDict(), "source": mine}) for r in _digests(name, written).collect()]
        if not found:  # an empty table
            found = [Row(table=name, month_id=None, source=mine, row_count=0, digest="")] if name not in FACTS else []
            if name not in FACTS and changed == []:
                rows.write.parquet(self.star.path(name))
        self.star.manifest += found
        return self.star.table(name)

    def publish(self) -> Star:
        spark, star_ = self.star.spark, self.star
        lines = [tuple(r[c] for c in MANIFEST.names) for r in star_.manifest]
        spark.createDataFrame(lines, MANIFEST).coalesce(1).write.parquet(star_.path("manifest"))
        now = dt.datetime.now(dt.timezone.utc).timestamp()
        spark.createDataFrame([(star_.version, now)], "version string, published_at double").write.mode(
            "append"
        ).parquet(f"{star_.root}/versions")
        return star_


def full_refresh(
    shop: Shop,
    root: str,
    keep_history: bool = False,
    effective: dt.datetime | str | None = None,
    as_of: bool = False,
) -> Star:
    """Rebuild the star from the operational tables.

    By default customer history starts over.  ``keep_history`` carries the published customer
    dimension on, closing and opening versions at ``effective``.  Orders refer to the current version
    of their customer, with ``as_of`` to the one that was valid when they were placed.
    """
    return _refresh(shop, root, None, keep_history, effective, as_of)


def incremental_refresh(
    shop: Shop,
    root: str,
    keep_history: bool = False,
    effective: dt.datetime | str | None = None,
    as_of: bool = False,
) -> Star:
    """The same star as ``full_refresh`` makes, but only months and dimensions that differ are written.

    The others stay the files of the published version.  Changed, late and removed rows alike change
    the digest of their month.
    """
    return _refresh(shop, root, published(shop.spark, root), keep_history, effective, as_of)


def _refresh(
    shop: Shop,
    root: str,
    over: Star | None,
    keep_history: bool,
    effective: dt.datetime | str | None,
    as_of: bool,
) -> Star:
    loading = _Load(shop.spark, root, over)
    loading.store("dim_date", star.dim_date(shop.orders))
    products = loading.store("dim_product", star.dim_product(shop.products, shop.categories))
    if keep_history:
        if effective is None:
            raise ValueError("keep_history needs the moment the changes take effect")
        before = published(shop.spark, root).table("dim_customer")
        profile = star.customer_profile(shop.users)
        customers = scd2_apply(before, profile, "user_id", PROFILE, effective, "customer_sk")
    else:
        customers = star.dim_customer_initial(shop.users)
    customers = loading.store("dim_customer", customers)
    loading.store("fct_orders", star.fct_orders(shop.orders, customers, as_of))
    items = star.fct_order_items(shop.keyed_items(), shop.orders, products)
    if over is not None:
        # Looked at twice, for digests and for what changed; numbering and joining the lines moves them all.
        items = scratch.materialize(items, "items")
    loading.store("fct_order_items", items, {"line_total": star.line_total()})
    return loading.publish()


def remove_superseded(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Deletes folders that none of the ``keep`` latest versions names; returns them.

    Loads that were never published go too, so none may be running.  Readers of older versions lose them.
    """
    listed = versions(spark, root)
    staying = [Star(spark, root, v) for v in listed[:keep]]
    named = {star_.version for star_ in staying}
    for star_ in staying:
        for r in star_.manifest:
            table = star_.path(r["table"], r["source"])
            folder = r[MONTH] if r[MONTH] is not None else NO_MONTH
            named.add(f"{table}/{MONTH}={folder}" if r["table"] in FACTS else table)
    system = spark._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def children(folder: str) -> list[str]:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        return [f"{folder}/{f.getPath().getName()}" for f in system.listStatus(path) if f.isDirectory()]

    removed = []

    def remove(folder: str) -> None:
        system.delete(spark._jvm.org.apache.hadoop.fs.Path(folder), True)
        removed.append(folder)

    for load in children(root):
        name = load.rsplit("/", 1)[1]
        if not name.startswith("load-") or name in named:
            continue
        if not any(n.startswith(f"{load}/") for n in named):
            remove(load)
            continue
        for table in children(load):
            if table in named:
                continue
            for part in children(table) if any(n.startswith(f"{table}/") for n in named) else [table]:
                if part not in named:
                    remove(part)
    return removed


_LOADED: dict[tuple[str, str, tuple[tuple, ...]], Star] = {}


def star_of(shop: Shop) -> Star:
    """The star of a folder, loaded into the shared folder once per application and state of its files."""
    key = (shop.spark.sparkContext.applicationId, shop.folder, shop.version)
    if key not in _LOADED:
        _LOADED[key] = full_refresh(shop, scratch.new_path(shop.spark, "star"))
    return _LOADED[key]
