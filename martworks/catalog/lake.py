"""Lazy model graph over one directory of test tables. Nothing runs until a query's
result is asked for; every model is a plain DataFrame function of its inputs."""

from __future__ import annotations

import uuid
from functools import cache, cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks.catalog.testdata import RAW_TABLES, SELLER_SNAPSHOTS, SOURCES, SPARK_NAMES
from martworks.functions import columns as fn
from martworks.operators.scd2 import snapshot_check
from martworks.plans import marts, rollups, staging
from martworks.session import let_go, shared_dir
from martworks.sources import files

# First order date taken as valid in the test tables, which start in January 1995.
EARLIEST = "1995-02-01"
AS_OF = "2001-08-01"
# Models whose readers group and join by order: kept, they lie in buckets of it.
BY_ORDER = {"stg_order_items": "order_id", "order_context": "order_id"}
SELLER_CHECK_COLUMNS = ("seller_city", "seller_state", "zip_code_prefix")


class Lake:
    """``work_dir`` is where stored steps go, by default the session's shared folder.
    :meth:`close` removes them; a result that reads them has to be used before."""

    def __init__(self, spark: SparkSession, sf_dir: str, work_dir: str | None = None) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self.work_dir = work_dir
        self._folder: str | None = None
        self._kept: set[str] = set()
        self._sources: dict[str, DataFrame] = {}
        self.work = cache(self._work)
        self.src = cache(self._src)
        self.stored = cache(self._stored)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _src(self, name: str) -> DataFrame:
        needs, sql = SOURCES[name]
        frames = {
            n: self.stg_order_items if n == "stg_order_items" else self.table(n) for n in needs
        }
        for name, own in SPARK_NAMES.items():
            sql = sql.replace(f"{{{name}}}", own)
        return self.spark.sql(sql, **frames)

    def raw(self, table: str) -> DataFrame:
        return self._sources[table] if table in self._sources else self.src(RAW_TABLES[table])

    def keep_raw(self, *tables: str) -> None:
        """Store raw tables that joins or aggregates make; who reads them many times then
        reads the stored copy."""
        for table in tables:
            if table not in self._sources:
                path = f"{self.work()}/{RAW_TABLES[table]}"
                self.raw(table).write.option("compression", "zstd").parquet(path)
                self._sources[table] = self.spark.read.parquet(path)
        let_go(self.spark)

    def _work(self) -> str:
        """A folder of this lake's own."""
        root = self.work_dir or shared_dir(self.spark)
        self._folder = f"{root.rstrip('/')}/martworks-{uuid.uuid4().hex[:12]}"
        return self._folder

    def close(self) -> None:
        """Remove everything this lake has stored."""
        if self._folder:
            files.delete(self.spark, self._folder)

    def __enter__(self) -> Lake:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def _stored(self, name: str, columns: tuple[str, ...] = ()) -> DataFrame:
        """A model, or some columns of it, written once and read back, for queries that use
        it many times."""
        path = f"{self.work()}/{name}"
        df = getattr(self, name)
        df = df.select(*columns) if columns else df
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.parquet(path)

    def _bucketed(self, name: str, key: str) -> DataFrame:
        """A model written once in buckets of ``key``: whoever groups or joins it by that key
        needs no exchange. Only a catalog table tells of its buckets; the relation that was read
        keeps them, so the name is dropped at once while the files stay."""
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        table = f"kept_{uuid.uuid4().hex}"
        to = getattr(self, name).write.format("parquet").option("compression", "zstd")
        to.bucketBy(n, key).sortBy(key).option("path", f"{self.work()}/{name}").saveAsTable(table)
        kept = self.spark.table(table)
        self.spark.sql(f"drop table {table}")
        return kept

    def keep(self, *names: str) -> None:
        """Store models that several others read; those then read the stored copy."""
        for name in names:
            if name in self._kept:
                continue
            if name == "stg_order_items":  # the key is a hash that no codec makes smaller
                self.stg_order_items = self.stg_order_items.drop("order_item_key")
                kept = self._bucketed(name, BY_ORDER[name])
                kept = kept.withColumn("order_item_key", fn.surrogate_key("order_id", "line_number"))
            elif name == "order_context":  # measures are worked out after the way to the customers and back
                met = rollups.order_context(self.stg_orders, self.stg_customers).repartition(BY_ORDER[name])
                self.order_context = rollups.delivery_timeline(met)
                kept = self._bucketed(name, BY_ORDER[name])
                self.delivery_timeline = kept.drop(*rollups.BUYER_COLUMNS)
            else:
                kept = self.stored(name)
            self.__dict__[name] = kept
            self._kept.add(name)

    # staging

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.customers(self.src("src_customers"))

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.orders(self.src("src_orders"), EARLIEST)

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.order_items(self.src("src_order_items"))

    @cached_property
    def stg_payments(self) -> DataFrame:
        return staging.order_payments(self.src("src_order_payments"))

    @cached_property
    def stg_reviews(self) -> DataFrame:
        return staging.order_reviews(self.src("src_order_reviews"))

    @cached_property
    def stg_geolocation(self) -> DataFrame:
        return staging.geolocation(self.src("src_geolocation"))

    @cached_property
    def stg_translation(self) -> DataFrame:
        return staging.category_translation(self.src("src_translation"))

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.products(self.src("src_products"), self.stg_translation)

    @cached_property
    def stg_sellers(self) -> DataFrame:
        return staging.sellers(self.src("src_sellers"))

    # order grain and line context

    @cached_property
    def payment_summary(self) -> DataFrame:
        return rollups.payment_summary(self.stg_payments)

    @cached_property
    def item_summary(self) -> DataFrame:
        return rollups.item_summary(self.stg_order_items, self.stg_products, dealt=True)

    @cached_property
    def review_summary(self) -> DataFrame:
        return rollups.review_summary(self.stg_reviews)

    @cached_property
    def delivery_timeline(self) -> DataFrame:
        return rollups.delivery_timeline(self.stg_orders)

    @cached_property
    def order_context(self) -> DataFrame:
        return rollups.order_context(self.delivery_timeline, self.stg_customers)

    @cached_property
    def line_context(self) -> DataFrame:
        return rollups.line_context(
            self.stg_order_items, self.order_context, self.stg_products, self.stg_sellers,
            dealt=set(BY_ORDER) <= self._kept,
        )

    @cached_property
    def items_enriched(self) -> DataFrame:
        return self.line_context.select(*rollups.ENRICHED_COLUMNS)

    # marts

    @cached_property
    def fct_orders(self) -> DataFrame:
        return marts.fct_orders(
            self.order_context, self.item_summary, self.payment_summary, self.review_summary
        )

    @cached_property
    def fct_order_items(self) -> DataFrame:
        return marts.fct_order_items(self.line_context)

    @cached_property
    def dim_geography(self) -> DataFrame:
        return marts.dim_geography(self.stg_geolocation)

    @cached_property
    def order_values(self) -> DataFrame:
        if "order_context" in self._kept:
            return rollups.order_values(self.order_context, self.stg_order_items)
        return rollups.order_values(self.stg_orders, self.stg_order_items, self.stg_customers)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return marts.dim_customers(self.stg_customers, self.order_values, self.dim_geography)

    @cached_property
    def dim_products(self) -> DataFrame:
        return marts.dim_products(self.stg_products, self.stg_order_items)

    @cached_property
    def dim_sellers(self) -> DataFrame:
        sold = self.stg_order_items.select(
            "order_id", "seller_id", "item_price", "freight_value"
        ).join(self.delivery_timeline, "order_id", "inner")
        return marts.dim_sellers(self.stg_sellers, sold, self.dim_geography)

    @cached_property
    def dim_date(self) -> DataFrame:
        return marts.dim_date(marts.calendar_years_of(self.table("orders"), "o_orderdate"))

    @cached_property
    def agg_daily_performance(self) -> DataFrame:
        return marts.agg_daily_performance(self.fct_order_items, self.order_outcomes)

    @cached_property
    def order_outcomes(self) -> DataFrame:
        """The columns of the order fact the daily aggregate reads."""
        score = F.round(F.col("avg_review_score").cast("decimal(28,6)"), 3)
        return self.order_context.join(
            self.review_summary.select("order_id", score.alias("avg_review_score")),
            "order_id",
            "left",
        ).withColumnRenamed("order_id", "order_key")

    # history

    def _seller_attributes(self, source: str) -> DataFrame:
        return staging.sellers(self.src(source)).drop(*staging.LOAD_COLUMNS)

    @cached_property
    def seller_snapshot(self) -> DataFrame:
        first = snapshot_check(
            None,
            self._seller_attributes("src_sellers"),
            "seller_id",
            SELLER_CHECK_COLUMNS,
            SELLER_SNAPSHOTS[0],
        )
        return snapshot_check(
            first,
            self._seller_attributes("src_sellers_later"),
            "seller_id",
            SELLER_CHECK_COLUMNS,
            SELLER_SNAPSHOTS[1],
        )

    @cached_property
    def dim_sellers_history(self) -> DataFrame:
        return marts.dim_sellers_history(self.seller_snapshot)

    @cached_property
    def runs(self) -> DataFrame:
        return self.src("src_runs")
