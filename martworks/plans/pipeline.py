"""The daily build: raw tables to marts, in full or incrementally.

Order: staging, facts, dimensions and aggregate; the snapshot comes before the marts that
read it, so the history dimension is never one run behind."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import reduce
from time import monotonic

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martworks.operators import scd2, upsert
from martworks.operators.key_index import KeyIndex
from martworks.operators.measures import Measures
from martworks.plans import marts, rollups, staging
from martworks.plans.reports import RUN_METRICS_SCHEMA, append_run_metrics
from martworks.plans.warehouse import CLUSTER_COLUMNS, Warehouse, by_month
from martworks.quality import checks, declared, invariants
from martworks.session import concurrently, cut_lineage, let_go, staged
from martworks.sources import files

SELLER_CHECK_COLUMNS = ("seller_city", "seller_state", "zip_code_prefix")
MARTS = (
    "fct_orders",
    "fct_order_items",
    "dim_customers",
    "dim_products",
    "dim_sellers",
    "dim_geography",
    "dim_date",
    "agg_daily_performance",
    "dim_sellers_history",
)
FACT_KEYS = {"fct_orders": ["order_key"], "fct_order_items": ["order_item_key"]}
#: Lines that a full run takes through the facts at a time.
LINES_AT_ONCE = 20_000_000
PRICE = ("order_id", "product_id", "seller_id", "item_price")
#: Raw tables that are landed by slices; a snapshot lands whole each time.
SLICED = ("orders", "order_items")
SEEN_SCHEMA = "name string, ingest_date date, rows long, ingested_at timestamp_ntz"


@dataclass(frozen=True)
class Stored:
    """Measures kept between runs, and how an order's lines or the order add to them."""

    name: str
    measures: Measures
    contributions: Callable[[DataFrame], DataFrame]


CUSTOMER_STATE = Stored("customer_measures", marts.CUSTOMER_MEASURES, marts.customer_contributions)
SELLER_STATE = Stored("seller_measures", marts.SELLER_MEASURES, marts.seller_contributions)
PRODUCT_STATE = Stored("product_measures", marts.PRODUCT_MEASURES, marts.product_contributions)
PRODUCT_SELLER_STATE = Stored("product_sellers", marts.PRODUCT_SELLERS, marts.product_seller_contributions)
#: Columns of the line fact that sellers and products are measured by.
LINE_COLUMNS = (
    "order_id", "product_id", "seller_id", "item_price", "freight_value", "purchased_date", "is_delivered", "is_late",
    "days_to_delivery",
)


def fact_lines(lines: DataFrame) -> DataFrame:
    """Rows of the line fact under the names of the source."""
    return lines.select(
        F.col("order_key").alias("order_id"), F.col("product_key").alias("product_id"),
        F.col("seller_key").alias("seller_id"), *LINE_COLUMNS[3:],
    )


def _part_of(n: int) -> Column:
    return F.pmod(F.xxhash64("order_id"), F.lit(n)).cast("int")


def _without_key(lines: DataFrame) -> DataFrame:
    """Staged lines as they are kept: their key, a hash that no codec makes smaller, is worked
    out again where it is wanted."""
    return lines.drop("order_item_key", *staging.LOAD_COLUMNS)


class ChecksFailed(Exception):
    """Names the checks that a build's marts fail."""


@dataclass
class Build:
    """One run. ``raw`` gives the raw table of a name; ``as_of`` is the run's time.

    An incremental run recomputes the orders of the lookback window, and every older order
    for which an order or line was landed since the last run: in a partition that is new or
    has other rows or a later load than before. ``landed_since`` takes up what was landed on that day or later as well;
    with neither ``take_late`` nor it only the window is recomputed.

    An index tells in which partitions of the sliced raw tables, and of the facts, an
    order lies, so neither is read whole. The measures of the dimensions are kept and
    follow the orders that are recomputed. A run that stops before it has stored them leaves
    a mark, and the next one sums them again from the facts.

    All lines of a run, be it a full one or not, are staged in parts of about
    ``lines_at_once``, dealt by order, and a full run takes each part through both facts before
    the next: what lies on disk between its steps is that of one part. A full run that stops
    between parts leaves a mark, and the next one is a full one again."""

    warehouse: Warehouse
    raw: Callable[[str], DataFrame]
    as_of: datetime
    full_refresh: bool = False
    landed_since: date | None = None
    take_late: bool = True
    earliest: str = staging.EARLIEST_ORDER_DATE
    lookback_days: int = upsert.LOOKBACK_DAYS
    grace_days: int = rollups.DELIVERY_GRACE_DAYS
    partition_by_month: bool = False
    lines_at_once: int = LINES_AT_ONCE
    backdate_first: str | None = None
    calendar: tuple[str, str] = (marts.CALENDAR_START, marts.CALENDAR_END)
    timings: list[tuple[str, float, datetime]] = field(default_factory=list)
    rows: dict[str, int] = field(default_factory=dict)
    _touched: set[date] | None = None
    _began: int = 0
    _partitions: dict[str, dict] = field(default_factory=dict)
    _kept: set[str] = field(default_factory=set)

    @property
    def spark(self):
        return self.warehouse.spark

    def _timed(self, task: str, step: Callable[[], object]):
        """Its time is added to that of earlier parts of the same step."""
        started, began = datetime.now(), monotonic()
        result = step()
        seconds = monotonic() - began
        for i, (known, before, first) in enumerate(self.timings[self._began :], self._began):
            if known == task:
                self.timings[i] = (task, before + seconds, first)
                return result
        self.timings.append((task, seconds, started))
        return result

    # facts

    def _fact_column(self) -> str:
        return "purchased_month" if self.partition_by_month else "purchased_date"

    def _start(self) -> date | None:
        """First purchase date to recompute, None for everything."""
        if self.full_refresh or not all(self.warehouse.exists(f) for f in FACT_KEYS):
            return None
        if self.warehouse.exists("unfinished", "state"):
            return None
        # The newest orders may have no lines yet; the earlier start serves both facts.
        starts = [
            upsert.lookback_start(
                self.warehouse.read(fact), "purchased_date", self.lookback_days
            )
            for fact in FACT_KEYS
        ]
        return None if None in starts else min(starts)

    # what was landed, and where

    def _seen(self) -> dict[str, dict]:
        """Rows and newest load time of each partition of the sliced tables at the last run."""
        if not self.warehouse.exists("seen", "state"):
            return {}
        found: dict[str, dict] = {}
        for r in self.spark.read.schema(SEEN_SCHEMA).parquet(self.warehouse.path("seen", "state")).collect():
            found.setdefault(r["name"], {})[r["ingest_date"]] = (r["rows"], r["ingested_at"])
        return found

    def _landed(self, table: str) -> dict:
        """The same as it is now: one narrow column is read; the calendar bounds the result."""
        if table not in self._partitions:
            days = self.raw(table).groupBy("ingest_date").agg(F.count(F.lit(1)), F.max("_ingested_at"))
            self._partitions[table] = {day: (n, loaded) for day, n, loaded in days.collect()}
        return self._partitions[table]

    def _fresh(self, table: str) -> DataFrame | None:
        """Rows of a sliced table in partitions that were landed, or landed again, since the
        last run, None if there was none."""
        seen, day = self._seen(), F.col("ingest_date")
        if table not in seen and self.landed_since is None:
            return None
        changed = {d for d, what in self._landed(table).items() if seen.get(table, {}).get(d) != what}
        if self.landed_since is not None:
            known = changed if table in seen else set()
            changed = known | {d for d in self._landed(table) if d is not None and d >= self.landed_since}
        condition = day.isin(sorted(d for d in changed if d is not None))
        return self.raw(table).where(condition | day.isNull() if None in changed else condition)

    def _index(self, table: str) -> KeyIndex:
        return KeyIndex(self.spark, self.warehouse.path(table, "index"), "order_id", "ingest_date")

    def _fact_index(self, fact: str) -> KeyIndex:
        """By order, also for lines: a line's key is made of its order's, so the partitions of
        the order are those of its lines, for far fewer and shorter entries."""
        return KeyIndex(self.spark, self.warehouse.path(fact, "index"), "order_key", self._fact_column())

    def _take_in(self, full: bool) -> None:
        """Bring the index of the sliced tables up to date."""
        for table in SLICED:
            index, fresh = self._index(table), None if full else self._fresh(table)
            if fresh is None or not index.exists():
                index.rebuild(self.raw(table))
            else:
                index.add(fresh)

    def _remember(self) -> None:
        """Keep what this run has seen of the sliced tables."""
        seen = [(t, d, *what) for t in SLICED for d, what in self._landed(t).items()]
        frame = self.spark.createDataFrame(seen, SEEN_SCHEMA).coalesce(1)
        frame.write.mode("overwrite").parquet(self.warehouse.path("seen", "state"))

    def _matching(self, table: str, keys: DataFrame | None, key: str) -> DataFrame:
        """Raw rows whose key occurs in ``keys``. The restriction is by (part of) the
        table's key, so it commutes with removing duplicates and can come before that
        shuffle; for a few days of orders Spark broadcasts the key side. Of a sliced table
        only the partitions that hold such keys are read."""
        rows = self.raw(table)
        if keys is None:
            return rows
        if table in SLICED:
            days = self._index(table).partitions(keys, key)
            rows = rows.where(F.col("ingest_date").isin(sorted(days)) | F.col("ingest_date").isNull())
        return rows.join(keys.select(key), key, "left_semi")

    def _late(self) -> DataFrame | None:
        """Keys of the orders that newly landed rows touch. Rows that staging leaves out
        touch nothing."""
        if self.landed_since is None and not self.take_late:
            return None
        orders, lines = self._fresh("orders"), self._fresh("order_items")
        if orders is None or lines is None:
            return None
        floor = F.lit(f"{self.earliest} 00:00:00").cast("timestamp_ntz")
        valid = orders.where(F.col("order_purchase_timestamp") >= floor).select("order_id").union(
            lines.where((F.col("price") >= 0) & (F.col("freight_value") >= 0)).select("order_id")
        )
        return self._keep("late_orders", valid.distinct())

    def _orders(self, start: date | None, late: DataFrame | None) -> DataFrame:
        """Staged orders to recompute. Every order of the window has some raw copy in it,
        so only copies of such candidates, and of late orders, are deduplicated; the
        filter on the raw timestamp reaches the Parquet scan."""
        if start is None:
            return staging.orders(self.raw("orders"), self.earliest)
        since = F.lit(f"{start} 00:00:00").cast("timestamp_ntz")
        candidates = self.raw("orders").where(F.col("order_purchase_timestamp") >= since).select("order_id")
        if late is not None:
            candidates = candidates.union(late)
        candidates = self._keep("candidate_orders", candidates.distinct())
        staged = staging.orders(self._matching("orders", candidates, "order_id"), self.earliest)
        recent = upsert.since(staged, "purchased_date", start)
        if late is None:
            return recent
        older = staged.where(F.col("purchased_date") < F.lit(start))
        return recent.union(older.join(late, "order_id", "left_semi").select(*recent.columns))

    def _keep(self, name: str, df: DataFrame, by: str | None = None, more: bool = False) -> DataFrame:
        """Store a model that several later steps of this run read, in folders ``by`` a column.
        ``more``: add to what is there."""
        path = self.warehouse.path(name, "intermediate")
        out = df.write.mode("append" if more else "overwrite").option("compression", "zstd")
        out = out.partitionBy(by) if by else out
        self._timed(name, lambda: out.parquet(path))
        self._kept.add(name)
        return self.spark.read.schema(df.schema).parquet(path)

    def _parts(self) -> int:
        """In how many parts the lines of a run are taken."""
        lines = sum(n for n, _ in self._landed("order_items").values())
        return max(1, -(-lines // self.lines_at_once))

    @staticmethod
    def _part(n: int, rows: DataFrame, k: int) -> DataFrame:
        """The ``k``-th of ``n`` parts. The condition is by (part of) the key of the table, so it
        commutes with removing duplicates."""
        return rows if n == 1 else rows.where(_part_of(n) == k)

    def _drop_kept(self) -> None:
        """Remove what :meth:`_keep` has stored: no step of this run reads it any more."""
        for name in self._kept:
            files.delete(self.spark, self.warehouse.path(name, "intermediate"))
        self._kept.clear()

    def facts(self) -> dict[str, upsert.UpsertResult]:
        self._partitions.clear()
        self._began = len(self.timings)
        start = self._start()
        results = self._all_facts() if start is None else self._window_facts(start)
        self.rows.update({name: r.rows_written for name, r in results.items()})
        self._touched = None
        if all(r.mode == "incremental" for r in results.values()):
            self._touched = {d.replace(day=1) for r in results.values() for d in r.touched}
        self._mark(False)
        self._remember()
        self._drop_kept()
        let_go(self.spark)
        return results

    def _goods(self) -> tuple[DataFrame, DataFrame]:
        products = staging.products(
            self.raw("products"),
            staging.category_translation(self.raw("product_category_translation")),
        )
        return products, staging.sellers(self.raw("sellers"))

    def _batches(self, context, items, products, sellers, payments, reviews) -> dict[str, DataFrame]:
        return {
            "fct_orders": marts.fct_orders(
                context, rollups.item_summary(items, products), rollups.payment_summary(payments), reviews
            ),
            "fct_order_items": marts.fct_order_items(
                rollups.line_context(items, context, products, sellers)
            ),
        }

    def _store_facts(self, batches: dict[str, DataFrame], start: date | None, k: int = 0, n: int = 1) -> dict:
        # One after the other: the shuffle files of one fact are gone when the next begins.
        results = {}
        for name, batch in batches.items():
            results[name] = self._timed(name, lambda f=name, b=batch: self._store_fact(f, b, start, k, n))
            let_go(self.spark)
        return results

    def _all_facts(self) -> dict[str, upsert.UpsertResult]:
        """Both facts from all orders, part by part, and the measures."""
        n = self._parts()
        let_go_between = lambda: let_go(self.spark) if n > 1 else None
        self._take_in(True)
        let_go_between()
        timeline = rollups.delivery_timeline(staging.orders(self.raw("orders"), self.earliest), self.grace_days)
        context = rollups.order_context(timeline, staging.customers(self.raw("customers")))
        context = self._keep_parts("order_context", context, n)
        let_go_between()
        reviews = rollups.review_summary(staging.order_reviews(self.raw("order_reviews")))
        products, sellers = self._goods()
        if n == 1:
            reviews = [reviews]
        else:
            reviews = self._keep_parts("review_summary", reviews, n)
            products, sellers = self._keep("stg_products", products), self._keep("stg_sellers", sellers)
            let_go_between()
        self._mark(True, "unfinished")
        self._mark(True)
        results: dict[str, upsert.UpsertResult] = {}
        for k in range(n):
            items = staging.order_items(self._part(n, self.raw("order_items"), k))
            items = self._keep("stg_order_items", _without_key(items))
            let_go(self.spark)
            payments = staging.order_payments(self._part(n, self.raw("order_payments"), k))
            batches = self._batches(context[k], items, products, sellers, payments, reviews[k])
            for name, r in self._store_facts(batches, None, k, n).items():
                rows = r.rows_written + (results[name].rows_written if k else 0)
                results[name] = upsert.UpsertResult(r.mode, rows, r.touched)
            orphans = items.join(context[k].select("order_id"), "order_id", "left_anti").select(*PRICE)
            orphans.write.mode("append" if k else "overwrite").parquet(self._state("orphan_lines"))
        self._mark(False, "unfinished")
        self._drop_kept()
        let_go_between()
        self._timed("measures", lambda: self._measure_all(n))
        return results

    def _keep_parts(self, name: str, df: DataFrame, n: int) -> list[DataFrame]:
        """The parts of a model that is stored as a whole."""
        if n == 1:
            return [self._keep(name, df)]
        kept = self._keep(name, df.withColumn("_part", _part_of(n)), by="_part")
        return [kept.where(F.col("_part") == k).drop("_part") for k in range(n)]

    def _window_facts(self, start: date) -> dict[str, upsert.UpsertResult]:
        """The orders of the window, and those of late rows, in both facts and the measures."""
        self._take_in(False)
        late = self._late()
        # Stored once: its known size lets Spark decide on broadcasting the keys, and
        # none of the five tables below computes the window again.
        orders = self._keep("window_orders", self._orders(start, late))
        window = touched = orders.select("order_id", "customer_id")
        if late is not None:
            # Late lines without an order are taken up too: products count them.
            touched = self._keep("touched_orders", window.select("order_id").union(late).distinct())
        timeline = rollups.delivery_timeline(orders, self.grace_days)
        customers = staging.customers(self._matching("customers", window, "customer_id"))
        # Both facts read these two; storing them saves shuffling all lines and all
        # orders once more for the second fact and for the product measures.
        context, items = concurrently(
            self.spark,
            lambda: self._keep("order_context", rollups.order_context(timeline, customers)),
            lambda: self._window_lines(touched),
        )
        let_go(self.spark)
        products, sellers = self._goods()
        payments = staging.order_payments(
            self._matching("order_payments", window, "order_id")
        )
        reviews = staging.order_reviews(self._matching("order_reviews", window, "order_id"))
        batches = self._batches(context, items, products, sellers, payments, rollups.review_summary(reviews))
        whole = not self._measured()
        self._mark(True)
        if not whole:
            self._before(touched)
        results = self._store_facts(batches, start)
        if whole:
            self._timed("measures", self._measure_again)
        else:
            self._timed("measures", lambda: self._measure(items, context, touched))
        return results

    def _window_lines(self, touched: DataFrame) -> DataFrame:
        """Staged lines of some orders. In parts their keys are few enough to be broadcast, or
        else the raw lines of one part are shuffled at a time."""
        n = self._parts()
        for k in range(n):
            lines = self._matching("order_items", self._part(n, touched.select("order_id"), k), "order_id")
            lines = staging.order_items(self._part(n, lines, k))
            kept = self._keep("stg_order_items", _without_key(lines), more=k > 0)
            if n > 1:
                let_go(self.spark)
        return kept

    def _store_fact(self, name: str, batch: DataFrame, start: date | None, k: int = 0, n: int = 1):
        path, cluster = self.warehouse.path(name), CLUSTER_COLUMNS[name]
        rows = by_month(batch) if self.partition_by_month else batch
        column = self._fact_column()
        index = self._fact_index(name)
        if start is None:
            return upsert.full_refresh(rows, path, column, cluster, index if k == n - 1 else None, more=k > 0)
        return upsert.upsert_partitions(
            self.spark, rows, path, FACT_KEYS[name], column, cluster, index=index
        )

    # measures of the dimensions, kept between runs

    def _state(self, name: str) -> str:
        return self.warehouse.path(name, "state")

    def _measured(self) -> bool:
        """Whether the stored measures are those of the stored facts."""
        return self.warehouse.exists("customer_measures", "state") and not self.warehouse.exists("open", "state")

    def _mark(self, is_open: bool, name: str = "open") -> None:
        if is_open:
            self.spark.range(1).write.mode("overwrite").parquet(self._state(name))
        else:
            files.delete(self.spark, self._state(name))

    def _of_orders(self, fact: str, keys: DataFrame, column: str) -> DataFrame:
        """Stored rows of some orders, from the partitions that hold them."""
        stored = self.spark.read.option("mergeSchema", True).parquet(self.warehouse.path(fact))
        index = self._fact_index("fct_orders")
        if index.exists():
            stored = stored.where(F.col(self._fact_column()).isin(sorted(index.partitions(keys, "order_id"))))
        return stored.join(keys.select(F.col("order_id").alias(column)), column, "left_semi")

    def _before(self, touched: DataFrame) -> None:
        """Keep what the orders to be recomputed have added so far. An order's lines lie in
        the partitions that hold the order."""
        people = marts.customer_contributions(self._of_orders("fct_orders", touched, "order_key"))
        lines = fact_lines(self._of_orders("fct_order_items", touched, "order_key"))
        self._keep("old_orders", people)
        self._keep("old_lines", lines)

    def _measure_all(self, n: int) -> None:
        """Measures from all facts and the lines without an order, which are in no fact but
        count for products: they are kept apart. Where lines are taken in parts the measures
        follow each other, as each deals all lines."""
        read = self.warehouse.read
        orphans = self.spark.read.parquet(self._state("orphan_lines"))
        sold = fact_lines(read("fct_order_items"))
        every = sold.select(*PRICE).union(orphans)
        pairs = (
            (CUSTOMER_STATE, read("fct_orders")), (SELLER_STATE, sold),
            (PRODUCT_STATE, every), (PRODUCT_SELLER_STATE, every),
        )
        steps = [
            lambda s=stored, r=rows: s.measures.of(s.contributions(r))
            .write.mode("overwrite").parquet(self._state(s.name))
            for stored, rows in pairs
        ]
        if n == 1:
            concurrently(self.spark, *steps)
            return
        for step in steps:
            step()
            let_go(self.spark)

    def _measure_again(self) -> None:
        """The same after a run that stopped half-way: lines without an order are looked for
        among all lines."""
        known = self.warehouse.read("fct_orders").select(F.col("order_key").alias("order_id"))
        n = self._parts()
        for k in range(n):
            lines = staging.order_items(self._part(n, self.raw("order_items"), k))
            orphans = lines.join(self._part(n, known, k), "order_id", "left_anti").select(*PRICE)
            orphans.write.mode("append" if k else "overwrite").parquet(self._state("orphan_lines"))
            if n > 1:
                let_go(self.spark)
        self._measure_all(n)

    def _measure(self, items: DataFrame, context: DataFrame, touched: DataFrame) -> None:
        """Measures from what the recomputed orders change."""
        read, price = self.warehouse.read, PRICE
        orphans = items.join(context.select("order_id"), "order_id", "left_anti").select(*price)
        had = self.spark.read.parquet(self._state("orphan_lines"))
        keys = touched.select("order_id")
        with staged(had.join(keys, "order_id", "left_anti").union(orphans)) as left:
            old_lines = self.spark.read.parquet(self.warehouse.path("old_lines", "intermediate"))
            new_lines = fact_lines(self._of_orders("fct_order_items", touched, "order_key"))
            old_people = self.spark.read.parquet(self.warehouse.path("old_orders", "intermediate"))
            new_people = marts.customer_contributions(self._of_orders("fct_orders", touched, "order_key"))
            with staged(new_lines) as new_lines, staged(had.join(keys, "order_id", "left_semi")) as gone:
                before = old_lines.select(*price).union(gone)
                after = new_lines.select(*price).union(orphans)
                everything = fact_lines(read("fct_order_items"))
                people = marts.customer_contributions(read("fct_orders"))
                concurrently(
                    self.spark,
                    lambda: self._merge(CUSTOMER_STATE, old_people, new_people, people),
                    lambda: self._merge(
                        SELLER_STATE, marts.seller_contributions(old_lines), marts.seller_contributions(new_lines),
                        marts.seller_contributions(everything),
                    ),
                    *(
                        lambda s=stored: self._merge(s, s.contributions(before), s.contributions(after), everything)
                        for stored in (PRODUCT_STATE, PRODUCT_SELLER_STATE)
                    ),
                )
                left.write.mode("overwrite").parquet(self._state("orphan_lines"))

    def _merge(self, stored: Stored, old: DataFrame, new: DataFrame, everything: DataFrame) -> None:
        path = self._state(stored.name)
        kept = self.spark.read.parquet(path)
        delta = stored.measures.delta(old, new)
        with staged(stored.measures.merged(kept, delta, everything)) as merged:
            merged.write.mode("overwrite").parquet(path)
        self.spark.catalog.refreshByPath(path)

    # dimensions from kept measures, the aggregate from the stored facts

    def dimensions(self) -> None:
        """Attributes from staging, measures as the run's facts have left them: neither
        orders nor lines are read again."""
        wh = self.warehouse
        state = lambda stored: self.spark.read.parquet(self._state(stored.name))
        geography = self._timed(
            "dim_geography",
            lambda: wh.write(
                marts.dim_geography(staging.geolocation(self.raw("geolocation"))),
                "dim_geography",
            ),
        )
        products = staging.products(
            self.raw("products"),
            staging.category_translation(self.raw("product_category_translation")),
        )
        tables = {
            "dim_customers": marts.customers_with(
                staging.customers(self.raw("customers")), state(CUSTOMER_STATE), geography
            ),
            "dim_products": marts.products_with(products, state(PRODUCT_STATE), state(PRODUCT_SELLER_STATE)),
            "dim_sellers": marts.sellers_with(
                staging.sellers(self.raw("sellers")), state(SELLER_STATE), geography
            ),
            "dim_date": marts.dim_date(marts.calendar_bounds(self.spark, *self.calendar)),
        }
        concurrently(
            self.spark,
            *(lambda n=name, d=df: self._timed(n, lambda: wh.write(d, n)) for name, df in tables.items()),
        )

    def aggregate(self) -> None:
        """In full, or only the months that this run's upserts have touched."""
        wh, name = self.warehouse, "agg_daily_performance"
        if self._touched is None or not wh.exists(name):
            daily = marts.agg_daily_performance(wh.read("fct_order_items"), wh.read("fct_orders"))
            self._timed(name, lambda: wh.write_by(by_month(daily), name, "purchased_month"))
            return
        months = sorted(self._touched)
        daily = marts.agg_daily_performance(
            wh.months("fct_order_items", months), wh.months("fct_orders", months)
        )
        self._timed(name, lambda: self._replace_months(by_month(daily), name, months))

    def _replace_months(self, daily: DataFrame, name: str, months: list[date]) -> None:
        if not months:
            return
        path = self.warehouse.path(name)
        with staged(daily) as rows:
            upsert.write_partitioned(rows, path, "purchased_month", CLUSTER_COLUMNS[name])
            left = {r[0] for r in rows.select("purchased_month").distinct().collect()}
        for month in set(months) - left:
            files.delete(self.spark, f"{path}/purchased_month={month.isoformat()}")
        self.spark.catalog.refreshByPath(path)

    # history

    def snapshot(self) -> None:
        self._timed("snap_sellers", self._snapshot)

    def _snapshot(self) -> None:
        incoming = staging.sellers(self.raw("sellers")).drop(*staging.LOAD_COLUMNS)
        write_snapshot(
            self.warehouse, "snap_sellers", incoming, "seller_id", SELLER_CHECK_COLUMNS,
            self.as_of, self.backdate_first,
        )

    def history(self) -> None:
        wh = self.warehouse
        self._timed(
            "dim_sellers_history",
            lambda: wh.write(
                marts.dim_sellers_history(read_snapshot(wh, "snap_sellers")),
                "dim_sellers_history",
            ),
        )

    def run(self, publish: bool = False, run_id: str | None = None) -> dict[str, upsert.UpsertResult]:
        """The history follows the snapshot, dimensions and aggregate the facts; what does not
        depend on each other runs side by side. The run's metrics are stored beside the
        others; with ``publish`` the marts are tables of the session catalog afterwards."""

        def versions():
            self.snapshot()
            self.history()

        results, _ = concurrently(self.spark, self.facts, versions)
        concurrently(self.spark, self.dimensions, self.aggregate)
        run_id = run_id or f"{self.as_of:%Y-%m-%dT%H:%M:%S}"
        append_run_metrics(self.run_metrics("build", run_id), self._state("runs"))
        if publish:
            self.warehouse.publish(MARTS)
        return results

    # tests of what was built

    def marts(self) -> dict[str, DataFrame]:
        return {name: self.warehouse.read(name) for name in MARTS}

    def check(self, raise_on_error: bool = False) -> DataFrame:
        """Declared checks and invariants on the stored marts: one row per check with
        its failures and status. Failing rows are stored for inspection. With
        ``raise_on_error`` a check that is neither passed nor a warning stops the run."""
        tables = self.marts()
        folder = self.warehouse.path("", "test_failures")
        declared_results = cut_lineage(
            checks.with_severity(checks.run_checks(tables, declared.MART_CHECKS))
        )
        failed = {
            (r["model"], r["check"], r["column"])
            for r in declared_results.where(F.col("status") != "pass").collect()
        }
        for check in declared.MART_CHECKS:
            if (check.model, check.kind, check.column) in failed:
                checks.store_violations(check, tables, folder)
        results = [declared_results]
        for name, broken, limits in self._invariants(tables):
            path = f"{folder.rstrip('/')}/{name}"
            broken.write.mode("overwrite").parquet(path)
            stored = self.spark.read.parquet(path)
            counted = stored.agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit(name).alias("model"),
                F.lit("invariant").alias("check"),
                F.lit("").alias("column"),
                "failures",
            )
            results.append(checks.with_severity(counted, *limits))
        found = reduce(DataFrame.unionByName, results)
        if raise_on_error:
            broken = [f"{r['model']}.{r['column'] or r['check']}" for r in found.where("status = 'error'").collect()]
            if broken:
                raise ChecksFailed(", ".join(sorted(broken)))
        return found

    def _invariants(self, t: dict[str, DataFrame]):
        orders, lines = t["fct_orders"], t["fct_order_items"]
        exact = (None, 0)
        return [
            (
                "agg_reconciles_to_fact",
                invariants.agg_reconciles_to_fact(lines, t["agg_daily_performance"]),
                exact,
            ),
            ("delivery_sla_is_plausible", invariants.implausible_sla(orders), exact),
            (
                "no_impossible_dates",
                invariants.impossible_dates(
                    orders, F.lit(self.as_of).cast("timestamp_ntz"), self.earliest
                ),
                exact,
            ),
            (
                "orders_are_complete",
                invariants.incomplete_orders(orders),
                (invariants.INCOMPLETE_WARN_ABOVE, invariants.INCOMPLETE_ERROR_ABOVE),
            ),
            (
                "lines_roll_up_to_orders",
                invariants.lines_roll_up_to_orders(lines, orders),
                exact,
            ),
            ("payments_settle_orders", invariants.unsettled_orders(orders), exact),
            (
                "history_is_well_formed",
                scd2.history_violations(
                    t["dim_sellers_history"], "seller_key", "seller_version_key"
                ),
                exact,
            ),
        ]

    def run_metrics(self, dag_id: str, run_id: str) -> DataFrame:
        """One row per step of this run, in the run-metrics schema."""
        rows = [
            (self.as_of.date(), dag_id, task, run_id, started, None, seconds, "success", self.rows.get(task), None)
            for task, seconds, started in self.timings
        ]
        return self.spark.createDataFrame(rows, RUN_METRICS_SCHEMA)


OPEN_DAY = "9999-12-31"


def read_snapshot(warehouse: Warehouse, name: str) -> DataFrame:
    return warehouse.read(name, "snapshots").drop("closed_on")


def write_snapshot(
    warehouse: Warehouse,
    name: str,
    incoming: DataFrame,
    key: str,
    check_cols,
    as_of: datetime,
    backdate_first: str | None = None,
) -> None:
    """Advance a stored Type-2 table.

    Versions are kept in one folder per day they were closed on, open ones in a folder
    of their own. A run reads and rewrites the open folder and the folder of its own
    day; the closed past, which is what grows, is neither read nor written."""
    spark, path = warehouse.spark, warehouse.path(name, "snapshots")
    now = F.lit(as_of).cast("timestamp_ntz")
    if not files.exists(spark, path):
        start = now if backdate_first is None else backdate_first
        merged = scd2.first_snapshot(incoming, start)
    else:
        today = as_of.date().isoformat()
        stored = spark.read.option("mergeSchema", True).parquet(path)
        recent = stored.where(
            F.col("closed_on").isin(F.lit(OPEN_DAY).cast("date"), F.lit(today).cast("date"))
        ).drop("closed_on")
        merged = scd2.snapshot_check(recent, incoming, key, check_cols, now)
        merged = cut_lineage(merged)
    closed_on = F.coalesce(F.to_date("valid_to"), F.lit(OPEN_DAY).cast("date"))
    upsert.write_partitioned(
        merged.withColumn("closed_on", closed_on), path, "closed_on", [key]
    )
    if merged.where(F.col("valid_to").isNull()).isEmpty():
        # Dynamic overwrite leaves a folder alone that gets no rows.
        files.delete(spark, f"{path}/closed_on={OPEN_DAY}")
    spark.catalog.refreshByPath(path)
