"""A change feed derived from the ``events`` table, landed as raw tables.

``signup`` events become customer writes, ``error`` events customer deletes,
``purchase`` events orders that run through their statuses, ``click`` events
pipeline runs.  See FIXTURES.md for the same rules as SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import workspace
from tidelog.functions import columns as C
from tidelog.operators.history import customer_history
from tidelog.operators.latest import current_orders
from tidelog.operators.skew import HOT_ROWS, with_neighbour
from tidelog.plans import gold, staging
from tidelog.sources import bronze, ledger

TIER_SINCE = "2024-01-20"
CUT = "2024-01-15"
TODAY = "2024-01-31"
STAMP = "2024-02-01 00:00:00"
#: The feed is landed in so many batches of a week by commit time; the last takes the rest.
WEEKS, FIRST_DAY = 5, "2024-01-01"


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def week_of(at: str) -> Column:
    return F.least(F.floor(F.datediff(F.to_date(at), F.lit(FIRST_DAY).cast("date")) / 7), F.lit(WEEKS - 1)).cast("int")


def _images(*candidates: tuple[Column, Column]) -> Column:
    """Explode the candidate images whose condition holds."""
    return F.explode(F.filter(F.array(*[F.when(c, image) for c, image in candidates]), lambda x: x.isNotNull()))


def _landing(at: str) -> dict[str, Column]:
    return {
        "_bronze_ingested_at": F.col(at),
        "_bronze_batch_id": F.concat(F.lit("batch-"), F.to_date(at).cast("string")),
        "ingest_date": F.to_date(at),
    }


def derive_customers(events: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    base = events.filter(F.col("event_type").isin("signup", "error")).select("event_id", "ts", "user_id", "event_type")
    base = with_neighbour(base, "user_id", ["ts", "event_id"], ["event_type", "event_id"], "previous", "prev_", hot_rows)
    signup, was_live = F.col("event_type") == "signup", F.coalesce(F.col("prev_event_type") == "signup", F.lit(False))

    def image(kind: str, k: int, img: Column) -> Column:
        return F.struct(F.lit(kind).alias("ct"), F.lit(k).alias("k"), img.alias("img_id"))

    this, before = F.col("event_id"), F.col("prev_event_id")
    rows = base.withColumn(
        "i",
        _images(
            (signup & ~was_live, image("INSERT", 1, this)),
            (signup & was_live, image("UPDATE_BEFORE", 2, before)),
            (signup & was_live, image("UPDATE_AFTER", 3, this)),
            (~signup & was_live, image("DELETE", 4, before)),
            (signup & (F.col("event_id") % 61 == 0), image("UPDATE_AFTER", 5, this + 1)),
        ),
    ).select("event_id", "ts", "user_id", "i.*")
    img, user = F.col("img_id"), F.col("user_id").cast("string")
    state = (
        F.when(img % 41 == 0, None).when(img % 47 == 0, "CAL").when(img % 5 == 0, " ny ").when(img % 5 == 1, "CA")
        .when(img % 5 == 2, "TX").when(img % 5 == 3, "FL").otherwise("IL")
    )
    email = (
        F.when(img % 43 == 0, None).when(img % 37 == 0, "not-an-email")
        .otherwise(F.concat(F.lit("u"), user, F.lit("."), (img % 90).cast("string"), F.lit("@example.com")))
    )
    return rows.select(
        (F.col("event_id") * 10 + F.col("k")).alias("_row_sequence_id"),
        F.lit("customers").alias("entity_type"),
        F.col("ct").alias("_change_type"),
        F.col("ts").alias("_commit_timestamp"),
        F.when(img % 97 != 0, F.concat(F.lit("C"), user)).alias("customer_id"),
        F.concat(F.lit("First"), (F.col("user_id") % 10).cast("string")).alias("first_name"),
        F.concat(F.lit("Last"), (F.col("user_id") % 7).cast("string")).alias("last_name"),
        email.alias("email"),
        state.alias("state"),
        F.when(F.to_date("ts") >= F.lit(TIER_SINCE).cast("date"), F.concat(F.lit("tier"), (F.col("user_id") % 3).cast("string")))
        .alias("loyalty_tier"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("updated_at"),
    ).withColumns(_landing("_commit_timestamp"))


def derive_orders(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    moved, delivered = e % 3 != 0, (e % 3 == 1) & (e % 7 != 0)

    def image(kind: str, k: int, hours: int, status: str | Column) -> Column:
        status = F.lit(status) if isinstance(status, str) else status
        at = F.col("ts") + F.expr(f"interval {hours} hour")
        return F.struct(F.lit(kind).alias("ct"), F.lit(k).alias("k"), at.alias("cts"), status.alias("st"))

    always = F.lit(True)
    rows = events.filter("event_type = 'purchase'").withColumn(
        "i",
        _images(
            (always, image("INSERT", 1, 0, "Pending")),
            (moved, image("UPDATE_BEFORE", 2, 1, "Pending")),
            (moved, image("UPDATE_AFTER", 3, 1, F.when(e % 7 == 0, "Cancelled").otherwise("Shipped"))),
            (delivered, image("UPDATE_BEFORE", 4, 2, "Shipped")),
            (delivered, image("UPDATE_AFTER", 5, 2, "Delivered")),
            (e % 11 == 0, image("DELETE", 6, 3, "Pending")),
        ),
    ).select("event_id", "ts", "user_id", "value", "i.*")
    return rows.select(
        (e * 10 + F.col("k")).alias("_row_sequence_id"),
        F.lit("orders").alias("entity_type"),
        F.col("ct").alias("_change_type"),
        F.col("cts").alias("_commit_timestamp"),
        F.when(e % 101 != 0, F.concat(F.lit("O"), e.cast("string"))).alias("order_id"),
        F.when(e % 59 != 0, F.concat(F.lit("C"), F.col("user_id").cast("string"))).alias("customer_id"),
        F.when(e % 31 == 0, None).when(e % 29 == 0, -F.col("value")).otherwise(F.col("value")).alias("order_amount"),
        F.col("st").alias("order_status"),
        F.col("ts").alias("created_at"),
        F.col("cts").alias("updated_at"),
    ).withColumns(_landing("_commit_timestamp"))


class Lake:
    """The raw tables of one test-data folder, and the tables built on them.

    As in a deployed lake, the raw layer and the Silver and Gold tables are written
    once (below the shared root) and read back by the queries of later layers.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.root = workspace.new_dir(spark, "lake")
        self._written: set[str] = set()
        self._frames: dict[str, DataFrame] = {}
        self.names: dict[str, str] = {}
        self.views: dict[str, DataFrame] = {}

    def _frame(self, name: str, read: Callable[[], DataFrame]) -> DataFrame:
        """A scan, listed once: the files of a lake do not change after they are written."""
        if name not in self._frames:
            self._frames[name] = read()
        return self._frames[name]

    def source(self, table: str) -> DataFrame:
        return self._frame(f"source/{table}", lambda: self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet"))

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        def write_and_read() -> DataFrame:
            rows, path = build(), f"{self.root}/{name}"
            rows.write.mode("overwrite").parquet(path)
            return self.spark.read.schema(rows.schema).parquet(path)

        return self._frame(name, write_and_read)

    def folder(self, name: str, write: Callable[[str], None]) -> str:
        """A folder that is written once."""
        path = f"{self.root}/{name}"
        if name not in self._written:
            write(path)
            self._written.add(name)
        return path

    # raw layer -------------------------------------------------------------------

    def raw_path(self, entity: str) -> str:
        path = f"{self.root}/bronze/{entity}"
        if entity not in self._written:
            if entity == "customers":
                rows = derive_customers(self.source("events"))
                since = F.lit(TIER_SINCE).cast("date")
                # two generations of files: the tier column exists from a certain day on
                bronze.write_partitioned(rows.filter(F.col("ingest_date") < since).drop("loyalty_tier"), path)
                bronze.write_partitioned(rows.filter(F.col("ingest_date") >= since), path)
            else:
                bronze.write_partitioned(derive_orders(self.source("events")), path)
            self._written.add(entity)
        return path

    @property
    def raw_customers(self) -> DataFrame:
        path = self.raw_path("customers")
        return self._frame("raw/customers", lambda: bronze.read_raw(self.spark, path, "customers", ["loyalty_tier"]))

    @property
    def raw_orders(self) -> DataFrame:
        path = self.raw_path("orders")
        return self._frame("raw/orders", lambda: bronze.read_raw(self.spark, path, "orders"))

    @property
    def change_log(self) -> DataFrame:
        """Both entities as one mixed log, as the source system records them."""
        landing = ["_bronze_ingested_at", "_bronze_batch_id", "ingest_date"]
        return self.raw_customers.drop(*landing).unionByName(self.raw_orders.drop(*landing), allowMissingColumns=True)

    def landed(self) -> tuple[str, str]:
        """Folders of the raw tables and of the lists, with the feed landed in weekly batches."""
        raw, lists = f"{self.root}/landed/raw", f"{self.root}/landed/lists"
        if "landed" not in self._written:
            log = self.change_log
            for week in range(WEEKS):
                at = datetime.fromisoformat(FIRST_DAY) + timedelta(weeks=week + 1)
                ledger.land(log.filter(week_of("_commit_timestamp") == week), f"week-{week}", at, raw, lists, F.col("_commit_timestamp"))
            self._written.add("landed")
        return raw, lists

    @property
    def run_events(self) -> DataFrame:
        clicks = self.source("events").filter("event_type = 'click'").select("event_id", "ts")
        e, failed = F.col("event_id"), F.col("event_id") % 8 == 0
        run = F.concat(F.lit("run-"), e.cast("string")).alias("run_id")
        start = clicks.select(
            run,
            F.when(e % 2 == 0, "Bronze Ingest").otherwise("Silver Merge").alias("pipeline_name"),
            F.lit("START").alias("kind"), F.col("ts").alias("at"),
            F.lit(None).cast("long").alias("records_processed"), F.lit(None).cast("string").alias("error_message"),
        )
        finish = clicks.filter(e % 9 != 0).select(
            run, F.lit(None).cast("string").alias("pipeline_name"),
            F.when(failed, "FAILED").otherwise("SUCCESS").alias("kind"),
            (F.col("ts") + F.expr("interval 1 minute")).alias("at"),
            F.when(~failed, e % 50).alias("records_processed"), F.when(failed, "boom").alias("error_message"),
        )
        return start.unionByName(finish)

    @property
    def audit_log(self) -> DataFrame:
        return self.audit_by("day")

    def audit_by(self, unit: str) -> DataFrame:
        """Audit rows of runs that each took the rows of a day, or of an hour."""

        def per_day(raw: DataFrame, table: str, ok: Column, bad: Column) -> DataFrame:
            counts = raw.groupBy(F.date_trunc(unit, "_commit_timestamp").cast("timestamp_ntz").alias("d")).agg(
                F.count_if(ok).alias("records_processed"), F.count_if(bad).alias("records_quarantined")
            )
            return counts.withColumn("target_table", F.lit(table))

        at_sign = F.col("email").contains("@")
        n = per_day(
            self.raw_customers, "silver_customers", at_sign & F.col("state").isNotNull(), ~at_sign | F.col("state").isNull()
        ).unionByName(per_day(self.raw_orders, "silver_orders", F.col("order_amount") >= 0, F.col("order_amount") < 0))
        failed = F.col("records_processed") % 7 == 0
        day = F.col("d").cast("timestamp_ntz")
        return n.select(
            F.concat("target_table", F.lit("-"), F.date_format("d", "yyyy-MM-dd" if unit == "day" else "yyyy-MM-dd HH")).alias("log_id"),
            F.lit("silver_processing").alias("pipeline_name"), F.lit("silver").alias("layer"), "target_table",
            "records_processed", "records_quarantined",
            F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
            F.when(failed, "simulated failure").otherwise("").alias("error_message"),
            day.alias("start_time"), (day + F.expr("interval 5 minute")).alias("end_time"),
            F.lit(300.0).alias("duration_seconds"),
        )

    # layers ----------------------------------------------------------------------

    @property
    def stg_customers(self) -> DataFrame:
        return staging.staged_customers(self.raw_customers)

    @property
    def stg_orders(self) -> DataFrame:
        return staging.staged_orders(self.raw_orders)

    @property
    def silver_customers(self) -> DataFrame:
        return self.stored("silver_customers", lambda: customer_history(self.stg_customers))

    @property
    def silver_orders(self) -> DataFrame:
        return self.stored("silver_orders", lambda: current_orders(self.stg_orders))

    @property
    def dim_customers(self) -> DataFrame:
        return self.stored("dim_customers", lambda: gold.customer_dimension(self.silver_customers))

    @property
    def fact_orders(self) -> DataFrame:
        return self.stored("fact_orders", lambda: gold.order_facts(self.silver_orders, self.dim_customers))

    @property
    def current_customers(self) -> DataFrame:
        return gold.current_customers(self.silver_customers)

    @property
    def test_tables(self) -> dict[str, DataFrame]:
        names = ["stg_customers", "stg_orders", "silver_customers", "silver_orders", "dim_customers", "fact_orders"]
        return {n: getattr(self, n) for n in names}


# frames with what a month of clean data does not have ------------------------------------------

SPREAD = 14


def _number(id_: str) -> Column:
    """The number in an id such as O17, 0 without one."""
    return F.coalesce(F.substring(id_, 2, 20).try_cast("bigint"), F.lit(0).cast("bigint"))


def _months_on(at: str, number: Column) -> Column:
    return F.col(at) + F.make_ym_interval(F.lit(0), (number % SPREAD).cast("int"))


def spread_facts(lake: Lake) -> DataFrame:
    """Facts over more than a year, amounts with thousandths."""
    n = _number("order_id")
    moved = lake.fact_orders.withColumn("created_at", _months_on("created_at", n))
    return moved.withColumns({"date_key": C.date_key("created_at"), "order_amount": F.col("order_amount") + (n % 8) / 1000})


def spread_customers(lake: Lake) -> DataFrame:
    """Current customers who came over more than a year."""
    return lake.current_customers.withColumn("valid_from", _months_on("valid_from", _number("customer_id")))


def faulty_tables(lake: Lake) -> dict[str, DataFrame]:
    """The tables of the data tests with repeated rows, lost parents, unknown statuses, missing keys and negative amounts."""
    n, facts, dimension = _number("order_id"), lake.fact_orders, lake.dim_customers
    broken = facts.withColumns(
        {
            "customer_sk": F.when(n % 15 == 0, "ghost").when(n % 47 == 0, None).otherwise(F.col("customer_sk")),
            "order_status": F.when(n % 30 == 0, "Lost").otherwise(F.col("order_status")),
            "order_id": F.when(n % 70 != 0, F.col("order_id")),
        }
    )
    orders = lake.silver_orders.withColumn("order_amount", F.when(n % 40 == 0, -F.col("order_amount") - 1).otherwise(F.col("order_amount")))
    return lake.test_tables | {
        "fact_orders": broken.unionByName(facts.filter(n % 50 == 0)),
        "dim_customers": dimension.unionByName(dimension.filter(_number("customer_id") % 20 == 1)),
        "silver_orders": orders,
    }


_LAKES: dict[tuple[str, str], Lake] = {}


def lake_of(spark: SparkSession, sf_dir: str) -> Lake:
    """One lake per application and test-data folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAKES:
        _LAKES[key] = Lake(spark, sf_dir)
    return _LAKES[key]
