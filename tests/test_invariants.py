"""Properties of the built tables, whatever the data."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from scenarios.queries import QUERIES, _split
from tidelog.functions import columns as C
from tidelog.sources import bronze


def _overlaps(rows):
    w = Window.partitionBy("customer_id").orderBy("valid_from", "valid_to")
    return rows.withColumn("after", F.lead("valid_from").over(w)).filter(F.col("after") < F.col("valid_to")).count()


def test_versions_of_a_key_do_not_overlap(lake, spark, sf_dir):
    assert _overlaps(lake.silver_customers.filter("customer_id is not null")) == 0
    merged = QUERIES["scd2_merge_batch"](spark, sf_dir).withColumn("valid_to", F.col("valid_to").cast("timestamp_ntz"))
    assert _overlaps(merged) == 0


def test_at_most_one_current_version_per_key(lake, spark, sf_dir):
    for rows in (lake.silver_customers.filter("customer_id is not null"), QUERIES["scd2_merge_batch"](spark, sf_dir),
                 QUERIES["scd2_staged_merge"](spark, sf_dir)):
        assert rows.filter("is_current = 1").groupBy("customer_id").count().filter("count > 1").count() == 0


def test_current_versions_are_the_open_ended_ones(lake):
    odd = lake.silver_customers.filter((F.col("is_current") == 1) & (F.col("valid_to") != C.end_of_time()))
    assert odd.count() == 0


def test_one_fact_per_order(lake):
    assert lake.fact_orders.count() == lake.silver_orders.count()


def test_clean_and_quarantined_make_the_input(lake):
    for entity, raw in (("customers", lake.raw_customers), ("orders", lake.raw_orders)):
        clean, bad = _split(lake, entity)
        assert clean.count() + bad.count() == raw.count()


def test_a_processed_batch_is_not_pending(lake):
    every = bronze.batch_ids(lake.raw_customers, lake.raw_orders)
    assert every.count() > 1
    assert bronze.pending_batches(every, every).count() == 0
    assert bronze.pending_batches(every, every.limit(0)).count() == every.count()


def test_fixture_sizes(lake):
    assert (lake.raw_customers.count(), lake.raw_orders.count(), lake.change_log.count()) == (397, 575, 972)
    assert (lake.silver_customers.count(), lake.silver_orders.count(), lake.dim_customers.count()) == (278, 169, 190)
    assert lake.fact_orders.filter("customer_sk = '-1'").count() == 92
