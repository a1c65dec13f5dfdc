"""Loads from files into raw tables and back through staging."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest
from frames import ad, day, dicts, raw, sale

from starmart.operators.staging import stg_marketing, stg_sales
from starmart.plans.ingest import TooManyRejects, ingest, ingest_all, load
from starmart.sources import normalize, readers, schemas, sinks, watermark
from starmart.sources.registry import DATASETS
from starmart.sources.schemas import INGESTED_AT

T1 = dt.datetime(2024, 6, 1, 12, tzinfo=dt.timezone.utc)
T2 = dt.datetime(2024, 6, 2, 12, tzinfo=dt.timezone.utc)


@pytest.fixture
def source(folder):
    return readers.Source(root=f"{folder}/source")


def publish(source, **frames):
    for name, frame in frames.items():
        frame.drop(INGESTED_AT).write.mode("overwrite").parquet(f"{source.root}/{DATASETS[name].source}")


def sales_of(spark, *rows):
    return raw(spark, sales=list(rows))["raw_sales"]


def ids(frame):
    return sorted(r["order_id"] for r in dicts(frame))


def test_all_datasets_reach_their_raw_tables(spark, folder, source):
    tables = raw(spark, sales=[sale()], marketing=[ad()])
    publish(source, **{name.removeprefix("raw_"): frame for name, frame in tables.items()})
    ingest_all(spark, source, folder, T1)
    stored = readers.raw_tables(spark, folder)
    assert set(stored) == set(tables)
    for name, frame in tables.items():
        assert sorted(dicts(stored[name].drop(INGESTED_AT)), key=str) == sorted(dicts(frame.drop(INGESTED_AT)), key=str)
        assert stored[name].selectExpr(f"every({INGESTED_AT} = timestamp'2024-06-01 12:00:00Z')").first()[0]


def test_incremental_load_looks_back_three_days(spark, folder, source):
    dataset = DATASETS["sales"]
    publish(source, sales=sales_of(spark, sale("O1", date="2024-05-10"), sale("O0", date="2022-12-28")))
    assert ingest(spark, dataset, source, folder, T1) == day("2024-05-10")
    assert ids(readers.read_raw(spark, folder, dataset)) == ["O1"]  # O0 lies before the default watermark

    late = [sale("O2", date="2024-05-07"), sale("O3", date="2024-05-06"), sale("O4", date="2024-05-12")]
    publish(source, sales=sales_of(spark, sale("O1", date="2024-05-10"), *late))
    assert ingest(spark, dataset, source, folder, T2) == day("2024-05-12")
    stored = readers.read_raw(spark, folder, dataset)
    assert ids(stored) == ["O1", "O1", "O2", "O4"]
    assert ids(stg_sales(stored)) == ["O1", "O2", "O4"]
    log = watermark.watermark_log(spark, folder)
    assert log.count() == 2
    assert watermark.get_watermark(log, "raw_sales") == dt.datetime(2024, 5, 12)


def test_running_a_batch_again_changes_nothing_in_staging(spark, folder, source):
    dataset = DATASETS["marketing"]
    publish(source, marketing=raw(spark, marketing=[ad(), ad("A2", date="2024-01-09")])["raw_marketing"])
    ingest(spark, dataset, source, folder, T1)
    once = sorted(stg_marketing(readers.read_raw(spark, folder, dataset)).collect(), key=str)
    ingest(spark, dataset, source, folder, T2)
    stored = readers.read_raw(spark, folder, dataset)
    assert stored.count() == 4
    assert sorted(stg_marketing(stored).collect(), key=str) == once


def test_full_load_replaces_and_an_empty_one_does_not(spark, folder, source):
    dataset = DATASETS["customers"]
    frame = raw(spark)["raw_customers"]
    publish(source, customers=frame)
    ingest(spark, dataset, source, folder, T1)
    publish(source, customers=frame.filter("customer_id = 'C1'"))
    assert ingest(spark, dataset, source, folder, T2) is None
    assert readers.read_raw(spark, folder, dataset).count() == 1
    publish(source, customers=frame.limit(0))
    ingest(spark, dataset, source, folder, T2)
    assert readers.read_raw(spark, folder, dataset).count() == 1


def test_empty_incremental_batch_keeps_the_watermark(spark, folder, source):
    publish(source, sales=sales_of(spark))
    assert ingest(spark, DATASETS["sales"], source, folder, T1) is None
    assert watermark.watermark_log(spark, folder).count() == 0


def test_unknown_load_type(spark, folder, source):
    publish(source, customers=raw(spark)["raw_customers"])
    with pytest.raises(ValueError, match="sideways"):
        ingest(spark, replace(DATASETS["customers"], load_type="sideways"), source, folder, T1)


def test_watermark_log(spark, folder):
    watermark.create_watermark_log(spark, folder)
    watermark.create_watermark_log(spark, folder)
    log = watermark.watermark_log(spark, folder)
    assert watermark.get_watermark(log, "raw_sales") == dt.datetime(2023, 1, 1)
    for value in (day("2024-05-02"), None, dt.datetime(2024, 5, 1, 8)):
        watermark.update_watermark(spark, folder, "raw_sales", value, T1)
    watermark.update_watermark(spark, folder, "raw_marketing", day("2025-01-01"), T1)
    log = watermark.watermark_log(spark, folder)
    assert log.count() == 3
    assert watermark.get_watermark(log, "raw_sales") == dt.datetime(2024, 5, 2)
    targets = spark.createDataFrame([("raw_sales",), ("raw_customers",)], "table_name string")
    current = {r["table_name"]: r["last_loaded_date"] for r in dicts(watermark.current_watermarks(log, targets))}
    assert current["raw_customers"] == dt.datetime(2023, 1, 1)


def test_types_that_do_not_parse_become_null(spark):
    arrived = spark.createDataFrame(
        [("1", "12.345", "2024-02-29", "x"), ("3.0", "abc", "2024-02-30", None), ("3.7", None, "2024-05-01 10:00:00", ""), ("abc", " 7 ", "?", "y")],
        "quantity string, price string, order_date string, note string",
    )
    got = normalize.normalize_types(arrived, schemas.SALES)
    assert dict(got.dtypes) == {
        "quantity": "bigint", "price": "decimal(38,9)", "order_date": "date", "note": "string",
    }
    rows = got.collect()
    assert [r["quantity"] for r in rows] == [1, 3, None, None]
    assert [None if r["price"] is None else str(r["price"]) for r in rows] == ["12.345000000", None, None, "7.000000000"]
    assert [r["order_date"] for r in rows] == [day("2024-02-29"), None, day("2024-05-01"), None]
    assert [r["note"] for r in rows] == ["x", None, "", "y"]
    numbers = spark.sql("select 3.7D as quantity, 5 as age, cast(null as int) as customer_id")
    got = normalize.normalize_types(numbers, schemas.SALES)
    assert got.first().asDict() == {"quantity": None, "age": 5, "customer_id": None}
    assert dict(got.dtypes)["customer_id"] == "string"


def test_columns_are_parsed_before_and_after_renaming(spark):
    arrived = spark.createDataFrame([("2024-01-01", "1", "2024-01-02")], "`Order Date` string, ` Ad-Spend ` string, order_date string")
    got = normalize.prepare(arrived.select("Order Date", " Ad-Spend "), schemas.SALES, T1)
    assert got.columns == ["order_date", "ad_spend", INGESTED_AT]
    assert dict(got.dtypes)["order_date"] == "date"
    assert dict(normalize.prepare(arrived.select("order_date"), schemas.SALES, T1).dtypes)["order_date"] == "date"


def test_watermark_filter_reaches_the_files(spark, source):
    publish(source, sales=sales_of(spark, sale()))
    rows = readers.extract_incremental(source, spark, DATASETS["sales"], dt.datetime(2024, 1, 10, 6))
    plan = rows._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "GreaterThanOrEqual(order_date,2024-01-08)" in plan


def test_other_reader_formats(spark, folder):
    sales_of(spark, sale()).drop(INGESTED_AT).write.option("header", True).csv(f"{folder}/fact_sales")
    source = readers.Source(format="csv", root=folder, options={"header": "true"})
    ingest(spark, DATASETS["sales"], source, f"{folder}/raw", T1)
    got = readers.read_raw(spark, f"{folder}/raw", DATASETS["sales"])
    assert got.drop(INGESTED_AT).collect() == sales_of(spark, sale()).drop(INGESTED_AT).collect()


def test_raw_table_with_a_column_that_came_later(spark, folder):
    dataset = DATASETS["sales"]
    old = normalize.prepare(sales_of(spark, sale()).drop(INGESTED_AT, "campaign_id"), dataset.schema, T1)
    sinks.write_batch(old, folder, dataset.target, "incremental")
    new = normalize.prepare(sales_of(spark, sale("O2")).drop(INGESTED_AT), dataset.schema, T2)
    assert sinks.write_batch(new, folder, dataset.target, "incremental", "order_date") == day("2024-01-10")
    stored = {r["order_id"]: r["campaign_id"] for r in dicts(readers.read_raw(spark, folder, dataset))}
    assert stored == {"O1": None, "O2": "K1"}


def test_a_batch_with_other_column_names_reads_back(spark, folder, source):
    dataset = DATASETS["sales"]
    publish(source, sales=sales_of(spark, sale("O1", date="2024-05-10")))
    ingest(spark, dataset, source, folder, T1)
    odd = sales_of(spark, sale("O2", date="2024-05-12")).drop(INGESTED_AT)
    odd = odd.withColumnRenamed("order_date", "Order Date").selectExpr("* except (`Order Date`)", "string(`Order Date`) as `Order Date`")
    sinks.write_batch(normalize.prepare(odd, dataset.schema, T2), folder, dataset.target, "incremental", "order_date")
    staged = {r["order_id"]: r["order_date"] for r in dicts(stg_sales(readers.read_raw(spark, folder, dataset)))}
    assert staged == {"O1": day("2024-05-10"), "O2": day("2024-05-12")}


def test_a_failing_full_load_keeps_the_old_rows(spark, folder, source):
    dataset = DATASETS["customers"]
    publish(source, customers=raw(spark)["raw_customers"])
    ingest(spark, dataset, source, folder, T1)
    bad = normalize.prepare(raw(spark)["raw_customers"], dataset.schema, T2).selectExpr("* except (age)", "age div 0 as age")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        sinks.write_batch(bad, folder, dataset.target, "full")
    assert readers.read_raw(spark, folder, dataset).count() == 2


def test_a_batch_is_one_job_and_one_for_its_line(spark, folder):
    dataset = DATASETS["customers"]
    batch = normalize.prepare(raw(spark)["raw_customers"], dataset.schema, T1)
    spark.sparkContext.setJobGroup("one batch", "")
    sinks.write_batch(batch, folder, dataset.target, "full")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("one batch")) == 2


def test_written_forms_of_a_day(spark):
    forms = ["2024-02-01", "02/01/2024", "2024/2/1", "20240201", "1-Feb-2024", "Feb 1, 2024", " 2024-02-01 ", "1 Feb 2024"]
    rows = spark.createDataFrame([(f,) for f in [*forms, "2024", "soon", None]], "order_date string")
    got = [r[0] for r in normalize.normalize_types(rows, schemas.SALES).collect()]
    assert got == [day("2024-02-01")] * len(forms) + [None, None, None]
    lost = {r["column_name"]: (r["arrived"], r["rejected"]) for r in normalize.rejects(rows, schemas.SALES).collect()}
    assert lost == {"order_date": (10, 2)}


def test_amounts_keep_their_decimals(spark):
    rows = spark.createDataFrame([("0.125", "12345678901.50")], "discount string, price string")
    got = normalize.normalize_types(rows, schemas.SALES).first()
    assert (str(got["discount"]), str(got["price"])) == ("0.125000000", "12345678901.500000000")


def test_jdbc_needs_bounds_for_large_tables(spark):
    source = readers.Source("jdbc", options={"url": "jdbc:none:"})
    with pytest.raises(ValueError, match="numPartitions"):
        source.read(spark, "fact_sales")


def test_an_earlier_default_watermark_reaches_further_back(spark, folder, source):
    tables = raw(spark, sales=[sale(date="2019-05-01")], marketing=[ad(date="2019-05-01")])
    publish(source, **{name.removeprefix("raw_"): frame for name, frame in tables.items()})
    ingest_all(spark, source, folder, T1, default_watermark=dt.datetime(2019, 1, 1))
    assert readers.read_raw(spark, folder, DATASETS["sales"]).count() == 1


def test_rejects_are_counted_by_the_load_and_can_refuse_it(spark, folder):
    """Renamed columns count under their stored names; a refused batch leaves the table as it was."""
    dataset = replace(DATASETS["sales"], load_type="full")
    source = readers.Source(root=f"{folder}/source")

    def publish(rows):
        frame = spark.createDataFrame(rows, "`Order Id` string, product_id string, Quantity string, other string")
        frame.write.mode("overwrite").parquet(f"{source.root}/{dataset.source}")

    publish([("O1", "P1", "3", "x"), ("O2", "P1", "n/a", "x"), ("O3", None, None, "x"), ("O4", "P1", "4.5", "x")])
    first = load(spark, dataset, source, folder, T1)
    assert first.rejects == {"order_id": (4, 0), "product_id": (3, 0), "quantity": (3, 2)} and first.watermark is None
    publish([("O9", "P9", "none", "x")])
    with pytest.raises(TooManyRejects, match="quantity"):
        load(spark, dataset, source, folder, T2, most_rejected=0.5)
    assert readers.read_raw(spark, folder, dataset).count() == 4
    load(spark, dataset, source, folder, T2)
    assert readers.read_raw(spark, folder, dataset).count() == 1
