"""The versioned store, staging as an upsert, and refreshes against full rebuilds."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from frames import CUSTOMERS, PARAMS, ad, day, mart, raw, sale
from pyspark.sql import functions as F

from starmart.plans.incremental import BY_MONTH, IncrementalMart
from starmart.plans.mart import Mart
from starmart.sources import upsert
from starmart.sources.versions import Change, Store, WriteConflict

KIND = "key long, value string"


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def test_two_writers_from_one_version(spark, folder):
    """The later of two writers fails, has changed nothing, and succeeds when it starts anew."""
    store, schema = Store(spark, folder), spark.createDataFrame([], KIND).schema
    part = F.col("key").cast("string")
    first = store.begin()
    first.replace("t", spark.createDataFrame([(1, "a"), (2, "a")], KIND), part)
    assert store.read("t", schema).count() == 0  # nothing is visible before the commit
    first.commit()
    one, other = store.begin(), store.begin()
    one.replace("t", spark.createDataFrame([(2, "one")], KIND), part)
    other.replace("t", spark.createDataFrame([(1, "other"), (3, "other")], KIND), part)
    assert one.commit().number == 2
    with pytest.raises(WriteConflict):
        other.commit()
    assert rows_of(store.read("t", schema)) == rows_of(spark.createDataFrame([(1, "a"), (2, "one")], KIND))
    again = store.begin()
    again.replace("t", spark.createDataFrame([(1, "other"), (3, "other")], KIND), part)
    again.replace("t", spark.createDataFrame([], KIND), part, ["2"])
    again.commit()
    assert rows_of(store.read("t", schema)) == rows_of(spark.createDataFrame([(1, "other"), (3, "other")], KIND))
    assert rows_of(store.read("t", schema, store.version(1))) == rows_of(spark.createDataFrame([(1, "a"), (2, "a")], KIND))


def test_vacuum_keeps_what_the_last_versions_name(spark, folder):
    store, schema = Store(spark, folder), spark.createDataFrame([], KIND).schema
    for i in range(4):
        change = store.begin()
        change.replace("t", spark.createDataFrame([(i % 3, str(i))], KIND), F.col("key").cast("string"))
        change.commit()
    lost = store.begin()
    lost.replace("t", spark.createDataFrame([(9, "never committed")], KIND), F.lit("9"))
    before = rows_of(store.read("t", schema))
    gone = store.vacuum(keep=1)
    assert len(gone) == 2 and any(lost.name in g for g in gone)
    assert rows_of(store.read("t", schema)) == before
    assert store.current().number == 4


def test_upsert_of_overlapping_batches(spark, folder):
    """Copies in any order, repeated rows, NULL keys and an empty batch; only buckets that a batch hits are written."""
    draw = random.Random(2)
    copies = [
        sale(draw.choice([f"O{i}" for i in range(12)] + [None]), draw.choice(["P1", "P2", None]), price=Decimal(draw.randrange(1, 9)),
             _ingested_at=dt.datetime(2024, 1, draw.randrange(1, 9)))
        for _ in range(120)
    ]
    store, name = Store(spark, folder), upsert.SALES.name
    for i in range(0, 120, 40):
        change = store.begin()
        batch = raw(spark, sales=[*copies[i : i + 40], *copies[i : i + 3]])["raw_sales"]
        upsert.upsert(change, upsert.SALES, batch, buckets=8)
        change.commit()
        want = mart(spark, sales=copies[: i + 40])["stg_sales"]
        assert rows_of(upsert.staged(store.begin(), upsert.SALES, upsert.SALES.typed(batch).schema).select(want.columns)) == rows_of(want)
    before = store.current().tables[name]
    change = store.begin()
    changed = upsert.upsert(change, upsert.SALES, raw(spark, sales=[sale("O3", "P1", price=Decimal(99), _ingested_at=dt.datetime(2025, 1, 1))])["raw_sales"], buckets=8)
    assert [(r["new"]["order_id"], r["new"]["price"]) for r in changed.collect()] == [("O3", 99)]
    assert sum(change.parts(name)[p] != before[p] for p in before) == 1
    empty = store.begin()
    assert upsert.upsert(empty, upsert.SALES, raw(spark)["raw_sales"], buckets=8).count() == 0
    assert empty.parts(name) == before


def test_an_upsert_shuffles_batch_and_stored_rows_once(spark, folder, monkeypatch):
    """One shuffle of either side decides the latest copies and what changed; only the gathering of buckets comes after."""
    store, plans, scratch = Store(spark, folder), [], Change.scratch

    def watched(change, name, rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return scratch(change, name, rows)

    for price in (1, 2):
        change = store.begin()
        batch = raw(spark, sales=[sale(f"O{i}", "P1", price=Decimal(price), _ingested_at=dt.datetime(2024, 1, price)) for i in range(5)])["raw_sales"]
        if price == 2:
            monkeypatch.setattr(Change, "scratch", watched)
        changed = upsert.upsert(change, upsert.SALES, batch, buckets=4)
        change.commit()
    assert sum(p.count("Exchange") for p in plans) == 2
    assert {(r["old"]["price"], r["new"]["price"]) for r in changed.collect()} == {(1, 2)} and changed.count() == 5


def test_an_upsert_writes_rows_twice_besides_the_table(spark, folder, monkeypatch):
    """The typed batch and the merged rows; what changed is read from the latter, and parts are compressed."""
    names, scratch = [], Change.scratch
    monkeypatch.setattr(Change, "scratch", lambda change, name, rows: (names.append(name), scratch(change, name, rows))[1])
    store = Store(spark, folder)
    change = store.begin()
    batch = raw(spark, sales=[sale(f"O{i}", "P1") for i in range(5)])["raw_sales"]
    changed = upsert.upsert(change, upsert.SALES, batch, buckets=4)
    change.commit()
    assert names == ["stg_sales-batch", "stg_sales-merged"] and changed.count() == 5
    files = change.read("stg_sales", upsert.SALES.typed(batch).schema).inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def shop(seed: int):
    """Customers, lines and ads over ten months; some customers never buy, some lines are nobody's."""
    draw = random.Random(seed)
    customers = [{"customer_id": f"C{i}", "region": draw.choice(["North", "South", None]), "age": 20 + i} for i in range(25)]
    months = [f"2023-{m:02d}" for m in range(3, 13)]
    sold = [
        sale(f"O{i // 2}", f"P{i % 2}", f"C{draw.randrange(27)}", f"{draw.choice(months)}-{draw.randrange(1, 28):02d}",
             refund_status=draw.choice(["Completed", "Completed", "Refunded", None]), channel=draw.choice(["Email", "Web", "", None]))
        for i in range(120)
    ]
    ads = [ad(f"A{i}", f"{draw.choice(months)}-{draw.randrange(1, 28):02d}", channel_name=draw.choice(["Email", "Web"])) for i in range(30)]
    return customers, sold, ads


def test_refreshes_equal_a_full_rebuild(spark, folder):
    """Late lines, corrected lines that move to another day and customer, an earlier first purchase, a later last month."""
    customers, sold, ads = shop(4)
    fixed = {"customers": customers}
    early = [s for i, s in enumerate(sold) if i % 20]
    late = [s for i, s in enumerate(sold) if not i % 20]
    corrected = [
        early[10] | {"order_date": day("2023-05-05"), "customer_id": "C20", "_ingested_at": dt.datetime(2024, 6, 9)},
        early[11] | {"revenue": Decimal(7), "_ingested_at": dt.datetime(2024, 6, 9)},
        early[12] | {"order_date": day("2020-05-05"), "_ingested_at": dt.datetime(2023, 1, 1)},  # an older copy
        sale("O900", "P1", "C3", "2022-11-30"),  # C3 was here before
        sale("O901", "P1", "C4", "2024-02-02"),  # the window of the last cohorts opens further
        sale("O902", "P1", "C5", "1999-01-01"),  # outside the calendar
    ]
    batches = [(early, ads[:25]), (late + corrected, []), ([], ads[20:])]
    inc = IncrementalMart(spark, raw(spark, **fixed), folder, PARAMS, buckets=4)
    seen_sales, seen_ads, reports = [], [], []
    for lines, records in batches:
        seen_sales, seen_ads = [*seen_sales, *lines], [*seen_ads, *records]
        batch = raw(spark, sales=lines, marketing=records)
        before = inc.store.current().tables
        reports.append(inc.refresh(batch["raw_sales"], batch["raw_marketing"]))
        after = inc.store.current().tables
        for name, (written, _) in reports[-1].items():
            moved = {p for p in {*before.get(name, {}), *after.get(name, {})} if before.get(name, {}).get(p) != after.get(name, {}).get(p)}
            assert len(moved) <= written
    full = mart(spark, **fixed, sales=seen_sales, marketing=seen_ads)
    for name in ("dim_customers", *BY_MONTH):
        assert rows_of(inc.table(name).select(full[name].columns)) == rows_of(full[name]), name
    assert all(written == parts for written, parts in reports[0].values())
    assert reports[2]["fact_sales"][0] == reports[2]["agg_customer_segment"][0] == reports[2]["dim_customers"][0] == 0


def test_a_single_late_line_leaves_other_months_alone(spark, folder):
    sold = [sale(f"O{m}{c}", "P1", c, f"2023-{m:02d}-10") for m in range(1, 13) for c in ("C1", "C2")]
    inc = IncrementalMart(spark, raw(spark), folder, PARAMS, buckets=4)
    batch = raw(spark, sales=sold, marketing=[ad(date="2023-03-03")])
    inc.refresh(batch["raw_sales"], batch["raw_marketing"])
    late = raw(spark, sales=[sale("O99", "P1", "C1", "2023-06-20")])
    report = inc.refresh(late["raw_sales"], late["raw_marketing"])
    assert {t: report[t] for t in ("fact_sales", "agg_growth_daily", "agg_customer_segment", "agg_sales_daily")} == {
        "fact_sales": (1, 12), "agg_growth_daily": (1, 12), "agg_customer_segment": (1, 12), "agg_sales_daily": (1, 12)
    }
    assert report["fact_marketing"][0] == report["agg_channel_funnel_daily"][0] == 0
    first = raw(spark, sales=[sale("O0", "P1", "C1", "2022-12-31")])
    report = inc.refresh(first["raw_sales"], first["raw_marketing"])
    # C1 is returning now wherever C1 was new; the months C2 alone bought in would stay
    assert report["fact_sales"] == (1, 13) and report["agg_growth_daily"] == (13, 13) and report["agg_sales_daily"] == (1, 13)


def test_a_failed_refresh_changes_nothing(spark, folder, monkeypatch):
    inc = IncrementalMart(spark, raw(spark), folder, PARAMS, buckets=2)
    batch = raw(spark, sales=[sale(), sale("O2", customer="C2", date="2024-02-03")], marketing=[ad()])
    inc.refresh(batch["raw_sales"], batch["raw_marketing"])
    before = inc.store.current()
    late = raw(spark, sales=[sale("O3", date="2024-03-01")])
    monkeypatch.setattr(inc, "_cohorts", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        inc.refresh(late["raw_sales"], late["raw_marketing"])
    assert inc.store.current() == before
    monkeypatch.undo()
    inc.refresh(late["raw_sales"], late["raw_marketing"])
    assert inc.table("fact_sales").count() == 3
    assert len(CUSTOMERS) == 2 and isinstance(inc.mart, Mart)
