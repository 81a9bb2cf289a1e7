from __future__ import annotations

import os
import uuid

import pytest
from pyspark.sql import functions as F

from orderlens.plans.quality import DataQualityError
from orderlens.session import shared_dir
from orderlens.sources import lookups
from orderlens.sources.landing import load_landing, read_csv, typed_feed
from orderlens.sources.schemas import GEOLOCATION, LANDING, RAW
from orderlens.sources.tables import TableStore
from orderlens.streaming import health
from orderlens.streaming.ingest import Cursor, Ingest, next_window

from tests.conftest import frame


def an_order(number, bought="2017-01-01 10:00:00", customer=None):
    return {
        "order_id": f"o{number}", "customer_id": customer or f"c{number}", "order_status": " Delivered ",
        "order_purchase_timestamp": bought,
    }


def an_item(number, line="1", price="5.00", product="x", freight="1"):
    return {
        "order_id": f"o{number}", "order_item_id": line, "product_id": product, "seller_id": "s",
        "price": price, "freight_value": freight,
    }


@pytest.fixture
def landed(spark):
    def build(orders, customers=None, **rows):
        people = customers if customers is not None else [
            {"customer_id": o["customer_id"], "customer_unique_id": f"u-{o['customer_id']}"} for o in orders
        ]
        rows = {"orders": orders, "customers": people, "products": [{"product_id": "x"}], **rows}
        return {name: frame(spark, schema, rows.get(name, [])) for name, schema in LANDING.items()}

    return build


@pytest.fixture
def ingest_of(spark, tmp_path):
    return lambda tables: Ingest(spark, str(tmp_path / uuid.uuid4().hex), tables)


def errors(ingest):
    return sorted((r.source_table, r.record_key, r.error_type) for r in ingest.load_errors().collect())


def test_a_batch_leaves_no_passing_tables(spark, landed, ingest_of):
    def cuts():
        return {name for name in os.listdir(shared_dir(spark).removeprefix("file:")) if name.startswith("cut-")}

    before, ingest = cuts(), ingest_of(landed([an_order(1), an_order(2)], order_items=[an_item(1), an_item(2)]))
    done = ingest.next_batch(1)
    ingest.arrivals(ingest.feed.filter("order_id = 'o2'"), 0)
    ingest.backfill_children()
    assert cuts() == before
    assert done.rows_loaded == 3 and ingest.raw("order_items").count() == 2


def test_every_reject_reason(landed, ingest_of):
    ingest = ingest_of(
        landed(
            [an_order(1), an_order(2, "never"), an_order(3), an_order(4)],
            [{"customer_id": "c1", "customer_unique_id": "u"}, {"customer_id": "c4"}],
            order_items=[
                an_item(1), an_item(1, "2", "abc"), an_item(1, "3", "-1"), an_item(1, "4", product="none"),
                an_item(1, "?"), an_item(1, "5", freight="-2"), an_item(1, "6", freight=""), an_item(3),
            ],
            order_payments=[
                {"order_id": "o1", "payment_sequential": "1", "payment_type": " Boleto", "payment_value": "6"},
                {"order_id": "o1", "payment_sequential": "2", "payment_type": "boleto"},
            ],
            order_reviews=[
                {"review_id": f"r{s}", "order_id": "o1", "review_score": s, "review_comment_message": " hi "}
                for s in ("5", "0", "6", "x")
            ],
        )
    )
    result = ingest.next_batch(10)
    assert errors(ingest) == [
        ("seed.order_items", "o1#2", "bad_numeric"), ("seed.order_items", "o1#3", "negative_price"),
        ("seed.order_items", "o1#4", "missing_fk"), ("seed.order_items", "o1#5", "negative_freight"),
        ("seed.order_items", "o1#?", "bad_key"), ("seed.order_payments", "o1#2", "bad_numeric"),
        ("seed.order_reviews", "r0", "bad_score"), ("seed.order_reviews", "r6", "bad_score"),
        ("seed.order_reviews", "rx", "bad_score"), ("seed.orders", "o2", "bad_timestamp"),
        ("seed.orders", "o3", "missing_fk"), ("seed.orders", "o4", "null_required"),
    ]
    assert (result.orders_attempted, result.rows_loaded, result.rows_rejected, result.status) == (3, 6, 12, "partial")
    assert ingest.raw("orders").first().order_status == "delivered"
    assert {r.order_item_id: float(r.freight_value) for r in ingest.raw("order_items").collect()} == {1: 1.0, 6: 0.0}
    paid, review = ingest.raw("order_payments").first(), ingest.raw("order_reviews").first()
    assert (paid.payment_type, paid.payment_installments) == ("boleto", 1)
    assert (review.has_comment, review.comment_length) == (True, 2)
    payload = ingest.load_errors().filter("error_type = 'missing_fk' and source_table = 'seed.orders'").first().raw_payload
    assert '"order_id":"o3"' in payload and '"order_approved_at":null' in payload


@pytest.mark.parametrize("size", [1, 3, 100])
def test_batch_size_does_not_matter(landed, ingest_of, size):
    orders = [an_order(i, f"2017-01-0{1 + i // 3} 00:00:00") for i in range(6)]
    tables = landed(orders, order_items=[an_item(i, str(n)) for i in range(6) for n in (1, 2, 2)])
    ingest = ingest_of(tables)
    results = ingest.drip(size=size)
    assert results[-1].orders_attempted == 0 and results[-1].status == "succeeded"
    assert {t: ingest.raw(t).count() for t in RAW} == {
        "customers": 6, "orders": 6, "order_items": 12, "order_payments": 0, "order_reviews": 0,
    }
    assert ingest.read_cursor().orders_ingested == 6
    assert ingest.late_rows().isEmpty()


def test_a_refused_window_does_not_stop_the_feed(landed, ingest_of):
    orders = [an_order(i, f"2017-01-0{i} 00:00:00") for i in (1, 2, 3)]
    ingest = ingest_of(landed(orders, [{"customer_id": "c3", "customer_unique_id": "u"}]))
    results = ingest.drip(size=2)
    assert [r.orders_attempted for r in results] == [2, 1, 0]
    assert [r.order_id for r in ingest.raw("orders").collect()] == ["o3"]
    assert len(errors(ingest)) == 2


def test_replay_adds_nothing(landed, ingest_of):
    ingest = ingest_of(landed([an_order(1), an_order(2, "x")], order_items=[an_item(1), an_item(1, "2", "bad")]))
    ingest.next_batch(5)
    before = {t: ingest.raw(t).count() for t in RAW}, errors(ingest)
    ingest.store.clear("ops/ingest_watermark")
    again = ingest.next_batch(5)
    assert (again.orders_attempted, again.rows_loaded, again.rows_rejected) == (1, 0, 0)
    assert ({t: ingest.raw(t).count() for t in RAW}, errors(ingest)) == before


def test_a_failed_batch_is_logged_and_invisible(landed, ingest_of, monkeypatch):
    ingest = ingest_of(landed([an_order(1)], order_items=[an_item(1)]))
    monkeypatch.setattr(Ingest, "_write_errors", lambda *_: (_ for _ in ()).throw(RuntimeError("disk gone")))
    with pytest.raises(RuntimeError):
        ingest.next_batch(5)
    monkeypatch.undo()
    assert ingest.raw("orders").isEmpty()
    assert [(r.error_type, r.error_detail) for r in ingest.load_errors().collect()] == [
        ("pipeline_failure", "RuntimeError: disk gone")
    ]
    assert ingest.next_batch(5).rows_loaded == 3
    report = {r.batch_id: r.status for r in health.pipeline_health(ingest.load_batch()).collect()}
    assert report == {1: "failed", 2: "succeeded"}


def test_late_rows_and_children(spark, landed, ingest_of):
    ingest = ingest_of(landed([an_order(2, "2017-02-01 00:00:00")]))
    ingest.drip()
    tables = landed(
        [an_order(2, "2017-02-01 00:00:00"), an_order(1, "2017-01-01 00:00:00")], order_items=[an_item(2)]
    )
    later = Ingest(spark, ingest.store.root, tables)
    assert later.next_batch().orders_attempted == 0
    assert [r.order_id for r in later.late_rows().collect()] == ["o1"]
    assert later.backfill_children().rows_loaded == 1
    assert later.backfill_children().rows_loaded == 0


@pytest.mark.parametrize("size", [1, 2, 3, 4, 7, 50])
def test_windows_have_one_total_order(landed, size):
    """Copies of one order are taken in the same order, whatever the size of the window."""
    orders = [an_order(i, f"2017-0{1 + i % 3}-02 00:00:00") for i in range(9)]
    orders += [an_order(0, "2017-01-02 00:00:00", customer) for customer in ("z", "x", "y")]
    feed = typed_feed(landed(orders)["orders"])
    key = lambda r: (r.purchase_ts, r.order_id, r.customer_id)
    every = sorted(map(key, feed.collect()))
    assert sorted(map(key, next_window(feed, Cursor(), size).collect())) == every[:size]


def test_drip_says_whether_it_was_drained(landed, ingest_of):
    ingest = ingest_of(landed([an_order(i) for i in range(4)]))
    assert not ingest.drip(runs=2, size=1).drained
    assert ingest.drip(size=1).drained


def test_amounts_that_do_not_fit_are_refused(landed, ingest_of):
    ingest = ingest_of(
        landed(
            [an_order(1)],
            order_items=[
                an_item(1, "1", "12345678901.00"), an_item(1, "2", freight="12345678901.00"),
                an_item(1, "3", "9999999999.99", freight="9999999999.99"), an_item(1, "4", freight="oops"),
            ],
            order_payments=[{"order_id": "o1", "payment_sequential": "1", "payment_value": "12345678901.00"}],
        )
    )
    ingest.drip()
    assert errors(ingest) == [
        ("seed.order_items", "o1#1", "bad_numeric"), ("seed.order_items", "o1#2", "bad_numeric"),
        ("seed.order_payments", "o1#1", "bad_numeric"),
    ]
    kept = {r.order_item_id: (str(r.price), str(r.freight_value)) for r in ingest.raw("order_items").collect()}
    assert kept == {3: ("9999999999.99", "9999999999.99"), 4: ("5.00", "0.00")}


def test_a_second_stream_on_the_same_root_loads_its_orders(spark, tmp_path, landed, ingest_of):
    tables = landed([an_order(1), an_order(2)])
    ingest = ingest_of(tables)
    for number in (1, 2):
        folder = str(tmp_path / f"arrivals{number}")
        tables["orders"].filter(f"order_id = 'o{number}'").write.parquet(folder)
        source = spark.readStream.schema(LANDING["orders"]).parquet(folder)
        ingest.stream(source, str(tmp_path / f"state{number}")).awaitTermination()
    assert sorted(r.order_id for r in ingest.raw("orders").collect()) == ["o1", "o2"]


def test_children_that_land_later_are_seen(spark, tmp_path, landed, ingest_of):
    tables = landed([an_order(1)], order_items=[an_item(1)])
    folder = str(tmp_path / "items")
    tables["order_items"].write.parquet(folder)
    ingest = ingest_of(tables | {"order_items": lambda: spark.read.parquet(folder)})
    ingest.drip()
    landed([], order_items=[an_item(1, "2")])["order_items"].write.mode("append").parquet(folder)
    assert ingest.backfill_children().rows_loaded == 1
    assert ingest.raw("order_items").count() == 2


def test_stream_equals_drip_and_epochs_load_once(spark, tmp_path, landed, ingest_of):
    tables = landed([an_order(i) for i in range(5)], order_items=[an_item(i) for i in range(5)])
    tables["orders"].write.parquet(str(tmp_path / "arrivals"))
    ingest = ingest_of(tables)
    for _ in range(2):
        source = spark.readStream.schema(LANDING["orders"]).parquet(str(tmp_path / "arrivals"))
        ingest.stream(source, str(tmp_path / "state")).awaitTermination()
    assert ingest.raw("order_items").count() == 5 and len(ingest.committed()) == 1
    assert ingest.arrivals(tables["orders"], 7, "q") is not None
    assert ingest.arrivals(tables["orders"], 7, "q") is None


def test_refresh_gate_and_reset(spark, landed, ingest_of):
    ingest = ingest_of(landed([an_order(1), an_order(2)], order_items=[an_item(1)]))
    ingest.drip()
    reference = {
        "geolocation": frame(spark, GEOLOCATION, []),
        "states": lookups.states(spark),
        "category_groups": lookups.category_groups(spark),
        "payment_types": lookups.payment_types(spark),
    }
    steps = ingest.refresh_customer_layer(ingest.mart(reference)).collect()
    assert [(s.step, s.row_count) for s in steps] == [("analyze", 2), ("analyze", 1), ("analyze", 0), ("analyze", 0), ("analyze", 2)] + [("refresh", 2)] * 3
    # Every order has its own person here, which the grain check takes for a mix-up.
    with pytest.raises(DataQualityError, match="customer_grain_collapsed"):
        ingest.run_dq_checks(ingest.mart(reference), 1)
    assert ingest.dq_result().count() == 13
    ingest.reset()
    assert ingest.raw("orders").isEmpty() and ingest.read_cursor() == Cursor()


def test_versions_and_checks_before_publishing(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))

    def refuse(_):
        raise DataQualityError("no")

    for n in range(4):
        store.publish("t", spark.range(n))
    with pytest.raises(DataQualityError):
        store.publish("t", spark.range(99), check=refuse)
    assert store.versions("t") == [3, 4] and store.current("t").count() == 3
    with pytest.raises(FileNotFoundError):
        store.current("other")


def test_csv_landing(spark, tmp_path):
    (tmp_path / "reviews.csv").write_text(
        'review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n'
        'r1,o1,5,,"two\nlines, ""quoted""",2017-01-01,\n'
    )
    row = read_csv(spark, str(tmp_path / "reviews.csv"), "order_reviews").first()
    assert (row.review_comment_message, row.review_comment_title) == ('two\nlines, "quoted"', None)
    names = ",".join(LANDING["orders"].names)
    (tmp_path / "orders.csv").write_text(f"{names}\no1,c1,x,2017-05-06 07:08:09,,,,\no2,c2,x,oops,,,,\n")
    (tmp_path / "geo.csv").write_text(",".join(LANDING["geolocation_samples"].names) + "\n1,-20,-50,x,sp\n")
    tables = load_landing(
        spark,
        {"orders": str(tmp_path / "orders.csv"), "geolocation_samples": str(tmp_path / "geo.csv")},
        str(tmp_path / "landing"),
    )
    assert tables["orders"].count() == 2 and tables["geolocation"].first().zip_code_prefix == "00001"
    assert tables["orders"].filter("purchase_ts is not null").first().purchase_month == "2017-05"
    assert tables["orders"].filter(F.col("purchase_ts") > "2017-01-01").count() == 1


def test_bulk_queries_make_no_index(spark, monkeypatch):
    from orderlens import catalog
    from orderlens.sources.file_index import FileIndex
    from tests.conftest import SMALL

    monkeypatch.setattr(FileIndex, "refresh", lambda *_: pytest.fail("a load that needs every file made an index"))
    assert catalog.queries()["recent_batches"](spark, SMALL).count() == 2


def test_few_jobs_run_side_by_side():
    import threading
    import time

    from orderlens.session import at_once

    lock, now, most = threading.Lock(), [0], [0]

    def job():
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.05)
        with lock:
            now[0] -= 1
        return 1

    assert at_once({k: job for k in range(9)}) == {k: 1 for k in range(9)}
    assert 1 < most[0] <= 4
