from __future__ import annotations

import datetime
import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from orderlens.plans.mart import RawTables  # noqa: E402
from orderlens.session import local_session  # noqa: E402
from orderlens.sources import lookups  # noqa: E402
from orderlens.sources.schemas import GEOLOCATION, LANDING, RAW  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "orderlens-tests")
    session.conf.set("spark.sql.shuffle.partitions", "3")
    return session


def day(text: str) -> datetime.datetime:
    return datetime.datetime.fromisoformat(text)


def money(value) -> Decimal:
    return Decimal(str(value)).quantize(Decimal("0.01"))


def frame(spark, schema, rows):
    """Rows as dicts; columns left out are NULL."""
    names = schema.names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


@pytest.fixture
def raw_of(spark):
    """Raw tables from literal rows; tables left out are empty."""

    def build(**rows) -> RawTables:
        tables = {name: frame(spark, schema, rows.get(name, [])) for name, schema in RAW.items()}
        for name in ("products", "sellers", "category_translation"):
            tables[name] = frame(spark, LANDING[name], rows.get(name, []))
        return RawTables(
            spark,
            geolocation=frame(spark, GEOLOCATION, rows.get("geolocation", [])),
            states=lookups.states(spark),
            category_groups=lookups.category_groups(spark),
            payment_types=lookups.payment_types(spark),
            **tables,
        )

    return build


def order(number: int, person: str, bought: str, status: str = "delivered", **more) -> tuple[dict, dict]:
    """An order and its customer row."""
    row = {
        "order_id": f"o{number}",
        "customer_id": f"c{number}",
        "order_status": status,
        "order_purchase_timestamp": day(bought),
        **more,
    }
    customer = {
        "customer_id": f"c{number}",
        "customer_unique_id": person,
        "customer_zip_code_prefix": "1234",
        "customer_city": "são paulo",
        "customer_state": "sp",
    }
    return row, customer


def item(number: int, line: int, price, freight=0, product: str = "x", seller: str = "s") -> dict:
    return {
        "order_id": f"o{number}",
        "order_item_id": line,
        "product_id": product,
        "seller_id": seller,
        "price": money(price),
        "freight_value": money(freight),
    }
