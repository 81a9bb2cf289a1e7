"""The mart: every table of the model as a lazy DataFrame, built at most once."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from orderlens.operators.small import few
from orderlens.operators.skew import SkewPolicy, colocate, hot_keys, lookup_join
from orderlens.plans import analytics, bi, dimensions, facts, staging
from orderlens.session import cut_lineage
from orderlens.sources.tables import TableStore

PERSON_TABLES = ("mv_dim_customer", "mv_rfm", "mv_customer_ltv")


class RawTables:
    """Typed tables, unique on their keys, plus the reference tables.

    Names: orders, customers, order_items, order_payments, order_reviews, products,
    sellers, category_translation, geolocation, states, category_groups and
    payment_types. Each is a DataFrame, or a function that makes one when it is
    first asked for. `key_scans` holds cheaper frames with the same keys, for
    looking for hot ones; `calendar` fixes the calendar's bounds while raw orders
    still grow.
    """

    def __init__(
        self,
        spark: SparkSession,
        country: str = "Brazil",
        key_scans: Mapping[str, Callable[[], DataFrame]] | None = None,
        calendar: DataFrame | None = None,
        **tables: DataFrame | Callable[[], DataFrame],
    ):
        self.spark = spark
        self.country = country
        self.key_scans = dict(key_scans or {})
        self.calendar = calendar
        self._tables = tables

    def __getattr__(self, name: str) -> DataFrame:
        tables = self.__dict__.get("_tables", {})
        if name not in tables:
            raise AttributeError(name)
        made = tables[name]
        value = made if isinstance(made, DataFrame) else made()
        self.__dict__[name] = value
        return value


class Mart:
    """`store` holds the materialised person tables; without it they are computed.

    `skew` says when a key counts as hot; None trusts AQE alone and looks for none.
    """

    def __init__(
        self,
        raw: RawTables,
        store: TableStore | None = None,
        skew: SkewPolicy | None = None,
        legacy_fanout: bool = False,
    ):
        self.raw = raw
        self.store = store
        self.skew = skew
        self.legacy_fanout = legacy_fanout
        self.spark = raw.spark

    # -- hot keys ----------------------------------------------------------------
    @cached_property
    def _hot_item_keys(self) -> dict[str, list]:
        scans = self.raw.key_scans
        scan = scans["order_items"]() if "order_items" in scans else self.raw.order_items
        return hot_keys(scan, ["order_id", "product_id", "seller_id"], self.skew)

    @cached_property
    def _hot_people(self) -> list:
        scans = self.raw.key_scans
        scan = scans["persons"]() if "persons" in scans else self.raw.customers
        return hot_keys(scan, ["customer_unique_id"], self.skew)["customer_unique_id"]

    def hot(self, column: str) -> Sequence:
        if self.skew is None:
            return ()
        return self._hot_people if column == "customer_unique_id" else self._hot_item_keys[column]

    # -- staging -----------------------------------------------------------------
    @cached_property
    def customers(self) -> DataFrame:
        return staging.customers(self.raw.customers)

    @cached_property
    def orders(self) -> DataFrame:
        return staging.orders(self.raw.orders)

    @cached_property
    def order_items(self) -> DataFrame:
        # All work per order happens after this one shuffle.
        return colocate(staging.order_items(self.raw.order_items), "order_id", self.hot("order_id"))

    @cached_property
    def order_payments(self) -> DataFrame:
        return staging.order_payments(self.raw.order_payments)

    @cached_property
    def order_payment_summary(self) -> DataFrame:
        lines = colocate(self.order_payments, "order_id", self.hot("order_id"))
        return staging.order_payment_summary(lines, self.legacy_fanout)

    @cached_property
    def order_reviews(self) -> DataFrame:
        return staging.order_reviews(self.raw.order_reviews)

    @cached_property
    def products(self) -> DataFrame:
        return staging.products(
            self.raw.products, self.raw.category_translation, self.raw.category_groups
        )

    @cached_property
    def sellers(self) -> DataFrame:
        return staging.sellers(self.raw.sellers)

    @cached_property
    def geolocation(self) -> DataFrame:
        return staging.geolocation(self.raw.geolocation)

    # -- dimensions --------------------------------------------------------------
    @cached_property
    def dim_date(self) -> DataFrame:
        if self.raw.calendar is not None:
            return dimensions.dim_date(self.spark, self.raw.calendar, "purchase_ts")
        return dimensions.dim_date(self.spark, self.raw.orders, "order_purchase_timestamp")

    @cached_property
    def _customer_orders(self) -> DataFrame:
        return facts.customer_orders(self.orders, self.customers)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dimensions.dim_customer(self._customer_orders, self.raw.states)

    @cached_property
    def dim_product(self) -> DataFrame:
        return dimensions.dim_product(self.products)

    @cached_property
    def dim_seller(self) -> DataFrame:
        return dimensions.dim_seller(self.sellers, self.raw.states)

    @cached_property
    def dim_geo(self) -> DataFrame:
        return dimensions.dim_geo(self.raw.states, self.geolocation, self.raw.country)

    @cached_property
    def dim_payment_type(self) -> DataFrame:
        return self.raw.payment_types

    # Facts hold a handful of states and payment types, which a shuffle would put into as
    # many tasks; so these two are joined where the facts lie.
    @cached_property
    def places(self) -> DataFrame:
        return few(self.dim_geo, key="state_code")

    @cached_property
    def payment_labels(self) -> DataFrame:
        return few(self.dim_payment_type, key="payment_type")

    # -- facts -------------------------------------------------------------------
    @cached_property
    def order_sequence(self) -> DataFrame:
        return facts.order_sequence(self._customer_orders, self.hot("customer_unique_id"))

    @cached_property
    def order_context(self) -> DataFrame:
        return facts.order_context(
            self.order_sequence, self.order_payment_summary, self.order_reviews
        )

    @cached_property
    def fact_orders(self) -> DataFrame:
        return facts.fact_orders(self.order_context, facts.item_rollup(self.order_items))

    @cached_property
    def fact_sales(self) -> DataFrame:
        return facts.fact_sales(self.order_items, self.order_context, self.hot("order_id"))

    # -- analytics ---------------------------------------------------------------
    @cached_property
    def analysis_date(self) -> DataFrame:
        return dimensions.analysis_date(self.fact_orders)

    @cached_property
    def _person_totals(self) -> DataFrame:
        # Written once: RFM orders it twice and lifetime value once more.
        return cut_lineage(analytics.person_totals(self.fact_orders))

    @cached_property
    def rfm(self) -> DataFrame:
        return analytics.rfm(self._person_totals)

    @cached_property
    def cohort(self) -> DataFrame:
        return analytics.cohort(self.fact_orders)

    @cached_property
    def customer_ltv(self) -> DataFrame:
        return analytics.customer_ltv(self._person_totals)

    @cached_property
    def rfm_scores(self) -> DataFrame:
        """RFM, or if no table of it is there yet only its scores, from narrow rows."""
        stored = self.store is not None and self.store.versions("mv_rfm")
        if stored or self.__dict__.keys() & {"rfm", "_person_totals"}:
            return self.mv_rfm
        return analytics.rfm(cut_lineage(analytics.person_values(self.fact_orders)))

    @cached_property
    def concentration_curve(self) -> DataFrame:
        """`cumulative_revenue_pct` by `customer_percentile`: lifetime value, or if no table of it
        is there yet only what its curve needs, so that people are ordered by narrow rows."""
        stored = self.store is not None and self.store.versions("mv_customer_ltv")
        if stored or "customer_ltv" in self.__dict__:
            curve = self.mv_customer_ltv
        else:
            values = analytics.person_values(self.fact_orders)
            curve = analytics.ranked_by_value(values.select("customer_unique_id", "lifetime_value"))
        return curve.select("customer_percentile", "cumulative_revenue_pct")

    @cached_property
    def category_pareto(self) -> DataFrame:
        sold = self.fact_sales.filter("is_valid_sale")
        return analytics.category_pareto(analytics.category_totals(sold, self.dim_product))

    # -- materialised person tables and flat datasets ------------------------------
    def _stored(self, name: str, computed: str) -> DataFrame:
        if self.store is not None and self.store.versions(name):
            return self.store.current(name)
        return getattr(self, computed)

    @property
    def mv_dim_customer(self) -> DataFrame:
        return self._stored("mv_dim_customer", "dim_customer")

    @property
    def mv_rfm(self) -> DataFrame:
        return self._stored("mv_rfm", "rfm")

    @property
    def mv_customer_ltv(self) -> DataFrame:
        return self._stored("mv_customer_ltv", "customer_ltv")

    @cached_property
    def bi_sales(self) -> DataFrame:
        return bi.bi_sales(self)

    @cached_property
    def bi_orders(self) -> DataFrame:
        return bi.bi_orders(self)

    @cached_property
    def bi_customer(self) -> DataFrame:
        return bi.bi_customer(self)

    def lookup(self, left: DataFrame, right: DataFrame, on: str, how: str, spread: Sequence[str]) -> DataFrame:
        """Join a dimension to a fact, salted where the fact has hot keys."""
        return lookup_join(left, right, on, how, self.hot(on), spread)

    def settled(self, *names: str) -> Mart:
        """A mart whose named tables are written to the shared folder and read from there.

        For several reports over the same tables in one job.
        """
        other = Mart(self.raw, self.store, self.skew, self.legacy_fanout)
        for name in names:
            other.__dict__[name] = cut_lineage(getattr(self, name))
        return other
