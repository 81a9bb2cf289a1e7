"""The metric layer: named measures, evaluated by any shared attribute.

A measure is an aggregate over one dataset; a ratio combines measures, possibly of
different datasets. `evaluate` groups each dataset it needs once and lines the
groups up, so a report costs one pass per dataset however many measures it shows.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.bands import REVIEW_DETRACTOR, REVIEW_PROMOTER
from orderlens.functions.exact import mean_of, plain_ratio
from orderlens.operators.grouped import middle_values
from orderlens.operators.keyed import union_all
from orderlens.operators.ordering import exact_percentile, global_order
from orderlens.plans.mart import Mart
from orderlens.session import cut_lineage


def _c(name: str) -> Column:
    return F.col(name)


def _valid(*more: Column) -> Column:
    condition = _c("is_valid_sale")
    for extra in more:
        condition = condition & extra
    return condition


def _sum_valid(name: str, *more: Column) -> Column:
    return F.sum(F.when(_valid(*more), _c(name)))


def _detractor() -> Column:
    return _c("review_band") == REVIEW_DETRACTOR


def _promoter() -> Column:
    return _c("review_band") == REVIEW_PROMOTER


@dataclass(frozen=True)
class Measure:
    """An aggregate over one dataset."""

    dataset: str
    value: Callable[[], Column]


@dataclass(frozen=True)
class Median:
    """The exact median of a column; ordered across tasks, so not a plain aggregate."""

    dataset: str
    column: str


@dataclass(frozen=True)
class Combined:
    """An expression over other measures, by name."""

    needs: tuple[str, ...]
    value: Callable[..., Column]


def _ratio(num: str, den: str) -> Combined:
    return Combined((num, den), plain_ratio)


def _minus(left: str, right: str) -> Combined:
    return Combined((left, right), lambda a, b: a - b)


# Facts are unique on their keys, so valid rows of the order fact are distinct
# orders, and a person has one first order: both are counts, not distinct counts.
STAR_MEASURES: dict[str, Measure | Median | Combined] = {
    "total_revenue": Measure("sales", lambda: _sum_valid("item_total")),
    "product_revenue": Measure("sales", lambda: _sum_valid("price")),
    "freight_cost": Measure("sales", lambda: _sum_valid("freight_value")),
    "total_orders": Measure("orders", lambda: F.count_if(_valid())),
    "total_items": Measure("sales", lambda: F.count_if(_valid())),
    "total_customers": Measure(
        "orders", lambda: F.count_distinct(F.when(_valid(), _c("customer_unique_id")))
    ),
    "avg_order_value": _ratio("total_revenue", "total_orders"),
    "avg_items_per_order": _ratio("total_items", "total_orders"),
    "revenue_per_customer": _ratio("total_revenue", "total_customers"),
    "cancellation_rate": Measure(
        "orders", lambda: plain_ratio(F.count_if("is_cancelled"), F.count(F.lit(1)))
    ),
    "top_20_pct_customer_revenue_share": Measure(
        "ltv",
        lambda: plain_ratio(
            F.sum(F.when(_c("customer_percentile") <= 20, _c("lifetime_value"))),
            F.sum("lifetime_value"),
        ),
    ),
    "categories_to_80_pct": Measure(
        "pareto", lambda: F.count_distinct(F.when(_c("is_vital_few"), _c("category")))
    ),
    "new_customers": Measure("orders", lambda: F.count_if(_valid(_c("is_first_order")))),
    "returning_customers": _minus("total_customers", "new_customers"),
    "new_customer_revenue": Measure(
        "sales", lambda: F.coalesce(_sum_valid("item_total", _c("is_first_order")), F.lit(0))
    ),
    "returning_customer_revenue": _minus("total_revenue", "new_customer_revenue"),
    "returning_revenue_pct": _ratio("returning_customer_revenue", "total_revenue"),
    "repeat_customer_pct": Measure(
        "customers",
        lambda: plain_ratio(F.count_if("is_repeat_customer"), F.count_if(_c("lifetime_orders") >= 1)),
    ),
    "avg_customer_ltv": Measure("ltv", lambda: mean_of(_c("lifetime_value"))),
    "median_customer_ltv": Median("ltv", "lifetime_value"),
    "customers_in_segment": Measure("rfm", lambda: F.count(F.lit(1))),
    "segment_revenue": Measure("rfm", lambda: F.sum("monetary")),
    "avg_days_between_orders": Measure(
        "ltv",
        lambda: mean_of(
            plain_ratio(_c("lifespan_days"), _c("total_orders") - F.lit(1)).cast("decimal(20,10)"),
            _c("total_orders") > 1,
        ),
    ),
    "cohort_customers": Measure("cohort", lambda: F.sum("size")),
    "retention_pct": Measure("cohort", lambda: plain_ratio(F.sum("active"), F.sum("size"))),
    "m1_retention_pct": Measure("cohort", lambda: plain_ratio(F.sum("active_1"), F.sum("size_1"))),
    "m3_retention_pct": Measure("cohort", lambda: plain_ratio(F.sum("active_3"), F.sum("size_3"))),
    "m6_retention_pct": Measure("cohort", lambda: plain_ratio(F.sum("active_6"), F.sum("size_6"))),
    "revenue_per_cohort_customer": Measure(
        "cohort", lambda: plain_ratio(F.sum("revenue"), F.sum("size"))
    ),
    "avg_review_score": Measure("orders", lambda: mean_of(_c("review_score"), _valid())),
    "reviewed_orders": Measure("orders", lambda: F.count_if(_valid(_c("review_score").isNotNull()))),
    # The numerators count every order, the denominator valid ones only.
    "detractor_orders": Measure("orders", lambda: F.count_if(_detractor())),
    "promoter_orders": Measure("orders", lambda: F.count_if(_promoter())),
    "detractor_pct": _ratio("detractor_orders", "reviewed_orders"),
    "promoter_pct": _ratio("promoter_orders", "reviewed_orders"),
    "revenue_at_risk": Measure("orders", lambda: _sum_valid("order_total", _detractor())),
    "avg_delivery_days": Measure("orders", lambda: mean_of(_c("delivery_days"))),
    "avg_promised_days": Measure("orders", lambda: mean_of(_c("promised_days"))),
    "late_delivery_pct": Measure(
        "orders", lambda: plain_ratio(F.count_if("is_late"), F.count_if("is_delivered"))
    ),
    "avg_days_vs_promise": Measure("orders", lambda: mean_of(_c("days_vs_promise"))),
    "freight_pct_of_product_revenue": _ratio("freight_cost", "product_revenue"),
    "order_freight": Measure("orders", lambda: _sum_valid("order_freight")),
    "avg_freight_per_order": _ratio("order_freight", "total_orders"),
    "data_as_of": Measure("orders", lambda: F.max("purchase_date")),
    "last_batch_loaded": Measure("pipeline", lambda: F.max("finished_at")),
    "rows_rejected_last_batch": Measure("pipeline", lambda: F.max_by("rows_rejected", "batch_id")),
    "pipeline_reject_rate": Measure(
        "pipeline",
        lambda: plain_ratio(F.sum("rows_rejected"), F.sum("rows_loaded") + F.sum("rows_rejected")),
    ),
    "failed_batches": Measure("pipeline", lambda: F.count_if(_c("status") == "failed")),
}

# The same ideas on the flat datasets. Where a definition differs from the one
# above, the difference is the dataset's own and is kept.
FLAT_MEASURES: dict[str, dict[str, Measure | Median]] = {
    "bi_sales": {
        "total_revenue": STAR_MEASURES["total_revenue"],
        "product_revenue": STAR_MEASURES["product_revenue"],
        "freight_cost": STAR_MEASURES["freight_cost"],
        "total_items": STAR_MEASURES["total_items"],
        # Orders that have items, unlike the count on orders.
        "total_orders": Measure("sales", lambda: F.count_distinct(F.when(_valid(), _c("order_id")))),
        "total_customers": Measure(
            "sales", lambda: F.count_distinct(F.when(_valid(), _c("customer_unique_id")))
        ),
        "avg_order_value": Measure(
            "sales",
            lambda: plain_ratio(
                _sum_valid("item_total"), F.count_distinct(F.when(_valid(), _c("order_id")))
            ),
        ),
        "freight_pct_of_revenue": Measure(
            "sales", lambda: plain_ratio(_sum_valid("freight_value"), _sum_valid("price"))
        ),
    },
    "bi_orders": {
        "total_revenue": Measure("orders", lambda: _sum_valid("order_total")),
        "total_orders": STAR_MEASURES["total_orders"],
        # Counts orders without items too.
        "avg_order_value": Measure("orders", lambda: mean_of(_c("order_total"), _valid())),
        "avg_review_score": STAR_MEASURES["avg_review_score"],
        "detractor_pct": Measure(
            "orders", lambda: plain_ratio(F.count_if(_detractor()), F.count("review_score"))
        ),
        "promoter_pct": Measure(
            "orders", lambda: plain_ratio(F.count_if(_promoter()), F.count("review_score"))
        ),
        "late_delivery_pct": STAR_MEASURES["late_delivery_pct"],
        "avg_delivery_days": STAR_MEASURES["avg_delivery_days"],
        "avg_days_vs_promise": STAR_MEASURES["avg_days_vs_promise"],
        "cancellation_rate": STAR_MEASURES["cancellation_rate"],
        "new_customer_revenue": Measure(
            "orders", lambda: _sum_valid("order_total", _c("is_first_order"))
        ),
        "returning_revenue_pct": Measure(
            "orders",
            lambda: plain_ratio(
                _sum_valid("order_total", ~_c("is_first_order")), _sum_valid("order_total")
            ),
        ),
        "revenue_at_risk": STAR_MEASURES["revenue_at_risk"],
    },
    "bi_customer": {
        "customers": Measure("customers", lambda: F.count(F.lit(1))),
        "repeat_customer_pct": STAR_MEASURES["repeat_customer_pct"],
        "total_ltv": Measure("customers", lambda: F.sum("lifetime_value")),
        "avg_ltv": Measure("customers", lambda: mean_of(_c("lifetime_value"))),
        "median_ltv": Median("customers", "lifetime_value"),
        "avg_recency_days": Measure("customers", lambda: mean_of(_c("recency_days"))),
    },
    "cohort": {
        # Sizes repeat per month here: exact per cell, weighted down a column.
        "retention_pct": Measure(
            "cohort_cells", lambda: plain_ratio(F.sum("active_customers"), F.sum("cohort_size"))
        ),
        "cohort_size": Measure("cohort_cells", lambda: F.max("cohort_size")),
    },
}


@dataclass(frozen=True)
class Filters:
    """The filters a report shares.

    Each applies to every dataset that has its column, which is how a filtered
    dimension reaches the facts it describes; orders have no category.
    """

    date_from: datetime.date | None = None
    date_to: datetime.date | None = None
    regions: Sequence[str] = ()
    states: Sequence[str] = ()
    category_groups: Sequence[str] = ()

    def conditions(self) -> Iterable[tuple[str, Column]]:
        if self.date_from:
            yield "purchase_date", _c("purchase_date") >= F.lit(self.date_from)
        if self.date_to:
            yield "purchase_date", _c("purchase_date") <= F.lit(self.date_to)
        for column, wanted in (
            ("customer_region", self.regions),
            ("customer_state", self.states),
            ("product_category_group", self.category_groups),
        ):
            if wanted:
                yield column, _c(column).isin(list(wanted))

    def columns(self) -> set[str]:
        return {column for column, _ in self.conditions()}

    def apply(self, df: DataFrame, unrelated: Iterable[str] = ()) -> DataFrame:
        """Rows that meet the conditions; one on a column that `df` lacks must be named unrelated."""
        for column, condition in self.conditions():
            if column in df.columns:
                df = df.filter(condition)
            elif column not in unrelated:
                raise ValueError(f"the filter on {column} does not reach this table")
        return df


_FACTS = {"sales": ("fact_sales", "bi_sales"), "orders": ("fact_orders", "bi_orders")}
_TABLES = {
    "customers": "bi_customer",
    "ltv": "mv_customer_ltv",
    "rfm": "mv_rfm",
    "pareto": "category_pareto",
    "cohort_cells": "cohort",
    "cohort": "cohort",
}
_ALL_FILTERS = {"purchase_date", "customer_region", "customer_state", "product_category_group"}
# The filters that no relation of the model carries to a table: people have no date and no
# category, orders no category, and the rest is not about customers at all.
UNRELATED = {
    "sales": set(),
    "orders": {"product_category_group"},
    **dict.fromkeys(("customers", "ltv", "rfm"), {"purchase_date", "product_category_group"}),
    **dict.fromkeys(("pareto", "cohort_cells", "cohort", "pipeline"), _ALL_FILTERS),
}
_DATE_PARTS = {
    "purchase_month": lambda: F.trunc("purchase_date", "month"),
    "purchase_year": lambda: F.year("purchase_date"),
}
# What these say about a customer is on the flat table only.
_FACT_ONLY_UNSAFE = {"customer_state_code"}
_RFM_SCORES = {"rfm_segment", "segment_rank", "r_score", "f_score", "m_score", "recency_days", "frequency", "monetary"}


def dataset(mart: Mart, name: str, columns: Iterable[str], pipeline: DataFrame | None = None) -> DataFrame:
    """The narrowest table that has the columns: a fact alone needs no dimension joins."""
    if name == "pipeline":
        if pipeline is None:
            raise ValueError("pipeline measures need the batch log")
        return pipeline
    if getattr(mart, "secured", False):
        return _secured_dataset(mart, name)
    if name not in _FACTS:
        if name == "customers" and not set(columns) - set(mart.mv_dim_customer.columns):
            return mart.mv_dim_customer
        people = mart.mv_dim_customer if name in ("ltv", "rfm") else None
        if name == "rfm" and not set(columns) - set(people.columns) - _RFM_SCORES:
            # measures over this table need its scores and money only
            table = mart.rfm_scores
        else:
            table = getattr(mart, _TABLES[name])
        missing = set(columns) - set(table.columns)
        if name in ("ltv", "rfm") and missing:
            # what is said of a person comes from the person's row; the other person table is
            # ordered and joined only for columns that it alone has
            if missing <= set(people.columns):
                return table.join(people.select("customer_unique_id", *sorted(missing)), "customer_unique_id")
            return mart.bi_customer.filter("total_orders is not null")
        return table
    fact_name, flat_name = _FACTS[name]
    wanted, fact = set(columns), getattr(mart, fact_name)
    if wanted & _FACT_ONLY_UNSAFE or wanted - set(fact.columns) - set(_DATE_PARTS):
        return getattr(mart, flat_name)
    return fact.withColumns({n: _DATE_PARTS[n]() for n in wanted if n in _DATE_PARTS})


def _secured_dataset(mart, name: str) -> DataFrame:
    """Only the three flat datasets carry a region, so measures read those alone."""
    if name in _FACTS:
        return getattr(mart, _FACTS[name][1])
    people = getattr(mart, "bi_customer" if name in ("customers", "ltv", "rfm") else name)
    return people if name == "customers" else people.filter("total_orders is not null")


def _one_row_per_cohort(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """A cohort's size repeats on every month; count it once per group."""
    keys = dict.fromkeys([*by, "cohort_month"])
    picked = []
    for month in (1, 3, 6):
        here = _c("month_index") == month
        picked += [
            F.sum(F.when(here, _c("active_customers"))).alias(f"active_{month}"),
            F.max(F.when(here, _c("cohort_size"))).alias(f"size_{month}"),
        ]
    return cells.groupBy(*keys).agg(
        F.sum("active_customers").alias("active"),
        F.max("cohort_size").alias("size"),
        F.sum("cohort_revenue").alias("revenue"),
        *picked,
    )


def _closure(names: Sequence[str], measures: dict) -> list[str]:
    needed: list[str] = []
    for name in names:
        measure = measures[name]
        if isinstance(measure, Combined):
            needed += _closure(measure.needs, measures)
        else:
            needed.append(name)
    return list(dict.fromkeys(needed))


def _median(df: DataFrame, column: str, by: Sequence[str], name: str) -> DataFrame:
    if not by:
        return exact_percentile(df, column, 0.5).select(_c("percentile").alias(name))
    grouped = df.select(F.struct(*by).alias("_group"), _c(column).alias("_value"))
    low, high = _c("low").cast("double"), _c("high").cast("double")
    return middle_values(grouped, "_group", "_value").select(
        *[_c(f"_group.{b}").alias(b) for b in by], (low + (high - low) * F.lit(0.5)).alias(name)
    )


def evaluate(
    mart: Mart,
    names: Sequence[str],
    by: Sequence[str] = (),
    where: Filters | None = None,
    measures: dict | None = None,
    pipeline: DataFrame | None = None,
) -> DataFrame:
    """The measures `names` for every combination of `by`, after the filters.

    `mart` may be a secured one if its datasets suffice.
    """
    measures = STAR_MEASURES if measures is None else measures
    where = where or Filters()
    plain = _closure(names, measures)
    frames: list[DataFrame] = []
    for source in dict.fromkeys(measures[n].dataset for n in plain):
        mine = [n for n in plain if measures[n].dataset == source]
        columns = {*by, *(where.columns() - UNRELATED[source])}
        if source == "customers" and any(measures[n] is not STAR_MEASURES["repeat_customer_pct"] for n in mine):
            columns.add("lifetime_value")
        table = dataset(mart, source, columns, pipeline)
        missing = [b for b in by if b not in table.columns]
        if missing:
            raise ValueError(f"{source} has no {', '.join(missing)}")
        rows = where.apply(table, UNRELATED[source])
        medians = [n for n in mine if isinstance(measures[n], Median)]
        frames += [_median(rows, measures[n].column, by, n) for n in medians]
        aggregates = [n for n in mine if n not in medians]
        if aggregates:
            grouped = _one_row_per_cohort(rows, by) if source == "cohort" else rows
            frames.append(grouped.groupBy(*by).agg(*[measures[n].value().alias(n) for n in aggregates]))
    if len(frames) > 1:
        # Groups are few by now; stacking and folding them is a null-safe outer join.
        stacked = union_all(frames)
        joined = stacked.groupBy(*by).agg(*[F.max(n).alias(n) for n in plain])
    else:
        joined = frames[0]

    def value(name: str) -> Column:
        measure = measures[name]
        if isinstance(measure, Combined):
            return measure.value(*[value(n) for n in measure.needs])
        return _c(name)

    return joined.select(*by, *[value(n).alias(n) for n in names])


def share_of_selection(mart: Mart, by: str, where: Filters | None = None) -> DataFrame:
    """Revenue, its share of the selection, and the cumulative share with ties included."""
    # One row per group, read twice below.
    rows = cut_lineage(evaluate(mart, ["total_revenue"], [by], where).filter("total_revenue is not null"))
    # Equal revenues share one place: add up per distinct revenue, then order those.
    amounts = rows.groupBy("total_revenue").agg(F.sum("total_revenue").alias("_together"))
    ordered = global_order(
        amounts,
        [_c("total_revenue").desc()],
        "_at",
        running={"_running": "_together"},
        totals={"_all": "_together"},
    )
    return rows.join(ordered, "total_revenue").select(
        by,
        "total_revenue",
        plain_ratio(_c("total_revenue"), _c("_all")).alias("pct_of_total_revenue"),
        plain_ratio(_c("_running"), _c("_all")).alias("cumulative_revenue_pct"),
    )


def segment_share(mart: Mart) -> DataFrame:
    rows = evaluate(mart, ["customers_in_segment", "segment_revenue"], ["rfm_segment"])
    # one row per segment
    whole = F.sum("segment_revenue").over(Window.partitionBy())
    return rows.withColumn("segment_revenue_pct", plain_ratio(_c("segment_revenue"), whole))
