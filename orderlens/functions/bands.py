"""Business bands and rules. All labels and limits here are fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CANCELLED_STATUSES = ("canceled", "unavailable")

REVIEW_PROMOTER = "Promoter (4-5)"
REVIEW_PASSIVE = "Passive (3)"
REVIEW_DETRACTOR = "Detractor (1-2)"

# (exclusive upper limit, label); the last label has no limit.
WEIGHT_BANDS = ((500, "1. Under 0.5kg"), (2000, "2. 0.5-2kg"), (10000, "3. 2-10kg"), (None, "4. Over 10kg"))
LTV_BANDS = (
    (50, "1. Under R$50"),
    (100, "2. R$50-100"),
    (250, "3. R$100-250"),
    (500, "4. R$250-500"),
    (None, "5. R$500+"),
)
# (inclusive upper limit, label)
SPEED_BANDS = (
    (3, "1. 0-3 days"),
    (7, "2. 4-7 days"),
    (14, "3. 8-14 days"),
    (30, "4. 15-30 days"),
    (None, "5. 30+ days"),
)
PHOTO_BANDS = ((0, "No photo"), (1, "1 photo"), (3, "2-3 photos"), (None, "4+ photos"))
LTV_TIERS = ((1, "1. Top 10%"), (2, "2. 10-20%"), (5, "3. 20-50%"), (None, "4. Bottom 50%"))
FREQUENCY_SCORES = ((1, 1), (2, 3), (3, 4), (None, 5))

# rank, segment, action; which one applies is decided in `segment_rank`.
SEGMENTS = (
    (1, "Champions", "Reward. Early access, referral asks."),
    (2, "Cannot Lose Them", "Win back now. Personal outreach, high-value offer."),
    (3, "At Risk", "Reactivation campaign before they lapse for good."),
    (4, "Loyal Customers", "Upsell and cross-sell. They already trust you."),
    (5, "New Customers", "Onboard. Second-purchase nudge within 30 days."),
    (6, "Promising", "Build the habit. Category recommendations."),
    (7, "Needs Attention", "Re-engage with a reason to return."),
    (8, "Hibernating", "Low-cost automated win-back only."),
    (9, "Lost", "Do not spend. Suppress from paid targeting."),
)


def _banded(value: Column, bands, inclusive: bool) -> Column:
    *limited, (_, rest) = bands
    out = None
    for limit, label in limited:
        hit = value <= limit if inclusive else value < limit
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(rest))


def is_cancelled(status: Column) -> Column:
    return status.isin(*CANCELLED_STATUSES)


def is_valid_sale(status: Column) -> Column:
    return ~is_cancelled(status)


def review_band(score: Column) -> Column:
    return (
        F.when(score >= 4, REVIEW_PROMOTER).when(score == 3, REVIEW_PASSIVE).otherwise(REVIEW_DETRACTOR)
    )


def weight_band(grams: Column) -> Column:
    return F.when(grams.isNull(), "Unknown").otherwise(_banded(grams, WEIGHT_BANDS, inclusive=False))


def photo_band(photos: Column) -> Column:
    return _banded(photos, PHOTO_BANDS, inclusive=True)


def speed_band(days: Column) -> Column:
    """A missing duration falls into the last band, as the ad-hoc report has it."""
    return _banded(days, SPEED_BANDS, inclusive=True)


def delivery_speed_band(days: Column) -> Column:
    return F.when(days.isNull(), "Not delivered").otherwise(speed_band(days))


def ltv_band(value: Column) -> Column:
    return _banded(value, LTV_BANDS, inclusive=False)


def ltv_tier(decile: Column) -> Column:
    return _banded(decile, LTV_TIERS, inclusive=True)


def frequency_score(orders: Column) -> Column:
    return _banded(orders, FREQUENCY_SCORES, inclusive=True)


def segment_rank(recency: Column, value: Column) -> Column:
    recent = recency >= 4
    lapsed = recency <= 2
    strong = F.when(recent & (value >= 4), 1).when(lapsed & (value == 5), 2)
    worthy = strong.when(lapsed & (value >= 3), 3).when((recency >= 3) & (value >= 3), 4)
    # The rest depends on recency alone: 5 is rank 5, down to 1 which is rank 9.
    return worthy.otherwise(F.lit(10) - recency)


def _segment_text(rank: Column, field: int) -> Column:
    return F.element_at(F.array(*[F.lit(row[field]) for row in SEGMENTS]), rank.cast("int"))


def segment_name(rank: Column) -> Column:
    return _segment_text(rank, 1)


def segment_action(rank: Column) -> Column:
    return _segment_text(rank, 2)
