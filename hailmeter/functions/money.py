"""Payment labels, guarded ratios and fee arithmetic."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
PAYMENT_LABELS = {
    1: "Credit Card",
    2: "Cash",
    3: "No Charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided",
}
UNKNOWN_PAYMENT = "Unknown"

FEE_COLUMNS = (
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "cbd_congestion_fee",
    "airport_fee",
)


def payment_label(code: Column) -> Column:
    """Code -> label; 0, NULL and undocumented codes share the Unknown label."""
    chain = F
    for value, label in PAYMENT_LABELS.items():
        chain = chain.when(code == value, label)
    return chain.otherwise(UNKNOWN_PAYMENT)


def guarded_ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, and 0 where the denominator is not positive or unknown."""
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def pct_change(value: Column, base: Column) -> Column:
    """Change from base to value in percent, 0 without a positive base."""
    return F.when(base > 0, (value - base) / base * 100).otherwise(F.lit(0.0))


def component_sum(columns: tuple[str, ...] = FEE_COLUMNS) -> Column:
    """Sum of the fee columns, an absent fee counting as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) for c in columns])


def total_gap(total: str = "total_amount") -> Column:
    """Charged total minus the sum of its components."""
    return F.col(total) - component_sum()
