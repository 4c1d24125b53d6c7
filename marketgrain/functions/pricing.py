"""Price, loss and status labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from marketgrain.schemas import LOSS_BANDS, PRICE_BANDS


def price_band(price: Column) -> Column:
    """Band label of a price; bounds belong to the higher band."""
    label = F.lit(PRICE_BANDS[-1][0])
    for name, upper in reversed(PRICE_BANDS[:-1]):
        label = F.when(price < upper, name).otherwise(label)
    return label


def loss_band(rate: Column) -> Column:
    """Band label of a loss rate; right-closed, so 0 and anything above 100 have no band."""
    label = F.lit(None).cast("string")
    for name, low, high in reversed(LOSS_BANDS):
        label = F.when((rate > low) & (rate <= high), name).otherwise(label)
    return label


def gross_sales(quantity: Column, price: Column) -> Column:
    return quantity * price


def effective_supply(quantity: Column, loss_rate: Column) -> Column:
    return quantity * (1 - loss_rate / 100)


def clamp_prediction(price: Column, digits: int | None = 2) -> Column:
    """Predictions outside 0 to 1000 are pulled into 5 to 100; all are rounded to cents."""
    pulled = F.greatest(F.lit(5.0), F.least(F.lit(100.0), price))
    kept = F.when((price < 0) | (price > 1000), pulled).otherwise(price)
    return kept if digits is None else F.round(kept, digits)


# fixed values: words that decide the unit of a metric, first match wins
UNIT_WORDS = (
    ("Percent", "mape|percent|rate|ratio|accuracy"),
    ("Seconds", "latency|time|duration"),
    ("Count", "count|total|number"),
    ("Bytes", "memory|disk|size"),
)


def metric_unit(name: Column) -> Column:
    label = F.lit("None")
    for unit, words in reversed(UNIT_WORDS):
        label = F.when(F.lower(name).rlike(words), unit).otherwise(label)
    return label


def ks_text(statistic: Column, p_value: Column) -> Column:
    """Sentence for a Kolmogorov-Smirnov result."""
    def text(strength: str, tail: str, *extra: Column) -> Column:
        return F.format_string(f"{strength} drift (KS=%.3f, {tail})", statistic, *extra)

    return (
        F.when(p_value < 0.001, text("Highly significant", "p<0.001"))
        .when(p_value < 0.01, text("Very significant", "p<0.01"))
        .when(p_value < 0.05, text("Significant", "p<0.05"))
        .otherwise(text("No significant", "p=%.3f", p_value))
    )


def psi_text(psi: Column) -> Column:
    """Sentence for a population stability index."""
    def text(words: str) -> Column:
        return F.format_string(f"{words} (PSI: %.3f)", psi)

    return (
        F.when(psi < 0.1, text("No significant change"))
        .when(psi < 0.25, text("Some change detected"))
        .otherwise(text("Significant change detected"))
    )


def drift_severity(score: Column) -> Column:
    return F.when(score > 0.5, "high").when(score > 0.2, "medium").when(score > 0.1, "low").otherwise("none")
