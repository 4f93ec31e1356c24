"""Confidence tiers, signals and market-sentiment labels."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import TIERS

# Tier thresholds and how they move along the forecast.
HIGH_FROM = 0.7
HIGH_TO = 0.3
MEDIUM_ABOVE = 0.6
MEDIUM_BELOW = 0.4
HIGH_STEP = 0.02
DECAY_STEP = 0.05
DECAY_FLOOR = 0.3


@dataclass(frozen=True)
class Sentiment:
    """Cut points on the percentage of rising tickers and the three labels."""

    upper: float
    lower: float
    inclusive: bool
    up: str
    down: str
    flat: str

    def of(self, percent: Column) -> Column:
        if self.inclusive:
            rising, falling = percent >= self.upper, percent <= self.lower
        else:
            rising, falling = percent > self.upper, percent < self.lower
        return F.when(rising, self.up).when(falling, self.down).otherwise(self.flat)


# The three threshold sets in use.
DASHBOARD = Sentiment(55.0, 45.0, True, "BULLISH", "BEARISH", "NEUTRAL")
REPORT = Sentiment(60.0, 40.0, False, "UPTREND", "DOWNTREND", "SIDEWAYS")
WEEK = Sentiment(55.0, 45.0, False, "UP", "DOWN", "SIDEWAYS")


def confidence_tier(p: Column) -> Column:
    return (
        F.when((p >= HIGH_FROM) | (p <= HIGH_TO), "HIGH")
        .when((p > MEDIUM_ABOVE) | (p < MEDIUM_BELOW), "MEDIUM")
        .otherwise("LOW")
    )


def decay(day: Column) -> Column:
    """Weight of the model's own probability on forecast day ``day``."""
    return F.greatest(
        F.lit(DECAY_FLOOR), F.lit(1.0) - (day - 1).cast("double") * F.lit(DECAY_STEP)
    )


def damped(p: Column, day: Column) -> Column:
    """Probability pulled towards one half as the forecast day grows."""
    weight = decay(day)
    return p * weight + F.lit(0.5) * (F.lit(1.0) - weight)


def horizon_tier(p: Column, day: Column, floor: float | None = None) -> Column:
    """Tier of a damped probability; the HIGH threshold falls by 0.02 a day.

    Without ``floor`` the threshold passes 0.6 on day 6 (no MEDIUM from there)
    and one half on day 11 (everything HIGH from there). ``floor`` stops it.
    """
    high = F.lit(HIGH_FROM) - (day - 1).cast("double") * F.lit(HIGH_STEP)
    if floor is not None:
        high = F.greatest(high, F.lit(floor))
    return (
        F.when((p >= high) | (p <= F.lit(1.0) - high), "HIGH")
        .when((p > MEDIUM_ABOVE) | (p < MEDIUM_BELOW), "MEDIUM")
        .otherwise("LOW")
    )


def signal(prediction: Column) -> Column:
    return F.when(prediction == 1, "UP").otherwise("DOWN")


def tier_rank(tier: Column) -> Column:
    rank = F.when(tier == TIERS[0], 0)
    for position, name in enumerate(TIERS[1:], start=1):
        rank = rank.when(tier == name, position)
    return rank


def at_least(tier: Column, minimum: str) -> Column:
    """True where the tier is ``minimum`` or stronger."""
    if minimum not in TIERS:
        raise ValueError(f"minimum tier must be one of {', '.join(TIERS)}: {minimum!r}")
    return tier.isin(*TIERS[TIERS.index(minimum):])
