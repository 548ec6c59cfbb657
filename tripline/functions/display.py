"""Derived display values: marker size and class, formatted text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marker scaling, in trips and pixels. They suit a sample of
# 50,000 trips; pass larger thresholds for larger tables.
MAX_EXPECTED_TRIPS = 3000
HIGH_DEMAND_TRIPS = 1500
MIN_RADIUS = 5.0
MAX_RADIUS = 35.0


def marker_radius(count: Column, expected: int = MAX_EXPECTED_TRIPS,
                  low: float = MIN_RADIUS, high: float = MAX_RADIUS) -> Column:
    """Radius proportional to the count, clamped to [low, high]."""
    return F.least(F.greatest(count / F.lit(expected) * F.lit(high), F.lit(low)), F.lit(high))


def demand_class(count: Column, threshold: int = HIGH_DEMAND_TRIPS) -> Column:
    """'high' strictly above the threshold, else 'normal'."""
    return F.when(count > threshold, "high").otherwise("normal")


def thousands(count: Column) -> Column:
    """1234567 as '1,234,567'."""
    return F.format_number(count, 0)


def percent_text(ratio: Column) -> Column:
    """0.8011 as '80.1%'."""
    return F.format_string("%.1f%%", ratio * 100)


def trip_label(index: Column, miles: Column) -> Column:
    """'Trip #3 (4.1m)'."""
    return F.format_string("Trip #%d (%.1fm)", index, miles)
