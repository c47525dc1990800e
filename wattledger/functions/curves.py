"""Expected daily shapes of solar output and household demand."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Daylight window, cloud attenuation, demand baseline and peaks.
SUNRISE, SUNSET = 6.0, 18.0
CLOUD_ATTENUATION = 0.75
DEMAND_BASE = 0.55
MORNING_PEAK = (7.0, 0.6, 2.0)
EVENING_PEAK = (19.5, 0.84, 3.0)

# A cloudless day in hours at full output: daylight times the mean of half a sine wave.
FULL_OUTPUT_HOURS = (SUNSET - SUNRISE) * 2.0 / math.pi


def _four_digits(value: Column) -> Column:
    """Round half up at four digits, after dropping binary noise beyond eight."""
    return F.round(value.cast("decimal(12,8)"), 4).cast("double")


def solar_factor(hour: Column, cloud_cover_pct: Column) -> Column:
    """Share of nameplate output at an hour of day under a cloud cover."""
    position = (hour - F.lit(SUNRISE)) / F.lit(SUNSET - SUNRISE)
    cloud = F.least(F.greatest(cloud_cover_pct.cast("double"), F.lit(0.0)), F.lit(100.0))
    shape = F.sin(F.lit(math.pi) * position) * (F.lit(1.0) - F.lit(CLOUD_ATTENUATION) * cloud / 100.0)
    daylight = (hour > SUNRISE) & (hour < SUNSET)
    return F.when(daylight, _four_digits(shape)).otherwise(F.lit(0.0))


def demand_factor(hour: Column) -> Column:
    """Multiplier on base load at an hour of day: a baseline and two peaks."""

    def peak(centre: float, height: float, width: float) -> Column:
        offset = hour - F.lit(centre)
        return F.lit(height) * F.exp(-(offset * offset) / F.lit(width))

    return _four_digits(F.lit(DEMAND_BASE) + peak(*MORNING_PEAK) + peak(*EVENING_PEAK))
