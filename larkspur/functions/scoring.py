"""Scores and price factors of ride matching."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights of distance, gender, rating and salary; top salary and rating.
DISTANCE_WEIGHT = 0.4
GENDER_WEIGHT = 0.2
RATING_WEIGHT = 0.2
SALARY_WEIGHT = 0.2
MAX_SALARY = 100.0
MAX_RATING = 5.0
ANY_GENDER = "N"
# Driver average from which rides cost the plain price, and the slope below it.
SURGE_BELOW = 4.5
SURGE_STEP = 1.25


def match_score(
    request_lat: Column,
    request_lon: Column,
    preference: Column,
    lat: Column,
    lon: Column,
    gender: Column,
    rating: Column,
    salary: Column,
) -> Column:
    """How well a driver fits a request."""
    distance = F.sqrt(F.pow(lat - request_lat, F.lit(2)) + F.pow(lon - request_lon, F.lit(2)))
    fits = gender.isNotNull() & ((preference == ANY_GENDER) | (preference == gender))
    return (
        F.exp(-distance) * DISTANCE_WEIGHT
        + F.when(fits, 1.0).otherwise(0.0) * GENDER_WEIGHT
        + rating / MAX_RATING * RATING_WEIGHT
        + (1 - salary / MAX_SALARY) * SALARY_WEIGHT
    )


def surge_factor(previous: Column, current: Column) -> Column:
    """Price factor from a block's driver count at its last request and now; 1 at its first."""
    average = (previous + current) / 2
    return F.when(
        average < SURGE_BELOW, 1.0 + 2.0 * (SURGE_BELOW - average) / SURGE_STEP
    ).otherwise(1.0)
