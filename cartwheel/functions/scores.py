"""Score normalisation, banding and vector expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Score bounds and bands.
MODEL_BOUNDS = (0.0, 2.0)
OBSERVED_BOUNDS = (-0.05, 0.90)
POPULARITY_BOUNDS = (1.0, 45000.0)
SIGMOID_SCALE = 0.5
BANDS = (
    (0.7, "VERY_HIGH", "Very high preference/popularity"),
    (0.5, "HIGH", "High preference/popularity"),
    (0.3, "MEDIUM", "Medium preference/popularity"),
    (0.1, "LOW", "Low preference/popularity"),
)
LOWEST_BAND = ("VERY_LOW", "Very low preference/popularity")
COSINE_EPS = 1e-10


def normalize(score: Column, bounds: tuple[float, float] = MODEL_BOUNDS) -> Column:
    """Clamp to ``bounds`` and rescale to 0..1; NULL stays NULL."""
    lo, hi = bounds
    clamped = F.when(score < lo, lo).when(score > hi, hi).otherwise(score)
    return (clamped - lo) / (hi - lo)


def sigmoid(score: Column, scale: float = SIGMOID_SCALE) -> Column:
    return 1 / (1 + F.exp(-score / scale))


def _banded(score: Column, index: int) -> Column:
    out = None
    for band in BANDS:
        out = F.when(score >= band[0], band[index]) if out is None else out.when(score >= band[0], band[index])
    return out.otherwise(LOWEST_BAND[index - 1])


def confidence_band(score: Column) -> Column:
    return _banded(score, 1)


def band_description(score: Column) -> Column:
    return _banded(score, 2)


def lift(value: Column, base: Column) -> Column:
    """(value - base) / base, NULL for a missing or zero base."""
    return F.when(base != 0, (value - base) / base)


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
