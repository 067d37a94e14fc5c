"""Error measures and link functions as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Fixed value: shift used by log loss at probabilities of exactly 0 and 1.
LOG_LOSS_EPSILON = 10e-12
# Fixed value: bound on raw scores before the logistic function.
RAW_SCORE_BOUND = 20.0


def squared_error(label: Column, prediction: Column) -> Column:
    return (label - prediction) * (label - prediction)


def sigmoid_clipped(raw: Column) -> Column:
    """Logistic function of a raw score held within the bound."""
    held = F.greatest(F.least(raw, F.lit(RAW_SCORE_BOUND)), F.lit(-RAW_SCORE_BOUND))
    return 1 / (1 + F.exp(-held))


def log_loss(p: Column, y: Column) -> Column:
    """``-ln p`` for positives, ``-ln(1-p)`` otherwise."""
    safe = (
        F.when(p == 0, F.lit(LOG_LOSS_EPSILON)).when(p == 1, 1 - F.lit(LOG_LOSS_EPSILON)).otherwise(p)
    )
    return F.when(y == 1, -F.ln(safe)).otherwise(-F.ln(1 - safe))


def log_amount(c: Column) -> Column:
    return F.ln(c)


def polar_coords(a: Column, b: Column) -> tuple[Column, Column]:
    """Angle as a share of the full turn, and radius, of a point."""
    turn = 2 * math.pi
    phi = F.pmod(F.atan2(-a, -b) + math.pi / 2, F.lit(turn)) / turn
    return phi, F.sqrt(a * a + b * b)
