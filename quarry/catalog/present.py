"""Presentation of float results for cross-engine comparison."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_round(c, digits: int) -> Column:
    """Round through decimal(30, 8) (half up), absorbing an ulp of float noise before the last
    digit is chosen."""
    x = F.col(c) if isinstance(c, str) else c
    return F.round(x.cast("decimal(30,8)"), digits).cast("double")
