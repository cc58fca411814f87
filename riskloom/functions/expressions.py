"""Column expressions: bins, labels, scales. All of them stay in the JVM."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Floor of a share before its logarithm is taken.
EPSILON = 1e-6


def as_column(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def no_nan(x: Column | str) -> Column:
    """NaN becomes null, so that comparisons and aggregates treat it as missing."""
    x = as_column(x).cast("double")
    return F.when(~F.isnan(x), x)


def cuts_literal(cuts: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(c)) for c in cuts]) if cuts else F.array().cast("array<double>")


def bin_right_closed(x: Column, cuts: Column) -> Column:
    """Number of cuts below x: bins (a, b], from 0."""
    return F.size(F.filter(cuts, lambda t: t < x))


def bin_left_closed(x: Column, cuts: Column) -> Column:
    """Number of cuts at or below x: bins [a, b), from 0."""
    return F.size(F.filter(cuts, lambda t: t <= x))


def bin_or_missing(x: Column, cuts: Column) -> Column:
    return F.when(x.isNull(), F.lit(-1)).otherwise(bin_right_closed(x, cuts))


def interval_label(bin_: Column, cuts: Column) -> Column:
    """(a, b] with six decimals; the missing bin has a name of its own."""
    low = F.when(bin_ == 0, F.lit("-inf")).otherwise(F.format_string("%.6f", F.try_element_at(cuts, bin_)))
    high = F.when(bin_ >= F.size(cuts), F.lit("inf")).otherwise(F.format_string("%.6f", F.try_element_at(cuts, bin_ + 1)))
    return F.when(bin_ < 0, F.lit("missing")).otherwise(F.concat(F.lit("("), low, F.lit(", "), high, F.lit("]")))


def share(part: Column, whole: Column) -> Column:
    """part / whole, 0 where whole is 0 or null."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def floored(x: Column) -> Column:
    return F.when(x == 0, F.lit(EPSILON)).otherwise(x)


def iv_label(iv: Column) -> Column:
    """The usual reading of an information value."""
    return F.when(iv < 0.02, "useless").when(iv < 0.1, "weak").when(iv < 0.3, "medium").when(iv < 0.5, "strong").otherwise("suspicious")


def psi_label(psi: Column, stable: float = 0.1, warning: float = 0.25) -> Column:
    return F.when(psi.isNull(), "unknown").when(psi < stable, "stable").when(psi < warning, "warning").otherwise("unstable")


def score_points(p: Column, pdo: float = 20.0, base: float = 600.0, base_odds: float = 1 / 15) -> Column:
    """offset - factor * ln(odds of p), with p kept off 0 and 1."""
    factor = pdo / math.log(2)
    offset = base + factor * math.log(base_odds)
    q = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.lit(offset) - F.lit(factor) * F.log(q / (1 - q))
