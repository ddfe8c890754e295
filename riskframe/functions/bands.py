"""Banding of numeric columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def right_closed_bands(col: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """(e0, e1], (e1, e2], ...; outside all edges -> null."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per interval")
    out = F.lit(None).cast("string")
    for lo, hi, label in reversed(list(zip(edges[:-1], edges[1:], labels))):
        out = F.when((col > lo) & (col <= hi), F.lit(label)).otherwise(out)
    return out


def level_bands(col: Column, low: float, mid: float,
                labels: Sequence[str] = ("Low", "Medium", "High"),
                null_band: str | None = "High") -> Column:
    """Low up to ``low``, Medium up to ``mid``, High above.

    A missing value falls in ``null_band``: by default the last branch, as an
    unmatched comparison does; pass None to keep it missing.
    """
    return (F.when(col.isNull(), F.lit(null_band))
            .when(col <= low, F.lit(labels[0]))
            .when(col <= mid, F.lit(labels[1]))
            .otherwise(F.lit(labels[2])))


def risk_band(score: Column) -> Column:
    """Four risk bands of a probability."""
    # Cut-offs and names of the risk bands.
    return (F.when(score >= 0.75, "High risk")
            .when(score >= 0.50, "Elevated risk")
            .when(score >= 0.25, "Moderate-low risk")
            .otherwise("Low risk"))


def equal_width_bin(col: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Bin number 0..bins-1 over [lo, hi], last bin closed; one bin if lo = hi."""
    width = (hi - lo) / F.lit(float(bins))
    raw = F.floor(F.try_divide(col - lo, width))
    return F.coalesce(F.least(raw, F.lit(bins - 1).cast("long")), F.lit(0).cast("long"))
