"""Ordered bands over a number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def band(value: Column, upper: Sequence[float], names: Sequence[str]) -> Column:
    """``names[i]`` for the first bound with ``value <= upper[i]``; the last name otherwise, NULL included."""
    out = F.when(value <= upper[0], names[0])
    for bound, name in zip(upper[1:], names[1:]):
        out = out.when(value <= bound, name)
    return out.otherwise(names[len(upper)])
