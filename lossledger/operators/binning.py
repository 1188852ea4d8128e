"""Loans as vectors of bytes: numbers cut at quantiles, categories by frequency."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossledger.functions.numeric import finite_sql
from lossledger.operators.boosting import MISSING
from lossledger.sources.columns import NUMERIC_FEATURES

# Points that an approximate quantile remembers for each of its parts.
ACCURACY = 5_000


@dataclass(frozen=True)
class Bins:
    """Upper edges of the bins of each number, and the categories that have a byte of their own.
    Missing numbers, missing and unknown categories, and those too rare for a byte, share one."""

    edges: dict[str, list[float]]
    categories: dict[str, list[str]]

    @property
    def features(self) -> list[str]:
        return [*self.edges, *self.categories]

    @property
    def categorical(self) -> np.ndarray:
        return np.array([False] * len(self.edges) + [True] * len(self.categories))

    def vector(self) -> Column:
        """One byte per feature, as binary."""
        edges, labels = list(self.edges.values()), list(self.categories.values())

        @F.arrow_udf("binary")
        def packed(numbers: pa.Array, words: pa.Array) -> pa.Array:
            n = len(numbers)
            out = np.full((n, len(edges) + len(labels)), MISSING, np.uint8)
            values = numbers.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            for j, cuts in enumerate(edges):
                known = ~np.isnan(values[:, j])
                out[known, j] = np.searchsorted(cuts, values[known, j])
            told = words.flatten()
            for j, known in enumerate(labels):
                at = pc.index_in(told.take(pa.array(np.arange(n) * len(labels) + j)),
                                 value_set=pa.array(known, pa.string()))
                out[:, len(edges) + j] = pc.fill_null(at, MISSING).to_numpy(zero_copy_only=False)
            width = out.shape[1]
            return pa.Array.from_buffers(pa.binary(), n, [
                None, pa.array(np.arange(n + 1) * width, pa.int32()).buffers()[1],
                pa.py_buffer(out.tobytes())])

        numbers = F.array(*(F.expr(finite_sql(x)) for x in self.edges))
        words = F.array(*(F.col(x).cast("string") for x in self.categories))
        return packed(numbers if self.edges else F.array().cast("array<double>"),
                      words if self.categories else F.array().cast("array<string>"))


def edges_sql(numeric: Sequence[str] = tuple(NUMERIC_FEATURES)) -> list[Column]:
    """Aggregates that cut each number into bins of about as many rows, from one scan."""
    shares = ", ".join(f"{k / MISSING!r}D" for k in range(1, MISSING))
    return [F.expr(f"percentile_approx({finite_sql(x)}, array({shares}), {ACCURACY})").alias(x)
            for x in numeric]


def fit_bins(train: DataFrame, categories: dict[str, list[str]], *more: Column,
             numeric: Sequence[str] = tuple(NUMERIC_FEATURES)) -> tuple[Bins, dict]:
    """The bins of a training set, and the values of ``more`` aggregates from the same scan."""
    found = train.agg(*edges_sql(numeric), *more).first().asDict()
    return Bins({x: sorted(set(found.pop(x) or [])) for x in numeric}, dict(categories)), found
