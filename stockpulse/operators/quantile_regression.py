"""Linear quantile regression for several levels at once.

Majorise-minimise steps on the check loss: with residuals r of the last
coefficients, weights 1 / (eps + |r|) turn a step into weighted least squares.
The normal equations of all levels are summed in one pass over a written table
of inputs: each Arrow batch adds its weighted Gram matrices in numpy, a task
passes on one row for each level and cell of the triangle, and a grouped sum
adds those up. The driver gets (levels x columns^2) numbers a round, whatever
the number of rows, and solves. Rounds end when no level's loss falls by more
than ``tol`` of itself; ``eps`` falls with the rounds. Steps are over-relaxed. Last, each
intercept moves by its level's quantile of the residuals (a mergeable sketch).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpulse.operators.encode import _written


def design(batch: pa.RecordBatch, numeric: Sequence[str], split: Mapping[str, int], shift: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """A batch's inputs: 1, the scaled numbers, the indicators of all codes but the first of each."""
    plain = np.column_stack([np.ones(batch.num_rows), *[batch.column(c).to_numpy(zero_copy_only=False).astype("f8") for c in numeric]])
    plain[:, 1:] = (plain[:, 1:] - shift) / scale
    coded = [np.eye(n)[batch.column(c).to_numpy(zero_copy_only=False)][:, 1:] for c, n in split.items()]
    return np.hstack([plain, *coded])


@dataclass
class LinearQuantiles:
    """Coefficients of each level in the units of the inputs; ``predict`` is plain column arithmetic."""

    numeric: list[str]
    split: dict[str, int]
    levels: list[float]
    intercept: dict[float, float]
    slopes: dict[float, list[float]]
    steps: dict[float, dict[str, list[float]]]
    rounds: int
    loss: dict[float, float]

    def column(self, level: float) -> Column:
        out = F.lit(self.intercept[level])
        for c, b in zip(self.numeric, self.slopes[level]):
            out = out + F.lit(b) * F.col(c)
        for c, values in self.steps[level].items():
            out = out + F.element_at(F.array(*[F.lit(v) for v in values]), F.col(c) + 1)
        return out

    def predict(self, df: DataFrame, suffix: str = "_raw") -> DataFrame:
        return df.withColumns({f"q{int(round(q * 100)):02d}{suffix}": self.column(q) for q in self.levels})


def fit_quantiles(train: DataFrame, numeric: Sequence[str], label: str = "sales", levels: Sequence[float] = (0.05, 0.5, 0.95),
                  split: Mapping[str, int] | None = None, tol: float = 1e-3, max_rounds: int = 60) -> LinearQuantiles:
    """Fit all levels on the rows of ``train``; ``split`` has the code columns and their numbers of values."""
    split, levels = dict(split or {}), sorted(levels)
    spread = [x for c in numeric for x in (F.avg(c), F.stddev_pop(c))]
    got = train.agg(F.avg(F.col(label).cast("double")), F.avg(F.abs(F.col(label).cast("double"))), *spread).first()
    if got[0] is None:
        raise ValueError("no rows to fit on")
    middle, size = float(got[0]), max(float(got[1]), 1e-9)
    shift, scale = np.array(got[2::2], "f8"), np.array(got[3::2], "f8")
    used = [k for k, s in enumerate(scale) if s > 1e-12]  # a constant column is in the intercept
    numeric, shift, scale = [numeric[k] for k in used], shift[used], scale[used]
    rows = _written(train.select(F.col(label).cast("double").alias("_y"), *numeric, *split), "quantile-inputs")
    p = 1 + len(numeric) + sum(n - 1 for n in split.values())
    upper = np.triu_indices(p)
    beta = np.zeros((len(levels), p))
    beta[:, 0] = middle

    def round_of(beta: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gram matrices, right sides and losses of all levels."""
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            gram, right, loss = np.zeros((len(levels), p, p)), np.zeros((len(levels), p)), np.zeros(len(levels))
            some = False
            for b in batches:
                some = some or b.num_rows > 0
                x, y = design(b, numeric, split, shift, scale), b.column("_y").to_numpy(zero_copy_only=False)
                for k, q in enumerate(levels):
                    r = y - x @ beta[k]
                    w = 1 / (eps + np.abs(r))
                    xw = x * w[:, None]
                    gram[k] += xw.T @ x
                    right[k] += xw.T @ y + (2 * q - 1) * x.sum(axis=0)
                    loss[k] += np.maximum(q * r, (q - 1) * r).sum()
            if some:
                for k in range(len(levels)):
                    cells = np.concatenate([gram[k][upper], right[k], loss[k:k + 1]])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cells), k, "i4")), pa.array(np.arange(len(cells), dtype="i4")), pa.array(cells)], ["level", "cell", "x"])

        sums = rows.mapInArrow(run, "level int, cell int, x double").groupBy("level", "cell").agg(F.sum("x").alias("x")).toPandas()
        cells = np.zeros((len(levels), len(upper[0]) + p + 1))
        cells[sums["level"], sums["cell"]] = sums["x"]
        gram = np.zeros((len(levels), p, p))
        for k in range(len(levels)):
            gram[k][upper] = cells[k, :len(upper[0])]
            gram[k] += np.triu(gram[k], 1).T
        return gram, cells[:, len(upper[0]):-1], cells[:, -1]

    best, kept, eps, rounds = np.full(len(levels), np.inf), beta.copy(), 0.1 * size, 0
    floor = 2e-5 * size
    for rounds in range(1, max_rounds + 1):
        gram, right, loss = round_of(beta, eps)
        better = loss < best
        kept[better] = beta[better]
        settled = (best - loss <= tol * np.abs(best)).all() and eps <= floor
        # steps go further than the least-squares solution, unless the last one went too far
        reach = np.where(better, 1.8, 1.0)
        best = np.minimum(best, loss)
        if settled:
            break
        for k in range(len(levels)):
            ridge = 1e-9 * np.trace(gram[k]) / p
            beta[k] += reach[k] * (np.linalg.solve(gram[k] + ridge * np.eye(p), right[k]) - beta[k])
        eps = max(floor, eps / 4)
    intercept, slopes, steps = {}, {}, {}
    for k, q in enumerate(levels):
        b = kept[k]
        slopes[q] = (b[1:1 + len(numeric)] / scale).tolist()
        intercept[q] = float(b[0] - np.dot(slopes[q], shift))
        at, steps[q] = 1 + len(numeric), {}
        for c, n in split.items():
            steps[q][c] = [0.0, *b[at:at + n - 1].tolist()]
            at += n - 1
    fitted = LinearQuantiles(list(numeric), split, list(levels), intercept, slopes, steps, rounds, dict(zip(levels, best.tolist())))
    # the best intercept for these slopes is the level's quantile of the residuals: exact shares on the fitted rows
    left = rows.agg(*[F.percentile_approx(F.col("_y") - fitted.column(q), q, 100_000) for q in levels]).first()
    for q, r in zip(levels, left):
        fitted.intercept[q] += float(r)
    return fitted


def level_report(df: DataFrame, levels: Sequence[float] = (0.05, 0.5, 0.95), label: str = "sales", suffix: str = "_raw", by: Sequence[str] = ("split",),
                 slack: float = 1e-3) -> DataFrame:
    """Share of rows below and at or below each level's prediction (clipped at 0, F8), and the mean check loss.

    Rows within ``slack`` of a prediction count as at it: many sales are
    exactly zero, so a level's line can run through them. A fitted level q has
    ``below`` <= q <= ``at_or_below``.
    """
    y = F.col(label).cast("double")
    rows = []
    for q in levels:
        r = y - F.greatest(F.col(f"q{int(round(q * 100)):02d}{suffix}"), F.lit(0.0))
        rows.append(F.struct(F.lit(q).alias("level"), (r < -slack).cast("double").alias("below"), (r <= slack).cast("double").alias("at"),
                             F.greatest(q * r, (q - 1) * r).alias("loss")))
    return df.select(*by, F.inline(F.array(*rows))).groupBy(*by, "level").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("below").alias("below"), F.avg("at").alias("at_or_below"), F.avg("loss").alias("check_loss"))
