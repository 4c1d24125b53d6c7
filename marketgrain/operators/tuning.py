"""Tuning over rolling folds: linear models from one pass over the data, trees by a bounded search with drop-outs.

Linear models. Least squares needs sums of products only. After a scan for means, one more gives the matrix of products of (1,
inputs, label) for each fold's rows; summed from the oldest fold on they are the matrices of each fold's training rows. Every penalty of every
fold is then solved and scored from small matrices. The errors are those of fitting each model on its rows.

Trees. Candidates are fitted fold by fold, a bounded number at a time; after each fold the worse part of them drops out, so
later folds are spent on good ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from marketgrain.functions.naming import c

#: inputs whose squared matrix is summed
MOST_INPUTS = 1000


def product_sums(rows: DataFrame, inputs: Sequence[str], label: str = "label", group: str = "test_fold") -> DataFrame:
    """group, i, j (i <= j) and the sum of products of entries i and j of (1, inputs, label), over rows without gaps.

    Inputs and label are taken from their means over all rows.
    """
    if len(inputs) > MOST_INPUTS:
        raise ValueError(f"at most {MOST_INPUTS} inputs")
    names = [*inputs, label]
    whole = rows.select(F.coalesce(c(group), F.lit(0)).cast("int").alias("g"), *[c(n).cast("double").alias(f"x{k}") for k, n in enumerate(names)])
    whole = whole.na.drop()
    # products of values far from zero would lose digits; errors of models don't depend on the origin
    middle = whole.agg(*[F.avg(f"x{k}") for k in range(len(names))]).first()
    origin = np.array([x or 0.0 for x in middle])

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for frame in frames:
            fold = frame["g"].to_numpy()
            z = np.column_stack([np.ones(len(frame)), frame.drop(columns="g").to_numpy() - origin])
            for g in np.unique(fold):
                own = z[fold == g]
                total[g] = total.get(g, 0) + own.T @ own
        upper = np.triu_indices(len(names) + 1)
        for g, matrix in total.items():
            yield pd.DataFrame({"g": int(g), "i": upper[0], "j": upper[1], "s": matrix[upper]})

    found = whole.mapInPandas(sums, "g int, i int, j int, s double")
    return found.groupBy("g", "i", "j").agg(F.sum("s").alias("s"))


def _matrices(sums: DataFrame, size: int) -> dict[int, np.ndarray]:
    """One small matrix for each fold; bounded by folds x inputs squared."""
    out: dict[int, np.ndarray] = {}
    for row in sums.toLocalIterator():
        matrix = out.setdefault(row["g"], np.zeros((size, size)))
        matrix[row["i"], row["j"]] = matrix[row["j"], row["i"]] = row["s"]
    return out


def solved(products: np.ndarray, penalty: float) -> np.ndarray:
    """Intercept and coefficients: least mean squares plus ``penalty`` times the squared coefficients in deviations."""
    n, sums = products[0, 0], products[0, 1:-1]
    covered = products[1:-1, 1:-1] / n - np.outer(sums, sums) / n**2
    shared = products[1:-1, -1] / n - sums * products[0, -1] / n**2
    spread = np.sqrt(np.maximum(np.diag(covered), 0))
    used = np.flatnonzero(spread > 1e-12)
    slope = np.zeros(len(sums))
    if len(used):
        scale = spread[used]
        matrix = covered[np.ix_(used, used)] / np.outer(scale, scale) + penalty * np.eye(len(used))
        slope[used] = np.linalg.lstsq(matrix, shared[used] / scale, rcond=None)[0] / scale
    return np.concatenate([[products[0, -1] / n - slope @ sums / n], slope])


def squared_error(products: np.ndarray, model: np.ndarray) -> float:
    """Sum of squared errors of a model over the rows of a matrix of products."""
    weights = np.concatenate([model, [-1.0]])
    return float(max(weights @ products @ weights, 0.0))


def tune_ridge(rows: DataFrame, inputs: Sequence[str], penalties: Sequence[float], folds: int = 5, label: str = "label") -> DataFrame:
    """fold, penalty, n, rmse, mean_rmse over the folds, and whether the penalty is the best; ``rows`` have test_fold.

    Fold k is tested with a model of all rows before it. The least mean error is best, of equal ones the largest penalty.
    """
    parts = _matrices(product_sums(rows, inputs, label), len(inputs) + 2)
    train, found = parts.get(0), []
    for fold in range(1, folds + 1):
        test = parts.get(fold)
        if test is not None and train is not None:
            for penalty in penalties:
                error = squared_error(test, solved(train, penalty))
                found.append((fold, float(penalty), int(round(test[0, 0])), float(np.sqrt(error / test[0, 0]))))
        if test is not None:
            train = test if train is None else train + test
    frame = pd.DataFrame(found, columns=["fold", "penalty", "n", "rmse"])
    frame["mean_rmse"] = frame.groupby("penalty")["rmse"].transform("mean")
    order = frame.sort_values(["mean_rmse", "penalty"], ascending=[True, False])
    best = order["penalty"].iloc[0] if len(order) else None
    rows_out = [(int(r.fold), r.penalty, int(r.n), r.rmse, r.mean_rmse, bool(r.penalty == best)) for r in frame.itertuples()]
    return rows.sparkSession.createDataFrame(
        rows_out, "fold long, penalty double, n long, rmse double, mean_rmse double, chosen boolean")


def search(candidates: Mapping[str, object], score: Callable[[object, int], float], folds: Sequence[int], parallel: int = 4,
           keep: float = 0.5) -> list[tuple[str, int, float, bool]]:
    """(candidate, folds seen, mean error, best) of every candidate; ``score`` gives the error of one on one fold.

    Candidates of a fold are scored ``parallel`` at a time. After each fold but the last, the share ``keep`` with the least mean
    error goes on, at least one; names settle ties.
    """
    errors: dict[str, list[float]] = {name: [] for name in candidates}
    alive = sorted(candidates)
    with ThreadPoolExecutor(parallel) as pool:
        for at, fold in enumerate(folds):
            for name, error in zip(alive, pool.map(lambda name: score(candidates[name], fold), alive)):
                errors[name].append(error)
            alive.sort(key=lambda name: (float(np.mean(errors[name])), name))
            if at < len(folds) - 1:
                alive = sorted(alive[:max(1, int(np.ceil(len(alive) * keep)))])
    return [(name, len(e), float(np.mean(e)) if e else float("nan"), name == alive[0]) for name, e in sorted(errors.items())]
