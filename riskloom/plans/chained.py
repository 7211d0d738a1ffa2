"""Chained Bayesian ridge regressions from moments.

In every round each column with nulls is regressed on all others over the rows
where it is known, and its null cells take the prediction.  A prediction is an
affine function of the row, so the rows of one pattern of nulls all go through
one matrix, and the moments that the next regression needs follow from the
pattern's moments before: ``M -> T M T'``.  One aggregation of the moments by
pattern therefore serves all rounds; the regressions run on the driver on
``(p + 1) x (p + 1)`` matrices.  One more aggregation gives the largest change
of each round, which tells where to stop, and a projection fills the cells.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import ship_package

MOMENTS_DDL = "pattern string, moments binary"


def bayesian_ridge(n: float, xx: np.ndarray, xy: np.ndarray, yy: float, rounds: int = 300, tol: float = 1e-3,
                   prior: float = 1e-6) -> np.ndarray:
    """Coefficients of a Bayesian ridge regression from centred sums of products.

    The precisions of noise and coefficients are updated by the evidence until
    the coefficients change by less than ``tol`` in sum; gamma priors on both
    have shape and rate ``prior``.
    """
    values, vectors = np.linalg.eigh(xx)
    values = np.maximum(values, 0.0)
    turned = vectors.T @ xy
    noise, ridge = 1.0 / (yy / n + np.finfo(float).eps), 1.0

    def coefficients() -> np.ndarray:
        return vectors @ (turned / (values + ridge / noise))

    old: np.ndarray | None = None
    for _ in range(rounds):
        beta = coefficients()
        error = max(yy - 2 * beta @ xy + beta @ xx @ beta, 0.0)
        well = (noise * values / (ridge + noise * values)).sum()
        ridge = (well + 2 * prior) / (beta @ beta + 2 * prior)
        noise = (n - well + 2 * prior) / (error + 2 * prior)
        if old is not None and np.abs(old - beta).sum() < tol:
            break
        old = beta
    return coefficients()


def regression(moments: np.ndarray, target: int) -> np.ndarray:
    """(intercept, then a coefficient per column, 0 for the target) from the moments of (1, columns)."""
    n, p = moments[0, 0], len(moments) - 1
    others = [i for i in range(1, p + 1) if i != target]
    out = np.zeros(p + 1)
    if n <= 0:
        return out
    mean = moments[0] / n
    centred = moments - n * np.outer(mean, mean)
    out[others] = bayesian_ridge(n, centred[np.ix_(others, others)], centred[others, target], float(max(centred[target, target], 0.0)))
    out[0] = mean[target] - out[others] @ mean[others]
    return out


def rounds_of(moments: dict[str, np.ndarray], order: Sequence[int], rounds: int) -> list[dict[str, np.ndarray]]:
    """For every round the matrix of each pattern that fills a row (1, known values, 0 for nulls).

    ``pattern`` has a character per column, ``1`` where it is null; values are
    centred, so that the start (column means) is 0.
    """
    size = len(next(iter(moments.values())))
    now = {k: m.copy() for k, m in moments.items()}
    maps = {k: np.eye(size) for k in moments}
    out = []
    for _ in range(rounds):
        for target in order:
            known = sum((m for k, m in now.items() if k[target - 1] == "0"), np.zeros((size, size)))
            beta = regression(known, target)
            for k in now:
                if k[target - 1] == "1":
                    step = np.eye(size)
                    step[target] = beta
                    now[k] = step @ now[k] @ step.T
                    maps[k] = step @ maps[k]
        out.append({k: m.copy() for k, m in maps.items()})
    return out


def _moments(p: int):
    schema = pa.schema([("pattern", pa.string()), ("moments", pa.binary())])

    def add(total: dict[str, np.ndarray], key: str, m: np.ndarray) -> None:
        total[key] = total[key] + m if key in total else m

    def emit(total: dict[str, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array([m.tobytes() for m in total.values()], pa.binary())],
                                          schema=schema)

    def of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            z = np.column_stack([np.ones(batch.num_rows), *(batch.column(f"c{i}").fill_null(0.0).to_numpy(zero_copy_only=False) for i in range(p))])
            pattern = np.array(batch.column("pattern").to_pylist(), dtype=object)
            for key in set(pattern.tolist()):
                rows = z[pattern == key]
                add(total, key, rows.T @ rows)
        yield emit(total)

    def of_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                add(total, key, np.frombuffer(raw).reshape(p + 1, p + 1))
        yield emit(total)

    return of_rows, of_tasks


def pattern_moments(rows: DataFrame, p: int) -> dict[str, np.ndarray]:
    """Moments of (1, c0, c1, ...) by pattern; nulls count 0.  Summed in the tasks, then per pattern."""
    ship_package(rows.sparkSession)
    of_rows, of_tasks = _moments(p)
    parts = rows.select("pattern", *(f"c{i}" for i in range(p))).mapInArrow(of_rows, MOMENTS_DDL)
    found = parts.repartition("pattern").mapInArrow(of_tasks, MOMENTS_DDL).collect()
    return {r["pattern"]: np.frombuffer(r["moments"]).reshape(p + 1, p + 1) for r in found}


def _filled(p: int, rounds: list[dict[str, np.ndarray]], means: np.ndarray, columns: list[int], schema: pa.Schema):
    """Rows with their null cells filled by one round's matrices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = rounds[0]
        for batch in batches:
            z = np.column_stack([np.ones(batch.num_rows), *(batch.column(f"c{i}").fill_null(0.0).to_numpy(zero_copy_only=False) for i in range(p))])
            pattern = np.array(batch.column("pattern").to_pylist(), dtype=object)
            out = z.copy()
            for key in set(pattern.tolist()):
                at = pattern == key
                out[at] = z[at] @ maps[key].T
            new = {f"c{i}": pa.array(out[:, i + 1] + means[i], pa.float64()) for i in columns}
            yield pa.RecordBatch.from_arrays([new[f.name] if f.name in new else batch.column(f.name).cast(f.type) for f in schema], schema=schema)

    return run


def _changes(p: int, rounds: list[dict[str, np.ndarray]]):
    """The largest change of a cell in each round, over a task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = np.zeros(len(rounds))
        for batch in batches:
            z = np.column_stack([np.ones(batch.num_rows), *(batch.column(f"c{i}").fill_null(0.0).to_numpy(zero_copy_only=False) for i in range(p))])
            pattern = np.array(batch.column("pattern").to_pylist(), dtype=object)
            for key in set(pattern.tolist()):
                rows, before = z[pattern == key], np.eye(p + 1)
                for t, maps in enumerate(rounds):
                    most[t] = max(most[t], np.abs(rows @ (maps[key] - before).T).max(initial=0.0))
                    before = maps[key]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rounds)), pa.int32()), pa.array(most, pa.float64())],
                                         schema=pa.schema([("round", pa.int32()), ("change", pa.float64())]))

    return run


def chained_ridge(df: DataFrame, columns: Sequence[str], max_iter: int = 10, tol: float = 1e-3,
                  max_patterns: int = 4096) -> DataFrame | None:
    """``df`` with the nulls of ``columns`` (numbers) filled; None if the nulls have more than ``max_patterns`` patterns.

    Starts from the means, goes from the column of the fewest nulls to that of
    the most, and stops after ``max_iter`` rounds or when no cell has changed
    by ``tol`` times the largest known magnitude.  A column without a known
    value becomes 0.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    columns = list(columns)
    p = len(columns)
    value = [F.col(f"`{c}`").cast("double") for c in columns]
    stats = df.agg(*(F.avg(v).alias(f"m{i}") for i, v in enumerate(value)), *(F.count(v).alias(f"n{i}") for i, v in enumerate(value)),
                   *(F.max(F.abs(v)).alias(f"x{i}") for i, v in enumerate(value)), F.count("*").alias("rows")).first()
    nulls = [stats["rows"] - stats[f"n{i}"] for i in range(p)]
    order = [i for i in sorted(range(p), key=lambda i: (nulls[i], i)) if nulls[i]]
    if not order:
        return df
    means = np.array([stats[f"m{i}"] or 0.0 for i in range(p)])
    pattern = F.concat(*(F.when(v.isNull(), F.lit("1")).otherwise(F.lit("0")) for v in value))
    packed = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), pattern.alias("pattern"),
                       *((v - float(m)).alias(f"c{i}") for i, (v, m) in enumerate(zip(value, means, strict=True))))
    if len(packed.select("pattern").distinct().limit(max_patterns + 1).collect()) > max_patterns:
        return None
    rounds = rounds_of(pattern_moments(packed, p), [i + 1 for i in order], max_iter)
    changes = packed.select("pattern", *(f"c{i}" for i in range(p))).mapInArrow(_changes(p, rounds), "round int, change double")
    most = {r["round"]: r["change"] for r in changes.groupBy("round").agg(F.max("change").alias("change")).collect()}
    limit = tol * max((stats[f"x{i}"] or 0.0) for i in range(p))
    last = next((t for t in range(max_iter) if most.get(t, 0.0) < limit), max_iter - 1)
    filled = packed.mapInArrow(_filled(p, [rounds[last]], means, order, to_arrow_schema(packed.schema)), packed.schema)
    at = {c: i for i, c in enumerate(columns)}
    return filled.select(*(F.coalesce(F.col(f"row.`{c}`").cast("double"), F.col(f"c{at[c]}")).alias(c) if c in at and at[c] in order
                           else F.col(f"row.`{c}`").alias(c) for c in df.columns))
