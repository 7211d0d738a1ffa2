"""Second-order boosted trees for many settings and folds in the same scans.

The rows are binned once into a written table of blocks (one byte per value).
A scan then serves every open tree of every job (a setting with the fold that
it leaves out): each task sums gradients and Hessians of its blocks by (job,
node, feature, bin), the sums of a node meet in one task that finds its best
split, and only the splits reach the driver.  Jobs don't wait for each other:
a scan grows each by one level, whatever round and level it is at, so that the
number of scans is that of the longest job, not the sum of all.

Margins are part of the blocks; after a few rounds the trees grown since are
added to them in one more scan, and the table before is deleted.  Row and
column draws follow from the seed, the tree and the block.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import discard, ship_package, written

BLOCK_DDL = "block long, n int, bins binary, label binary, fold binary, held binary, margins binary"
BLOCK = pa.schema([("block", pa.int64()), ("n", pa.int32()), *((c, pa.binary()) for c in ("bins", "label", "fold", "held", "margins"))])
SUMS_DDL = "job int, node int, sums binary"
SUMS = pa.schema([("job", pa.int32()), ("node", pa.int32()), ("sums", pa.binary())])
SPLIT_DDL = "job int, node int, feature int, bin int, gain double, gl double, hl double, g double, h double"
SPLIT = pa.schema([("job", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("bin", pa.int32()),
                   *((c, pa.float64()) for c in ("gain", "gl", "hl", "g", "h"))])
LOSS = -1  # the node of a job's loss on held rows
ROUNDS_PER_WRITE = 5
SCORES_DDL = "job int, fold int, label int, score double"


@dataclass(frozen=True)
class Setting:
    """Parameters of one model."""

    rounds: int = 100
    depth: int = 5
    rate: float = 0.1
    min_child_weight: float = 1.0
    gamma: float = 0.0
    reg_lambda: float = 1.0
    subsample: float = 1.0
    colsample: float = 1.0
    positive_weight: float = 1.0
    patience: int = 0  # rounds without a better loss on held rows before it stops; 0: never
    seed: int = 42


@dataclass
class Tree:
    """A tree by heap number (children of i: 2i + 1, 2i + 2)."""

    feature: np.ndarray  # -1: leaf
    bin: np.ndarray  # rows of at most this bin go left
    gain: np.ndarray
    weight: np.ndarray  # a leaf's step, the rate included

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1, np.int32), np.zeros(n, np.uint8), np.zeros(n), np.zeros(n))

    def places(self, bins: np.ndarray, steps: int) -> np.ndarray:
        """The node of every row after at most ``steps`` splits; ``bins`` has a row per feature."""
        at, rows = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
        for _ in range(steps):
            f = self.feature[at]
            down = f >= 0
            if not down.any():
                break
            right = bins[np.maximum(f, 0), rows] > self.bin[at]
            at = np.where(down, 2 * at + 1 + right, at)
        return at

    def prune(self, gamma: float, leaf: np.ndarray) -> None:
        """Splits above leaves that gain less than ``gamma`` go, from the bottom up; then leaves get their weights."""
        for i in range(len(self.feature) // 2 - 1, -1, -1):
            if self.feature[i] >= 0 and self.feature[2 * i + 1] < 0 and self.feature[2 * i + 2] < 0 and self.gain[i] < gamma:
                self.feature[i], self.gain[i] = -1, 0.0
        self.weight = np.where(self.feature < 0, leaf, 0.0)


@dataclass
class Job:
    """One fit: a setting without the rows of ``fold`` (None: with all rows)."""

    setting: Setting
    fold: int | None = None
    trees: list[Tree] = field(default_factory=list)
    applied: int = 0  # trees that the written margins hold
    tree: Tree | None = None
    sums: dict[int, tuple[float, float]] = field(default_factory=dict)  # node -> gradient and Hessian
    level: int = 0
    open: list[int] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)

    def begin(self) -> None:
        self.tree, self.level, self.open, self.sums = Tree.empty(self.setting.depth), 0, [0], {}

    @property
    def done(self) -> bool:
        return self.tree is None

    def columns(self, n: int) -> np.ndarray:
        """The columns of the current tree, drawn for the whole tree."""
        take = max(1, int(self.setting.colsample * n))
        if take >= n:
            return np.arange(n)
        return np.sort(np.random.default_rng([self.setting.seed, len(self.trees), 1]).permutation(n)[:take])

    def drawn(self, block: int, n: int) -> np.ndarray:
        """The rows of a block that the current tree sees."""
        if self.setting.subsample >= 1:
            return np.ones(n, bool)
        rng = np.random.default_rng([self.setting.seed, len(self.trees), 2, block])
        return rng.random(n) < self.setting.subsample

    def grow(self, splits: dict[int, dict]) -> None:
        """Takes a level's splits; a finished tree is pruned and kept, and the next one begins."""
        s, below = self.setting, []
        for node in self.open:
            r = splits.get(node)
            if r is None:  # no row reached it
                self.sums.setdefault(node, (0.0, 0.0))
                continue
            self.sums[node] = (r["g"], r["h"])
            if r["feature"] >= 0:
                self.tree.feature[node], self.tree.bin[node], self.tree.gain[node] = r["feature"], r["bin"], r["gain"]
                self.sums[2 * node + 1], self.sums[2 * node + 2] = (r["gl"], r["hl"]), (r["g"] - r["gl"], r["h"] - r["hl"])
                below += [2 * node + 1, 2 * node + 2]
        self.level += 1
        self.open = below
        if below and self.level < s.depth:
            return
        leaf = np.zeros(len(self.tree.feature))
        for node, (g, h) in self.sums.items():
            leaf[node] = -s.rate * g / (h + s.reg_lambda)
        self.tree.prune(s.gamma, leaf)
        self.trees.append(self.tree)
        self.tree = None
        if len(self.trees) < s.rounds or s.patience:  # the loss after the last tree is taken with the next root
            self.begin()

    def stalled(self) -> bool:
        """Whether the loss on held rows has not become better for ``patience`` rounds."""
        p = self.setting.patience
        return bool(p) and len(self.losses) > p and min(self.losses[-p:]) >= min(self.losses[:-p])

    def best_rounds(self) -> int:
        """Trees that a prediction uses: all, or those up to the least loss on held rows."""
        return int(np.argmin(self.losses)) if self.setting.patience and self.losses else len(self.trees)


@dataclass
class Binned:
    """Rows in blocks, and the upper ends of all bins but the last, by feature."""

    blocks: DataFrame
    cuts: list[np.ndarray]

    @property
    def offsets(self) -> np.ndarray:
        """Where the bins of each feature begin when all bins stand in one row; the last is their number."""
        return np.cumsum([0, *(len(c) + 1 for c in self.cuts)])


# --- binning --------------------------------------------------------------------------------


def quantile_cuts(df: DataFrame, features: str, n_features: int, max_bins: int = 64) -> list[np.ndarray]:
    """Cut points of each feature: its quantiles, in one aggregation."""
    if not n_features:
        return []
    x = vector_to_array(features) if dict(df.dtypes)[features] == "vector" else F.col(features)
    probs = [(i + 1) / max_bins for i in range(max_bins - 1)]
    values = df.select(F.posexplode(x).alias("i", "v"))
    found = {r["i"]: r["c"] for r in values.groupBy("i").agg(F.percentile_approx("v", probs, 10_000).alias("c")).collect()}
    return [np.unique(np.asarray(found.get(i) or [], dtype=float)) for i in range(n_features)]


def _bin(cuts: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, batch in enumerate(batches):
            n = batch.num_rows
            if not n:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, len(cuts))
            bins = np.array([np.searchsorted(c, x[:, i], "left") for i, c in enumerate(cuts)], dtype=np.uint8)
            ints = lambda c, t: batch.column(c).to_numpy(zero_copy_only=False).astype(t).tobytes()
            block = (batch.column("part")[0].as_py() << 32) + k
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip((block, n, bins.tobytes(), ints("label", np.uint8), ints("fold", np.int16),
                                                       ints("held", np.uint8), b""), BLOCK, strict=True)], schema=BLOCK)

    return run


def bin_rows(df: DataFrame, features: str, label: str, cuts: list[np.ndarray], fold: str | None = None,
             held: str | None = None) -> Binned:
    """Binned rows; ``fold`` is a row's fold (none: -1), ``held`` marks rows that only stop a fit early.

    Rows without a label or features are left out.  At most 256 bins.
    """
    if max((len(c) for c in cuts), default=0) > 255:
        raise ValueError("at most 256 bins")
    ship_package(df.sparkSession)
    x = vector_to_array(features) if dict(df.dtypes)[features] == "vector" else F.col(features)
    rows = df.where(F.col(label).isNotNull() & F.col(features).isNotNull()).select(
        x.alias("x"), F.col(label).cast("int").alias("label"),
        (F.coalesce(F.col(fold), F.lit(-1)) if fold else F.lit(-1)).cast("int").alias("fold"),
        (F.coalesce(F.col(held).cast("int"), F.lit(0)) if held else F.lit(0)).alias("held"),
        F.spark_partition_id().cast("long").alias("part"))
    return Binned(written(rows.mapInArrow(_bin(cuts), BLOCK_DDL)), cuts)


# --- scans ----------------------------------------------------------------------------------


class Block:
    def __init__(self, row: dict, features: int, jobs: int) -> None:
        self.id, self.n = row["block"], row["n"]
        self.bins = np.frombuffer(row["bins"], np.uint8).reshape(features, self.n)
        self.label = np.frombuffer(row["label"], np.uint8)
        self.fold, self.held = np.frombuffer(row["fold"], np.int16), np.frombuffer(row["held"], np.uint8) > 0
        self.margins = np.frombuffer(row["margins"]).reshape(jobs, self.n) if row["margins"] else np.zeros((jobs, self.n))

    def margin(self, number: int, job: Job, trees: int | None = None) -> np.ndarray:
        """Margins of a job after all its trees (or its first ``trees``)."""
        out = self.margins[number].copy() if trees is None else np.zeros(self.n)
        for t in job.trees[job.applied:] if trees is None else job.trees[:trees]:
            out += t.weight[t.places(self.bins, job.setting.depth)]
        return out


def chance(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-margin))


def _sums(jobs: list[Job], offsets: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, len(offsets) - 1, len(jobs))
                for number, job in enumerate(jobs):
                    if not job.done:
                        for node, sums in job_sums(block, number, job, offsets):
                            if (number, node) in total:
                                total[number, node] += sums
                            else:
                                total[number, node] = sums
        keys = list(total)
        for at in range(0, len(keys), 200):
            some = keys[at:at + 200]
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in some], pa.int32()), pa.array([k[1] for k in some], pa.int32()),
                                              pa.array([total[k].tobytes() for k in some], pa.binary())], schema=SUMS)

    return run


def job_sums(block: Block, number: int, job: Job, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(node, sums by (column, bin) of gradient and Hessian) of a job's open nodes; with a new tree, its loss on held rows."""
    s = job.setting
    margin = block.margin(number, job)
    p = chance(margin)
    weight = np.where(block.label == 1, s.positive_weight, 1.0)
    out_of_fold = block.fold == job.fold if job.fold is not None else np.zeros(block.n, bool)
    if job.level == 0 and s.patience:
        rows = block.held & ~out_of_fold
        q = np.clip(np.where(block.label == 1, p, 1 - p)[rows], 1e-16, None)
        yield LOSS, np.array([-(weight[rows] * np.log(q)).sum(), weight[rows].sum()])
    at = job.tree.places(block.bins, job.level)
    local = np.full(len(job.tree.feature), -1)
    local[job.open] = np.arange(len(job.open))
    node = local[at]
    rows = (node >= 0) & ~out_of_fold & ~block.held & job.drawn(block.id, block.n)
    if not rows.any():
        return
    at = np.flatnonzero(rows)
    node = node[at]
    values = [(v * weight)[at] for v in (p - block.label, np.maximum(p * (1 - p), 1e-16))]
    # a column at a time: its cells and the values stay in the processor's cache
    parts, starts = [], {}
    for f in job.columns(len(offsets) - 1):
        width = int(offsets[f + 1] - offsets[f])
        if width not in starts:
            starts[width] = node * width
        cell = block.bins[f].take(at) + starts[width]
        parts.append([np.bincount(cell, v, len(job.open) * width).reshape(len(job.open), width) for v in values])
    sums = [np.concatenate([part[i] for part in parts], axis=1) for i in range(2)]
    for k in np.unique(node):
        yield job.open[k], np.stack([s[k] for s in sums])


def best_split(sums: np.ndarray, columns: np.ndarray, offsets: np.ndarray, s: Setting) -> dict:
    """The split of the largest gain of a node (the first of equal ones by feature and bin); feature -1: none."""
    sizes = np.diff(offsets)[columns]
    ends = np.cumsum(sizes)
    g, h = sums.reshape(2, -1)
    left = []
    for v in (g, h):  # running sums that begin anew with each feature
        run = np.cumsum(v)
        left.append(run - np.repeat(run[ends - sizes] - v[ends - sizes], sizes))
    gl, hl = left
    total_g, total_h = float(g[:sizes[0]].sum()), float(h[:sizes[0]].sum())
    gr, hr = total_g - gl, total_h - hl
    score = lambda a, b: a * a / (b + s.reg_lambda)
    gain = score(gl, hl) + score(gr, hr) - score(total_g, total_h)
    possible = (hl >= s.min_child_weight) & (hr >= s.min_child_weight)
    possible[ends - 1] = False  # the last bin has no upper end
    gain = np.where(possible, gain, -np.inf)
    at = int(gain.argmax())
    out = {"g": total_g, "h": total_h, "feature": -1, "bin": 0, "gain": 0.0, "gl": 0.0, "hl": 0.0}
    if gain[at] > 1e-6:
        f = int(np.searchsorted(ends, at, "right"))
        out |= {"feature": int(columns[f]), "bin": at - int(ends[f] - sizes[f]), "gain": float(gain[at]), "gl": float(gl[at]),
                "hl": float(hl[at])}
    return out


def _splits(jobs: list[tuple[Setting, np.ndarray]], offsets: np.ndarray):
    """Sums of a node from all tasks, and its best split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for job, node, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                sums = np.frombuffer(raw)  # in the order of job_sums
                total[job, node] = total[job, node] + sums if (job, node) in total else sums
        out: list[dict] = []
        for (job, node), sums in total.items():
            if node == LOSS:
                found = {"g": float(sums[0]), "h": float(sums[1]), "feature": -1, "bin": 0, "gain": 0.0, "gl": 0.0, "hl": 0.0}
            else:
                setting, columns = jobs[job]
                found = best_split(sums, columns, offsets, setting)
            out.append({"job": job, "node": node, **found})
        yield pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in out], f.type) for f in SPLIT], schema=SPLIT)

    return run


def _apply(jobs: list[Job], features: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, row in enumerate(batch.to_pylist()):
                block = Block(row, features, len(jobs))
                margins = np.stack([block.margin(number, job) for number, job in enumerate(jobs)])
                part = batch.slice(k, 1)
                yield pa.RecordBatch.from_arrays([pa.array([margins.tobytes()], pa.binary()) if f.name == "margins" else part.column(f.name)
                                                  for f in BLOCK], schema=BLOCK)

    return run


def fit(binned: Binned, jobs: Sequence[Job], reducers: int = 8) -> list[Job]:
    """Grows all jobs to their ends, a level of each per scan; the jobs come back with their trees."""
    jobs = list(jobs)
    blocks, features = binned.blocks, len(binned.cuts)
    if not features or not jobs:
        return jobs
    offsets = binned.offsets
    for job in jobs:
        job.begin()
    while any(not j.done for j in jobs):
        keys = sum(len(j.open) for j in jobs if not j.done)
        sums = blocks.mapInArrow(_sums(jobs, offsets), SUMS_DDL)
        dealt = sums.repartition(max(1, min(reducers, keys)), "job", "node")
        found = dealt.mapInArrow(_splits([(j.setting, j.columns(features)) for j in jobs], offsets), SPLIT_DDL).collect()
        by_job: dict[int, dict[int, dict]] = {}
        for r in found:
            by_job.setdefault(r["job"], {})[r["node"]] = r.asDict()
        for number, job in enumerate(jobs):
            if job.done:
                continue
            splits = by_job.get(number, {})
            loss = splits.pop(LOSS, None)
            if loss is not None and loss["h"]:
                job.losses.append(loss["g"] / loss["h"])
            if len(job.trees) >= job.setting.rounds or job.stalled():
                job.tree = None
            else:
                job.grow(splits)
        if any(not j.done and len(j.trees) - j.applied >= ROUNDS_PER_WRITE for j in jobs):
            after = written(blocks.mapInArrow(_apply(jobs, features), BLOCK_DDL))
            if blocks is not binned.blocks:
                discard(blocks)
            blocks = after
            for job in jobs:
                job.applied = len(job.trees)
    if blocks is not binned.blocks:
        discard(blocks)
    return jobs


def _score(jobs: list[Job], features: int):
    schema = pa.schema([("job", pa.int32()), ("fold", pa.int32()), ("label", pa.int32()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block({**row, "margins": b""}, features, len(jobs))
                for number, job in enumerate(jobs):
                    rows = np.flatnonzero(block.fold == job.fold)
                    p = chance(block.margin(number, job, job.best_rounds()))[rows]
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(
                        (np.full(len(rows), number), block.fold[rows], block.label[rows], p), schema, strict=True)], schema=schema)

    return run


def out_of_fold(binned: Binned, jobs: Sequence[Job]) -> DataFrame:
    """(job, fold, label, score) of the rows of each job's own fold, in one scan for all jobs."""
    return binned.blocks.mapInArrow(_score(list(jobs), len(binned.cuts)), SCORES_DDL)
