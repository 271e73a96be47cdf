"""Challenger models over the z-signals: principal components, isolation forest and local outlier factor.

They are diagnostics beside the robust score. Components go by moments of all
scored rows, each isolation tree by a sample of its own of them, and the outlier
factor by every row's exact neighbours (``neighbours``); rows are scored where they lie.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import checkpointed
from .neighbours import outlier_factors
from .signals import CUSTOMER_Z, PEER_Z
from .stats import AVERAGE_RANK, MAD_FACTOR, MIN_LOG_SCALE, RANKS, quantiles, ranked

TREES, TREE_ROWS = 100, 256
METHODS = {"pca": "pca", "isolation_forest": "if", "lof": "lof"}


def matrix_columns(scores: DataFrame, names: Sequence[str], least_rate: float = 0.01, large: bool = False) -> list[Column]:
    """Robustly scaled features cut to [-8, 8], each with an indicator of its missing; only features of two values or more. large: whether the table may be too large for one task."""
    middle = lambda c: (c.cast("double"), (0.5,))
    told = [x for n in names for x in (F.count(n).alias(f"n_{n}"), (F.max(n) > F.min(n)).alias(f"d_{n}"))]
    first = quantiles(scores, [], {f"m_{n}": middle(F.col(n)) for n in names}, [F.count("*").alias("rows"), *told], large).first()
    if first is None:
        return []
    kept = [n for n in names if first[f"n_{n}"] >= least_rate * max(first["rows"], 1) and first[f"d_{n}"]]
    if not kept:
        return []
    first = {**first.asDict(), **{f"m_{n}": first[f"m_{n}"][0] for n in kept}}
    mads = quantiles(scores, [], {n: middle(F.abs(F.col(n) - first[f"m_{n}"])) for n in kept}, (), large).first()
    mads = {n: mads[n][0] for n in kept}
    out = []
    for n in kept:
        scale = max(MAD_FACTOR * mads[n], MIN_LOG_SCALE)
        out.append(F.coalesce(F.greatest(F.least((F.col(n) - first[f"m_{n}"]) / scale, F.lit(8.0)), F.lit(-8.0)), F.lit(0.0)))
        out.append(F.col(n).isNull().cast("double"))
    return out


def reconstruction_error(rows: DataFrame, width: int, keep: float, most: int) -> Column:
    """The mean squared part of a row of matrix ``x`` outside the first components; moments are aggregated, the eigenproblem is of ``width``."""
    x = [F.col("x")[k] for k in range(width)]
    got = rows.agg(F.count("*").alias("n"), *[F.avg(c).alias(f"m{k}") for k, c in enumerate(x)], *[F.avg(x[a] * x[b]).alias(f"c{a}_{b}") for a in range(width) for b in range(a + 1)]).first()
    mean = np.array([got[f"m{k}"] for k in range(width)])
    second = np.array([[got[f"c{max(a, b)}_{min(a, b)}"] for b in range(width)] for a in range(width)])
    values, vectors = np.linalg.eigh(second - np.outer(mean, mean))
    values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
    if got["n"] < 3 or values.sum() <= 0:
        return F.lit(0.0)
    count = int(np.searchsorted(np.cumsum(values) / values.sum(), keep - 1e-12) + 1)
    vectors = vectors[:, : max(1, min(count, most, width))]
    centred = [c - F.lit(float(m)) for c, m in zip(x, mean, strict=True)]
    total = sum((c * c for c in centred), F.lit(0.0))
    inside = sum(((sum((c * F.lit(float(v)) for c, v in zip(centred, column, strict=True)), F.lit(0.0))) ** 2 for column in vectors.T), F.lit(0.0))
    # What is left within rounding is nothing, or ranks would go by noise.
    return F.when(total - inside > 1e-9 * total, (total - inside) / width).otherwise(0.0)


def grow(rows: np.ndarray, rng: np.random.Generator, depth: int, most: int) -> tuple:
    """An isolation tree: ('leaf', rows) or (feature, cut, left, right)."""
    if depth >= most or len(rows) <= 1 or not np.ptp(rows, axis=0).any():
        return ("leaf", len(rows))
    feature = rng.choice(np.flatnonzero(np.ptp(rows, axis=0) > 0))
    cut = rng.uniform(rows[:, feature].min(), rows[:, feature].max())
    left = rows[:, feature] < cut
    return (int(feature), float(cut), grow(rows[left], rng, depth + 1, most), grow(rows[~left], rng, depth + 1, most))


def expected_depth(n: float) -> float:
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def depths(tree: tuple, x: np.ndarray) -> np.ndarray:
    """Path length of each row in a tree."""
    out, todo = np.zeros(len(x)), [(tree, np.arange(len(x)), 0)]
    while todo:
        node, at, depth = todo.pop()
        if node[0] == "leaf":
            out[at] = depth + expected_depth(node[1])
        else:
            left = x[at, node[0]] < node[1]
            todo += [(node[2], at[left], depth + 1), (node[3], at[~left], depth + 1)]
    return out


def _mixed(h: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each h under each seed, a row for each seed; different h never have the same."""
    z = h.view(np.uint64)[None, :] ^ seeds[:, None]
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def tree_seeds(seed: int, trees: int = TREES) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, trees, dtype=np.uint64)


def tree_samples(rows: DataFrame, seed: int, size: int = TREE_ROWS) -> list[np.ndarray]:
    """For each tree, the x of the size rows of rows (h: a hash of the row's key, x) whose hashes under the tree's seed are the least, in that order.

    A task sends on its own least ones only; what reaches the driver is trees times size rows.
    """
    seeds = tree_seeds(seed)

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, x = [np.zeros(0, np.uint64)] * len(seeds), [None] * len(seeds)
        for batch in batches:
            mixed = _mixed(batch.column(0).to_numpy(zero_copy_only=False), seeds)
            matrix = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for t, own in enumerate(mixed):
                at = np.argpartition(own, size - 1)[:size] if len(own) > size else np.arange(len(own))
                key[t] = np.concatenate([key[t], own[at]])
                x[t] = matrix[at] if x[t] is None else np.concatenate([x[t], matrix[at]])
                order = np.argsort(key[t], kind="stable")[:size]
                key[t], x[t] = key[t][order], x[t][order]
        for t in range(len(seeds)):
            if len(key[t]):
                signed = (key[t] ^ np.uint64(1 << 63)).view(np.int64)  # the same order
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(signed), t, np.int32)), pa.array(signed), pa.array(list(x[t]), pa.list_(pa.float64()))], names=["tree", "key", "x"])

    found = rows.select("h", "x").mapInArrow(least, "tree int, key long, x array<double>")
    found = found.withColumn("at", F.row_number().over(Window.partitionBy("tree").orderBy("key", "x"))).filter(F.col("at") <= size)
    table = found.select("tree", "at", "x").toArrow().sort_by([("tree", "ascending"), ("at", "ascending")])
    tree = table.column("tree").to_numpy()
    x = np.array(table.column("x").to_pylist(), np.float64)
    return [x[tree == t] for t in range(len(seeds)) if (tree == t).any()]


def isolation_forest(samples: Sequence[np.ndarray], seed: int) -> list[tuple]:
    """A tree for each sample; tree t is grown with the t-th child of the seed."""
    rngs = np.random.default_rng(seed).spawn(len(samples))
    return [grow(x, rng, 0, int(np.ceil(np.log2(max(len(x), 2))))) for x, rng in zip(samples, rngs, strict=True)]


def isolation_score(samples: Sequence[np.ndarray], seed: int):
    """A function from rows to isolation scores in (0, 1) by a forest over samples."""
    forest, size = isolation_forest(samples, seed), max(len(x) for x in samples)
    return lambda x: 2.0 ** (-np.mean([depths(t, x) for t in forest], axis=0) / max(expected_depth(size), 1e-9))


def add_challengers(scores: DataFrame, config: Mapping[str, Any], key: str = "customer_id", large: bool = False) -> DataFrame:
    """Scores (0 to 100 by rank) and flags of each method, their mean and a warning; nulls where there are too few rows."""
    scores = checkpointed(scores)  # each method reads them, and they may be a plan of many columns
    rules = config["challenger_models"]
    names = list(rules.get("feature_columns") or (*CUSTOMER_Z, *PEER_Z))
    reason = None
    if not rules.get("enabled", True):
        reason = "Challenger model disabled."
    elif scores.count() < int(rules.get("min_rows", 200)):
        reason = "Challenger model skipped: scoring row count below minimum."
    columns = [] if reason else matrix_columns(scores, names, large=large)
    if not reason and not columns:
        reason = "Challenger model skipped: no usable residual features."
    if reason:
        empty = {f"{m}_challenger_score": F.lit(None).cast("double") for m in METHODS.values()} | {f"{m}_challenger_anomaly_flag": F.lit(0) for m in METHODS.values()}
        return scores.withColumns(empty | {"model_challenger_score": F.lit(None).cast("double"), "model_challenger_warning": F.lit(reason)})
    wanted = [m for m in METHODS if m in {str(x).lower() for x in rules["methods"]}]
    rows = scores.withColumn("x", F.array(*columns))
    seed = int(rules.get("random_state", 42))
    raw: dict[str, Column] = {}
    if "pca" in wanted:
        raw["pca"] = reconstruction_error(rows, len(columns), float(rules["pca_variance_to_keep"]), int(rules["pca_max_components"]))
    if "isolation_forest" in wanted:
        samples = tree_samples(rows.select(F.xxhash64(key).alias("h"), "x"), seed)
        raw["isolation_forest"] = _scored(isolation_score(samples, seed))(F.col("x"))
    if "lof" in wanted:
        rows = checkpointed(rows.withColumn("__row", F.monotonically_increasing_id()))
        # Written, as ranks join the factors back: one that is summed anew can differ in its last digit.
        found = checkpointed(outlier_factors(rows.select(F.col("__row").alias("row"), "x"), max(5, int(rules["lof_neighbors"]))))
        rows = rows.join(found.toDF("__row", "__factor"), "__row").drop("__row")
        raw["lof"] = F.col("__factor")
    out = rows.withColumns({f"__{m}": c for m, c in raw.items()})
    for m in raw:
        out = ranked(out, [], F.col(f"__{m}"), large).withColumn(f"{METHODS[m]}_challenger_score", 100.0 * F.expr(AVERAGE_RANK)).drop(*RANKS)
    out = out.withColumns({f"{v}_challenger_score": F.lit(None).cast("double") for k, v in METHODS.items() if k not in raw})
    flag = float(rules["flag_threshold"])
    out = out.withColumns({f"{v}_challenger_anomaly_flag": F.coalesce(F.col(f"{v}_challenger_score") >= flag, F.lit(False)).cast("int") for v in METHODS.values()})
    mean = sum((F.col(f"{METHODS[m]}_challenger_score") for m in raw), F.lit(0.0)) / len(raw)
    text = "+".join(sorted(raw))
    warn = F.when(mean >= 95, f"challengers ({text}) stand far apart; the robust score decides").when(mean >= 80, f"challengers ({text}) give a signal to watch; the robust score decides").otherwise(f"challengers ({text}) add no evidence")
    return out.withColumns({"model_challenger_score": mean, "model_challenger_warning": warn}).drop("x", "__factor", *[f"__{m}" for m in raw])


def _scored(model):
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            yield pd.Series(model(np.array(x.tolist())) if len(x) else [], dtype="float64")

    return F.pandas_udf(score, "double")
