"""Tree fits of many rows (T1-T3): the rows are binned once and stay with the tasks that grow the trees.

Spark's tree estimators read every row again in a job for each level and send a histogram of
every node from every task.  Here the same trees are grown (Spark's own split points, impurities,
bagging rates, feature counts and stopping rules) by numpy kernels over one byte for each feature:

* :func:`fit_boosting`: one barrier stage.  Each task keeps its rows; a level of a tree is one pass
  over them and one exchange of histograms (counts and sums of each bin of each open node) through
  small files of the shared folder (:class:`Exchange`; ``allGather`` of a barrier stage takes a second).
  All tasks then choose the same splits.  The result is a ``GBTClassificationModel``.
* :func:`fit_forest`: the binned table goes to the tasks that grow the trees, a group of trees for
  each; a tree bags the rows and grows all its nodes there.  The result is a :class:`StoredForest`,
  trees as arrays, since a forest without a depth limit has millions of nodes.

Bags and feature subsets are drawn by numpy generators (seed, tree, level), so they are other draws
than those of Spark's estimators at the same rates.  :func:`growable` says which fits these are for.
"""

from __future__ import annotations

import json
import os
import pickle
import sys
import time
import uuid
import zlib
from dataclasses import dataclass
from typing import Any, Iterator, Optional

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saferow.session import checkpoint_dir, scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the kernels go to the tasks with their code
EPSILON = 2.0 ** -52  # a node of less impurity is a leaf, as in Spark
BLOCK = 1 << 16  # rows of a pass that are in the processor's cache together
DEEPEST_BOOSTED = 8  # levels of a boosted tree; an exchange holds the histograms of a level
#: Rows that a task may hold: about 40 bytes each while boosting, 100 while growing a forest.
MOST_BOOSTED_ROWS, MOST_FOREST_ROWS = 8_000_000, 4_000_000
MOST_BOOSTING_TASKS = 64  # each task gets the histograms of all
LONGEST_WAIT = 3600  # seconds without a sign of another task of an exchange


@dataclass
class Bins:
    """Split points of each feature (a value up to the k-th is in bin k) and the features a node draws."""

    points: list[np.ndarray]
    per_node: int

    @property
    def size(self) -> int:
        return len(self.points)

    def binary(self) -> np.ndarray:
        return np.array([f for f, p in enumerate(self.points) if len(p) == 1], np.int64)

    def wide(self) -> np.ndarray:
        return np.array([f for f, p in enumerate(self.points) if len(p) > 1], np.int64)


def _module(package, name: str):
    """A Scala object of a JVM package."""
    return getattr(getattr(package, f"{name}$"), "MODULE$")


def find_bins(est, df: DataFrame, boosting: bool) -> Optional[Bins]:
    """The split points that Spark's fit of ``est`` on ``df`` takes; None where a feature has
    more than two categories (those are ordered anew in every node) or the bins exceed a byte."""
    jvm = df.sparkSession._jvm  # noqa: SLF001
    est._transfer_params_to_java()  # noqa: SLF001
    java, spark_ml = est._java_obj, jvm.org.apache.spark.ml  # noqa: SLF001
    trees, old = spark_ml.tree.impl, jvm.org.apache.spark.mllib.tree
    field = df._jdf.schema().apply(est.getFeaturesCol())  # noqa: SLF001
    if boosting:
        algo, impurity, n_trees = old.configuration.Algo.Regression(), old.impurity.Variance, 1
    else:
        algo, impurity, n_trees = old.configuration.Algo.Classification(), old.impurity.Gini, est.getNumTrees()
    strategy = java.getOldStrategy(spark_ml.util.MetadataUtils.getCategoricalFeatures(field), 2, algo, impurity.instance())
    rows = _module(spark_ml.util, "DatasetUtils").extractInstances(java, df._jdf, jvm.scala.Option.empty())  # noqa: SLF001
    meta = trees.DecisionTreeMetadata.buildMetadata(rows, strategy, n_trees, est.getFeatureSubsetStrategy())
    n_features = int(meta.numFeatures())
    arity = [None if meta.isContinuous(f) else int(meta.numSplits(f)) + 1 for f in range(n_features)]
    if any(a is not None and a > 2 for a in arity) or est.getMaxBins() > 255:
        return None
    splits = _module(trees, "RandomForest").findSplits(rows, meta, est.getSeed())
    points = [np.array([s.threshold() for s in splits[f]], float) if a is None else np.full(a - 1, 0.5)
              for f, a in enumerate(arity)]
    return Bins(points, int(meta.numFeaturesPerNode()))


def growable(est, df: DataFrame, n_rows: int, boosting: bool) -> int:
    """Tasks of a fit by this module; 0 if Spark's estimator has to do it."""
    spark = df.sparkSession
    context = spark.sparkContext
    if boosting:
        scala = context._jsc.sc()  # noqa: SLF001
        if est.getMaxDepth() > DEEPEST_BOOSTED or context.getConf().get("spark.dynamicAllocation.enabled", "false") == "true":
            return 0  # a barrier stage needs all its tasks at once
        try:
            _file_system(checkpoint_dir(spark))
        except (pa.ArrowException, OSError):
            return 0  # a file system that only Spark knows
        slots = int(scala.maxNumConcurrentTasks(scala.resourceProfileManager().defaultResourceProfile()))
        tasks = max(1, min(context.defaultParallelism, slots, MOST_BOOSTING_TASKS))
        return tasks if n_rows <= tasks * MOST_BOOSTED_ROWS else 0
    return max(1, context.defaultParallelism) if n_rows <= MOST_FOREST_ROWS else 0


def _plain(df: DataFrame, features: str, label: str, weight: Optional[str]) -> DataFrame:
    """Features as an array, label and weight as doubles: what the kernels read."""
    return df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"),
                     (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"))


def _matrix(column: pa.Array, n_features: int) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if values.null_count or (len(values) and np.ptp(np.diff(values.offsets.to_numpy()))):
        raise ValueError("features must be vectors of one length, without nulls")
    x = values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)
    if len(x) and x.shape[1] != n_features:
        raise ValueError(f"{x.shape[1]} features, not {n_features}")
    return x.reshape(len(values), n_features)


def _labels(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    y, w = batch.column("y"), batch.column("w")
    if y.null_count or w.null_count:
        raise ValueError("labels and weights must not be null")
    y, w = y.to_numpy(), w.to_numpy()
    if not ((y == 0) | (y == 1)).all() or not (w >= 0).all():
        raise ValueError("labels must be 0 or 1 and weights not negative")
    return y.astype(np.uint8), w


def _binned(x: np.ndarray, points: list[np.ndarray], which) -> np.ndarray:
    """Bin of each value: (feature, row)."""
    out = np.empty((len(which), len(x)), np.uint8)
    for k, f in enumerate(which):
        out[k] = np.searchsorted(points[f], x[:, f]) if len(points[f]) > 1 else (x[:, f] > points[f][0] if len(points[f]) else 0)
    return out


# ---------------------------------------------------------------------------
# Boosting
# ---------------------------------------------------------------------------
def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(path)


class Exchange:
    """Adds up arrays over the tasks of a barrier stage: each writes its own as a file and reads those of
    all, in the order of the tasks, so that every task gets the same sums.  A file is removed when
    all tasks have written their next one, since then all have read it."""

    def __init__(self, folder: str, part: int, parts: int):
        self.files, self.folder = _file_system(folder)
        self.part, self.parts, self.turn = part, parts, 0
        self.files.create_dir(self.folder, recursive=True)

    def _name(self, turn: int, part: int) -> str:
        return f"{self.folder}/{turn}-{part}"

    def _read(self, name: str) -> bytes:
        wait, until = 0.0005, time.monotonic() + LONGEST_WAIT
        while True:
            try:
                with self.files.open_input_file(name) as f:
                    return f.read()
            except FileNotFoundError:
                if time.monotonic() > until:
                    raise
                time.sleep(wait)
                wait = min(wait * 1.5, 0.02)

    def __call__(self, own: np.ndarray) -> np.ndarray:
        mine = self._name(self.turn, self.part)
        with self.files.open_output_stream(f"{mine}.part") as f:
            f.write(np.ascontiguousarray(own, float).tobytes())
        self.files.move(f"{mine}.part", mine)
        total = np.zeros(own.size)
        for part in range(self.parts):
            total += np.frombuffer(self._read(self._name(self.turn, part)))
        if self.turn:
            self.files.delete_file(self._name(self.turn - 1, self.part))
        self.turn += 1
        return total.reshape(own.shape)


class _Rows:
    """The rows of a boosting task: bins of the wide features, and for the features with two bins the
    numbers of those that are set in a row (one-hot features: one for each group)."""

    def __init__(self, batches: Iterator[pa.RecordBatch], bins: Bins):
        self.wide, self.binary = bins.wide(), bins.binary()
        self.none = len(self.binary)  # the code of no feature
        cut = np.array([bins.points[f][0] for f in self.binary])
        kind = np.uint8 if self.none < 255 else np.int32
        wide, codes, y, w = [], [], [], []
        for batch in batches:
            x = _matrix(batch.column("x"), bins.size)
            wide.append(_binned(x, bins.points, self.wide))
            row, code = np.nonzero(x[:, self.binary] > cut)
            n_set = np.bincount(row, minlength=len(x))
            place = np.arange(len(row)) - (np.cumsum(n_set) - n_set)[row]
            c = np.full((int(n_set.max(initial=0)), len(x)), self.none, kind)
            c[place, row] = code
            codes.append(c)
            labels, weights = _labels(batch)
            y.append(labels)
            w.append(weights)
        most = max((len(c) for c in codes), default=0)
        self.n = sum(map(len, y))
        self.x = np.concatenate(wide, axis=1) if wide else np.empty((len(self.wide), 0), np.uint8)
        self.codes = np.full((most, self.n), self.none, kind)
        at = 0
        for c in codes:
            self.codes[:len(c), at:at + c.shape[1]] = c
            at += c.shape[1]
        self.sign = (np.concatenate(y).astype(np.int8) * 2 - 1) if y else np.empty(0, np.int8)
        self.w = np.concatenate(w) if w else np.empty(0)
        self.plain = bool((self.w == 1).all())

    def histograms(self, node: np.ndarray, bag: np.ndarray, target: np.ndarray, open_: np.ndarray, k: int, width: int,
                   weighted: bool) -> np.ndarray:
        """Sums over the bagged rows of the ``k`` open nodes, in one line: rows, weight and weight * target for
        each (node, bin) of each feature, and for each node also of weight * target ** 2.  ``open_``: the open
        node of a place, ``k`` for the others."""
        kinds = 3 if weighted else 2
        per = [np.zeros((kinds, (k + 1) * width)) for _ in self.wide]
        coded = np.zeros((kinds, (k + 1) * (self.none + 1)))
        total = np.zeros((4, k + 1))
        for a in range(0, self.n, BLOCK):
            part = slice(a, a + BLOCK)
            place = np.where(bag[part], open_[node[part]], k)
            t = target[part]
            sums = [None, t]
            if weighted:
                wt = self.w[part]
                t = wt * t
                sums = [None, wt, t]
            total[0] += np.bincount(place, minlength=k + 1)
            total[1] += np.bincount(place, weights=self.w[part], minlength=k + 1) if weighted else 0
            total[2] += np.bincount(place, weights=t, minlength=k + 1)
            total[3] += np.bincount(place, weights=t * target[part], minlength=k + 1)
            base = place * width
            for f, out in enumerate(per):
                key = base + self.x[f, part]
                for i, v in enumerate(sums):
                    out[i] += np.bincount(key, weights=v, minlength=out.shape[1])
            base = place * (self.none + 1)
            for c in self.codes:
                key = base + c[part]
                for i, v in enumerate(sums):
                    coded[i] += np.bincount(key, weights=v, minlength=coded.shape[1])
        return np.concatenate([h[:, :k * width].ravel() for h in per]
                              + [coded[:, :k * (self.none + 1)].ravel(), total[:, :k].ravel()])

    def split(self, node: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> None:
        """Moves every row one level down, in place: place ``2 p`` or ``2 p + 1``; rows of leaves go left."""
        wide_at = np.zeros(len(feature), np.int64)
        limit = np.full(len(feature), 255, np.uint8)
        code = np.full(len(feature), self.none + 1, np.int64)  # no row has it
        for p in np.flatnonzero(feature >= 0):
            k = np.searchsorted(self.wide, feature[p])
            if k < len(self.wide) and self.wide[k] == feature[p]:
                wide_at[p], limit[p] = k, cut[p]
            else:
                code[p] = np.searchsorted(self.binary, feature[p])
        code = code.astype(self.codes.dtype)
        for a in range(0, self.n, BLOCK):
            b = min(a + BLOCK, self.n)
            at = node[a:b]
            right = np.zeros(b - a, bool)
            if len(self.wide):
                right |= self.x[wide_at[at], np.arange(a, b)] > limit[at]
            want = code[at]
            for c in self.codes:
                right |= c[a:b] == want
            node[a:b] = 2 * at + right


def _best_splits(line: np.ndarray, k: int, rows: "_Rows", bins: Bins, width: int, weighted: bool, allowed: np.ndarray,
                 least: int) -> tuple[np.ndarray, ...]:
    """From the sums of all tasks: feature (-1: leaf), bin, gain and the totals of each open node."""
    kinds = 3 if weighted else 2
    n_wide, step = len(rows.wide), kinds * k * width
    wide = line[:n_wide * step].reshape(n_wide, kinds, k, width)
    at = n_wide * step
    coded = line[at:at + kinds * k * (rows.none + 1)].reshape(kinds, k, rows.none + 1)
    total = line[at + coded.size:].reshape(4, k).copy()
    if not weighted:
        total[1] = total[0]
    count, weight, sums, squares = total
    gains = np.full((k, bins.size), -np.inf)
    cuts = np.zeros((k, bins.size), np.int64)

    def gain(left_rows, left_weight, left_sum, shape):
        rest = lambda v: v.reshape(shape)
        right_rows, right_weight, right_sum = rest(count) - left_rows, rest(weight) - left_weight, rest(sums) - left_sum
        with np.errstate(divide="ignore", invalid="ignore"):
            g = (left_sum ** 2 / left_weight + right_sum ** 2 / right_weight - rest(sums) ** 2 / rest(weight)) / rest(weight)
        return np.where((left_rows >= least) & (right_rows >= least) & (g > 0), g, -np.inf)

    if n_wide:
        left = np.cumsum(wide, axis=3)[..., :-1]
        g = gain(left[:, 0], left[:, -2], left[:, -1], (1, k, 1))
        at = g.argmax(axis=2)
        gains[:, rows.wide] = np.take_along_axis(g, at[..., None], 2)[..., 0].T
        cuts[:, rows.wide] = at.T
    if rows.none:
        c = coded[:, :, :rows.none]
        left = lambda v, i: v[:, None] - c[i]
        gains[:, rows.binary] = gain(left(count, 0), left(weight, kinds - 2), left(sums, kinds - 1), (k, 1))
    gains[~allowed] = -np.inf
    feature = gains.argmax(axis=1)
    best = np.take_along_axis(gains, feature[:, None], 1)[:, 0]
    with np.errstate(divide="ignore", invalid="ignore"):
        pure = (squares - sums ** 2 / weight) / weight < EPSILON
    leaf = ~(best > 0) | pure
    return np.where(leaf, -1, feature), np.take_along_axis(cuts, feature[:, None], 1)[:, 0], best, total


def drawn(rng: np.random.Generator, k: int, n: int, m: int) -> np.ndarray:
    """For each of ``k`` nodes ``m`` of ``n`` features, as a mask."""
    if m >= n:
        return np.ones((k, n), bool)
    mask = np.zeros((k, n), bool)
    np.put_along_axis(mask, np.argpartition(rng.random((k, n)), m, axis=1)[:, :m], True, axis=1)
    return mask


NODE = pa.schema([("tree", pa.int32()), ("id", pa.int32()), ("feature", pa.int32()), ("cut", pa.float64()),
                  ("left", pa.int32()), ("right", pa.int32()), ("gain", pa.float64()), ("rows", pa.int64()),
                  ("weight", pa.float64()), ("sum", pa.float64()), ("squares", pa.float64())])


def _numbered(tree: int, levels: list[dict[str, np.ndarray]], points: list[np.ndarray]) -> list[tuple]:
    """The nodes of a tree from the root on; two leaves of one prediction are their parent's leaf, as in Spark."""
    value = [lv["total"][2] / np.where(lv["total"][1] > 0, lv["total"][1], 1) for lv in levels]
    for d in range(len(levels) - 2, -1, -1):
        feature, below = levels[d]["feature"], levels[d + 1]["feature"]
        same = (below[0::2] < 0) & (below[1::2] < 0) & (value[d + 1][0::2] == value[d + 1][1::2])
        feature[(feature >= 0) & same] = -1
    out, queue = [], [(0, 0)]
    for i, (d, p) in enumerate(queue):  # grows while it is read
        lv = levels[d]
        f = int(lv["feature"][p])
        n, w, s, q = (float(v) for v in lv["total"][:, p])
        if f < 0:
            out.append((tree, i, -1, 0.0, -1, -1, -1.0, int(n), w, s, q))
            continue
        left = len(queue)
        queue += [(d + 1, 2 * p), (d + 1, 2 * p + 1)]
        out.append((tree, i, f, float(points[f][lv["cut"][p]]), left, left + 1, float(lv["gain"][p]), int(n), w, s, q))
    return out


def _boost(rows: _Rows, bins: Bins, settings: dict[str, Any], part: int, exchange) -> list[tuple]:
    """All rounds of boosting over the rows of one task; ``exchange`` adds up arrays over the tasks."""
    depth, seed, rate, least = (settings[x] for x in ("depth", "seed", "rate", "least"))
    width = max((len(p) + 1 for p in bins.points), default=1)
    weighted = bool(exchange(np.array([0.0 if rows.plain else 1.0]))[0])
    score = np.zeros(rows.n)
    node = np.empty(rows.n, np.int32)
    target = rows.sign.astype(float)  # the first tree fits the labels, the others the residuals
    out = []
    for tree in range(settings["rounds"]):
        if tree:
            for a in range(0, rows.n, BLOCK):
                y = rows.sign[a:a + BLOCK]
                target[a:a + BLOCK] = 4.0 * y / (1.0 + np.exp(2.0 * y * score[a:a + BLOCK]))
        bag = np.random.default_rng([seed, tree, part]).random(rows.n) < rate if rate < 1 else np.ones(rows.n, bool)
        node[:] = 0
        at = np.zeros(1, np.int64)  # places of the level's nodes that are at work
        levels: list[dict[str, np.ndarray]] = []
        for d in range(depth + 1):
            k, n = len(at), 2 ** d
            level = {"feature": np.full(n, -1), "cut": np.zeros(n, np.int64), "gain": np.zeros(n), "total": np.zeros((4, n))}
            levels.append(level)
            if not k:
                break
            open_ = np.full(n, k, np.int64)
            open_[at] = np.arange(k)
            if d == depth:  # only totals
                place = np.where(bag, open_[node], k)
                wt = target * rows.w
                level["total"][:, at] = exchange(np.stack([np.bincount(place, weights=v, minlength=k + 1)[:k]
                                                           for v in (None, rows.w, wt, wt * target)]))
                break
            line = exchange(rows.histograms(node, bag, target, open_, k, width, weighted))
            allowed = drawn(np.random.default_rng([seed, tree, depth + d, 1]), k, bins.size, bins.per_node)
            feature, cut, gain, total = _best_splits(line, k, rows, bins, width, weighted, allowed, least)
            level["feature"][at], level["cut"][at], level["gain"][at], level["total"][:, at] = feature, cut, gain, total
            at = at[feature >= 0]
            at = np.stack([2 * at, 2 * at + 1], axis=1).ravel()
            rows.split(node, level["feature"], level["cut"])
        nodes = _numbered(tree, levels, bins.points)
        out += nodes
        # the value of a place of the last level is that of the leaf above it
        value = np.zeros(1)
        for d, lv in enumerate(levels):
            own = lv["total"][2] / np.where(lv["total"][1] > 0, lv["total"][1], 1)
            split = levels[d - 1]["feature"] >= 0 if d else np.ones(1, bool)
            value = np.where(np.repeat(split, 2), own, np.repeat(value, 2)) if d else own
        step = 1.0 if tree == 0 else settings["step"]
        for a in range(0, rows.n, BLOCK):
            score[a:a + BLOCK] += step * value[node[a:a + BLOCK]]
    return out


def fit_boosting(est, df: DataFrame, tasks: int, bins: Bins, features: str, label: str,
                 weight: Optional[str]) -> GBTClassificationModel:
    """The boosted ensemble of ``est`` on ``df``, whose rows are in ``tasks`` partitions."""
    settings = {"rounds": est.getMaxIter(), "depth": est.getMaxDepth(), "seed": abs(int(est.getSeed())),
                "rate": est.getSubsamplingRate(), "step": est.getStepSize(), "least": est.getMinInstancesPerNode()}

    folder = scratch_path(df.sparkSession, "exchange")

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import BarrierTaskContext

        context = BarrierTaskContext.get()
        part = context.partitionId()
        run = context.allGather(uuid.uuid4().hex)[0]  # a stage that runs again gets files of its own
        exchange = Exchange(f"{folder}/{run}", part, tasks)
        nodes = _boost(_Rows(batches, bins), bins, settings, part, exchange)
        if part == 0:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*nodes), NODE)], schema=NODE)

    schema = "tree int, id int, feature int, cut double, left int, right int, gain double, rows long, " \
             "weight double, sum double, squares double"
    nodes = _plain(df, features, label, weight).mapInArrow(grow, schema, barrier=True).toArrow()
    return _boosted_model(est, nodes, bins.size, df.sparkSession)


def _boosted_model(est, nodes: pa.Table, n_features: int, spark: SparkSession) -> GBTClassificationModel:
    """The nodes as a model of Spark, through the format in which Spark stores it."""
    gateway, jvm = spark.sparkContext._gateway, spark._jvm  # noqa: SLF001
    old, ml = jvm.org.apache.spark.mllib.tree.impurity, jvm.org.apache.spark.ml
    java, rounds = est._java_obj, est.getMaxIter()  # noqa: SLF001
    trees = gateway.new_array(ml.regression.DecisionTreeRegressionModel, rounds)
    scale = gateway.new_array(jvm.double, rounds)
    stats = gateway.new_array(jvm.double, 3)
    leaf = ml.tree.LeafNode(0.0, 0.0, old.VarianceCalculator(stats, 0))
    for i in range(rounds):  # their nodes are replaced below
        trees[i], scale[i] = ml.regression.DecisionTreeRegressionModel(f"dtr_{java.uid()}_{i}", leaf, n_features), 1.0 if i == 0 else est.getStepSize()
    shell = ml.classification.GBTClassificationModel(java.uid(), trees, scale, n_features, 2)
    settings = java.extractParamMap().toSeq()
    for i in range(settings.size()):
        shell.set(settings.apply(i))
    path = scratch_path(spark, "boosted")
    shell.write().overwrite().save(path)
    c, s, q = (F.col(x) for x in ("weight", "sum", "squares"))
    split = F.struct(F.col("feature").alias("featureIndex"),
                     F.when(F.col("feature") >= 0, F.array("cut")).otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"),
                     F.lit(-1).alias("numCategories"))
    spark.createDataFrame(nodes).select(F.col("tree").alias("treeID"), F.struct(
        "id", F.try_divide(s, c).alias("prediction"), F.try_divide(q - F.try_divide(s * s, c), c).alias("impurity"),
        F.array(c, s, q).alias("impurityStats"), F.col("rows").alias("rawCount"), "gain",
        F.col("left").alias("leftChild"), F.col("right").alias("rightChild"), split.alias("split")).alias("nodeData")) \
        .fillna(0.0).write.mode("overwrite").parquet(os.path.join(path, "data"))
    return GBTClassificationModel.load(path)


# ---------------------------------------------------------------------------
# Forest
# ---------------------------------------------------------------------------
def _gini(parts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Impurity of weights ``(..., 2)`` of the two classes."""
    with np.errstate(divide="ignore", invalid="ignore"):
        share = parts / total[..., None]
    return np.where(total > 0, 1.0 - share[..., 0] ** 2 - share[..., 1] ** 2, 0.0)


def _grow_tree(x: np.ndarray, y: np.ndarray, w: np.ndarray, bag: np.ndarray, bins: Bins, depth: int, least: int,
               draw: list[int]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """One tree over bins ``x`` (feature, row): its nodes as arrays, and the importance of each feature."""
    n_all = x.shape[1]
    flat = x.ravel()
    row = np.flatnonzero(bag)
    times = bag[row].astype(float)
    wt, label = w[row] * times, y[row].astype(np.int64)
    n_points = np.array([len(p) for p in bins.points])
    width = int(n_points.max(initial=0)) + 1
    node = np.zeros(len(row), np.int64)
    total = np.array([[wt[label == 0].sum(), wt[label == 1].sum()]])
    count = np.array([times.sum()])
    kept: list[list[np.ndarray]] = []  # per level: feature, bin, first child, totals, gain
    first = 1  # number of the next level's first node
    at = np.arange(1)  # the level's nodes at work, as places of the level
    level_total = total
    for d in range(depth + 1):
        n_level = len(level_total)
        feature, cut = np.full(n_level, -1, np.int32), np.zeros(n_level, np.uint8)
        child, gains = np.full(n_level, -1, np.int64), np.zeros(n_level)
        kept.append([feature, cut, child, level_total, gains])
        k = len(at)
        if d == depth or not k:
            break
        weight = total.sum(axis=1)
        impurity = _gini(total, weight)
        chosen = np.sort(np.argpartition(np.random.default_rng([*draw, d]).random((k, bins.size)), min(bins.per_node, bins.size) - 1,
                                         axis=1)[:, :bins.per_node], axis=1)
        best, best_f, best_cut = np.full(k, -np.inf), np.zeros(k, np.int64), np.zeros(k, np.int64)
        best_left, best_rows = np.zeros((k, 2)), np.zeros(k)
        for j in range(chosen.shape[1]):
            f = chosen[:, j]
            key = node * width + flat[f[node] * n_all + row]
            rows_in = np.bincount(key, weights=times, minlength=k * width).reshape(k, width)
            parts = np.bincount(key * 2 + label, weights=wt, minlength=k * width * 2).reshape(k, width, 2)
            left = np.cumsum(parts[:, :-1], axis=1)
            left_rows = np.cumsum(rows_in[:, :-1], axis=1)
            right = total[:, None] - left
            lw, rw = left.sum(axis=2), right.sum(axis=2)
            g = impurity[:, None] - lw / weight[:, None] * _gini(left, lw) - rw / weight[:, None] * _gini(right, rw)
            g[(left_rows < least) | (count[:, None] - left_rows < least)] = -np.inf
            b = g.argmax(axis=1) if width > 1 else np.zeros(k, np.int64)
            top = g[np.arange(k), b] if width > 1 else np.full(k, -np.inf)
            better = top > best
            best, best_f, best_cut = np.where(better, top, best), np.where(better, f, best_f), np.where(better, b, best_cut)
            here = np.flatnonzero(better)
            best_left[here], best_rows[here] = left[here, b[here]], left_rows[here, b[here]]
        split = (best > 0) & (impurity >= EPSILON)
        n_split = int(split.sum())
        feature[at[split]], cut[at[split]], gains[at[split]] = best_f[split], best_cut[split], best[split]
        child[at[split]] = first + 2 * np.arange(n_split)
        first += 2 * n_split
        below = np.empty((2 * n_split, 2))
        below[0::2], below[1::2] = best_left[split], total[split] - best_left[split]
        below_count = np.empty(2 * n_split)
        below_count[0::2], below_count[1::2] = best_rows[split], count[split] - best_rows[split]
        work = _gini(below, below.sum(axis=1)) >= EPSILON
        if d + 1 == depth:
            work[:] = False
        # rows go to the children that are at work; the others are done
        base = np.full(k, -1, np.int64)
        base[split] = 2 * np.arange(n_split)
        right = flat[best_f[node] * n_all + row] > best_cut[node]
        place = np.where(base[node] >= 0, base[node] + right, -1)
        number = np.full(2 * n_split + 1, -1, np.int64)  # place -1 is the last
        number[:-1][work] = np.arange(int(work.sum()))
        node = number[place]
        stay = node >= 0
        node, row, times, wt, label = node[stay], row[stay], times[stay], wt[stay], label[stay]
        level_total, at = below, np.flatnonzero(work)
        total, count = below[work], below_count[work]
    return _packed(kept, bins.size)


def _packed(kept: list[list[np.ndarray]], n_features: int) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Levels as one list of nodes; two leaves of one prediction are their parent's leaf, as in Spark."""
    feature, cut, child, total, gain = (np.concatenate(v) for v in zip(*kept))
    guess = total[:, 1] > total[:, 0]
    ends = np.cumsum([len(lv[0]) for lv in kept])
    for end, n in zip(ends[::-1], [len(lv[0]) for lv in kept][::-1]):
        inner = np.arange(end - n, end)
        inner = inner[feature[inner] >= 0]
        a = child[inner]
        alike = (feature[a] < 0) & (feature[a + 1] < 0) & (guess[a] == guess[a + 1])
        feature[inner[alike]] = -1
    reached = np.zeros(len(feature), bool)
    reached[0] = True
    start = 0
    for end in ends:
        inner = np.arange(start, end)
        inner = inner[reached[inner] & (feature[inner] >= 0)]
        reached[child[inner]] = reached[child[inner] + 1] = True
        start = end
    number = np.cumsum(reached) - 1
    feature, cut, total, gain = feature[reached], cut[reached], total[reached], gain[reached]
    inner = feature >= 0
    child = np.where(inner, number[child[reached]], np.arange(len(feature)))
    weight = total.sum(axis=1)
    importance = np.bincount(feature[inner], weights=(gain * weight)[inner], minlength=n_features)
    kind = np.uint8 if n_features < 256 else np.uint16 if n_features < 65536 else np.uint32
    share = np.divide(total[:, 1], weight, out=np.zeros(len(weight)), where=weight > 0)
    tree = {"feature": np.where(inner, feature, 0).astype(kind), "cut": np.where(inner, cut, 255).astype(np.uint8),
            "child": child.astype(np.int32), "share": share, "empty": weight <= 0}
    return tree, importance


def _tree_bytes(tree: dict[str, np.ndarray]) -> bytes:
    return zlib.compress(pickle.dumps(tree, protocol=5), 1)


def fit_forest(est, df: DataFrame, tasks: int, bins: Bins, features: str, label: str, weight: Optional[str],
               bootstrap: bool = True) -> "StoredForest":
    """The forest of ``est`` on ``df``: the binned rows go to every group of trees."""
    n_trees, depth, least = est.getNumTrees(), est.getMaxDepth(), est.getMinInstancesPerNode()
    seed, rate = abs(int(est.getSeed())), est.getSubsamplingRate()
    groups = min(n_trees, 2 * tasks)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            x, y, w = (np.concatenate(v, axis=-1) for v in zip(*held))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([at], pa.int32()),
                                               pa.array([pickle.dumps((x, y, w), protocol=5)], pa.binary())], ["part", "seq", "block"])

        for batch in batches:
            held.append((_binned(_matrix(batch.column("x"), bins.size), bins.points, range(bins.size)), *_labels(batch)))
            if sum(len(h[1]) for h in held) >= BLOCK:
                yield block()
                held, at = [], at + 1
        if held:
            yield block()

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, group = [], None
        for batch in batches:
            for r in batch.to_pylist():
                group = r["grp"]
                blocks.append(((r["part"], r["seq"]), pickle.loads(r["block"])))
        if group is None:
            return
        blocks.sort(key=lambda b: b[0])
        x, y, w = (np.concatenate(v, axis=-1) for v in zip(*[b for _, b in blocks]))
        blocks.clear()
        for tree in range(group, n_trees, groups):
            rng = np.random.default_rng([seed, tree])
            bag = rng.poisson(rate, len(y)) if bootstrap else (rng.random(len(y)) < rate).astype(np.int64)
            nodes, importance = _grow_tree(x, y, w, bag, bins, depth, least, [seed, tree])
            yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([len(nodes["child"])], pa.int64()),
                                              pa.array([importance.tolist()], pa.list_(pa.float64())),
                                              pa.array([_tree_bytes(nodes)], pa.binary())], ["tree", "nodes", "importance", "body"])

    packed = _plain(df, features, label, weight).mapInArrow(pack, "part int, seq int, block binary")
    dealt = packed.select("*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp")).repartitionById(groups, "grp")
    grown = dealt.mapInArrow(grow, "tree int, nodes long, importance array<double>, body binary")
    path = os.path.join(scratch_path(df.sparkSession, "forest"), "trees")
    grown.write.parquet(path)
    return StoredForest(path, features, [p.tolist() for p in bins.points])


class _Importances(list):
    def toArray(self) -> np.ndarray:  # noqa: N802 (as Spark's vectors)
        return np.array(self)


class StoredForest:
    """A forest as a table with one row for each tree; scores like Spark's forest of the same trees."""

    CHUNK = 200_000  # rows that a task sends through the trees together

    def __init__(self, path: str, features: str, points: list[list[float]]):
        self.path, self.features, self.points = path, features, points
        self._bodies: Any = None
        table = SparkSession.getActiveSession().read.parquet(path).select("tree", "nodes", "importance").orderBy("tree").collect()
        self.getNumTrees = len(table)
        self.totalNumNodes = sum(r["nodes"] for r in table)
        whole = np.zeros(len(points))
        for r in table:
            own = np.array(r["importance"])
            whole += own / own.sum() if own.sum() > 0 else 0.0
        self.featureImportances = _Importances((whole / whole.sum() if whole.sum() > 0 else whole).tolist())

    def _trees(self, spark: SparkSession):
        if self._bodies is None:
            rows = spark.read.parquet(self.path).select("tree", "body").collect()  # packed trees, as Spark would broadcast a model
            self._bodies = spark.sparkContext.broadcast([bytes(r["body"]) for r in sorted(rows, key=lambda r: r["tree"])])
        return self._bodies

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``rawPrediction`` (votes), ``probability`` and ``prediction``."""
        bodies, points, chunk = self._trees(df.sparkSession), [np.array(p) for p in self.points], self.CHUNK

        @F.pandas_udf("array<double>")
        def votes(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            held, sizes = [], []

            def scored() -> Iterator[pd.Series]:
                out = _votes(np.concatenate(held, axis=1), bodies.value)
                at = 0
                for n in sizes:
                    yield pd.Series(list(out[at:at + n]))
                    at += n

            for part in parts:
                x = np.stack(part.to_numpy()) if len(part) else np.empty((0, len(points)))
                held.append(_binned(x, points, range(len(points))))
                sizes.append(len(part))
                if sum(sizes) >= chunk:
                    yield from scored()
                    held, sizes = [], []
            if sizes:
                yield from scored()

        raw = F.col("_votes")
        out = df.withColumn("_votes", votes(vector_to_array(self.features)))
        share = F.transform(raw, lambda v: v / (raw[0] + raw[1]))
        return out.withColumn("rawPrediction", array_to_vector(raw)).withColumn("probability", array_to_vector(share)) \
            .withColumn("prediction", (raw[1] > raw[0]).cast("double")).drop("_votes")

    def write(self) -> "StoredForest":
        return self

    def overwrite(self) -> "StoredForest":
        return self

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        spark.read.parquet(self.path).write.mode("overwrite").parquet(os.path.join(path, "trees"))
        about = json.dumps({"features": self.features, "points": self.points})
        spark.createDataFrame([(about,)], "value string").coalesce(1).write.mode("overwrite").text(os.path.join(path, "bins"))

    @staticmethod
    def load(path: str) -> "StoredForest":
        about = json.loads(SparkSession.getActiveSession().read.text(os.path.join(path, "bins")).first()[0])
        return StoredForest(os.path.join(path, "trees"), about["features"], about["points"])


def _votes(x: np.ndarray, bodies: list[bytes]) -> np.ndarray:
    """Sum over the trees of each leaf's class shares, for the binned rows ``x`` (feature, row)."""
    n = x.shape[1]
    flat, out = x.ravel(), np.zeros((n, 2))
    for body in bodies:
        tree = pickle.loads(zlib.decompress(body))
        feature, cut, child = tree["feature"].astype(np.int64) * n, tree["cut"], tree["child"]
        leaf = child == np.arange(len(child))
        node, row = np.zeros(n, np.int64), np.arange(n)
        at = node.copy()
        while len(row):
            inner = ~leaf[at]
            if not inner.all():
                node[row[~inner]] = at[~inner]
                row, at = row[inner], at[inner]
            at = child[at] + (flat[feature[at] + row] > cut[at])
        one, some = tree["share"][node], ~tree["empty"][node]
        out[:, 1] += one * some
        out[:, 0] += (1.0 - one) * some
    return out


def tasks_for(df: DataFrame, tasks: int) -> DataFrame:
    """The rows of ``df`` dealt over ``tasks`` tasks, those of a task in the order of a hash."""
    return df.repartition(tasks).sortWithinPartitions(F.xxhash64(*df.columns))

