"""Forests and boosted trees on one-hot slots, grown from counts by category.

Spark's tree learners hold every row as one number a feature slot, so a column of a thousand categories costs a
thousand numbers a row: beyond a few million rows each pass reads them from disk. Of a column's slots a row has one only,
and what a split "slot is set or not" needs is that category's counts and the node's. So rows stay one code a column,
and a level of all trees is one Spark job: tasks add up counts by node and code, nodes are shuffled, and
each node's best split is found beside its counts. The models are Spark's own.

Splits, gains, leaf values, shrinkage and parameters are those of Spark's learners; a row's part in a tree is drawn by a hash of
its number instead of a generator by partition. Sums of residuals are of multiples of 2**-20, hence exact and the same under any
partitioning up to 2**33. Memory in a task: ``CELLS`` cells of counts and ``ROWS`` rows; a level with more
cells takes several jobs. Collected: one row a node.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.base import Estimator, Model
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoderModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.sources.stage import stage_folder, unstage

CELLS, ROWS = 1 << 22, 1 << 17
TASK_ROWS = 50_000  # a task more for so many rows, up to two a core
MARGIN_ROUNDS = 4  # rounds after which the rows' margins are written, not added up anew


@dataclass(frozen=True)
class Block:
    """A column of the assembled vector: its ``first`` slot and, if one-hot, its number of slots."""

    column: str
    first: int
    slots: int = 0  # 0: a number


def blocks(features: PipelineModel, transformed: DataFrame) -> list[Block] | None:
    """How the assembled vector is made of one-hot columns and numbers; None where it has no one-hot column or other vectors."""
    encoded = {}
    for step in features.stages:
        if isinstance(step, OneHotEncoderModel):
            encoded |= dict(zip(step.getOutputCols(), step.getInputCols(), strict=True))
    found, first = [], 0
    if not encoded or not isinstance(features.stages[-1], VectorAssembler):
        return None
    for name in features.stages[-1].getInputCols():
        kind = transformed.schema[name]
        if name in encoded:
            slots = sum(map(len, kind.metadata["ml_attr"]["attrs"].values()))
            found.append(Block(encoded[name], first, slots))
        elif kind.dataType.typeName() == "vectorudt":
            return None
        else:
            found.append(Block(name, first))
        first += found[-1].slots or 1
    return found


def grows(classifier: Estimator) -> bool:
    """Whether a classifier is one that ``Grower`` fits with all its settings."""
    if not isinstance(classifier, (GBTClassifier, RandomForestClassifier)):
        return False
    boosted = isinstance(classifier, GBTClassifier)
    optional = ["weightCol", "thresholds", *["validationIndicatorCol"] * boosted]
    return (
        not any(classifier.isDefined(name) and classifier.getOrDefault(name) for name in optional)
        and classifier.getFeatureSubsetStrategy() in (("all", "auto") if boosted else ("auto", "sqrt", "all"))
        and classifier.getMinWeightFractionPerNode() == 0
        and (boosted or (classifier.getImpurity() == "gini" and classifier.getBootstrap()))
    )


@dataclass
class Nodes:
    """Nodes of all trees, numbered as they come. A row goes from a node to ``child``, or the one after it if its code of ``column`` lies in low..high."""

    roots: list[int] = field(default_factory=list)
    child: list[int] = field(default_factory=list)
    column: list[int] = field(default_factory=list)
    low: list[int] = field(default_factory=list)
    high: list[int] = field(default_factory=list)
    stats: list[tuple[float, float, float]] = field(default_factory=list)  # rows, sum, sum of squares
    split: list[tuple[int, float, float] | None] = field(default_factory=list)  # slot, threshold, gain

    def add(self, stats: tuple[float, float, float]) -> int:
        number = len(self.child)
        for values, value in ((self.child, number), (self.column, 0), (self.low, 1), (self.high, 0), (self.stats, stats), (self.split, None)):
            values.append(value)
        return number

    def arrays(self, weights: Sequence[float]) -> tuple[np.ndarray, ...]:
        """For tasks: where rows go, the values of the nodes times their tree's weight (trees one after the other), and the roots."""
        ends = [*self.roots[1:], len(self.child)]
        of = np.repeat(np.asarray(weights, dtype=float), np.subtract(ends, self.roots)) if weights else np.zeros(0)
        values = np.array([s / n if n else 0.0 for n, s, _ in self.stats]) * of if weights else np.zeros(len(self.child))
        return (*(np.array(x, dtype=np.int64) for x in (self.child, self.column, self.low, self.high)), values, np.array(self.roots, dtype=np.int64))


def _task(columns: Sequence[str], nodes: tuple, known: int, depth: int, boosted: bool, rate: float, seed: int):
    """Helpers of tasks, pickled whole: (codes, walk, margin, target, weight)."""
    child, column, low, high, values, roots = nodes

    def codes(rows: pd.DataFrame) -> np.ndarray:
        return np.column_stack([rows[c].to_numpy(np.int64) for c in columns])

    def walk(x: np.ndarray, tree: int) -> np.ndarray:
        at, every = np.full(len(x), roots[tree]), np.arange(len(x))
        for _ in range(depth):
            code = x[every, column[at]]
            at = child[at] + ((code >= low[at]) & (code <= high[at]))
        return at

    def margin(rows: pd.DataFrame, x: np.ndarray, trees: int) -> np.ndarray:
        """After so many trees; those before ``known`` are in the rows' own margin."""
        total = rows["_margin"].to_numpy(float)
        for tree in range(known, trees):
            total = total + values[walk(x, tree)]
        return total

    def target(rows: pd.DataFrame, x: np.ndarray, tree: int) -> np.ndarray:
        label = rows["label"].to_numpy(float)
        if not boosted:
            return label
        sign = 2 * label - 1
        if tree == 0:
            return sign
        return np.round(4 * sign / (1 + np.exp(2 * sign * margin(rows, x, tree))) * 2**20) / 2**20

    def weight(rows: pd.DataFrame, tree: int) -> np.ndarray:
        """How often a row counts in a tree: a share of the rows when boosting, else as drawn with replacement."""
        if boosted and rate >= 1:
            return np.ones(len(rows))
        z = rows["_row"].to_numpy(np.uint64) + np.uint64(((tree + 1) * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03) % (1 << 64))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 0x9E3779B97F4A7C15), (29, 0xBF58476D1CE4E5B9)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
        share = (z >> np.uint64(11)).astype(float) / 2**53
        if boosted:
            return (share < rate).astype(float)
        below = np.cumsum([np.exp(-rate) * rate**k / float(math.factorial(k)) for k in range(30)])
        return np.searchsorted(below, share, side="right").astype(float)

    return codes, walk, margin, target, weight


class Grower:
    """Grows a forest or boosted trees on rows with a label of 0 or 1 and the columns of the blocks."""

    def __init__(self, classifier: Estimator, rows: DataFrame, found: list[Block]):
        self.classifier, self.blocks, self.spark = classifier, found, rows.sparkSession
        self.boosted = isinstance(classifier, GBTClassifier)
        self.nodes, self.weights, self.known, self.path = Nodes(), [], 0, None
        bins = classifier.getMaxBins()
        self.limits = self._limits(rows, [b.column for b in found if not b.slots], bins)
        self.sizes = [b.slots + 1 if b.slots else len(self.limits[b.column]) + 1 for b in found]
        self.columns = [f"_c{i}" for i in range(len(found))]
        n, labelled = rows.agg(F.count("*"), F.count_if(F.col("label").isin(0, 1))).first()
        if labelled < n:
            raise ValueError(f"labels must be 0 or 1; {n - labelled} of {n} rows have others or none")
        tasks = max(1, min(2 * self.spark.sparkContext.defaultParallelism, n // TASK_ROWS))
        coded = rows.selectExpr("CAST(label AS int) AS label", *(f"{self._code(b)} AS {c}" for b, c in zip(found, self.columns, strict=True)))
        self._write(coded.repartition(tasks).withColumns({"_row": F.monotonically_increasing_id(), "_margin": F.lit(0.0)}))

    def _write(self, rows: DataFrame) -> None:
        before, self.path = self.path, stage_folder(self.spark, "tree-rows")
        rows.write.parquet(self.path)
        self.rows = self.spark.read.schema(rows.schema).parquet(self.path)
        if before:
            unstage(self.spark, before)

    def close(self) -> None:
        unstage(self.spark, self.path)

    def _limits(self, rows: DataFrame, numbers: list[str], bins: int) -> dict[str, list[float]]:
        """Thresholds: between all values where they are few, else at quantiles."""
        if not numbers:
            return {}
        few = rows.select(*(F.approx_count_distinct(c) for c in numbers)).first()
        cuts = rows.approxQuantile(numbers, [i / bins for i in range(1, bins)], 0.001)
        limits = {c: sorted(set(q)) for c, q in zip(numbers, cuts, strict=True)}
        for c, about in zip(numbers, few, strict=True):
            if about <= 2 * bins:
                values = sorted(r[0] for r in rows.where(f"NOT isnan({c}) AND {c} IS NOT NULL").select(F.col(c).cast("double")).distinct().limit(bins + 1).collect())
                if len(values) <= bins:
                    limits[c] = [(a + b) / 2 for a, b in zip(values, values[1:], strict=False)]
        return limits

    def _code(self, block: Block) -> str:
        if block.slots:
            return f"CAST(least({block.column}, {block.slots}) AS int)"
        cases = " ".join(f"WHEN {block.column} <= {float(x)!r}D THEN {i}" for i, x in enumerate(self.limits[block.column]))
        return f"CASE {cases} ELSE {len(self.limits[block.column])} END" if cases else "0"

    # --- one level ---------------------------------------------------------------------------

    def _counted(self, wanted: list[tuple[int, int]], depth: int) -> DataFrame:
        """``tree, node, counts``: of every task that has rows of a wanted node, its counts by code, as bytes."""
        items, offsets = sum(self.sizes), np.cumsum([0, *self.sizes[:-1]])
        at = np.full(len(self.nodes.child), -1, dtype=np.int64)
        at[[node for _, node in wanted]] = np.arange(len(wanted))
        trees, boosted, kinds = sorted({tree for tree, _ in wanted}), self.boosted, 3 if self.boosted else 2
        arrays = self.nodes.arrays(self._weights())
        size = len(wanted) * items
        helpers = _task(self.columns, arrays, self.known, depth, boosted, self.classifier.getSubsamplingRate(), self.classifier.getSeed())

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            codes, walk, _, target, weight = helpers
            counts, waiting, n = np.zeros((kinds, size)), [], 0

            def count(rows: pd.DataFrame) -> None:
                x = codes(rows)
                for tree in trees:
                    place = at[walk(x, tree)]
                    w = weight(rows, tree)
                    use = np.flatnonzero((place >= 0) & (w > 0))
                    if len(use):
                        keys = (place[use, None] * items + offsets + x[use]).ravel()
                        w, y = w[use], target(rows, x, tree)[use]
                        for kind, value in enumerate((w, w * y, w * y * y)[:kinds]):
                            counts[kind] += np.bincount(keys, np.repeat(value, len(offsets)), size)

            for batch in batches:
                waiting.append(batch)
                n += len(batch)
                if n >= ROWS:
                    count(pd.concat(waiting, ignore_index=True))
                    waiting, n = [], 0
            if n:
                count(pd.concat(waiting, ignore_index=True))
            by_node = counts.reshape(kinds, len(wanted), items)
            for i in range(0, len(wanted), 256):
                part = [k for k in range(i, min(i + 256, len(wanted))) if by_node[0, k].any()]
                yield pd.DataFrame({"tree": [wanted[k][0] for k in part], "node": [wanted[k][1] for k in part], "counts": [by_node[:, k].tobytes() for k in part]}).astype({"counts": object})

        return self.rows.mapInPandas(run, "tree int, node int, counts binary")

    def _best(self, counted: DataFrame) -> list:
        """A row a node: its sums, the best split and what goes left there; slot -1 where no split gains."""
        sizes, slots, kinds = list(self.sizes), [b.slots for b in self.blocks], 3 if self.boosted else 2
        first, total = [b.first for b in self.blocks], self.blocks[-1].first + (self.blocks[-1].slots or 1)
        subset = total if self.boosted or self.classifier.getFeatureSubsetStrategy() == "all" else math.ceil(math.sqrt(total))
        least, least_gain, seed = self.classifier.getMinInstancesPerNode(), self.classifier.getMinInfoGain() * (1 if self.boosted else 0.5), self.classifier.getSeed()

        def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
            sums = np.sum([np.frombuffer(c).reshape(kinds, -1) for c in group["counts"]], axis=0)
            whole = sums[:, : sizes[0]].sum(axis=1)
            right, slot, code, column, begin = [], [], [], [], 0
            for k, (size, one_hot, at) in enumerate(zip(sizes, slots, first, strict=True)):
                part = sums[:, begin : begin + size]
                begin += size
                some = part[:, :one_hot] if one_hot else whole[:, None] - np.cumsum(part, axis=1)[:, :-1]
                right.append(some)
                slot.append(at + np.arange(one_hot) if one_hot else np.full(some.shape[1], at))
                code.append(np.arange(some.shape[1]))
                column.append(np.full(some.shape[1], k))
            right, slot, code, column = np.concatenate(right, axis=1), np.concatenate(slot), np.concatenate(code), np.concatenate(column)
            left = whole[:, None] - right
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = (left[1] ** 2 / left[0] + right[1] ** 2 / right[0] - whole[1] ** 2 / whole[0]) / whole[0]
            ok = (left[0] >= least) & (right[0] >= least)
            if subset < total:
                drawn = np.random.Generator(np.random.PCG64([seed % (1 << 63), int(key[0]), int(key[1])])).choice(total, subset, replace=False)
                ok &= np.isin(slot, drawn)
            gain = np.where(ok, gain, -1.0)
            best = int(np.argmax(gain)) if len(gain) else -1
            if best < 0 or gain[best] <= 1e-12 or gain[best] < least_gain:
                found = [-1, 0, 0, 0.0, *whole, *whole]
            else:
                found = [slot[best], column[best], code[best], gain[best], *whole, *left[:, best]]
            if kinds == 2:  # labels are their own squares
                found = [*found[:6], found[5], *found[6:], found[7]]
            return pd.DataFrame([[*key, *found]], columns=names)

        schema = "tree int, node int, slot int, column int, code int, gain double, n double, s double, q double, left_n double, left_s double, left_q double"
        names = [f.split()[0] for f in schema.split(", ")]
        return counted.groupBy("tree", "node").applyInPandas(run, schema).collect()

    def _weights(self) -> list[float]:
        return self.weights if self.boosted else []  # a forest's tasks need no values

    def _grow(self, trees: int) -> None:
        """So many trees more, side by side."""
        nodes = self.nodes
        open_ = []
        for _ in range(trees):
            nodes.roots.append(nodes.add((0.0, 0.0, 0.0)))
            open_.append((len(nodes.roots) - 1, nodes.roots[-1]))
            self.weights.append(self.classifier.getStepSize() if self.boosted and self.weights else 1.0)
        depth, step = self.classifier.getMaxDepth(), max(1, CELLS // sum(self.sizes))
        for level in range(max(1, depth)):
            below = []
            for i in range(0, len(open_), step):
                for r in sorted(self._best(self._counted(open_[i : i + step], max(level, depth if self.boosted else 0))), key=lambda r: (r["tree"], r["node"])):
                    nodes.stats[r["node"]] = (r["n"], r["s"], r["q"])
                    if r["slot"] >= 0 and depth:
                        below += self._split(r)
            open_ = below
            if not open_:
                break

    def _split(self, r) -> list[tuple[int, int]]:
        nodes, node, block = self.nodes, r["node"], self.blocks[r["column"]]
        left = (r["left_n"], r["left_s"], r["left_q"])
        nodes.child[node] = nodes.add(left)
        nodes.add((r["n"] - left[0], r["s"] - left[1], r["q"] - left[2]))
        nodes.column[node] = r["column"]
        nodes.low[node], nodes.high[node] = (r["code"], r["code"]) if block.slots else (r["code"] + 1, 1 << 30)
        nodes.split[node] = (r["slot"], 0.5 if block.slots else self.limits[block.column][r["code"]], r["gain"])
        return [(r["tree"], nodes.child[node]), (r["tree"], nodes.child[node] + 1)]

    # --- all of it ---------------------------------------------------------------------------

    def grow(self, trees: int) -> Model:
        """The model of so many trees; those that are there already stay."""
        if not self.boosted:
            self._grow(trees - len(self.nodes.roots))
        while len(self.nodes.roots) < trees:
            if len(self.nodes.roots) - self.known >= MARGIN_ROUNDS:
                self._keep_margins()
            self._grow(1)
        return self._model()

    def _keep_margins(self) -> None:
        columns, known, trees = self.columns, self.known, len(self.nodes.roots)
        helpers = _task(columns, self.nodes.arrays(self._weights()), known, self.classifier.getMaxDepth(), True, 1.0, 0)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            codes, _, margin, _, _ = helpers
            for rows in batches:
                yield rows.assign(_margin=margin(rows, codes(rows), trees))

        self._write(self.rows.mapInPandas(run, self.rows.schema))
        self.known = trees

    def _model(self) -> Model:
        """As Spark's own model, from its public constructors."""
        context, nodes = self.spark.sparkContext, self.nodes
        jvm, gateway, slots = context._jvm, context._gateway, self.blocks[-1].first + (self.blocks[-1].slots or 1)
        ml, impurity = jvm.org.apache.spark.ml, jvm.org.apache.spark.mllib.tree.impurity

        def numbers(values: Sequence[float]):
            array = gateway.new_array(jvm.double, len(values))
            for i, value in enumerate(values):
                array[i] = float(value)
            return array

        def built(node: int):
            n, s, q = nodes.stats[node]
            mean = s / n if n else 0.0
            if self.boosted:
                stats, predicted, spread = impurity.VarianceCalculator(numbers((n, s, q)), int(n)), mean, max(0.0, q / n - mean**2) if n else 0.0
            else:
                stats, predicted, spread = impurity.GiniCalculator(numbers((n - s, s)), int(n)), float(2 * s > n), 2 * mean * (1 - mean)
            if nodes.split[node] is None:
                return ml.tree.LeafNode(predicted, spread, stats)
            slot, threshold, gain = nodes.split[node]
            child = nodes.child[node]
            return ml.tree.InternalNode(predicted, spread, gain * (1 if self.boosted else 2), built(child), built(child + 1), ml.tree.ContinuousSplit(slot, threshold), stats)

        kind = ml.regression.DecisionTreeRegressionModel if self.boosted else ml.classification.DecisionTreeClassificationModel
        trees = gateway.new_array(kind, len(nodes.roots))
        for i, root in enumerate(nodes.roots):
            trees[i] = kind(f"{self.classifier.uid}_{i}", built(root), slots, *[2] * (not self.boosted))
        uid = self.classifier.uid
        if self.boosted:
            model = ml.classification.GBTClassificationModel(uid, trees, numbers(self.weights), slots, 2)
        else:
            model = ml.classification.RandomForestClassificationModel(uid, trees, slots, 2)
        self.classifier._transfer_params_to_java()
        java = self.classifier._java_obj
        return (GBTClassificationModel if self.boosted else RandomForestClassificationModel)(java.copyValues(model, java.extractParamMap()))


def fit(classifier: Estimator, rows: DataFrame, found: list[Block]) -> Model:
    grower = Grower(classifier, rows, found)
    try:
        return grower.grow(classifier.getMaxIter() if grower.boosted else classifier.getNumTrees())
    finally:
        grower.close()
