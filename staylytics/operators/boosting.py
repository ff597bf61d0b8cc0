"""Boosted trees of ``pyspark.ml``, grown from sums over blocks of binned rows.

The trees are those that ``GBTRegressor`` defines: its thresholds, its draw of rows for each round, its gains and its order among
equal ones. Only how the sums are taken differs:

* Tasks keep their rows as arrays of small codes; features of few values share one code (``Layout``), so one count serves several.
* Of two sibling nodes only the smaller is counted; the other one is their parent's sums less those.
* Residuals are counted in whole steps so small that no sum of them is rounded: sums and differences are the same in any order.
* A level is one job that hands on sums for each node, feature and bin; their number depends on the model, not on the rows.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from math import frexp, prod
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.errors import IllegalArgumentException
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from staylytics.sources.staging import remove, scratch_path

#: Rows of a block, cells of a code, numbers that one lane draws, rounds after which the blocks are written and their lineage is cut,
#: and bytes of sums that the driver adds up itself.
_BLOCK_ROWS = 1 << 15
_CODE_CELLS = 1 << 8
_LANE = 5
_CUT_ROUNDS = 20
_DRIVER_BYTES = 1 << 26

_ENSEMBLE_ONLY = {"featureSubsetStrategy", "lossType", "maxIter", "stepSize", "subsamplingRate", "validationTol"}
_NODES = """treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double,
leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"""


class Layout(NamedTuple):
    """Bins of the features and the codes that hold them: ``codes`` lists the features of each code, the last one changing fastest.
    ``cuts`` are a feature's thresholds, None for a category, whose bin is its number."""

    cuts: tuple[np.ndarray | None, ...]
    bins: tuple[int, ...]
    codes: tuple[tuple[int, ...], ...]

    @staticmethod
    def of(cuts: list[np.ndarray | None], bins: list[int]) -> Layout:
        codes: list[list[int]] = []
        for f in sorted(range(len(bins)), key=lambda f: -bins[f]):
            fits = [c for c in codes if prod(bins[g] for g in c) * bins[f] <= _CODE_CELLS]
            if fits:
                min(fits, key=lambda c: prod(bins[g] for g in c)).append(f)
            else:
                codes.append([f])
        return Layout(tuple(cuts), tuple(bins), tuple(tuple(c) for c in codes))

    def cells(self, code: int) -> int:
        return prod(self.bins[f] for f in self.codes[code])

    def place(self, f: int) -> tuple[int, int]:
        """The code that holds a feature, and how many cells lie between two of its bins."""
        code = next(i for i, c in enumerate(self.codes) if f in c)
        own = self.codes[code]
        return code, prod(self.bins[g] for g in own[own.index(f) + 1 :])

    def dtype(self) -> np.dtype:
        return np.min_scalar_type(max(map(self.cells, range(len(self.codes)))) - 1)

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Codes (codes by rows) of rows (rows by features)."""
        out = np.zeros((len(self.codes), len(x)), dtype=self.dtype())
        for own, codes in zip(out, self.codes):
            for f in codes:
                cuts = self.cuts[f]
                if f != codes[0]:
                    own *= out.dtype.type(self.bins[f])
                own += (x[:, f] if cuts is None else np.searchsorted(cuts, x[:, f])).astype(out.dtype)
        return out

    def by_bin(self, code: int, sums: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Sums (nodes by cells) of a code as sums (nodes by bins) of each of its features."""
        own = self.codes[code]
        cube = sums.reshape(len(sums), *[self.bins[f] for f in own])
        for i, f in enumerate(own):
            yield f, cube.sum(axis=tuple(a + 1 for a in range(len(own)) if a != i))

    def starts(self) -> list[int]:
        """Where each feature's bins begin in a row of sums."""
        return [0, *np.cumsum(self.bins).tolist()]


class Block(NamedTuple):
    """Rows of a task: their partition and place in it, their codes, what is left to explain (``rest``), the bits of the rows drawn for
    the round, and the squares of the last round's drawn rows by leaf."""

    part: int
    start: int
    codes: np.ndarray
    rest: np.ndarray
    bits: np.ndarray
    squares: np.ndarray

    def drawn(self) -> np.ndarray:
        return np.unpackbits(self.bits, count=len(self.rest)).view(bool)


def _first_state(seed: int) -> int:
    """Where the generator behind ``rand(seed)`` begins: the seed's bytes, hashed."""
    data, words, mask = (seed & (1 << 64) - 1).to_bytes(8, "big"), [], (1 << 32) - 1
    h = 0x3C074A61
    for _ in range(2):
        for at in (0, 4):
            k = int.from_bytes(data[at : at + 4], "little") * 0xCC9E2D51 & mask
            k = (k << 15 | k >> 17) * 0x1B873593 & mask
            h = (h ^ k) & mask
            h = ((h << 13 | h >> 19) * 5 + 0xE6546B64) & mask
        h ^= 8
        h = (h ^ h >> 16) * 0x85EBCA6B & mask
        h = (h ^ h >> 13) * 0xC2B2AE35 & mask
        h ^= h >> 16
        words.append(h)
    return words[1] << 32 | words[0]


def _step(state: np.ndarray) -> np.ndarray:
    state = state ^ state << np.uint64(21)
    state ^= state >> np.uint64(35)
    state ^= state << np.uint64(4)
    return state


def _moved(state: np.ndarray, jump: np.ndarray) -> np.ndarray:
    """States after a jump, given as what becomes of each single bit: the generator is linear in its bits."""
    return np.bitwise_xor.reduce((state[:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1)) * jump, axis=1)


@lru_cache(64)
def _jump(n: int) -> np.ndarray:
    """The jump over ``2^n`` numbers, of two steps each."""
    if n == 0:
        return _step(_step(np.uint64(1) << np.arange(64, dtype=np.uint64)))
    return _moved(_jump(n - 1), _jump(n - 1))


def draws(seed: int, part: int, start: int, n: int) -> np.ndarray:
    """The numbers that ``rand(seed)`` gives a partition's ``n`` rows from place ``start`` on.

    Each row's number follows from the one before, so many lanes of ``2^_LANE`` neighbouring rows are drawn side by side.
    """
    state = np.array([_first_state(seed + part)], dtype=np.uint64)
    for i in range(start.bit_length()):
        if start >> i & 1:
            state = _moved(state, _jump(i))
    lane = _LANE
    while len(state) << _LANE < n:
        state = np.concatenate([state, _moved(state, _jump(lane))])
        lane += 1
    out = np.empty((1 << _LANE, len(state)))
    for own in out:
        state = _step(state)
        high = state & np.uint64((1 << 26) - 1)
        state = _step(state)
        own[:] = (high << np.uint64(27)) + (state & np.uint64((1 << 27) - 1))
    return out.T.reshape(-1)[:n] * 2.0**-53


@dataclass
class Growing:
    """A tree by levels: for each of a level's ``2^level`` places the tested feature (-1: none) and the bins that go right."""

    feature: list[np.ndarray] = field(default_factory=list)
    right: list[np.ndarray] = field(default_factory=list)

    def tables(self, layout: Layout) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each level, by place: the code that is looked at, and which of its cells go right."""
        cells, out = np.arange(max(map(layout.cells, range(len(layout.codes))))), []
        for feature, right in zip(self.feature, self.right):
            code, goes = np.zeros(len(feature), dtype=np.intp), np.zeros((len(feature), len(cells)), dtype=np.uint8)
            for i in np.flatnonzero(feature >= 0).tolist():
                code[i], step = layout.place(feature[i])
                goes[i] = right[i].take(cells // step % layout.bins[feature[i]])
            out.append((code, goes))
        return out


def _places(codes: np.ndarray, tables: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Each row's place below the last level. What is not split goes to the left."""
    n = codes.shape[1]
    flat, row, place = codes.reshape(-1), np.arange(n), np.zeros(n, dtype=np.intp)
    for code, goes in tables:
        at = (code * n).take(place)
        at += row
        cell = place * goes.shape[1]
        cell += flat.take(at)
        place *= 2
        place += goes.reshape(-1).take(cell)
    return place


def _sums(blocks: Iterator[Block], tree: Growing, slots: np.ndarray, scale: float, layout: Layout) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Count and sum (2 by nodes by bins of all features) of the drawn rows at the places that have a slot, and the blocks' squares."""
    many = int(slots.max()) + 1
    held = [np.zeros((2, many * layout.cells(c))) for c in range(len(layout.codes))]
    tables, squares = tree.tables(layout), 0.0
    for block in blocks:
        slot = slots.take(_places(block.codes, tables))
        some = np.flatnonzero((slot >= 0) & block.drawn())
        slot, steps = slot.take(some), np.rint(block.rest.take(some) * scale)
        for c, total in enumerate(held):
            at = slot * layout.cells(c)
            at += block.codes[c].take(some)
            total[0] += np.bincount(at, minlength=total.shape[1])
            total[1] += np.bincount(at, steps, minlength=total.shape[1])
        squares = squares + block.squares
    starts = layout.starts()
    out = np.empty((2, many, starts[-1]))
    for c, total in enumerate(held):
        for side, own in zip(out, total):
            for f, sums in layout.by_bin(c, own.reshape(many, -1)):
                side[:, starts[f] : starts[f + 1]] = sums
    yield out, squares


def _drawn(seed: int, rate: float, part: int, start: int, n: int) -> np.ndarray:
    """The rows that a round learns from, as bits."""
    return np.packbits(np.ones(n, dtype=bool) if rate == 1.0 else draws(seed, part, start, n) < rate)


def _next(block: Block, tree: Growing, values: np.ndarray, weight: float, first: bool, draw: tuple[int, float], layout: Layout) -> Block:
    """What the grown tree leaves to explain, twice the error (the negative gradient of the squared error), with the next round's draw."""
    place = _places(block.codes, tree.tables(layout))
    drawn = block.drawn()
    squares = np.bincount(place[drawn], np.square(block.rest[drawn]), minlength=len(values))
    rest = 2.0 * (block.rest - values.take(place)) if first else block.rest - (2.0 * weight * values).take(place)
    return Block(block.part, block.start, block.codes, rest, _drawn(*draw, block.part, block.start, len(rest)), squares)


def _best(sums: np.ndarray, layout: Layout, least: int, gain_least: float) -> tuple[np.ndarray, ...]:
    """Best split of each node out of its sums (2 by nodes by bins): feature (-1: none), gain, bins that go right, and count and sum left."""
    count, total = sums
    starts = layout.starts()
    nodes = np.arange(count.shape[0])
    n, s = (side[:, starts[0] : starts[1]].sum(axis=1, keepdims=True) for side in sums)
    feature, best = np.full(len(nodes), -1), np.full(len(nodes), -1.0)
    right = np.zeros((len(nodes), max(layout.bins)), dtype=bool)
    left = np.zeros((2, len(nodes)))
    for f, (start, bins) in enumerate(zip(starts, layout.bins)):
        if bins < 2:
            continue
        c, t = count[:, start : start + bins], total[:, start : start + bins]
        order = np.broadcast_to(np.arange(bins), c.shape)
        if layout.cuts[f] is None:  # by mean; categories without rows last
            order = np.argsort(np.where(c > 0, t / np.maximum(c, 1), np.inf), axis=1, kind="stable")
            c, t = np.take_along_axis(c, order, axis=1), np.take_along_axis(t, order, axis=1)
        c, t = c.cumsum(axis=1)[:, :-1], t.cumsum(axis=1)[:, :-1]
        d = n - c
        gap = t / np.maximum(c, 1) - (s - t) / np.maximum(d, 1)
        gain = np.where((c >= least) & (d >= least), c * d / np.square(np.maximum(n, 1)) * np.square(gap), -1.0)
        at = gain.argmax(axis=1)
        better = gain[nodes, at] > best
        feature[better], best[better] = f, gain[nodes, at][better]
        side = np.zeros((len(nodes), bins), dtype=bool)
        np.put_along_axis(side, order, np.arange(bins) > at[:, None], axis=1)
        right[better] = False
        right[better, :bins] = side[better]
        left[:, better] = c[nodes, at][better], t[nodes, at][better]
    feature[(best <= 0) | (best < gain_least)] = -1
    return feature, best, right, left


class Node(NamedTuple):
    """A node's rows and the sum of their steps; its split (feature -1: none), the split's gain, and the bins that go right."""

    count: float
    total: float
    gain: float
    feature: int
    right: np.ndarray

    def mean(self, scale: float) -> float:
        return self.total / scale / self.count if self.count else 0.0


class HistogramBoosting(GBTRegressor):
    """``GBTRegressor`` for large tables: the same parameters, the same kind of model.

    ``columns`` may name the columns that the features were assembled from; then no vectors are made for the rows to learn from.
    """

    columns: Sequence[str] = ()

    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        same = self.getLossType() == "squared" and self.getFeatureSubsetStrategy() == "all" and self.getMinWeightFractionPerNode() == 0.0
        if not same or not self.getMaxDepth() or any(self.isDefined(p) for p in (self.weightCol, self.validationIndicatorCol)):
            return super()._fit(dataset)
        label, features = self.getLabelCol(), self.getFeaturesCol()
        x = F.array(*[F.col(c).cast("double") for c in self.columns]) if self.columns else vector_to_array(features)
        rows = dataset.select(F.col(label).cast("double").alias("y"), x.alias("x"))
        odd = F.sum(F.when(F.col("y").isNull() | F.isnan("y") | (F.abs("y") == float("inf")), 1).otherwise(0))
        n, most, wrong = rows.agg(F.count(F.lit(1)), F.max(F.abs("y")), odd).first()
        if not n or wrong:
            raise IllegalArgumentException(f"{n} rows to learn from, {wrong or 0} of them with a label that is missing or not finite")
        layout = self._layout(rows, dataset.schema[features].metadata, n)
        nodes = self._rounds(dataset.sparkSession, self._blocks(rows, layout), layout, n, most)
        return self._copyValues(self._model(dataset.sparkSession, nodes, len(layout.bins)))

    def _layout(self, rows: DataFrame, metadata: dict, n: int) -> Layout:
        """Thresholds between the values of a sample of some 10,000 rows, at about equal distances in rows; a category's bins are its values."""
        bins = min(self.getMaxBins(), n)
        attrs = metadata.get("ml_attr", {}).get("attrs", {})
        arity = {a["idx"]: len(a["vals"]) if "vals" in a else a["num_vals"] for a in attrs.get("nominal", []) if "vals" in a or "num_vals" in a}
        arity |= {a["idx"]: 2 for a in attrs.get("binary", [])}
        if any(many > bins for many in arity.values()):
            raise IllegalArgumentException(f"maxBins ({bins} for {n} rows) must be at least {max(arity.values())}, the most values of a category")
        wanted = max(self.getMaxBins() ** 2, 10_000)
        share = min(1.0, wanted / n)
        sample = rows.select("x")
        if share < 1.0:  # drawn in the JVM as pyspark.ml draws it: the same rows
            spark, first = rows.sparkSession, int(_step(np.array([_first_state(self.getSeed())], dtype=np.uint64))[0]) & (1 << 32) - 1
            drawn = sample._jdf.toJavaRDD().sample(False, share, first - (first >> 31 << 32))
            sample = DataFrame(spark._jsparkSession.createDataFrame(drawn, sample._jdf.schema()), spark)
        x = np.array([r["x"] for r in sample.collect()])
        cuts = [None if f in arity else _thresholds(x[:, f], share * n, bins) for f in range(x.shape[1])]
        return Layout.of(cuts, [arity[f] if c is None else len(c) + 1 for f, c in enumerate(cuts)])

    def _blocks(self, rows: DataFrame, layout: Layout) -> RDD:
        draw = self.getSeed() + 1, self.getSubsamplingRate()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def block() -> pa.RecordBatch:
                codes, rest = np.concatenate([c for c, _ in held], axis=1), np.concatenate([y for _, y in held])
                cells = [TaskContext.get().partitionId(), start, codes.tobytes(), rest.tobytes()]
                return pa.RecordBatch.from_arrays([pa.array([c]) for c in cells], ["part", "start", "codes", "rest"])

            start, held = 0, []
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                if not np.isfinite(x).all():
                    raise ValueError("features must not be missing or infinite")
                held.append((layout.encode(x), batch.column("y").to_numpy(zero_copy_only=False)))
                if sum(len(y) for _, y in held) >= _BLOCK_ROWS:
                    yield block()
                    start += sum(len(y) for _, y in held)
                    held.clear()
            if held:
                yield block()

        def unpacked(row: Row) -> Block:
            rest = np.frombuffer(bytes(row["rest"]))
            codes = np.frombuffer(bytes(row["codes"]), layout.dtype()).reshape(len(layout.codes), -1)
            return Block(row["part"], row["start"], codes, rest, _drawn(*draw, row["part"], row["start"], len(rest)), np.zeros(1))

        packed = rows.mapInArrow(run, "part long, start long, codes binary, rest binary")
        return packed.rdd.map(unpacked).persist(StorageLevel.MEMORY_AND_DISK_DESER)

    def _rounds(self, spark: SparkSession, blocks: RDD, layout: Layout, n: int, most: float) -> list[list[tuple]]:
        """Every tree's nodes as rows of the model's table. A round's blocks are made by the next one's first job."""
        context, trees, held, written = blocks.context, [], [], ""
        grown: tuple = ()
        for m in range(self.getMaxIter()):
            scale = 2.0 ** (52 - frexp(n)[1] - frexp(most)[1])  # a sum of n rests stays below 2^52 steps
            tree, nodes, squares = self._grow(blocks, layout, scale)
            if m:
                trees.append(_table(*grown, layout, squares))
            held = _released(held)
            if blocks.getCheckpointFile():
                if written:
                    remove(spark, written)
                written = blocks.getCheckpointFile()
            depth = len(tree.feature)
            values = np.zeros(1 << depth)
            for (level, place), node in nodes.items():
                if node.feature < 0:
                    values[place << depth - level] = node.mean(scale)
            grown, weight, peak = (nodes, scale, depth), self._weight(m), float(np.abs(values).max())
            most = 2.0 * (most + peak) if m == 0 else most + 2.0 * weight * peak
            shared = context.broadcast((tree, values))
            draw = self.getSeed() + m + 2, self.getSubsamplingRate()
            after = blocks.map(lambda b, shared=shared, weight=weight, first=m == 0, draw=draw: _next(b, *shared.value, weight, first, draw, layout))
            after = after.persist(StorageLevel.MEMORY_AND_DISK_DESER)
            if (m + 1) % _CUT_ROUNDS == 0:
                if not context.getCheckpointDir():
                    context.setCheckpointDir(scratch_path(spark, "checkpoints"))
                after.checkpoint()
            held.append(blocks)
            blocks = after
        trees.append(_table(*grown, layout, blocks.map(lambda b: b.squares).reduce(np.add)))
        _released([*held, blocks])
        for path in {written, blocks.getCheckpointFile()} - {"", None}:
            remove(spark, path)
        return trees

    def _weight(self, m: int) -> float:
        return self.getStepSize() if m else 1.0

    def _grow(self, blocks: RDD, layout: Layout, scale: float) -> tuple[Growing, dict[tuple[int, int], Node], np.ndarray]:
        """The round's tree, its nodes by (level, place), and the squares of the round before by leaf."""
        tree, nodes = Growing(), {}
        squares, parent = np.zeros(1), np.empty(0)
        places, small = [0], np.zeros(1, dtype=int)  # to split at this level; those whose rows are counted
        for level in range(self.getMaxDepth()):
            slots = np.full(1 << level, -1, dtype=np.intp)
            slots[small] = np.arange(len(small))
            found, squared = _collected(blocks, tree, slots, scale, layout)
            if level == 0:
                sums, squares = found, squared
                total = found[:, 0, : layout.bins[0]].sum(axis=1)
                known = {0: (float(total[0]), float(total[1]))}
            else:  # a sibling is the parent less the counted one
                sums = np.empty((2, len(places), found.shape[2]))
                for i, place in enumerate(places):
                    sums[:, i] = found[:, slots[place]] if slots[place] >= 0 else parent[:, i // 2] - found[:, slots[place ^ 1]]
            feature, gain, right, left = _best(sums, layout, self.getMinInstancesPerNode(), self.getMinInfoGain() * scale**2)
            features, rights = np.full(1 << level, -1), np.zeros((1 << level, right.shape[1]), dtype=bool)
            after, split, small = {}, [], []
            for i, place in enumerate(places):
                count, total = known[place]
                nodes[level, place] = Node(count, total, float(gain[i]) / scale**2, int(feature[i]), right[i])
                if feature[i] >= 0:
                    features[place], rights[place] = feature[i], right[i]
                    a, b = 2 * place, 2 * place + 1
                    after[a] = float(left[0, i]), float(left[1, i])
                    after[b] = count - after[a][0], total - after[a][1]
                    split.append(i)
                    small.append(a if after[a][0] <= after[b][0] else b)
            if not split:
                break
            tree.feature.append(features)
            tree.right.append(rights)
            parent, known, places, small = sums[:, split], after, sorted(after), np.array(small, dtype=int)
        for place in places:
            if (len(tree.feature), place) not in nodes:
                nodes[len(tree.feature), place] = Node(*known[place], -1.0, -1, np.empty(0))
        return tree, nodes, squares

    def _model(self, spark: SparkSession, trees: list[list[tuple]], features: int) -> GBTRegressionModel:
        """The model as pyspark.ml stores it, read back."""
        path = scratch_path(spark, "boosted")
        own = [{p.name: v for p, v in values.items()} for values in (self._paramMap, self._defaultParamMap)]
        of_tree = [{name: v for name, v in values.items() if name not in _ENSEMBLE_ONLY} for values in own]

        def about(name: str, uid: str, values: list[dict], **more) -> str:
            told = {"class": f"org.apache.spark.ml.regression.{name}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid}
            return json.dumps(told | {"paramMap": values[0], "defaultParamMap": values[1], "numFeatures": features} | more)

        metadata = [(about("GBTRegressionModel", self.uid, own, numTrees=len(trees)),)]
        single = [(m, about("DecisionTreeRegressionModel", f"{self.uid}_{m}", of_tree), self._weight(m)) for m in range(len(trees))]
        spark.createDataFrame(metadata, "value string").coalesce(1).write.text(f"{path}/metadata")
        spark.createDataFrame(single, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        nodes = [(m, node) for m, tree in enumerate(trees) for node in tree]
        spark.createDataFrame(nodes, _NODES, verifySchema=False).coalesce(1).write.parquet(f"{path}/data")
        return GBTRegressionModel.load(path)


def _released(held: list[RDD]) -> list[RDD]:
    for blocks in held:
        blocks.unpersist()
    return []


def _collected(blocks: RDD, tree: Growing, slots: np.ndarray, scale: float, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
    shared = blocks.context.broadcast((tree, slots))
    parts = blocks.mapPartitions(lambda own: _sums(own, *shared.value, scale, layout))
    size = 16 * (int(slots.max()) + 1) * sum(layout.bins) * blocks.getNumPartitions()
    found = parts.treeReduce(lambda a, b: (a[0] + b[0], a[1] + b[1]), depth=1 if size <= _DRIVER_BYTES else 2)
    shared.unpersist()
    return found


def _thresholds(values: np.ndarray, expected: float, bins: int) -> np.ndarray:
    """Thresholds between distinct values: all of them, or those nearest to steps of equal numbers of rows."""
    found, count = np.unique(values[values != 0.0], return_counts=True)
    count = count.astype(float)
    if expected - len(values[values != 0.0]) > np.finfo(float).eps * expected * expected:  # the rest is zero
        at = np.searchsorted(found, 0.0)
        found, count = np.insert(found, at, 0.0), np.insert(count, at, expected - count.sum())
    middle = (found[:-1] + found[1:]) / 2.0
    if len(middle) <= bins - 1:
        return middle
    step, upto = expected / bins, np.cumsum(count)
    out, target = [], step
    for i in range(1, len(found)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            out.append(middle[i - 1])
            target += step
    return np.array(out)


def _table(nodes: dict[tuple[int, int], Node], scale: float, depth: int, layout: Layout, squares: np.ndarray) -> list[tuple]:
    """A tree's nodes as the model's table has them, numbered from the root, left before right."""
    out: list[tuple] = []

    def squared(level: int, place: int) -> float:
        width = 1 << depth - level
        return float(squares[place * width : (place + 1) * width].sum())

    def put(level: int, place: int) -> tuple[int, bool]:
        node, number = nodes[level, place], len(out)
        mean, stats = node.mean(scale), [node.count, node.total / scale, squared(level, place)]
        impurity = max(0.0, stats[2] / node.count - mean * mean) if node.count else 0.0
        leaf = (number, mean, impurity, stats, int(node.count), -1.0, -1, -1, (-1, [], -1))
        out.append(leaf)
        if node.feature >= 0:
            left, plain = put(level + 1, 2 * place)
            right, also = put(level + 1, 2 * place + 1)
            if plain and also and out[left][1] == out[right][1]:  # leaves that say the same are one
                del out[left:]
                return number, True
            f, cuts = node.feature, layout.cuts[node.feature]
            kept = np.flatnonzero(~node.right[: layout.bins[f]])
            test = (f, [float(cuts[kept[-1]])], -1) if cuts is not None else (f, kept.astype(float).tolist(), layout.bins[f])
            out[number] = (*leaf[:5], node.gain, left, right, test)
            return number, False
        return number, True

    put(0, 0)
    return out
