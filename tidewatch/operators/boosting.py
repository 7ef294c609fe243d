"""Boosted trees fitted from histograms of packed bins.

``BoostedTrees`` is Spark's ``GBTClassifier`` with its parameters and models; only the fit differs in
how it goes over the rows. Spark keeps an object per row and updates statistics value by value; here a
row is a byte per feature, rows lie in blocks by feature, and a pass of a tree adds up whole blocks.
The thresholds, the rows drawn for each tree, the statistics and the choice of splits are Spark's; sums of
the most frequent bin differ in their last digits, so splits that part the rows alike may be told apart otherwise.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

# Rows of one block.
BLOCK_ROWS = 65_536
# Trees after which margins are added up anew.
_CHAIN = 8
# Rows up to which Spark's own fit is the faster one: passes over blocks cost more to start.
_FEW_ROWS = 1_500_000
# Partitions whose histograms are added up by the driver.
_FEW = 32
# Rows that thresholds are found from, as Spark has it.
_SAMPLED = 10_000
_EPSILON = 2.0**-52


class BoostedTrees(GBTClassifier):
    """``GBTClassifier`` whose trees are grown from blocks of bins.

    Fits of few rows or with weights, validation rows, categories or trees too deep or fine for bytes are
    Spark's own.
    """

    def _fit_java(self, dataset: DataFrame):
        trees = self._grown(dataset) if self._in_bytes(dataset) else None
        if trees is None:
            return super()._fit_java(dataset)
        self._transfer_params_to_java()
        return _java_model(dataset, self._java_obj.uid(), trees, self.getStepSize(), _width(dataset, self.getFeaturesCol()))

    def _in_bytes(self, dataset: DataFrame) -> bool:
        if self.isSet("weightCol") or self.isSet("validationIndicatorCol"):
            return False
        if self.getFeatureSubsetStrategy() != "all" or self.getMinWeightFractionPerNode() != 0 or self.getLossType() != "logistic":
            return False
        return self.getMaxBins() <= 256 and self.getMaxDepth() <= 7 and bool(_width(dataset, self.getFeaturesCol()))

    def _grown(self, dataset: DataFrame) -> list[Split] | None:
        label = F.col(self.getLabelCol()).cast("double")
        known = F.coalesce(label.isin(0.0, 1.0), F.lit(False))
        n, wrong = dataset.agg(F.count(F.lit(1)), F.count_if(~known)).first()
        if n <= _FEW_ROWS or wrong:
            return None  # Spark's own fit also tells what is wrong
        rows = dataset.select(label.alias("label"), vector_to_array(F.col(self.getFeaturesCol())).alias("x"))
        seed, bins = self.getSeed(), min(self.getMaxBins(), n)
        thresholds = _thresholds(rows, n, bins, max(self.getMaxBins() ** 2, _SAMPLED), seed)
        blocks = _blocks(rows, thresholds).persist(StorageLevel.MEMORY_AND_DISK_DESER)
        trees, added, held = [], [], blocks
        try:
            for m in range(self.getMaxIter()):
                # Margins go on from those ahead of the last tree, and now and then from none, which keeps lineages short.
                since = 0 if m % _CHAIN == 0 else m - 1
                source = blocks if since == 0 else held
                ahead = source.mapPartitionsWithIndex(_advance(added[since:], self.getSubsamplingRate(), seed + m)).persist(StorageLevel.MEMORY_AND_DISK_DESER)
                held, past = ahead, held
                trees.append(_tree(ahead, thresholds, self.getMaxDepth(), self.getMinInstancesPerNode(), self.getMinInfoGain()))
                added.append(_places_of(trees[-1], thresholds, self.getMaxDepth(), self.getStepSize() if m else 1.0))
                if past is not blocks:
                    past.unpersist()
        finally:
            held.unpersist()
            blocks.unpersist()
        return trees


def _width(dataset: DataFrame, features: str) -> int:
    """Features of the vector column, 0 where it is not known to hold numbers only."""
    known = dataset.schema[features].metadata.get("ml_attr", {})
    if {"nominal", "binary"} & set(known.get("attrs", {})):
        return 0
    return known.get("num_attrs", 0) or sum(map(len, known.get("attrs", {}).values()))


# --- random numbers ---------------------------------------------------------

_M32, _M64 = 2**32 - 1, 2**64 - 1
# Steps of one lane of states.
_LANE = 256


def _murmur(data: bytes, seed: int) -> int:
    def turned(v: int, by: int) -> int:
        return ((v << by) | (v >> (32 - by))) & _M32

    h = seed
    for at in range(0, len(data), 4):
        k = int.from_bytes(data[at : at + 4], "little") * 0xCC9E2D51 & _M32
        h = turned(h ^ (turned(k, 15) * 0x1B873593 & _M32), 13) * 5 + 0xE6546B64 & _M32
    h ^= len(data)
    h = (h ^ (h >> 16)) * 0x85EBCA6B & _M32
    h = (h ^ (h >> 13)) * 0xC2B2AE35 & _M32
    return h ^ (h >> 16)


def _step(s: int) -> int:
    s ^= (s << 21) & _M64
    s ^= s >> 35
    return s ^ ((s << 4) & _M64)


@cache
def _jump() -> list[list[int]]:
    """The state ``_LANE`` steps on, by bytes of a state: a step is linear in its bits."""
    images = []
    for bit in range(64):
        s = 1 << bit
        for _ in range(_LANE):
            s = _step(s)
        images.append(s)
    tables = []
    for byte in range(8):
        table = [0] * 256
        for v in range(1, 256):
            low = v & -v
            table[v] = table[v ^ low] ^ images[8 * byte + low.bit_length() - 1]
        tables.append(table)
    return tables


class Draws:
    """Spark's ``XORShiftRandom``, many numbers at a time."""

    def __init__(self, seed: int):
        data = (seed & _M64).to_bytes(8, "big")
        low = _murmur(data, 0x3C074A61)
        self._state = (_murmur(data, low) << 32) | low

    def _states(self, count: int) -> np.ndarray:
        starts, s = [], self._state
        for _ in range(-(-count // _LANE)):
            starts.append(s)
            on = 0
            for table in _jump():
                on ^= table[s & 255]
                s >>= 8
            s = on
        lanes = np.array(starts, np.uint64)
        out = np.empty((_LANE, len(starts)), np.uint64)
        for row in out:
            lanes = lanes ^ (lanes << np.uint64(21))
            lanes ^= lanes >> np.uint64(35)
            lanes ^= lanes << np.uint64(4)
            row[:] = lanes
        states = out.T.ravel()[:count]
        self._state = int(states[-1])
        return states

    def integer(self) -> int:
        v = int(self._states(1)[0]) & _M32
        return v - 2**32 if v >= 2**31 else v

    def doubles(self, n: int) -> np.ndarray:
        if n == 0:
            return np.empty(0)
        pairs = self._states(2 * n).reshape(n, 2)
        high, low = pairs[:, 0] & np.uint64(2**26 - 1), pairs[:, 1] & np.uint64(2**27 - 1)
        return ((high << np.uint64(27)) + low).astype(float) * 2.0**-53


def _java_longs(seed: int) -> Iterator[int]:
    """Numbers of ``java.util.Random``."""
    s = (seed ^ 0x5DEECE66D) & (2**48 - 1)
    while True:
        halves = []
        for _ in range(2):
            s = (s * 0x5DEECE66D + 0xB) & (2**48 - 1)
            v = s >> 16
            halves.append(v - 2**32 if v >= 2**31 else v)
        yield (halves[0] << 32) + halves[1]


class _Picked:
    """Rows of one partition that ``RDD.sample`` picks, block by block."""

    def __init__(self, fraction: float, seed: int, partition: int):
        longs = _java_longs(seed)
        for _ in range(partition):
            next(longs)
        self._fraction, self._draws, self._seen = fraction, Draws(next(longs)), 0
        if fraction <= 0.4:
            self._next = self._gap()

    def _gap(self) -> int:
        u = max(float(self._draws.doubles(1)[0]), 5e-11)
        return int(math.log(u) / math.log1p(-self._fraction))

    def of(self, n: int) -> np.ndarray:
        if self._fraction >= 1:
            return np.arange(n)
        if self._fraction > 0.4:
            return np.flatnonzero(self._draws.doubles(n) <= self._fraction)
        found = []
        while self._next < self._seen + n:
            found.append(self._next - self._seen)
            self._next += 1 + self._gap()
        self._seen += n
        return np.array(found, np.intp)


# --- bins -------------------------------------------------------------------


def _values(batch) -> np.ndarray:
    """Features of a batch, a row for each of its rows."""
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _thresholds(rows: DataFrame, n: int, bins: int, wanted: int, seed: int) -> list[np.ndarray]:
    """Rising thresholds of every feature, from all rows or about ``wanted`` sampled ones."""
    import pyarrow as pa

    fraction = min(1.0, wanted / n)
    by = Draws(seed).integer()

    def pick(batches):
        picked = _Picked(fraction, by, TaskContext.get().partitionId())
        for batch in batches:
            at = picked.of(batch.num_rows) if batch.num_rows else ()
            if len(at):
                yield pa.record_batch([pa.array([_values(batch)[at].tobytes()], pa.binary()), pa.array([len(at)], pa.int64())], names=["x", "n"])

    found = rows.mapInArrow(pick, "x binary, n long").collect()
    if not found:
        return [np.empty(0)] * _first_width(rows)
    sampled = np.concatenate([np.frombuffer(r["x"]).reshape(r["n"], -1) for r in found])
    return [thresholds(column, fraction * n, bins) for column in sampled.T]


def _first_width(rows: DataFrame) -> int:
    return len(rows.first()["x"])


def thresholds(sampled: np.ndarray, n: float, bins: int) -> np.ndarray:
    """Thresholds of one feature, at most ``bins - 1``: between all values, or about equally many rows apart.

    Values that were sampled stand for ``n`` rows; those missing from them are zeros.
    """
    values, counts = np.unique(sampled[sampled != 0.0], return_counts=True)
    if not len(values):
        return np.empty(0)
    rest = n - float(counts.sum())
    weights = counts.astype(float)
    if rest > _EPSILON * int(counts.sum()) * 100:
        at = int(np.searchsorted(values, 0.0))
        values, weights = np.insert(values, at, 0.0), np.insert(weights, at, rest)
    if len(values) == 1:
        return np.empty(0)
    between = (values[:-1] + values[1:]) / 2
    if len(between) <= bins - 1:
        return between
    stride = n / bins
    found, target, total = [], stride, float(weights[0])
    for at, w in enumerate(weights[1:].tolist()):
        before, total = total, total + w
        if abs(before - target) < abs(total - target):
            found.append(between[at])
            target += stride
    return np.array(found)


@dataclass(frozen=True)
class Block:
    """Bins of at most ``BLOCK_ROWS`` rows: per feature the usual bin, and the places and bins of rows with another."""

    ends: np.ndarray
    at: np.ndarray
    bins: np.ndarray
    usual: np.ndarray
    signs: np.ndarray

    def others(self, feature: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.ends[feature], self.ends[feature + 1])
        return self.at[part], self.bins[part]

    def column(self, feature: int) -> np.ndarray:
        at, bins = self.others(feature)
        out = np.full(len(self.signs), self.usual[feature])
        out[at] = bins
        return out


_BLOCK = {"ends": np.int32, "at": np.uint16, "bins": np.uint8, "usual": np.uint8, "signs": np.int8}


def packed(bins: np.ndarray, signs: np.ndarray) -> Block:
    """A block from bins by feature."""
    usual = np.array([np.bincount(b).argmax() for b in bins], np.uint8)
    places = [np.flatnonzero(b != u) for b, u in zip(bins, usual)]
    ends = np.cumsum([0, *map(len, places)], dtype=np.int32)
    others = np.concatenate([b[at] for b, at in zip(bins, places)])
    return Block(ends, np.concatenate(places).astype(np.uint16), others, usual, signs.astype(np.int8))


def _blocks(rows: DataFrame, thresholds: Sequence[np.ndarray]) -> RDD:
    """Blocks in the order of the rows, with no margins nor drawn rows yet."""
    import pyarrow as pa

    def written(held):
        block = packed(np.concatenate([b for b, _ in held], axis=1), np.concatenate([s for _, s in held]))
        return pa.record_batch([pa.array([getattr(block, c).tobytes()], pa.binary()) for c in _BLOCK], names=list(_BLOCK))

    def pack(batches):
        held, count = [], 0
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(start, BLOCK_ROWS)
                if count + batch.num_rows > BLOCK_ROWS:
                    yield written(held)
                    held, count = [], 0
                x = np.ascontiguousarray(_values(batch).T)
                bins = np.array([np.searchsorted(t, v) for t, v in zip(thresholds, x)], np.uint8)
                held.append((bins, 2 * batch.column("label").to_numpy() - 1))
                count += batch.num_rows
        if held:
            yield written(held)

    def block(row):
        return Block(*[np.frombuffer(row[c], kind) for c, kind in _BLOCK.items()]), None, None

    return rows.mapInArrow(pack, ", ".join(f"{c} binary" for c in _BLOCK)).rdd.map(block)


# --- trees ------------------------------------------------------------------


@dataclass
class Split:
    """A node: its statistics (rows, sum, sum of squares) and, of an inner one, what it asks for."""

    stats: tuple[float, float, float]
    impurity: float
    gain: float = 0.0
    feature: int = -1
    threshold: float = 0.0
    left: Split | None = None
    right: Split | None = None

    @property
    def prediction(self) -> float:
        return self.stats[1] / self.stats[0] if self.stats[0] else 0.0


def _places(block: Block, levels: Sequence[dict[int, tuple[int, int]]]) -> np.ndarray:
    """Where each row is after the levels, counted from the left; a leaf's rows go on to the left."""
    at = np.zeros(len(block.signs), np.uint8)
    columns = {f: block.column(f) for f in {f for level in levels for f, _ in level.values()}}
    for level in levels:
        right = np.zeros(len(at), bool)
        for place, (feature, last) in level.items():
            right |= (at == place) & (columns[feature] > last)
        at = (at << 1) | right
    return at


def _places_of(tree: Split, thresholds: Sequence[np.ndarray], depth: int, weight: float):
    """A tree as levels of (place: feature, last bin to the left) and what it adds by place."""
    levels: list[dict[int, tuple[int, int]]] = [{} for _ in range(depth)]
    values = np.zeros(2**depth)
    open_ = [(tree, 0, 0)]
    while open_:
        node, level, place = open_.pop()
        if node.left is None:
            values[place << (depth - level)] = node.prediction * weight
            continue
        levels[level][place] = (node.feature, int(np.searchsorted(thresholds[node.feature], node.threshold)))
        open_ += [(node.left, level + 1, 2 * place), (node.right, level + 1, 2 * place + 1)]
    return levels, values


def _advance(trees: Sequence, rate: float, seed: int):
    """Adds trees to the rows' margins and draws the rows of the next one."""

    def run(partition, blocks):
        draws = Draws(seed + partition + 1)
        for block, margin, _ in blocks:
            for levels, values in trees:
                added = values[_places(block, levels)]
                margin = added if margin is None else margin + added
            n = len(block.signs)
            yield block, margin, draws.doubles(n) < rate if rate < 1 else np.ones(n, bool)

    return run


def _histograms(levels: Sequence[dict[int, tuple[int, int]]], open_: Sequence[int], width: int):
    """Per open node of the last level: rows, sum and sum of squares by feature and bin.

    The usual bin has what the others leave of the node.
    """

    def run(blocks):
        total, nodes = None, len(open_)
        slots = np.full(2 ** len(levels), nodes, np.intp)
        slots[list(open_)] = np.arange(nodes)
        # Written again and again: fresh arrays of this size cost more than what is done with them.
        places, bins, values, squares = np.empty(BLOCK_ROWS, np.intp), np.empty(BLOCK_ROWS, np.intp), np.empty(BLOCK_ROWS), np.empty(BLOCK_ROWS)
        for block, margin, drawn in blocks:
            if total is None:
                total = np.zeros((3, len(block.usual), nodes, width))
            y = block.signs.astype(float)
            if margin is not None:
                y = 4.0 * y / (1.0 + np.exp(2.0 * y * margin))
            # Rows that are not drawn or at no open node go to one node more.
            slot = np.where(drawn, slots[_places(block, levels)], nodes)
            base = slot * width
            whole = np.array([np.bincount(slot, w, nodes + 1)[:nodes] for w in (None, y, y * y)])
            for f, usual in enumerate(block.usual):
                at, other = block.others(f)
                k = len(at)
                np.copyto(places[:k], at)
                np.take(base, places[:k], out=bins[:k], mode="clip")
                np.take(y, places[:k], out=values[:k], mode="clip")
                np.add(bins[:k], other, out=bins[:k])
                np.multiply(values[:k], values[:k], out=squares[:k])
                found = [np.bincount(bins[:k], w, (nodes + 1) * width) for w in (None, values[:k], squares[:k])]
                found = np.array(found).reshape(3, nodes + 1, width)[:, :nodes]
                rest = whole - found.sum(axis=2)
                found[:, :, usual] = np.where(rest[0] == 0, 0.0, rest)
                total[:, f] += found
        if total is not None:
            for k, place in enumerate(open_):
                yield place, total[:, :, k]

    return run


def _variance(stats: np.ndarray) -> np.ndarray:
    n, s, q = stats
    some = np.where(n == 0, 1.0, n)
    return np.where(n == 0, 0.0, (q - s * s / some) / some)


def _best(found: np.ndarray, splits: np.ndarray, node: Split | None, least: int, least_gain: float) -> tuple[Split, Split, Split]:
    """The node with its best split and the children; without feature if no split is allowed."""
    sums = found.cumsum(axis=2)
    left, whole = sums[:, :, :-1], sums[:, :, -1:]
    right = whole - left
    allowed = np.arange(left.shape[2])[None, :] < splits[:, None]
    if node is None:
        f = int(np.argmax(splits > 0))
        stats = left[:, f, 0] + right[:, f, 0] if allowed.any() else whole[:, 0, 0]
        node = Split(tuple(stats.tolist()), float(_variance(stats)))
    if not allowed.any():
        return node, node, node
    both = left[0] + right[0]
    some = np.where(both == 0, 1.0, both)
    low, high = _variance(left), _variance(right)
    gain = node.impurity - left[0] / some * low - right[0] / some * high
    gain = np.where(allowed & (left[0] >= least) & (right[0] >= least) & (gain >= least_gain), gain, -np.inf)
    f, at = np.unravel_index(int(np.argmax(gain)), gain.shape)
    if not gain[f, at] > 0:
        node.impurity = node.impurity if gain[f, at] == 0 else -1.0
        return node, node, node
    node.gain, node.feature, node.threshold = float(gain[f, at]), int(f), int(at)
    return node, Split(tuple(left[:, f, at].tolist()), float(low[f, at])), Split(tuple(right[:, f, at].tolist()), float(high[f, at]))


def _tree(blocks: RDD, thresholds: Sequence[np.ndarray], depth: int, least: int, least_gain: float) -> Split:
    splits = np.array([len(t) for t in thresholds])
    width = int(splits.max(initial=0)) + 2
    root = None
    levels: list[dict[int, tuple[int, int]]] = []
    open_: dict[int, Split | None] = {0: None}
    while open_ and len(levels) < max(depth, 1):
        run = _histograms(levels, sorted(open_), width)
        found = _summed(blocks.mapPartitions(run), len(open_))
        asked, ahead = {}, {}
        for place in sorted(open_):
            node, low, high = _best(found[place], splits if depth else 0 * splits, open_[place], least, least_gain)
            root = root or node
            if node.feature < 0:
                continue
            asked[place] = (node.feature, node.threshold)
            node.threshold = float(thresholds[node.feature][node.threshold])
            node.left, node.right = low, high
            if len(levels) + 1 < depth:
                ahead |= {2 * place + k: c for k, c in enumerate((low, high)) if abs(c.impurity) >= _EPSILON}
        levels.append(asked)
        open_ = ahead
    return _pruned(root)


def _summed(found: RDD, nodes: int) -> dict[int, np.ndarray]:
    """Histograms by node, of all partitions."""
    parts = found.getNumPartitions()
    if parts > _FEW:
        found = found.reduceByKey(np.add, min(nodes, parts))
    total: dict[int, np.ndarray] = {}
    for place, histogram in found.collect():
        total[place] = total[place] + histogram if place in total else histogram
    return total


def _pruned(node: Split) -> Split:
    """Leaves of one prediction under the same node are one leaf."""
    if node.left is None:
        return node
    node.left, node.right = _pruned(node.left), _pruned(node.right)
    if node.left.left is None and node.right.left is None and node.left.prediction == node.right.prediction:
        return Split((node.stats[0], node.stats[1], node.stats[2]), node.impurity)
    return node


def _java_model(dataset: DataFrame, uid: str, trees: Sequence[Split], step: float, width: int):
    """Spark's model of the trees."""
    context = dataset.sparkSession.sparkContext
    gateway, ml = context._gateway, context._jvm.org.apache.spark.ml
    variance = context._jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator

    def doubles(values):
        array = gateway.new_array(gateway.jvm.double, len(values))
        for k, v in enumerate(values):
            array[k] = float(v)
        return array

    def node(n: Split):
        stats = variance(doubles(n.stats), int(n.stats[0]))
        if n.left is None:
            return ml.tree.LeafNode(n.prediction, n.impurity, stats)
        split = ml.tree.ContinuousSplit(n.feature, n.threshold)
        return ml.tree.InternalNode(n.prediction, n.impurity, n.gain, node(n.left), node(n.right), split, stats)

    models = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
    for k, t in enumerate(trees):
        models[k] = ml.regression.DecisionTreeRegressionModel(node(t), width)
    weights = [1.0] + [step] * (len(trees) - 1)
    return ml.classification.GBTClassificationModel(uid, models, doubles(weights), width)
