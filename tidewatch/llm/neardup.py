"""Near-duplicates by SetSketch registers, banding, a likelihood test and verification.

Every document is the set of its word shingles. Register ``i`` of a set keeps the least of
exponential variates, one per element, on a logarithmic scale of base ``B``, truncated to 16 bits.
Registers of a union are the maxima of registers, so sketches are mergeable; two sets agree in a
register with a probability close to their similarity, so bands of registers find candidates.

Steps, all on shared tables:

1. Documents with equal sets become one class. Nothing below sees copies.
2. Classes that agree in a band share a bucket. In each bucket the member that shares most buckets
   is the hub; every other member is compared with it: a number of pairs linear in the bucket.
3. A pair whose most likely similarity, given both sketches and set sizes, is too low is set
   aside; the rest are compared by their full sets.
4. Members that met the same hub but still lie in different components are compared with each
   other, in blocks: sketches first, then full sets of those that have a chance. Pairs that are
   connected already are left out, and a task gives only links that connect. None is lost.
5. Components of all links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.components import components
from tidewatch.llm.words import mix, shingle_sets, words
from tidewatch.sources.tables import stage, unstage

# Bands of four registers: a pair of similarity 0.8 shares no band with a probability of 5e-8.
BANDS, BAND = 32, 4
REGISTERS = BANDS * BAND
# Scale of the registers: base and rate; 16 bits hold sets of up to about 1e27 elements.
B, RATE = 1.001, 20.0
_TOP = (1 << 16) - 1
# Pairs are set aside when the most likely similarity is below the threshold by more than this:
# five standard deviations of an estimate from 128 registers at 0.8.
MARGIN = 0.18
# Members of a block in step 4.
BLOCK = 256

_draw = np.random.Generator(np.random.PCG64(20_011))
_LOW, _HIGH = (_draw.integers(0, 1 << 32, REGISTERS, dtype=np.uint32) | np.uint32(1) for _ in range(2))


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a set of 64-bit hashes (not empty)."""
    least = np.full(REGISTERS, np.uint32(0xFFFFFFFF))
    for at in range(0, len(hashes), 2048):
        part = hashes[at : at + 2048]
        low, high = part.astype(np.uint32), (part >> np.uint64(32)).astype(np.uint32)
        v = low[:, None] * _LOW + high[:, None] * _HIGH
        v ^= v >> np.uint32(15)
        v *= np.uint32(0x2C1B3C6D)
        v ^= v >> np.uint32(13)
        np.minimum(least, v.min(0), out=least)
    # The least of uniform variates is that of exponential ones, which grow with them.
    h = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(h) / np.log(B)), 0, _TOP).astype("<u2")


def _agreement(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (B - 1) / B) / np.log(B)


_GRID = np.linspace(0.02, 1, 50)


def likely_similarity(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Similarity of greatest likelihood for pairs of sketches (rows of a and b) of known set sizes."""
    more, less = (a > b).sum(-1), (a < b).sum(-1)
    same = a.shape[-1] - more - less
    u = na / (na + nb)
    v = 1 - u
    most = np.minimum(u / v, v / u)
    best, score = np.zeros(len(u)), np.full(len(u), -np.inf)
    for j in _GRID:
        over = _agreement(np.clip(u - v * j, 1e-9, 1))
        under = _agreement(np.clip(v - u * j, 1e-9, 1))
        both = np.clip(1 - over - under, 1e-9, 1)
        now = np.where(j <= most + 0.02, more * np.log(over) + less * np.log(under) + same * np.log(both), -np.inf)
        best, score = np.where(now > score, j, best), np.maximum(now, score)
    return best


def _unpack(column: pa.Array) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, "<u2").reshape(-1, REGISTERS)


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, node, regs): set size, a hash of the set (null if empty) and the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, node, regs = [], [], []
            for w in words(batch.column("text"), lower=True):
                for s in shingle_sets(w, k):
                    size.append(len(s))
                    node.append(_set_hash(s) if len(s) else None)
                    regs.append(registers(s).tobytes() if len(s) else None)
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(node, pa.int64()), pa.array(regs, pa.binary())],
                names=["doc_id", "n", "node", "regs"],
            )

    rows = docs.select("doc_id", F.col("text").cast("string"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n long, node long, regs binary")


def _set_hash(s: np.ndarray) -> int:
    """64 bits that stand for a whole set: sums of two mixings and the size, mixed again."""
    parts = np.array([mix(s).sum(), mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(), len(s)], np.uint64)
    return int(mix(mix(mix(parts[:1]) + parts[1:2]) + parts[2:]).view(np.int64)[0])


def shingles(docs: DataFrame, k: int) -> DataFrame:
    """(node, elements): the full set of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in words(batch.column("text"), lower=True):
                sets = list(shingle_sets(w, k))
                node = [_set_hash(s) if len(s) else None for s in sets]
                offsets = np.cumsum([0, *map(len, sets)])
                values = np.concatenate(sets).view(np.int64)
                for at in range(0, len(sets), 512):  # bounded batches
                    to = min(at + 512, len(sets))
                    lists = pa.ListArray.from_arrays(
                        pa.array(offsets[at : to + 1] - offsets[at], pa.int32()), pa.array(values[offsets[at] : offsets[to]])
                    )
                    yield pa.record_batch([pa.array(node[at:to], pa.int64()), lists], names=["node", "elements"])

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "node long, elements array<long>")


def _promising(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (u, v) that sizes and sketches leave a chance."""
    side = lambda s: classes.select(F.col("node").alias(s), F.col("n").alias(f"n{s}"), F.col("regs").alias(f"r{s}"))
    joined = pairs.join(side("u"), "u").join(side("v"), "v")
    joined = joined.where(F.least("nu", "nv") >= threshold * F.greatest("nu", "nv"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                na, nb = (batch.column(c).to_numpy().astype(float) for c in ("nu", "nv"))
                j = likely_similarity(_unpack(batch.column("ru")), _unpack(batch.column("rv")), na, nb)
                yield batch.select(["u", "v"]).filter(pa.array(j >= threshold - MARGIN))

    return joined.select("u", "v", "nu", "nv", "ru", "rv").mapInArrow(run, "u long, v long")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    a = sets.select(F.col("node").alias("u"), F.col("elements").alias("a"))
    b = sets.select(F.col("node").alias("v"), F.col("elements").alias("b"))
    common = F.size(F.array_intersect("a", "b")).cast("long")
    return (
        pairs.join(a, "u").join(b, "v")
        .select("u", "v", common.alias("both"), (F.size("a") + F.size("b")).cast("long").alias("total"))
        .where(100 * F.col("both") >= percent * (F.col("total") - F.col("both")))
        .select("u", "v")
    )


def _split_groups(members: DataFrame) -> DataFrame:
    """Members (grp, node, comp) of groups that lie in more than one component, with their number."""
    split = members.groupBy("grp").agg(F.count(F.lit(1)).alias("members"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    return members.join(split.where("lo != hi").select("grp", "members"), "grp")


def _sets_of(nodes: DataFrame, classes: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """Full sets of classes, from one document of each."""
    nodes = nodes.distinct()
    wanted = nodes.join(classes.select("node", F.col("some_id").alias("doc_id")), "node")
    ids = wanted.select(F.col("doc_id").alias("wanted_id")).distinct()
    texts = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi")
    # Rows may repeat an id with other texts; the set itself tells which class a row is of.
    return shingles(texts, k).join(nodes, "node", "left_semi").dropDuplicates(["node"])


def _by_blocks(members: DataFrame, compare, schema: str) -> DataFrame:
    """Compare the members of each group two blocks at a time.

    members: grp, members (their number), node, n, comp and what ``compare`` reads. Every member goes
    to as many tasks as its group has blocks; a task streams over its block pairs. ``compare`` gets
    two lists of row positions, in one block or in two, and the rows; it returns arrays of a schema.
    """
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("node"), blocks).cast("int")
    spread = members.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    spread = spread.withColumns(
        {"b0": F.least("mine", "other"), "b1": F.greatest("mine", "other"), "far": F.col("mine") > F.col("other")}
    ).drop("mine", "other", "members")
    order = ["grp", "b0", "b1"]
    dealt = spread.repartition(*order).sortWithinPartitions(*order, "far", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def take(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            key = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in order])
            far = rows.column("far").to_numpy(zero_copy_only=False)
            cut = np.flatnonzero((np.diff(key) != 0).any(0)) + 1
            for a, b in zip([0, *cut], [*cut, rows.num_rows]):
                if b - a > 1:
                    here = far[a:b]
                    both = (np.arange(b - a),) * 2 if key[1, a] == key[2, a] else (np.flatnonzero(~here), np.flatnonzero(here))
                    if len(both[0]) and len(both[1]) and (found := compare(rows.slice(a, b - a), *both)) is not None:
                        yield found

        def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            last = tuple(batch.column(c)[batch.num_rows - 1].as_py() for c in order)
            if all(held[0].column(c)[0].as_py() == x for c, x in zip(order, last)):
                continue
            rows = joined(held)
            same = np.logical_and.reduce([rows.column(c).to_numpy() == x for c, x in zip(order, last)])
            whole = int(np.argmax(same))  # the last pair of blocks may go on in the next batch
            held = [rows.slice(whole)]
            yield from take(rows.slice(0, whole))
        if held:
            yield from take(joined(held))

    return dealt.mapInArrow(run, schema)


def _apart(rows: pa.RecordBatch, left: np.ndarray, right: np.ndarray, least: float) -> np.ndarray:
    """Which pairs (left x right) lie in different components and could be similar by their sizes."""
    comp, n = rows.column("comp").to_numpy(), rows.column("n").to_numpy()
    small, large = np.minimum.outer(n[left], n[right]), np.maximum.outer(n[left], n[right])
    return (comp[left][:, None] != comp[right][None, :]) & (small >= least * large)


def _with_chances(members: DataFrame, percent: int) -> DataFrame:
    """(grp, node) of members whose sketches leave a chance with a member of another component."""
    least = percent / 100

    def compare(rows: pa.RecordBatch, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch | None:
        i, j = np.nonzero(_apart(rows, left, right, least))
        regs, n = _unpack(rows.column("regs")), rows.column("n").to_numpy().astype(float)
        chance = np.zeros(rows.num_rows, bool)
        for at in range(0, len(i), 4096):
            a, b = left[i[at : at + 4096]], right[j[at : at + 4096]]
            ok = likely_similarity(regs[a], regs[b], n[a], n[b]) >= least - MARGIN
            chance[a[ok]] = chance[b[ok]] = True
        return rows.select(["grp", "node"]).filter(pa.array(chance)) if chance.any() else None

    return _by_blocks(members, compare, "grp long, node long").distinct()


def _links_across(members: DataFrame, percent: int) -> DataFrame:
    """Links between components, by full sets; within a task only those that still connect two."""

    def compare(rows: pa.RecordBatch, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch | None:
        apart = _apart(rows, left, right, percent / 100)
        if not apart.any():
            return None
        lists = rows.column("elements")
        ends = np.r_[0, np.cumsum(pa.compute.list_value_length(lists).to_numpy())]
        _, element, times = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
        # Elements of one member have no part in any intersection.
        shared = times > 1
        column = np.cumsum(shared) - 1
        member = np.repeat(np.arange(rows.num_rows), np.diff(ends))
        use = shared[element]
        common = np.zeros((len(left), len(right)), np.float32)
        member, element = member[use], column[element[use]]
        order = np.argsort(element, kind="stable")
        member, element = member[order], element[order]
        for lo in range(0, int(shared.sum()), 8192):
            a, b = np.searchsorted(element, [lo, lo + 8192])
            has = np.zeros((rows.num_rows, 8192), np.float32)
            has[member[a:b], element[a:b] - lo] = 1
            common += has[left] @ has[right].T
        n, comp, node = (rows.column(c).to_numpy() for c in ("n", "comp", "node"))
        linked = apart & (100 * common >= percent * (np.add.outer(n[left], n[right]) - common))
        root: dict[int, int] = {}

        def find(c: int) -> int:
            while root.get(c, c) != c:
                c = root[c]
            return c

        us, vs = [], []
        for i, j in zip(*np.nonzero(linked)):
            a, b = left[i], right[j]
            x, y = find(comp[a]), find(comp[b])
            if x != y:
                root[x] = y
                us.append(min(node[a], node[b]))
                vs.append(max(node[a], node[b]))
        return pa.record_batch([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"]) if us else None

    return _by_blocks(members, compare, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, k: int = 4, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    Documents are linked when ``100 * common >= percent * union`` over their distinct k-word
    shingles (ASCII lower case; fewer than k words make one shingle). ``component_id`` is the least
    id reachable over links, ``kept`` marks the rows that have it. Null, empty and blank texts have
    no shingle and are linked with nothing. Rows that repeat an id are separate rows; null ids are
    less than none and never a component's id unless all of its ids are null. Ids are of any type that
    has an order, structs included. An empty table gives an empty table; other columns are ignored.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sketched = stage(sketches(docs, k), "near-sketches")
    classes = stage(
        sketched.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("some_id"), F.max("n").alias("n"), F.max("regs").alias("regs")),
        "near-classes",
    )
    # A band's key names its place too; equal keys of different bands would be compared in vain.
    keys = F.expr(f"transform(sequence(0, {BANDS - 1}), i -> xxhash64(i, substring(regs, {2 * BAND} * i + 1, {2 * BAND})))")
    banded = classes.select("node", F.explode(keys).alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    buckets = stage(banded.join(shared, "key"), "near-buckets")
    weight = buckets.groupBy("node").agg(F.sum("members").alias("weight"))
    hubs = buckets.join(weight, "node").groupBy("key").agg(F.max(F.struct("weight", "node"))["node"].alias("hub"))
    star = buckets.join(hubs, "key")
    met_rows = stage(star.where("node != hub").select(F.col("hub").alias("grp"), "node").distinct(), "near-met")
    pairs = met_rows.select(F.least("node", "grp").alias("u"), F.greatest("node", "grp").alias("v")).distinct()
    tried = stage(_promising(pairs, classes, percent / 100), "near-pairs")
    sets = stage(_sets_of(tried.select(F.explode(F.array("u", "v")).alias("node")), classes, docs, k), "near-sets")
    links = stage(_verified(tried, sets, percent), "near-links")
    first = components(links, "near-components")

    # A hub has met all that share a bucket with it; the rest have met if they are connected.
    # All members that one hub has met make one group: each pair of a bucket is in its hub's group.
    met = met_rows.join(first, "node", "left").select("grp", "node", F.coalesce("root", "node").alias("comp"))
    members = _split_groups(met).join(classes.select("node", "n", "regs"), "node")
    chances = stage(_with_chances(members, percent), "near-chances")
    more_sets = stage(_sets_of(chances.select("node"), classes, docs, k), "near-sets")
    left = _split_groups(met.join(chances, ["grp", "node"], "left_semi"))
    more_links = stage(_links_across(left.join(more_sets.withColumn("n", F.size("elements").cast("long")), "node"), percent), "near-links")
    if more_links.isEmpty():
        roots = first
    else:
        star_links = first.where("node != root").select(F.col("node").alias("u"), F.col("root").alias("v"))
        roots = components(star_links.unionByName(more_links), "near-components")
    unstage(buckets, met_rows, tried, sets, links, chances, more_sets, more_links)

    least = (
        classes.select("node", "some_id").join(roots, "node", "left")
        .select("node", F.coalesce("root", "node").alias("root"), "some_id")
    )
    smallest = least.groupBy("root").agg(F.min("some_id").alias("component_id"))
    named = least.join(smallest, "root").select("node", "component_id")
    return sketched.select("doc_id", "n", "node").join(named, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (F.col("node").isNull() | F.col("component_id").eqNullSafe(F.col("doc_id"))).alias("kept"),
    )
