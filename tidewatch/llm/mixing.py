"""Mixing of sources to target weights by Pfair scheduling.

Every source is a task whose weight is its share of the mix and whose documents, in a random but
fixed order, are cut into blocks of equal volume. Block ``i`` (from 0) of a source of weight ``w``
is released at slot ``floor(i / w)`` and due by slot ``ceil((i + 1) / w)``. Giving each slot to the
released block that is due first meets every deadline when the weights sum to one, so after any
number of slots ``t`` each source has had less than one block more or less than ``w * t``.

Weights are whole millionths over their sum, and the deviation is from these exactly. So the schedule
repeats after ``cycle`` slots, the sum of the millionths without their common divisor. Earliest
deadline first hands a state from slot to slot; it is folded over as many slots as the longest source
needs, a cycle at most, in one row that holds the next block of each source and one number per slot.
Its size depends on the weights and the number of sources, and no more on the data once a cycle is
reached. Every block then computes its slot from its number.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch.sources.tables import stage

# Weights are taken in parts of this size.
PARTS = 1_000_000
# Slots of the fold that are gathered before they join the others.
_CHUNK = 1024
# Code points of a block.
BLOCK_CHARS = 65_536
# Hexadecimal digits of the order's key by which one level of running sums is cut, and the rows
# that a last part holds on average.
_LEVEL = 3
_PART_ROWS = 4_000


def _running(docs: DataFrame, parts: int) -> DataFrame:
    """``before``: the volume of a source's documents ahead of each one in the order of (h, id, vol).

    Sums by the leading digits of ``h`` come first, one level at a time, so that a window never
    holds more than 16 ** _LEVEL sums or the few thousand rows of one last part.
    """
    prefix = lambda n: F.substring("h", 1, n * _LEVEL)
    leaf = docs.withColumn("p", prefix(parts))
    offsets = None
    for n in range(1, parts + 1):
        sums = (
            docs.groupBy("src", prefix(n).alias("p")).agg(F.sum("vol").alias("vol")).withColumn("up", F.substring("p", 1, (n - 1) * _LEVEL))
        )
        ahead = Window.partitionBy("src", "up").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
        level = sums.select("src", "p", "up", F.coalesce(F.sum("vol").over(ahead), F.lit(0)).alias("off"))
        if offsets is not None:
            above = offsets.select("src", F.col("p").alias("up"), F.col("off").alias("base"))
            level = level.join(above, ["src", "up"]).select("src", "p", (F.col("off") + F.col("base")).alias("off"))
        offsets = level.select("src", "p", "off")
    ahead = Window.partitionBy("src", "p").orderBy("h", "id", "vol").rowsBetween(Window.unboundedPreceding, -1)
    within = leaf.withColumn("here", F.coalesce(F.sum("vol").over(ahead), F.lit(0)))
    return within.join(offsets, ["src", "p"]).withColumn("before", F.col("here") + F.col("off")).drop("here", "off", "p")


def quotas(sizes: DataFrame, weights: DataFrame | None) -> DataFrame:
    """(src, vol, q, cycle): a source's weight is ``q / cycle``; the smallest such numbers.

    ``sizes`` has (src, vol), ``weights`` (src, weight). Without weights a source weighs the root of its
    volume, one part at least.
    """
    if weights is None:
        # Integer roots are the same in every engine.
        root = F.floor(F.sqrt(F.col("vol").cast("double"))).cast("long")
        rooted = sizes.select("src", "vol", root.alias("root"))
        whole = rooted.agg(F.sum("root").alias("all")).scalar()
        parts = rooted.withColumn("all", whole).selectExpr("src", "vol", f"greatest(({PARTS} * root) div `all`, 1L) AS q")
    else:
        per_source = weights.groupBy("src").agg(F.max("weight").alias("weight"))
        part = F.round(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)) * PARTS).cast("long")
        parts = sizes.select("src", "vol").join(per_source, "src", "left").select("src", "vol", part.alias("q"))
    # One row per source in one array: the greatest common divisor and the sum of all parts.
    euclid = "aggregate(sequence(1, 64), struct(a, b), (s, n) -> if(s.b = 0, s, struct(s.b AS a, s.a % s.b AS b))).a"
    one = parts.agg(F.collect_list("q").alias("q")).select(
        F.expr(f"aggregate(q, 0L, (x, y) -> transform(array(struct(greatest(x, y) AS a, least(x, y) AS b)), p -> {euclid.replace('struct(a, b)', 'p')})[0])").alias("g"),
        F.expr("aggregate(q, 0L, (x, y) -> x + y)").alias("total"),
    )
    reduced = parts.withColumns({c: one.select(c).scalar() for c in ("g", "total")})
    return reduced.selectExpr("src", "vol", "if(g > 0, q div g, 0L) AS q", "if(g > 0, total div g, 0L) AS cycle")


def schedule(quota: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(src, nth, slot): the slot of each source's n-th block, within a cycle and as far as blocks go.

    Earliest deadline first over the slots; equal deadlines go to the source of lower name.
    """
    blocks = f"((vol - 1) div {int(block_chars)} + 1)"
    listed = quota.where("q > 0").agg(
        F.array_sort(F.collect_list(F.struct("src", "q"))).alias("tasks"),
        F.max("cycle").alias("cycle"),
        # The last deadline that any source's blocks have.
        F.expr(f"max(({blocks} * cycle + q - 1) div q)").alias("last"),
    )
    chosen = "array_min(filter(s.next, x -> x.free <= t))"
    after = (
        "transform(s.next, x -> if(x.k = p.k, named_struct("
        "'due', ((x.n + 2) * cycle + x.q - 1) div x.q, 'k', x.k, 'free', ((x.n + 1) * cycle) div x.q, 'n', x.n + 1, 'q', x.q), x))"
    )
    step = f"transform(array({chosen}), p -> named_struct('next', {after}, 'plan', array_append(s.plan, p.k)))[0]"
    chunk = f"aggregate(sequence(c * {_CHUNK}L, least((c + 1) * {_CHUNK}L, slots) - 1), named_struct('next', o.next, 'plan', cast(array() AS array<int>)), (s, t) -> {step})"
    slots = listed.where("cycle > 0").select("tasks", "cycle", F.least("cycle", "last").alias("slots")).selectExpr(
        "tasks",
        f"""aggregate(
              sequence(0L, (slots - 1) div {_CHUNK}),
              named_struct(
                'next', transform(tasks, (x, k) -> named_struct('due', (cycle + x.q - 1) div x.q, 'k', k, 'free', 0L, 'n', 0L, 'q', x.q)),
                'plan', cast(array() AS array<array<int>>)),
              (o, c) -> transform(array({chunk}), f -> named_struct('next', f.next, 'plan', array_append(o.plan, f.plan)))[0]
            ).plan AS plan""",
    )
    parts = slots.select("tasks", F.posexplode("plan").alias("chunk", "part"))
    dealt = parts.select("tasks", "chunk", F.posexplode("part").alias("pos", "k")).select(
        (F.col("chunk").cast("long") * _CHUNK + F.col("pos")).alias("slot"), F.element_at("tasks", F.col("k") + 1)["src"].alias("src")
    )
    nth = F.row_number().over(Window.partitionBy("src").orderBy("slot")).cast("long") - 1
    return dealt.select("src", nth.alias("nth"), "slot")


def mix_sources(
    docs: DataFrame,
    weights: DataFrame | Mapping[str, float] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_chars: int = BLOCK_CHARS,
    volume: Column | None = None,
) -> DataFrame:
    """Each row of ``docs`` as ``row`` (all of its columns), with ``block``, ``slot``, ``on_target``.

    Reading by ``slot`` gives the mix. A document of several blocks' volume takes as many slots.
    ``weights`` is a table (source, weight) or a mapping; weights need not sum to one and are taken to a
    millionth; negative ones are an error, of several weights of a source the greatest counts. Without
    ``weights`` a source weighs the root of its volume. No row is dropped: once the first source has
    ended (``on_target`` is false from then on) the others keep their slots and its slots stay empty.
    Sources without a weight, or of weight 0, follow one another behind all others, not on target.

    A document's volume is its length in code points, one at least, also for null and empty texts;
    ``volume`` may name another measure over ``row``, so that the text need not come along.
    The order within a source is by the md5 of the id, null being an empty string; rows that repeat
    an id follow each other by volume. A null source is a source of its own; its weight is that of a
    null source. An empty table gives an empty table.
    """
    named = lambda c: F.when(F.col(c).isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), F.col(c)))
    key = named(f"row.`{source_col}`")
    if volume is None:
        volume = F.length(f"row.`{text_col}`")
    ident = F.coalesce(F.col(f"row.`{id_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row")).select(
        "row",
        key.alias("src"),
        ident.alias("id"),
        F.md5(ident).alias("h"),
        F.greatest(F.coalesce(volume, F.lit(0)), F.lit(1)).cast("long").alias("vol"),
    )
    if isinstance(weights, Mapping):
        weights = docs.sparkSession.createDataFrame([(k, float(w)) for k, w in weights.items()], "source string, weight double")
    if weights is not None:
        if not weights.where("weight < 0").isEmpty():
            raise ValueError("weights must not be negative")
        weights = weights.select(named("source").alias("src"), "weight")
    # One row per source or slot each, read several times below: written, or every reader would plan and run
    # all that leads to them again.
    sizes = stage(rows.groupBy("src").agg(F.sum("vol").alias("vol"), F.count(F.lit(1)).alias("rows")), "mix-sizes")
    parts, reach = 1, _PART_ROWS * 16**_LEVEL
    n = sizes.agg(F.sum("rows")).first()[0] or 0
    while n > reach:
        parts, reach = parts + 1, reach * 16**_LEVEL
    quota = stage(quotas(sizes, weights), "mix-quotas")
    plan = stage(schedule(quota, block_chars), "mix-schedule")
    weighted = quota.where("q > 0")
    # The slot of each weighted source's last block; the first of them ends the stretch that holds all
    # weights, and what has none begins after the last of them.
    last = weighted.withColumn("block", F.expr(f"(vol - 1) div {int(block_chars)}"))
    last = last.select("src", "cycle", F.expr("block div q").alias("turn"), F.expr("block % q").alias("nth")).join(plan, ["src", "nth"])
    ends = last.agg(*[f(F.col("turn") * F.col("cycle") + F.col("slot")).alias(n) for f, n in ((F.min, "first"), (F.max, "last"))])
    ahead = Window.partitionBy(F.lit(0)).orderBy("src").rowsBetween(Window.unboundedPreceding, -1)
    # One row per source without a weight.
    behind = quota.where("q = 0").withColumn("n", F.expr(f"(vol - 1) div {int(block_chars)} + 1"))
    behind = behind.select("src", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))
    light = _running(rows, parts).withColumn("block", F.expr(f"before div {int(block_chars)}"))
    placed = light.join(weighted.select("src", "q", "cycle"), "src").select(
        "row", "src", "block", F.col("cycle"), F.expr("block div q").alias("turn"), F.expr("block % q").alias("nth")
    )
    placed = placed.join(plan, ["src", "nth"]).withColumn("at", F.col("turn") * F.col("cycle") + F.col("slot"))
    mixed = placed.select("row", "block", F.col("at").alias("slot"), (F.col("at") <= ends.select("first").scalar()).alias("on_target"))
    if weights is None:
        return mixed
    end = F.coalesce(ends.select("last").scalar(), F.lit(-1).cast("long"))
    rest = light.join(behind, "src").select("row", "block", (end + 1 + F.col("offset") + F.col("block")).alias("slot"), F.lit(False).alias("on_target"))
    return mixed.unionByName(rest)
