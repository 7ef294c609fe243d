"""Exact ranks, quantile tiles and alert sets without a global sort.

Most uses of a global rank only ask on which side of a few positions a row lies (deciles, the top
10 %, a sample of n rows). ``exact_cutoffs`` finds the exact rows at those positions by narrowing:
a quantile sketch brackets each position, exact counts tell which side of a bracket it lies on, and
a sketch of what is inside brackets it again, until no bracket holds more than a fixed number of
rows. Only these are ordered. All positions share each step, and each step cuts the rows by several
hundred times, so a table a thousand times as large takes one more. The full table is then marked by
comparing with literals: no shuffle.

Rows of equal score are ordered by the md5 of their keys, which is uniform: a score that a large
part of the rows share is narrowed by it in the same way. Rows that agree in it too, because their
keys repeat, are numbered among themselves where a cut-off divides them.

The steps run as small jobs whose results on the driver have a fixed size (a sketch of about a
thousand numbers, counts, one value per position). The cut-offs enter later plans as literals, so
every branch and every retry sees the same ones. Each step scans ``df``: hand in a table (or
``stage`` it first) rather than a long computation. A position that cannot be found, as happens when
``df`` changes between scans, is an error.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Generator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, Window

from tidewatch.config import ANCHOR_KEYS
from tidewatch.functions import null_if_nan, tie_hash
from tidewatch.sources.tables import stage

# Number of quantiles kept by the sketch, and its accuracy (rank error below rows / accuracy).
_QUANTILES = 1000
_ACCURACY = 10_000
# Rows that one task orders; brackets are narrowed until they hold no more.
_ORDER_AT_ONCE = 1_000_000

Positions = Callable[[int], Sequence[int]]
_NTH = "__nth"


@dataclass(frozen=True)
class Cutoff:
    """The row at an ascending position: its score, and its tie hash if equal scores go on after it.

    ``within`` is the number of rows up to the position among those of equal score and tie hash, if
    more of these go on after it.
    """

    position: int
    rows: int
    score: float | None = None
    tie: str | None = None
    within: int | None = None


def order_after(score: Column, tie: Column | None, cut: Cutoff, nth: Column | None = None) -> Column:
    """Does a row come after the cut-off in ascending (score, tie) order? False for a null score.

    Without ``tie`` rows equal to the cut-off's score count as not after it. ``nth`` numbers the rows
    that agree with a cut-off in both (see ``numbered``).
    """
    if cut.position <= 0:
        return score.isNotNull()
    if cut.position >= cut.rows:
        return F.lit(False)
    above = score > F.lit(cut.score)
    if cut.tie is not None and tie is not None:
        above = above | ((score == F.lit(cut.score)) & (tie > F.lit(cut.tie)))
        if cut.within is not None and nth is not None:
            above = above | ((score == F.lit(cut.score)) & (tie == F.lit(cut.tie)) & (nth > cut.within))
    return F.coalesce(above, F.lit(False))


def numbered(
    df: DataFrame, score: Column, tie: Column, cuts: Sequence[Cutoff | Sequence[Cutoff]], group: Column | None = None
) -> tuple[DataFrame, Column | None]:
    """Number the rows that a cut-off divides although they agree in score and keys.

    Without such cut-offs, as with unique keys, ``df`` comes back as it is. Other rows do not move.
    The number follows the hash of the whole row; rows alike in all columns may change places. With
    ``group`` there is a list of cut-offs per group.
    """
    listed = [(0, cuts)] if group is None else list(enumerate(cuts))
    split = {(g, c.score, c.tie) for g, some in listed for c in some if c.within is not None}
    if not split:
        return df, None
    group = F.lit(0) if group is None else group
    hit = F.lit(False)
    for g, value, digest in sorted(split):
        hit = hit | ((group == g) & (score == F.lit(value)) & (tie == F.lit(digest)))
    hit = F.coalesce(hit, F.lit(False))
    columns = df.columns
    inside = df.where(hit).withColumns({"__g": group, "__s": score, "__t": tie, "__x": F.xxhash64(*columns)})
    order = Window.partitionBy("__g", "__s", "__t").orderBy("__x")
    inside = inside.withColumn(_NTH, F.row_number().over(order).cast("bigint")).select(*columns, _NTH)
    outside = df.where(~hit).withColumn(_NTH, F.lit(None).cast("bigint"))
    return inside.unionByName(outside), F.col(_NTH)


def _brackets(n: int, quantiles: Sequence[float], positions: Sequence[int]) -> list[tuple[float, float]]:
    """Disjoint score intervals that should hold the positions, with a margin of one quantile."""
    spans = []
    for p in positions:
        at = p * _QUANTILES / n
        lo, hi = max(int(at) - 1, 0), min(int(at) + 2, _QUANTILES)
        spans.append((quantiles[lo], quantiles[hi]))
    return _merged(spans)


def _merged(spans: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
    merged: list[tuple[float, float]] = []
    for lo, hi in sorted(spans):
        if merged and lo <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], hi))
        else:
            merged.append((lo, hi))
    return merged


@dataclass(frozen=True)
class _Part:
    """Rows few enough to be ordered by one task, the rows ahead of them, and the positions among them."""

    where: Column
    before: int
    positions: tuple[int, ...]
    group: int = 0


def exact_cutoffs(
    df: DataFrame,
    score: str | Column,
    positions: Positions | Sequence[float],
    tie: Column | Sequence[str] | None,
) -> list[Cutoff]:
    """Exact cut-offs at ascending positions (1-based), given as fractions or as a function of n.

    Without ``tie`` the cut-offs only have scores.
    """
    wanted = positions if callable(positions) else lambda n: [int(f * n) for f in positions]
    return cutoffs_by(df, F.lit(0), 1, score, wanted, tie)[0]


def cutoffs_by(
    df: DataFrame, group: Column, groups: int, score: str | Column, positions: Positions, tie: Column | Sequence[str] | None
) -> list[list[Cutoff]]:
    """``exact_cutoffs`` of each group at once; ``group`` numbers the groups from 0 to ``groups - 1``.

    Every step narrows the brackets of all groups in one pass, and all that is left is ordered in one:
    as many actions as for the group that takes most, however many groups there are.
    """
    value = F.col(score) if isinstance(score, str) else score
    digest = tie if isinstance(tie, Column) else F.lit(None).cast("string") if tie is None else tie_hash(tie)
    scored = df.select(null_if_nan(value.cast("double")).alias("s"), digest.alias("t"), group.cast("int").alias("g"))
    scored = scored.where(F.col("s").isNotNull() & F.col("g").isNotNull())
    sizes = {
        r["g"]: (r["n"], list(r["q"] or []))
        for r in scored.groupBy("g").agg(F.count(F.lit(1)).alias("n"), _quantiles_of(F.col("s")).alias("q")).collect()
    }
    wanted = [list(positions(sizes.get(g, (0, []))[0])) for g in range(groups)]
    inner = {g: sorted({p for p in wanted[g] if 0 < p < n}) for g, (n, _) in sizes.items()}
    found = _narrowed(scored, {g: (*sizes[g], ps) for g, ps in inner.items() if ps}, tie is not None)
    missing = [(g, p) for g, ps in inner.items() for p in ps if (g, p) not in found]
    if missing:
        raise RuntimeError(f"no row at positions {missing} (by group): does the table change between scans?")
    return [[found.get((g, p), Cutoff(p, sizes.get(g, (0, []))[0])) for p in wanted[g]] for g in range(groups)]


def _quantiles_of(c: Column) -> Column:
    return F.percentile_approx(c, [i / _QUANTILES for i in range(_QUANTILES + 1)], _ACCURACY)


def _narrowed(scored: DataFrame, groups: dict[int, tuple[int, list[float], list[int]]], ties: bool) -> dict[tuple[int, int], Cutoff]:
    """Cut-offs by (group, position), from each group's (rows, quantiles, positions).

    The groups ask for counts of the stretches they are at; one pass answers them all.
    """
    found: dict[tuple[int, int], Cutoff] = {}
    parts: list[_Part] = []
    open_ = {}
    for g, (n, quantiles, positions) in groups.items():
        steps = _narrowing(scored.where(F.col("g") == g), g, n, quantiles, positions, ties, found, parts)
        spans = next(steps, None)
        if spans is not None:
            open_[g] = (steps, spans)
    while open_:
        regions = _count_regions(scored, {g: spans for g, (_, spans) in open_.items()})
        again = {}
        for g, (steps, _) in open_.items():
            try:
                again[g] = (steps, steps.send(regions.get(g, {})))
            except StopIteration:
                pass
        open_ = again
    return found | _ordered(scored, {g: n for g, (n, *_) in groups.items()}, parts)


def _narrowing(
    scored: DataFrame, g: int, n: int, quantiles: Sequence[float], positions: list[int], ties: bool, found: dict, parts: list[_Part]
) -> Generator[list[tuple[float, float]], dict[int, dict], None]:
    """Brackets around the positions of one group, made smaller until their rows can be ordered.

    Yields the brackets, is sent the counts of the stretches they cut the scores into, and leaves
    cut-offs in ``found`` and what remains to be ordered in ``parts``.
    """
    mine_only, s = F.col("g") == g, F.col("s")
    if n <= _ORDER_AT_ONCE:
        parts.append(_Part(mine_only, 0, tuple(positions), g))
        return
    spans, pending = _brackets(n, quantiles, positions), positions
    while pending:
        regions = yield spans
        before, inside, again = 0, {}, []
        for code, region in sorted(regions.items()):
            mine = [p for p in pending if before < p <= before + region["n"]]
            if mine:
                inside[code] = (before, mine)
            before += region["n"]
        done: set[int] = set()
        for code, (before, mine) in inside.items():
            region = regions[code]
            lo, hi = region["lo"], region["hi"]
            if lo == hi:
                if ties:
                    here = mine_only & (s == F.lit(lo))
                    more, cuts = _narrowed_ties(scored.where(s == F.lit(lo)), here, lo, n, before, region["n"], mine, g)
                    parts += more
                    found.update({(g, p): cut for p, cut in cuts.items()})
                else:
                    found.update({(g, p): Cutoff(p, n, lo) for p in mine})
                done.update(mine)
            elif region["n"] <= _ORDER_AT_ONCE:
                parts.append(_Part(mine_only & (s >= F.lit(lo)) & (s <= F.lit(hi)), before, tuple(mine), g))
                done.update(mine)
            elif region["q"]:
                again += _brackets(region["n"], region["q"], [p - before for p in mine])
            else:
                again.append((lo, hi))
        pending = [p for p in pending if p not in done]
        again = _merged(again)
        if again == spans:
            # The sketch tells no more: halve what is left, down to single scores.
            again = [cut for lo, hi in spans for cut in ((lo, lo + (hi - lo) / 2), (hi, hi))]
        if pending and not again:
            break
        spans = again


def _count_regions(scored: DataFrame, spans_of: dict[int, Sequence[tuple[float, float]]]) -> dict[int, dict[int, dict]]:
    """Per group: rows, extremes and quantiles of the stretches that the ends of its spans cut its scores into.

    Each end is a stretch of its own, so a common score never keeps a bracket large. Quantiles are
    taken within spans only; a position found outside gets the whole stretch as its next span.
    """
    s, g = F.col("s"), F.col("g")
    whole = F.when(F.lit(False), F.lit(0))
    for group, spans in spans_of.items():
        code = F.when(F.lit(False), F.lit(0))
        for i, (lo, hi) in enumerate(spans):
            for k, cond in enumerate((s < F.lit(lo), s == F.lit(lo), s < F.lit(hi), s == F.lit(hi))):
                code = code.when(cond, F.lit(4 * i + k))
        whole = whole.when(g == group, code.otherwise(F.lit(4 * len(spans))))
    coded = scored.select("s", "g", whole.alias("code")).where(F.col("code").isNotNull())
    inner = F.when(F.col("code") % 4 == 2, s)
    rows = coded.groupBy("g", "code").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("s").alias("lo"),
        F.max("s").alias("hi"),
        _quantiles_of(inner).alias("q"),
    )
    found: dict[int, dict[int, dict]] = {}
    for r in rows.collect():
        found.setdefault(r["g"], {})[r["code"]] = r.asDict()
    return found


def _narrowed_ties(
    rows: DataFrame, where: Column, value: float, n: int, before: int, count: int, positions: list[int], group: int
) -> tuple[list[_Part], dict[int, Cutoff]]:
    """Parts to order, or cut-offs, among rows of one score, by their digests.

    Digests are uniform, so the k-th of them lies close to the fraction k / count of their range:
    within six standard deviations of it. Where keys repeat that may not hold; the counts then say
    on which side to go on, between the least and the greatest digest found there, and an interval
    that stays as it was is halved. One that holds a single digest is the cut-off.
    """
    t = F.col("t")
    parts, found = [], {}
    for p in positions:
        lo, hi, ahead, inside, halve = "", "g", before, count, False
        while inside > _ORDER_AT_ONCE and lo != hi:
            low, high = _fraction_of(lo), _fraction_of(hi)
            share = (p - ahead) / inside
            spread = 6 * math.sqrt(inside * share * (1 - share)) / inside + 10 / inside
            at, width = (0.5, 0.0) if halve else (share, min(0.25, spread))
            a, b = (_digest_at(low + (at + sign * width) * (high - low)) for sign in (-1, 1))
            if halve and not lo < b <= hi:
                a = b = hi  # too close to be told apart by their leading digits: set the last one apart
            pieces = (t < a, (t >= a) & (t < b), t >= b)
            got = rows.where((t >= lo) & (t <= hi)).agg(
                *[F.count_if(piece).alias(f"n{i}") for i, piece in enumerate(pieces)],
                *[F.min(F.when(piece, t)).alias(f"lo{i}") for i, piece in enumerate(pieces)],
                *[F.max(F.when(piece, t)).alias(f"hi{i}") for i, piece in enumerate(pieces)],
            ).first()
            old = (lo, hi)
            for i in range(3):
                if p <= ahead + got[f"n{i}"]:
                    lo, hi, inside = got[f"lo{i}"], got[f"hi{i}"], got[f"n{i}"]
                    break
                ahead += got[f"n{i}"]
            else:
                return parts, found  # the rows have changed; the caller reports the position
            halve = (lo, hi) == old
        if lo == hi:
            found[p] = Cutoff(p, n, value, lo, None if p == ahead + inside else p - ahead)
        else:
            parts.append(_Part(where & (t >= lo) & (t <= hi), ahead, (p,), group))
    return parts, found


def _ordered(scored: DataFrame, rows_of: dict[int, int], parts: Sequence[_Part]) -> dict[tuple[int, int], Cutoff]:
    """Order the rows of each part by (score, tie) in a task of its own and read off the positions."""
    if not parts:
        return {}
    found: dict[tuple[int, int], Cutoff] = {}
    # Parts may overlap where positions share a bracket, so a row can belong to several.
    flags = F.array_compact(F.array(*[F.when(p.where, F.lit(i)) for i, p in enumerate(parts)]))
    order = Window.partitionBy("part").orderBy("s", "t")
    starts = F.element_at(F.expr("array(" + ",".join(f"{p.before}L" for p in parts) + ")"), F.col("part") + 1)
    wanted = [(i, q) for i, p in enumerate(parts) for q in p.positions]
    chosen = F.struct("part", "position").isin([F.struct(F.lit(i), F.lit(q).cast("bigint")) for i, q in wanted])
    rows = (
        scored.select("s", "t", F.explode(flags).alias("part"))
        .select(
            "s", "t", "part",
            (F.row_number().over(order) + starts).alias("position"),
            (F.rank().over(order) + starts).alias("first"),
            F.lead(F.struct("s", "t")).over(order).alias("next"),
        )
        .where(chosen)
    )
    for r in rows.collect():
        more = r["next"] is not None and r["next"]["s"] == r["s"]
        alike = more and r["next"]["t"] == r["t"] and r["t"] is not None
        # A tie hash is kept where the score goes on; at the end of a part it is harmless.
        tie = r["t"] if more or r["next"] is None else None
        p, part = r["position"], parts[r["part"]]
        found[part.group, p] = Cutoff(p, rows_of[part.group], r["s"], tie, p - r["first"] + 1 if alike else None)
    return found


def tile_positions(tiles: int) -> Positions:
    """Last position of every tile but the highest; the first tiles take the remainder, as ``ntile`` does."""

    def positions(n: int) -> list[int]:
        size, extra = divmod(n, tiles)
        return [i * size + min(i, extra) for i in range(1, tiles)]

    return positions


def top_positions(rates: Sequence[float]) -> Positions:
    """Position in front of the top ``int(n * rate)`` rows."""
    return lambda n: [n - int(n * r) for r in rates]


def risk_decile(
    df: DataFrame, score: str = "risk_score", tiles: int = 10, tie_keys: Sequence[str] = ANCHOR_KEYS, out: str = "risk_decile"
) -> DataFrame:
    """``ntile`` over the ascending score: the highest tile holds the highest scores, null stays null."""
    cuts = exact_cutoffs(df, score, tile_positions(tiles), tie_keys)
    s, tie = null_if_nan(F.col(score).cast("double")), tie_hash(tie_keys)
    df, nth = numbered(df, s, tie, cuts)
    return df.withColumn(out, _tile(s, tie, cuts, nth)).drop(_NTH)


def _tile(s: Column, tie: Column, cuts: Sequence[Cutoff], nth: Column | None) -> Column:
    tile = F.lit(1)
    for cut in cuts:
        tile = tile + order_after(s, tie, cut, nth).cast("int")
    return F.when(s.isNotNull(), tile)


def deciles_and_alerts(
    df: DataFrame,
    rate: float = 0.10,
    tiles: int = 10,
    score: str = "risk_score",
    tie_keys: Sequence[str] = ANCHOR_KEYS,
) -> DataFrame:
    """``risk_decile`` and exact ``alert_flags`` with one search for all cut-offs."""

    def positions(n: int) -> list[int]:
        return [*top_positions([rate])(n), *tile_positions(tiles)(n)]

    alert, *cuts = exact_cutoffs(df, score, positions, tie_keys)
    s, tie = null_if_nan(F.col(score).cast("double")), tie_hash(tie_keys)
    df, nth = numbered(df, s, tie, [alert, *cuts])
    alerted = order_after(s, tie, alert, nth)
    return df.withColumns(
        {
            "risk_decile": _tile(s, tie, cuts, nth),
            "alert_flag": F.when(alerted, 1).otherwise(0),
            "alert_rate_config": F.lit(float(rate)),
        }
    ).drop(_NTH)


def alert_flags(
    df: DataFrame,
    rate: float = 0.10,
    score: str = "risk_score",
    tie_keys: Sequence[str] = ANCHOR_KEYS,
    mode: str = "exact",
    out: str = "alert_flag",
) -> DataFrame:
    """Flag the highest scores under an alert budget and keep the rate as ``alert_rate_config``.

    ``exact`` flags ``int(n * rate)`` rows. ``threshold`` flags every score at or above the exact
    ``1 - rate`` quantile, so ties may exceed the budget. ``approx`` does so with an approximate
    quantile that stays inside the plan.
    """
    s = null_if_nan(F.col(score).cast("double"))
    if mode == "exact":
        (cut,) = exact_cutoffs(df, score, top_positions([rate]), tie_keys)
        df, nth = numbered(df, s, tie_hash(tie_keys), [cut])
        alerted = order_after(s, tie_hash(tie_keys), cut, nth)
    elif mode == "threshold":
        threshold = exact_quantile(df, score, 1.0 - rate)
        alerted = s >= F.lit(threshold)
    elif mode == "approx":
        quantile = df.agg(F.percentile_approx(s, 1.0 - rate, _ACCURACY).alias("threshold"))
        alerted = s >= quantile.scalar()
    else:
        raise ValueError(f"unknown mode {mode}")
    return df.withColumns({out: F.when(alerted, 1).otherwise(0), "alert_rate_config": F.lit(float(rate))}).drop(_NTH)


def exact_quantile(df: DataFrame, score: str, fraction: float) -> float | None:
    """Smallest score with at least ``fraction`` of the rows at or below it."""

    def position(n: int) -> list[int]:
        return [max(math.ceil(n * fraction), 1)]

    (cut,) = exact_cutoffs(df, score, position, None)
    if cut.score is None:
        row = df.agg(F.max(null_if_nan(F.col(score).cast("double")))).first()
        return row[0]
    return cut.score


def distributed_rank(
    df: DataFrame,
    score: str = "risk_score",
    tie_keys: Sequence[str] = ANCHOR_KEYS,
    descending: bool = False,
    out: str = "rank",
) -> DataFrame:
    """Exact ``row_number`` over the whole table, for callers that need every row's rank.

    The rows are range-partitioned by (score, tie) over the session's shuffle partitions and staged,
    so that counting and ranking see the same ranges; a common score is divided by its tie hashes.
    Counts per range turn the rank within a range into the rank overall.
    """
    s, tie = null_if_nan(F.col(score).cast("double")), tie_hash(tie_keys)
    keyed = df.withColumns({"__s": s, "__t": tie})
    ranged = staged_ranges(keyed.where(F.col("__s").isNotNull()), ["__s", "__t"], "rank-ranges")
    order = [F.col(c).desc() if descending else F.col(c).asc() for c in ("__s", "__t")]
    within = F.row_number().over(Window.partitionBy("__range").orderBy(*order)).cast("bigint")
    # One row per range.
    first = F.col("__range").desc() if descending else F.col("__range").asc()
    ahead = Window.orderBy(first).rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("__range").count().select("__range", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("__start"))
    ranked = ranged.withColumn(out, within).join(starts, "__range").withColumn(out, F.col(out) + F.col("__start"))
    unscored = keyed.where(F.col("__s").isNull()).withColumn(out, F.lit(None).cast("bigint"))
    return ranked.drop("__range", "__start").unionByName(unscored).drop("__s", "__t")


def staged_ranges(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """``df`` on the shared folder, cut into ranges of ``columns`` numbered ascending in ``__range``.

    Rows equal in all of ``columns`` share a range.
    """
    return stage(df.repartitionByRange(*columns).withColumn("__range", F.spark_partition_id()), name)


def topk_metrics(
    df: DataFrame,
    rates: Sequence[float] = (0.05, 0.10, 0.20),
    label: str = "label",
    score: str = "prob",
    tie_keys: Sequence[str] = ANCHOR_KEYS,
    by: Sequence[str] = (),
) -> DataFrame:
    """Precision, recall and lift among the top ``int(n * rate)`` rows, one row per rate.

    With ``by`` one row per rate and group; groups, a few (models and splits), are found first, and one
    search finds the cut-offs of all. All rates come out of one aggregation over the marked rows. Rates
    that select no row have null metrics; a table without scores gives, without ``by``, rates of no row.
    """
    s, tie = null_if_nan(F.col(score).cast("double")), tie_hash(tie_keys)
    names = [tuple(r) for r in df.where(s.isNotNull()).select(*by).distinct().collect()] if by else [()]
    names.sort(key=lambda r: tuple((v is not None, str(v)) for v in r))
    if not names:
        names = [tuple(None for _ in by)]
    code = F.when(F.lit(False), F.lit(0))
    for g, values in enumerate(names):
        same = F.lit(True)
        for c, v in zip(by, values):
            same = same & F.col(c).eqNullSafe(F.lit(v))
        code = code.when(same, F.lit(g))
    cuts = cutoffs_by(df, code, len(names), score, top_positions(rates), tie_keys)
    df, nth = numbered(df, s, tie, cuts, code)
    positive = F.col(label) == 1

    def above(i: int) -> Column:
        chosen = F.when(F.lit(False), F.lit(False))
        for g, some in enumerate(cuts):
            chosen = chosen.when(F.col("__code") == g, order_after(s, tie, some[i], nth))
        return chosen

    hits = [F.count_if(above(i) & positive).alias(f"hits{i}") for i in range(len(rates))]
    marked = df.where(s.isNotNull()).withColumn("__code", code)
    totals = marked.groupBy(*(["__code"] if by else [])).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(positive).cast("double").alias("pos"), *hits
    )
    if not by:
        totals = totals.withColumn("__code", F.lit(0))
    taken = lambda i: F.element_at(F.array(*[F.lit(some[i].rows - some[i].position).cast("bigint") for some in cuts]), F.col("__code") + 1)
    per_rate = F.array(
        *[
            F.struct(F.lit(float(r)).alias("k_rate"), taken(i).alias("k"), F.col(f"hits{i}").cast("double").alias("hits"))
            for i, r in enumerate(rates)
        ]
    )
    for k, c in enumerate(by):
        kind = df.schema[c].dataType
        totals = totals.withColumn(c, F.element_at(F.array(*[F.lit(v[k]).cast(kind) for v in names]), F.col("__code") + 1))
    some = F.col("k") > 0
    base = F.try_divide(F.col("pos"), F.col("n"))
    precision = F.try_divide(F.col("hits"), F.col("k"))
    recall = F.when(F.col("pos") > 0, F.col("hits") / F.col("pos")).otherwise(F.lit(0.0))
    return (
        totals.select(*by, "n", "pos", F.explode(per_rate).alias("r"))
        .select(*by, "n", "pos", "r.*")
        .select(
            *by,
            "k_rate",
            "k",
            F.when(some, precision).alias("precision_at_k"),
            F.when(some, recall).alias("recall_at_k"),
            F.when(some, F.try_divide(precision, base)).alias("lift_at_k"),
            F.when(some, base).alias("base_rate"),
        )
    )


def hash_sample(df: DataFrame, n: int, seed: int, keys: Sequence[str] = ANCHOR_KEYS) -> DataFrame:
    """``n`` rows drawn by the hash of their keys: the same rows however the table is partitioned.

    The hash of the n-th row is found first, so the sample is a filter and not a global sort.
    """
    if n <= 0:
        return df.where(F.lit(False))
    drawn = tie_hash(keys, seed)
    # One score for all rows: the order is that of the hashes alone.
    level = F.length(drawn).cast("double")
    (cut,) = exact_cutoffs(df, level, lambda _: [n], drawn)
    if cut.position >= cut.rows:
        return df
    df, nth = numbered(df, level, drawn, [cut])
    return df.where(~order_after(level, drawn, cut, nth)).drop(_NTH)


def _fraction_of(digest: str) -> float:
    """Where a digest lies in their range; the inverse of ``_digest_at`` up to its accuracy."""
    return 0.0 if digest == "" else 1.0 if digest == "g" else int(digest[:12], 16) / 16**12


def _digest_at(fraction: float) -> str:
    """Hex digits of a fraction of the range of digests; beyond its end a value above all of them."""
    if fraction >= 1:
        return "g"
    return f"{int(max(fraction, 0.0) * 16**12):012x}"


def stratified_sample(
    df: DataFrame,
    n: int,
    fraction: float = 0.5,
    seed: int = 42,
    flag: str = "alert_flag",
    keys: Sequence[str] = ANCHOR_KEYS,
) -> DataFrame:
    """``int(n * fraction)`` flagged rows and the remainder from the others, fewer where there are not enough."""
    flagged = int(n * fraction)
    alerted = hash_sample(df.where(F.col(flag) == 1), flagged, seed, keys)
    background = hash_sample(df.where(F.col(flag) == 0), n - flagged, seed + 1, keys)
    return alerted.unionByName(background)
