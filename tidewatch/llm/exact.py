"""Exact deduplication by most-significant-digit radix partitioning.

A text's first digit is its length in bytes and its first bytes; the following digits are its
successive bytes, in pieces that grow eightfold. A round splits every group by the next digit.
A group of one document is finished, and so is a group whose texts have ended: all of its members
agree in every byte, which is equality itself, without a digest.

A round is one count per (group, digit), combined before the shuffle, and one join that gives
every document its new group. No group is ever gathered: a group that holds a third of all rows
is one row of the counts, and Spark splits its side of the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.sources.tables import stage, unstage

# Bytes of the first digit and the growth of each further one: a text of n bytes takes about
# log8(n / 64) rounds, and only as long as another text agrees with all of its earlier digits.
FIRST_DIGIT = 64
DIGIT_GROWTH = 8


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digit: int = FIRST_DIGIT,
    growth: int = DIGIT_GROWTH,
    carry: Sequence[Column] | None = None,
) -> DataFrame:
    """Each row of ``docs`` as ``row``, with ``keep_id``, ``group_size``, ``kept``.

    ``row`` holds all columns, or those of ``carry``; the text is then kept only for as long as
    rounds need it.

    A null text counts as empty. Of equal texts the row with the largest id stays; a null id is
    less than any other, and a group of null ids keeps all its rows, as do rows that repeat both
    text and the largest id: they are the same document. Repeated rows count in ``group_size``.
    An empty table gives an empty table. Columns of any name may come along.
    """
    row = F.struct("*") if carry is None else F.struct(*carry)
    body = F.col(text_col)
    rows = docs.select(row.alias("row"), F.col(id_col).alias("id"), *([] if carry is None else [body.alias("body")]))
    # A text that is part of the row is not moved twice.
    text = F.coalesce(F.encode(F.col(f"row.{text_col}" if carry is None else "body"), "UTF-8"), F.lit(b""))
    keep = [] if carry is None else ["body"]
    # Documents not yet told apart, with the group that they share so far.
    open_ = rows.select("row", "id", *keep, F.lit(0).cast("long").alias("grp"), F.octet_length(text).alias("size"))
    done: list[DataFrame] = []
    start, width = 0, digit
    while True:
        piece = F.substring(text, start + 1, width)
        dealt = open_.withColumn("digit", piece)
        counts = (
            dealt.groupBy("grp", "size", "digit")
            .agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
            .where("n > 1")
            .withColumn("sub", F.monotonically_increasing_id())
        )
        # The new group's number is fixed by writing it; digits are as long as what they tell apart.
        counts = stage(counts, "radix-groups")
        ended = F.col("size") <= start + width
        unsplit = F.col("n").isNotNull() & ~ended
        # Merged at every size: what a broadcast saves on a small table says nothing of a large one.
        found = dealt.join(counts.hint("merge"), ["grp", "size", "digit"], "left").select(
            "row", "id", "size", "sub", "n", "top", *[F.when(unsplit, F.col(c)).alias(c) for c in keep]
        )
        found = stage(found, "radix-rows")
        done.append(found.where(~unsplit).drop(*keep))
        unstage(counts)
        open_ = found.where(unsplit).select("row", "id", *keep, F.col("sub").alias("grp"), "size")
        if open_.isEmpty():
            break
        start, width = start + width, width * growth
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result.select(
        "row",
        F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("top")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (F.col("n").isNull() | F.col("id").eqNullSafe(F.col("top"))).alias("kept"),
    )
