"""Exact duplicates by a distributed MSD radix partitioning of the texts' bytes.

A digit is a run of bytes: 64 at first, eight times as many in each later round. A round splits every open
group by the next digit. Rows alone in their group are finished, and so are groups whose texts have ended;
only the others go on, so later rounds touch ever fewer rows. Texts are compared byte by byte; no digest
decides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import bare, col, materialize

FIRST_DIGIT = 64
GROWTH = 8
MADE = ("keep_id", "group_size", "kept")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """Every row of ``docs`` with ``keep_id`` (largest id among equal texts), ``group_size`` and ``kept``.

    * A null text equals the empty text. A null id is smaller than any other; a group of null ids has a null ``keep_id``.
    * Of rows that repeat text and id, one is kept.
    * An input column named like a result column gives way to it. ``keep_text=False`` leaves the text out.
    * An empty table gives an empty result.

    The digits of a hot group are counted before the shuffle. The groups of a round are stored, so the join
    that hands them to the rows has a plain scan on either side and adaptive execution can split a hot group. It
    is a merge join at every size: the table of groups has no bound that would allow to broadcast it.
    """
    passed = [c for c in bare(docs, *MADE) if c not in (id_col, text_col)]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    open_rows = docs.select(
        F.struct(F.lit(0).alias("_"), *[col(c).alias(f"c{i}") for i, c in enumerate(passed)]).alias("row"),
        col(id_col).alias("id"), col(text_col).alias("text"), F.lit(0).cast("long").alias("place"),
    )
    start, width, finished = 0, FIRST_DIGIT, []
    while True:
        keyed = open_rows.select(
            "*",
            F.substring(text.cast("binary"), start + 1, width).alias("digit"),
            (F.octet_length(text) <= start + width).alias("ended"),
        )
        groups = materialize(
            keyed.groupBy("place", "digit", "ended")
            .agg(F.count("*").alias("n"), F.max("id").alias("keep_id"))
            .filter("n > 1")
            .withColumn("next_place", F.monotonically_increasing_id()),
            "radix-groups",
        )
        still_open = F.col("n").isNotNull() & ~F.col("ended")
        rows = materialize(
            keyed.join(groups.hint("merge"), ["place", "digit", "ended"], "left").select(
                "row", "id", "n", "keep_id", "ended", F.col("next_place").alias("place"),
                F.monotonically_increasing_id().alias("uid"),
                "text" if keep_text else F.when(still_open, F.col("text")).alias("text"),
            ),
            "radix-rows",
        )
        finished.append(rows.filter(~still_open))
        if groups.filter("not ended").isEmpty():
            break
        open_rows = rows.filter(still_open).select("row", "id", "text", "place")
        start, width = start + width, width * GROWTH

    def result(df: DataFrame, keep_id, size, kept) -> DataFrame:
        return df.select(
            "id", "text", "row", keep_id.alias("keep_id"), size.cast("long").alias("group_size"), kept.alias("kept"),
        )

    parts = []
    for rows in finished:
        parts.append(result(rows.filter("n is null"), F.col("id"), F.lit(1), F.lit(True)))
        equal = rows.filter("n is not null")
        # One row of each group carries the largest id; among rows that repeat it too, the first one stored.
        winners = equal.filter(F.col("id").eqNullSafe(F.col("keep_id"))).groupBy("place").agg(F.min("uid").alias("uid"))
        marked = equal.join(winners.select("uid", F.lit(True).alias("won")), "uid", "left")
        parts.append(result(marked, F.col("keep_id"), F.col("n"), F.coalesce("won", F.lit(False))))
    own = {id_col: F.col("id"), text_col: F.col("text")} if keep_text else {id_col: F.col("id")}
    order = [c for c in bare(docs, *MADE) if c in own or c in passed]
    shown = [own[c].alias(c) if c in own else F.col(f"row.c{passed.index(c)}").alias(c) for c in order]
    return reduce(DataFrame.union, parts).select(*shown, *MADE)
