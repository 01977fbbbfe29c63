"""Type-2 history: merge a new batch into the versions kept so far."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Names of the history columns.
SCD_ID = "dbt_scd_id"
UPDATED_AT = "dbt_updated_at"
VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"
META = (SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO)
# What a load does to a version.
CHANGE = "_change"
KEPT, CLOSED, OPENED = "kept", "closed", "opened"


def _first_versions(cur: DataFrame, key: str, moment: Column) -> DataFrame:
    """Every row as an open version that begins at ``moment``."""
    return cur.select(
        "*",
        F.md5(F.concat(F.col(key).cast("string"), F.lit("|"), moment.cast("string"))).alias(SCD_ID),
        moment.alias(UPDATED_AT),
        moment.alias(VALID_FROM),
        F.lit(None).cast(cur.select(moment.alias("m")).schema["m"].dataType).alias(VALID_TO),
    )


def _message(key: str) -> Column:
    return F.concat(F.lit(f"the batch repeats {key}: "), F.col(key).cast("string"))


def _refuse(rows: DataFrame, bad: Column, message: Column) -> DataFrame:
    """``rows``, or an error once the plan comes upon a bad one. No job of its own."""
    return rows.filter(F.when(bad, F.raise_error(message)).otherwise(F.lit(True)))


def _first_load(cur: DataFrame, key: str, moment: Column) -> DataFrame:
    """A batch with two rows of one key has no single newest version. Keys alone are counted, map-side, as a subquery."""
    repeated = cur.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1")
    example = repeated.agg(F.min(F.col(key).cast("string")).alias("example")).scalar()
    message = F.concat(F.lit(f"the batch repeats {key}: "), example)
    return _first_versions(_refuse(cur, example.isNotNull(), message), key, moment)


def _merge(
    open_rows: DataFrame, fresh: DataFrame, key: str, changed: Column, closed_at: Column, all_open: bool
) -> DataFrame:
    """Open versions ``o`` met with fresh ones ``n`` on the key: one shuffle, and one or two rows for each pair.

    ``changed`` says whether the fresh version replaces the open one; ``closed_at`` is the end the open version gets, or
    null to leave it open. With ``all_open`` open versions that stay are given out too, else only what changes. ``CHANGE``
    says which of the three a row is. Rows without a key meet nothing and pass beside the join. The batch is sorted by key
    for the join anyway, so the second row of a key is seen there.
    """
    names = fresh.columns
    nth = F.row_number().over(Window.partitionBy(key).orderBy(key))
    keyed = _refuse(fresh.filter(F.col(key).isNotNull()).withColumn("_nth", nth), F.col("_nth") > 1, _message(key))
    old_side = open_rows.select(F.struct(*names).alias("o"), F.col(key).alias("_key"))
    new_side = keyed.select(F.struct(*names).alias("n"), F.col(key).alias("_key"))
    pairs = old_side.filter("_key IS NOT NULL").join(new_side, "_key", "full_outer").select("o", "n")
    types = pairs.schema
    none = {c: F.lit(None).cast(types[c].dataType).alias(c) for c in ("o", "n")}
    pairs = pairs.union(old_side.filter("_key IS NULL").select("o", none["n"]))
    pairs = pairs.union(fresh.filter(F.col(key).isNull()).select(none["o"], F.struct(*names).alias("n")))

    end = closed_at.cast(open_rows.schema[VALID_TO].dataType)
    given = F.col("o").isNotNull() if all_open else F.col("o").isNotNull() & end.isNotNull()
    tagged = F.col("o").withField(VALID_TO, end).withField(CHANGE, F.when(end.isNotNull(), CLOSED).otherwise(KEPT))
    inserted = F.when(F.col("o").isNull() | changed, F.col("n").withField(CHANGE, F.lit(OPENED)))
    return pairs.select(F.inline(F.array_compact(F.array(F.when(given, tagged), inserted))))


def _by_timestamp(open_rows: DataFrame, cur: DataFrame, key: str, updated_at: str, all_open: bool) -> DataFrame:
    changed = F.col("n").isNotNull() & (F.col(f"o.{VALID_FROM}") < F.col(f"n.{UPDATED_AT}"))
    fresh = _first_versions(cur, key, F.col(updated_at))
    return _merge(open_rows, fresh, key, changed, F.when(changed, F.col(f"n.{UPDATED_AT}")), all_open)


def _by_columns(
    open_rows: DataFrame, cur: DataFrame, key: str, check_cols: Sequence[str], as_of: Column, hard_deletes: bool, all_open: bool
) -> DataFrame:
    differs = F.lit(False)
    for c in check_cols:
        differs = differs | ~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
    changed = F.col("n").isNotNull() & F.col("o").isNotNull() & differs
    closing = (changed | F.col("n").isNull()) if hard_deletes else changed
    return _merge(open_rows, _first_versions(cur, key, as_of), key, changed, F.when(closing, as_of), all_open)


def _whole(prev: DataFrame, merged: DataFrame) -> DataFrame:
    history = prev.filter(F.col(VALID_TO).isNotNull())
    return history.unionByName(merged.drop(CHANGE))


def snapshot_timestamp(prev: DataFrame | None, cur: DataFrame, key: str, updated_at: str) -> DataFrame:
    """A key gets a new version when its ``updated_at`` is later than its open version's start.

    Keys that are missing from the batch stay open. A batch that repeats a key is an error once the result is computed.
    """
    if prev is None:
        return _first_load(cur, key, F.col(updated_at))
    return _whole(prev, _by_timestamp(current_rows(prev), cur, key, updated_at, all_open=True))


def snapshot_check(
    prev: DataFrame | None,
    cur: DataFrame,
    key: str,
    check_cols: Sequence[str],
    as_of: Column,
    invalidate_hard_deletes: bool = True,
) -> DataFrame:
    """A key gets a new version at ``as_of`` when one of ``check_cols`` differs, nulls being equal.

    With ``invalidate_hard_deletes`` an open key that is missing from the batch is closed. A batch that repeats a key is an
    error once the result is computed.
    """
    if prev is None:
        return _first_load(cur, key, as_of)
    return _whole(prev, _by_columns(current_rows(prev), cur, key, check_cols, as_of, invalidate_hard_deletes, all_open=True))


def changes_timestamp(open_rows: DataFrame | None, cur: DataFrame, key: str, updated_at: str) -> DataFrame:
    """What ``snapshot_timestamp`` changes: closed versions and new ones, told apart by ``CHANGE``.

    ``open_rows`` holds the open versions alone; None is the first load. Columns that the batch lacks (a row number, say)
    stay with closed versions and are null in new ones.
    """
    if open_rows is None:
        return _first_load(cur, key, F.col(updated_at)).withColumn(CHANGE, F.lit(OPENED))
    return _by_timestamp(open_rows, _widened(cur, open_rows), key, updated_at, all_open=False)


def changes_check(
    open_rows: DataFrame | None,
    cur: DataFrame,
    key: str,
    check_cols: Sequence[str],
    as_of: Column,
    invalidate_hard_deletes: bool = True,
) -> DataFrame:
    """What ``snapshot_check`` changes, see ``changes_timestamp``."""
    if open_rows is None:
        return _first_load(cur, key, as_of).withColumn(CHANGE, F.lit(OPENED))
    wide = _widened(cur, open_rows)
    return _by_columns(open_rows, wide, key, check_cols, as_of, invalidate_hard_deletes, all_open=False)


def _widened(cur: DataFrame, open_rows: DataFrame) -> DataFrame:
    missing = [f for f in open_rows.schema if f.name not in cur.columns and f.name not in META]
    return cur.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


def current_rows(snapshot: DataFrame) -> DataFrame:
    """The open version of every key."""
    return snapshot.filter(F.col(VALID_TO).isNull())
