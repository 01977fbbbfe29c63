"""Declarative data tests. Each returns the failing rows; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.session import counted, materialize


def _literal(value: Any) -> str:
    """A Python value as SQL text."""
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    raise TypeError(f"no SQL literal for {type(value).__name__}")


def _name(col: str) -> str:
    return f"`{col}`"


def _scope(df: DataFrame, where: str | None) -> DataFrame:
    return df.filter(where) if where else df


# Failing conditions as SQL text. A null condition is no failure.


def _outside(col: str, values: Sequence[Any]) -> str:
    """True for a value that is not listed. Null passes; a null in the list adds nothing to it."""
    listed = ", ".join(_literal(v) for v in values if v is not None)
    return f"{_name(col)} IS NOT NULL" + (f" AND {_name(col)} NOT IN ({listed})" if listed else "")


def _out_of_range(col: str, low: Any = None, high: Any = None, inclusive: bool = True) -> str:
    below, above = ("<", ">") if inclusive else ("<=", ">=")
    bounds = []
    if low is not None:
        bounds.append(f"{_name(col)} {below} {_literal(low)}")
    if high is not None:
        bounds.append(f"{_name(col)} {above} {_literal(high)}")
    return " OR ".join(bounds) or "FALSE"


def _not_greater(a: str, b: str, or_equal: bool = False) -> str:
    return f"NOT ({_name(a)} {'>=' if or_equal else '>'} {_name(b)})"


def _no_match(col: str, regex: str) -> str:
    return f"NOT ({_name(col)} RLIKE {_literal(regex)})"


def _untrue(sql_expr: str) -> str:
    return f"NOT ({sql_expr})"


def not_null(df: DataFrame, col: str, where: str | None = None) -> DataFrame:
    return _scope(df, where).filter(f"{_name(col)} IS NULL")


def unique(df: DataFrame, col: str, where: str | None = None) -> DataFrame:
    """Values that occur more than once, nulls aside."""
    counted = _scope(df, where).filter(f"{_name(col)} IS NOT NULL").groupBy(col)
    return counted.agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def unique_combination(df: DataFrame, cols: Sequence[str], where: str | None = None) -> DataFrame:
    """Combinations that occur more than once; nulls count as equal."""
    counted = _scope(df, where).groupBy(*cols)
    return counted.agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def accepted_values(df: DataFrame, col: str, values: Sequence[Any], where: str | None = None) -> DataFrame:
    """Each value that is not accepted, once, with its number of rows."""
    bad = _scope(df, where).filter(_outside(col, values))
    return bad.groupBy(col).agg(F.count(F.lit(1)).alias("n_records"))


def in_set(df: DataFrame, col: str, values: Sequence[Any], where: str | None = None) -> DataFrame:
    return _scope(df, where).filter(_outside(col, values))


def relationships(
    child: DataFrame, col: str, parent: DataFrame, parent_col: str, where: str | None = None
) -> DataFrame:
    """Child rows whose value does not occur in the parent; null passes."""
    keys = parent.select(F.col(parent_col).alias("_parent_key"))
    rows = _scope(child, where).filter(f"{_name(col)} IS NOT NULL")
    return rows.join(keys, F.col(col) == F.col("_parent_key"), "left_anti")


def matches_regex(df: DataFrame, col: str, regex: str, where: str | None = None) -> DataFrame:
    return _scope(df, where).filter(_no_match(col, regex))


def accepted_range(
    df: DataFrame, col: str, low: Any = None, high: Any = None, inclusive: bool = True, where: str | None = None
) -> DataFrame:
    return _scope(df, where).filter(_out_of_range(col, low, high, inclusive))


def pair_greater(df: DataFrame, a: str, b: str, or_equal: bool = False, where: str | None = None) -> DataFrame:
    return _scope(df, where).filter(_not_greater(a, b, or_equal))


def expression(df: DataFrame, sql_expr: str, where: str | None = None) -> DataFrame:
    return _scope(df, where).filter(_untrue(sql_expr))


@dataclass(frozen=True)
class DataTest:
    """One declared test. ``kind`` is the name of one of the functions above."""

    model: str
    kind: str
    columns: tuple[str, ...] = ()
    args: Mapping[str, Any] = field(default_factory=dict)
    where: str | None = None
    severity: str = "error"

    @property
    def label(self) -> str:
        """What the test is about: its columns, or its expression."""
        return self.args["sql_expr"] if self.kind == "expression" else ", ".join(self.columns)

    def row_condition(self) -> str | None:
        """The failing condition of one row as SQL text, for the tests that look at single rows."""
        condition = _ROW_CONDITIONS.get(self.kind)
        return condition(*self.columns, **self.args) if condition else None

    def failing_rows(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        df, cols, a = tables[self.model], self.columns, dict(self.args)
        if self.kind == "relationships":
            return relationships(df, cols[0], tables[a["to"]], a["field"], where=self.where)
        if self.kind == "unique_combination":
            return unique_combination(df, cols, where=self.where)
        return globals()[self.kind](df, *cols, **a, where=self.where)


_ROW_CONDITIONS = {
    "not_null": lambda col: f"{_name(col)} IS NULL",
    "in_set": _outside,
    "matches_regex": _no_match,
    "accepted_range": _out_of_range,
    "pair_greater": _not_greater,
    "expression": _untrue,
}


# Keys are kept in columns of two kinds: whole numbers as they are, everything else as text.
_WHOLE, _TEXT = "whole", "text"


def _kinds(df: DataFrame, columns: Sequence[str]) -> tuple[str, ...]:
    return tuple(_WHOLE if isinstance(df.schema[c].dataType, T.IntegralType) else _TEXT for c in columns)


@dataclass(frozen=True)
class _Key:
    """Values counted in one model: its columns, their kinds, and the rows that take part."""

    columns: tuple[str, ...]
    kinds: tuple[str, ...]
    takes_part: str

    def as_struct(self, number: int, width: int) -> str:
        """SQL of one row ``number, whole0, text0, whole1, ...``; null where the row does not take part."""
        fields = [f"'number', {number}"]
        for i in range(width):
            for kind, sql_type in ((_WHOLE, "BIGINT"), (_TEXT, "STRING")):
                used = i < len(self.columns) and self.kinds[i] == kind
                fields.append(f"'{kind}{i}', CAST({_name(self.columns[i]) if used else 'NULL'} AS {sql_type})")
        return f"CASE WHEN {self.takes_part} THEN named_struct({', '.join(fields)}) END"


def _slots(width: int) -> list[str]:
    return [f"{kind}{i}" for i in range(width) for kind in (_WHOLE, _TEXT)]


def _takes_part(test: DataTest) -> str:
    conditions = [f"({test.where})"] if test.where else []
    if test.kind == "accepted_values":
        conditions.append(_outside(test.columns[0], test.args["values"]))
    elif test.kind != "unique_combination":
        conditions.append(f"{_name(test.columns[0])} IS NOT NULL")
    return " AND ".join(conditions) or "TRUE"


@dataclass
class _Count:
    """What the one scan of each model counts: keys by number, and which of them a test or a reference uses."""

    keys: dict[str, dict[_Key, int]] = field(default_factory=dict)
    of_test: dict[int, int] = field(default_factory=dict)
    parent_of: dict[int, int] = field(default_factory=dict)

    def number(self, model: str, key: _Key) -> int:
        """Equal keys of a model are counted once, whoever asks."""
        mine = self.keys.setdefault(model, {})
        return mine.setdefault(key, sum(map(len, self.keys.values())))

    @classmethod
    def of(cls, tables: Mapping[str, DataFrame], tests: Mapping[int, DataTest]) -> _Count:
        made = cls()
        for i, t in tests.items():
            kinds = _kinds(tables[t.model], t.columns)
            if t.kind == "relationships":
                parent = tables[t.args["to"]]
                # Both sides in the same kind of column.
                if kinds != _kinds(parent, (t.args["field"],)):
                    kinds = (_TEXT,)
                named = (t.args["field"],)
                made.parent_of[i] = made.number(t.args["to"], _Key(named, kinds, f"{_name(named[0])} IS NOT NULL"))
            made.of_test[i] = made.number(t.model, _Key(t.columns, kinds, _takes_part(t)))
        return made


def _scan(
    df: DataFrame, rowwise: Mapping[int, DataTest], keys: Mapping[_Key, int], width: int
) -> tuple[DataFrame, Observation | None]:
    """The keys of one model as rows, and the failures of its single-row tests, which the same scan observes."""
    conditions = [f"({t.where or 'TRUE'}) AND ({t.row_condition()})" for t in rowwise.values()]
    structs = ", ".join(key.as_struct(number, width) for key, number in keys.items())
    # Conditions and keys come first, so the scan reads just the columns they need.
    narrow = df.selectExpr(
        *[f"({c}) AS `{i}`" for i, c in zip(rowwise, conditions, strict=True)], *([f"array({structs}) AS keys"] if keys else [])
    )
    failures = None
    if rowwise:
        failures = Observation()
        narrow = narrow.observe(failures, *[F.count_if(F.col(f"`{i}`")).alias(str(i)) for i in rowwise])
    if keys:
        return narrow.selectExpr("inline(keys)").filter("number IS NOT NULL"), failures
    # Nothing to count, but the scan has to run.
    empty = [f"CAST(NULL AS {'BIGINT' if c.startswith(_WHOLE) else 'STRING'}) AS {c}" for c in _slots(width)]
    return narrow.groupBy().count().filter("count > 0").selectExpr("-1 AS number", *empty), failures


def key_counts(
    tables: Mapping[str, DataFrame], tests: Mapping[int, DataTest], count: _Count
) -> tuple[DataFrame, list[Observation]]:
    """Rows per key over all models, and observations of the single-row failures: one scan per table, one shuffle.

    Rows are combined within their task, so a hot key is one row of each task in the shuffle.
    """
    rowwise = {i: t for i, t in tests.items() if i not in count.of_test}
    models = dict.fromkeys([t.model for t in tests.values()] + list(count.keys))
    width = max((len(k.columns) for keys in count.keys.values() for k in keys), default=1)
    scans = [
        _scan(tables[m], {i: t for i, t in rowwise.items() if t.model == m}, count.keys.get(m, {}), width) for m in models
    ]
    together = reduce(DataFrame.unionByName, [rows for rows, _ in scans])
    return together.groupBy("number", *_slots(width)).agg(F.count(F.lit(1)).alias("n")), [o for _, o in scans if o]


def told_apart(counts: DataFrame, tests: Mapping[int, DataTest], count: _Count) -> DataFrame:
    """The counts that can tell a failure: keys that are only tested for repeats, such as an item's, matter if they repeat."""
    whole = {n for i, n in count.of_test.items() if tests[i].kind not in ("unique", "unique_combination")} | set(count.parent_of.values())
    return counts.filter((F.col("n") > 1) | F.col("number").isin(*whole))


def _counted_failures(counts: DataFrame, tests: Mapping[int, DataTest], count: _Count) -> dict[int, int]:
    """Failures of the tests that count keys, from the stored counts. A number per test or reference is collected."""
    repeats = {n for i, n in count.of_test.items() if tests[i].kind in ("unique", "unique_combination")}
    listed = {n for i, n in count.of_test.items() if tests[i].kind == "accepted_values"}
    number, here = F.col("number"), F.lit(-1).alias("parent")
    several = counts.filter(number.isin(*listed) | (number.isin(*repeats) & (F.col("n") > 1)))
    found = [several.groupBy("number", here).agg(F.count(F.lit(1)).alias("failures"))]
    if count.parent_of:
        parents_of: dict[int, list[int]] = {}
        for i, parent in count.parent_of.items():
            parents_of.setdefault(count.of_test[i], []).append(parent)
        lists = F.create_map(*[x for n, ps in parents_of.items() for x in (F.lit(n), F.array(*map(F.lit, sorted(set(ps)))))])
        key = _slots(1)
        children = counts.filter(number.isin(*parents_of)).select("number", "n", *key, F.explode(lists[number]).alias("parent"))
        parents = counts.filter(number.isin(*count.parent_of.values())).select(number.alias("parent"), *key)
        same = [F.col(f"c.{c}").eqNullSafe(F.col(f"p.{c}")) for c in key]
        orphans = children.alias("c").join(parents.alias("p"), (F.col("c.parent") == F.col("p.parent")) & same[0] & same[1], "left_anti")
        found.append(orphans.groupBy("number", "parent").agg(F.sum("n").alias("failures")))
    rows = {(r["number"], r["parent"]): r["failures"] for r in reduce(DataFrame.unionByName, found).collect()}
    return {i: rows.get((n, count.parent_of.get(i, -1)), 0) for i, n in count.of_test.items()}


def run_tests(tables: Mapping[str, DataFrame], suite: Sequence[DataTest]) -> DataFrame:
    """One report row per test: model, test, column, failures, severity, status.

    Each table is scanned once, be it a model, a parent or both: single-row failures are observed while the keys are counted.
    The counts that can tell a failure are stored and serve repeats, references and their parents alike; only a number per
    test reaches the driver.
    The tests run when this is called.
    """
    numbered = dict(enumerate(suite))
    count = _Count.of(tables, {i: t for i, t in numbered.items() if t.row_condition() is None})
    failures = dict.fromkeys(numbered, 0)
    if numbered:
        counts, observed = key_counts(tables, numbered, count)
        stored = materialize(told_apart(counts, numbered, count), "test-keys")
        for o in observed:
            failures |= {int(i): n for i, n in counted(o).items()}
        failures |= _counted_failures(stored, numbered, count)

    def status(test: DataTest, n: int) -> str:
        return "pass" if n == 0 else "warn" if test.severity == "warn" else "fail"

    return next(iter(tables.values())).sparkSession.createDataFrame(
        [(i, t.model, t.kind, t.label, failures[i], t.severity, status(t, failures[i])) for i, t in numbered.items()],
        "test_no int, model string, test string, column string, failures long, severity string, status string",
    )
