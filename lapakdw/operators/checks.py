"""Reusable counts of rule violations.

``pattern``, ``value_range``, ``domain`` and ``blank`` are conditions on single
rows; those on one table can share a scan. The others start from row counts per
key. ``count_together`` answers any number of them at once: one scan of each
table emits a row per key that some rule asks for, with the counters of all
rules, one grouping adds them up, within each task first, and what every rule
makes of a key is summed behind it. Tables that a rule holds against each other
meet in that grouping, so nothing is stored and nothing is joined. A rule on its
own joins counts per key. Either way a key that holds a large part of a table
costs one row per task in the shuffle, and no pairs of rows are ever formed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapakdw.functions.columns import code, is_blank, try_double, try_int

Views = Mapping[str, DataFrame]
VIOLATIONS = "violations"
ROWS = "_rows"


@dataclass(frozen=True)
class RowRule:
    """Counts the rows of a view on which a condition is true."""

    view: str
    condition: Callable[[], Column]

    def count(self) -> Column:
        return F.count_if(self.condition())

    def frame(self, views: Views) -> DataFrame:
        return views[self.view].agg(self.count().alias(VIOLATIONS))


@dataclass(frozen=True)
class KeyCount:
    """Rows per key of a view: all of them, or those on which a condition is true."""

    view: str
    keys: tuple[str, ...]
    condition: Callable[[], Column] | None = None

    def frame(self, views: Views) -> DataFrame:
        df = views[self.view]
        if self.condition is not None:
            df = df.where(self.condition())
        return df.groupBy(*self.keys).agg(F.count("*").alias(ROWS))

    def counter(self) -> Column:
        """What a row adds to its key."""
        one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
        return one if self.condition is None else F.when(self.condition(), one).otherwise(none)


@dataclass(frozen=True)
class KeyRule:
    """Counts violations from row counts per key.

    ``combine`` makes one row of the frames of counts, one column of it.
    ``measure`` says the same key by key: it takes whether all values of the key
    are known and the number of rows of each count, 0 where the view lacks the
    key, and its sum over the keys is the result. A rule with ``labels``, one per key column, lists the keys instead.
    """

    counts: tuple[KeyCount, ...]
    combine: Callable[..., DataFrame]
    measure: Callable[..., Column] | None = None
    labels: tuple[str, ...] = ()

    def frame(self, views: Views) -> DataFrame:
        return self.combine(*(count.frame(views) for count in self.counts))

    def joins_others(self, views: Views) -> bool:
        """Whether ``count_together`` can answer it: its keys are texts, and it works key by key.

        Raises what is wrong with its columns and conditions, if anything is.
        """
        if self.measure is None and not self.labels:
            return False
        asked = [views[c.view].select(*c.keys, c.counter().alias(ROWS)).drop(ROWS) for c in self.counts]
        return all(isinstance(field.dataType, T.StringType) for df in asked for field in df.schema.fields)


def count_together(views: Views, rules: Mapping[str, KeyRule]) -> DataFrame:
    """All rules at once, as rows of (name, labels, value).

    ``labels`` is null, except for rules that list their keys: they have one row
    per key, with its values. Every view is read once, however many rules and
    keys there are, and the rows of all views are grouped once by the number of
    the key and its values. Rules must be such that ``joins_others``.
    """
    domains: dict[tuple, int] = {}  # key columns, and the rule if it is a listing
    places: dict[tuple, int] = {}  # (domain, view, condition): counter of that domain
    asked: dict[str, dict[int, None]] = {}  # domains of each view
    for name, rule in rules.items():
        for count in rule.counts:
            domain = domains.setdefault((count.keys, name if rule.labels else None), len(domains))
            asked.setdefault(count.view, {})[domain] = None
            places.setdefault((domain, count.view, count.condition), sum(key[0] == domain for key in places))

    values = [f"_v{i}" for i in range(max(len(keys) for keys, _ in domains))]
    counters = [f"_c{i}" for i in range(max(places.values()) + 1)]
    keys_of = {number: keys for (keys, _), number in domains.items()}
    none, no_text = F.lit(0).cast("bigint"), F.lit(None).cast("string")

    def emitted(view: str, domain: int) -> list[Column]:
        row = {name: no_text for name in values} | {name: none for name in counters}
        row |= {f"_v{i}": F.col(key) for i, key in enumerate(keys_of[domain])}
        for (number, of, condition), i in places.items():
            if (number, of) == (domain, view):
                row[f"_c{i}"] = KeyCount(view, (), condition).counter()
        return [F.lit(domain).alias("_key"), *(value.alias(name) for name, value in row.items())]

    frames = []
    for view, numbers in asked.items():
        rows = [emitted(view, number) for number in numbers]
        one = rows[0] if len(rows) == 1 else [F.inline(F.array(*(F.struct(*row) for row in rows)))]
        frames.append(views[view].select(*one))
    grouped = reduce(DataFrame.unionByName, frames).groupBy("_key", *values)
    grouped = grouped.agg(*(F.sum(name).alias(name) for name in counters))

    sums: dict[str, Column] = {}
    listed: dict[int, str] = {}
    for name, rule in rules.items():
        keys = rule.counts[0].keys
        domain = domains[keys, name if rule.labels else None]
        if rule.labels:
            listed[domain] = name
            continue
        known = reduce(lambda a, b: a & b, (F.col(f"_v{i}").isNotNull() for i in range(len(keys))))
        counted = (F.col(f"_c{places[domain, count.view, count.condition]}") for count in rule.counts)
        measured = rule.measure(known, *counted)
        sums[name] = F.coalesce(F.sum(F.when(F.col("_key") == domain, measured)), none)

    results = [
        F.struct(F.lit(name).alias("name"), F.lit(None).cast("array<string>").alias("labels"), F.col(f"`{name}`").alias("value"))
        for name in sums
    ]
    totals = [total.alias(name) for name, total in sums.items()]
    if not listed:
        return grouped.agg(*totals).select(F.inline(F.array(*results)))
    # Rows of listings keep their key; all others fall into one group, which a row of zeros makes sure of.
    session = next(iter(frames)).sparkSession
    zero = session.range(1).select(
        F.lit(-1).alias("_key"), *(no_text.alias(v) for v in values), *(none.alias(c) for c in counters)
    )
    which = F.when(F.col("_key").isin(*listed), F.col("_key"))
    labels = F.when(which.isNotNull(), F.array(*values))
    whole = grouped.unionByName(zero).groupBy(which.alias("_which"), labels.alias("_labels"))
    whole = whole.agg(F.sum(counters[0]).alias("_n"), *totals)
    names = F.create_map(*(F.lit(x) for pair in listed.items() for x in pair))
    listing = F.array(
        F.struct(names[F.col("_which")].alias("name"), F.col("_labels").alias("labels"), F.col("_n").alias("value"))
    )
    others = F.array(*results) if results else F.slice(listing, 1, 0)
    return whole.select(F.inline(F.when(F.col("_which").isNull(), others).otherwise(listing)))


def typed(column: str, dtype: str) -> Column:
    """Raw text as ``int``, ``bigint`` or ``double``; NULL where it is not one."""
    return try_double(F.col(column)) if dtype == "double" else try_int(F.col(column), dtype)


def pattern(view: str, column: str, like: str) -> RowRule:
    return RowRule(view, lambda: F.col(column).like(like))


def value_range(view: str, column: Callable[[], Column], bad: Callable[[Column], Column]) -> RowRule:
    """``bad`` says which typed values break the rule; values that are not numbers do not."""
    return RowRule(view, lambda: bad(column()))


def domain(view: str, column: str, allowed: tuple[str, ...]) -> RowRule:
    return RowRule(view, lambda: ~code(F.col(column)).isin(*allowed))


def blank(view: str, column: str) -> RowRule:
    return RowRule(view, lambda: is_blank(F.col(column)))


def _one(condition: Column) -> Column:
    return condition.cast("bigint")


def _repeated_keys(counted: DataFrame) -> DataFrame:
    return counted.agg(F.count_if(F.col(ROWS) > 1).alias(VIOLATIONS))


def _orphans(key: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Written as an outer join, not an anti join: the optimizer moves an anti join
    below the grouping, and the child would be shuffled row by row again."""

    def combine(child: DataFrame, parent: DataFrame) -> DataFrame:
        known = parent.select(key).withColumn("_known", F.lit(True))
        missing = child.join(known, key, "left").where(F.col("_known").isNull())
        return missing.agg(F.coalesce(F.sum(ROWS), F.lit(0)).alias(VIOLATIONS))

    return combine


def _pairs(key: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    def combine(left: DataFrame, right: DataFrame) -> DataFrame:
        both = left.withColumnRenamed(ROWS, "_left").join(right.withColumnRenamed(ROWS, "_right"), key)
        return both.agg(F.coalesce(F.sum(F.col("_left") * F.col("_right")), F.lit(0)).alias(VIOLATIONS))

    return combine


def _split(determinant: str, dependent: str) -> Callable[[DataFrame], DataFrame]:
    def combine(counted: DataFrame) -> DataFrame:
        groups = counted.groupBy(determinant).agg(F.count(dependent).alias("_values"))
        return groups.agg(F.count_if(F.col("_values") > 1).alias(VIOLATIONS))

    return combine


def _distinct(key: str) -> Callable[[DataFrame], DataFrame]:
    return lambda counted: counted.agg(F.count(key).alias(VIOLATIONS))


def orphan_rows(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose key, NULL included, has no row in ``parent``."""
    return orphan("child", "parent", key).frame({"child": child, "parent": parent})


def matching_pairs(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Size of the inner join on ``key``: the product of both counts, summed over the keys.

    A number of pairs beyond the range of a bigint is an error, not a wrong count.
    """
    one, two = KeyCount("left", (key,)), KeyCount("right", (key,))
    return KeyRule((one, two), _pairs(key)).frame({"left": left, "right": right})


def duplicate_key(view: str, *keys: str) -> KeyRule:
    """Number of key values that occur more than once."""
    return KeyRule((KeyCount(view, keys),), _repeated_keys, lambda known, rows: _one(rows > 1))


def distinct_values(view: str, column: str) -> KeyRule:
    """Number of different values, nulls not counted."""
    return KeyRule((KeyCount(view, (column,)),), _distinct(column), lambda known, rows: _one(known & (rows > 0)))


def orphan(child: str, parent: str, key: str) -> KeyRule:
    def measure(known: Column, in_child: Column, in_parent: Column) -> Column:
        return F.when(known & (in_parent > 0), 0).otherwise(in_child)

    return KeyRule((KeyCount(child, (key,)), KeyCount(parent, (key,))), _orphans(key), measure)


def cross_table(
    left: str, left_bad: Callable[[], Column], right: str, right_bad: Callable[[], Column], key: str
) -> KeyRule:
    """Joined rows of two views that break a rule made of one condition on each."""
    counts = (KeyCount(left, (key,), left_bad), KeyCount(right, (key,), right_bad))
    return KeyRule(counts, _pairs(key), lambda known, one, two: F.when(known, one * two).otherwise(0))


def fd_violation(view: str, determinant: str, dependent: str) -> KeyRule:
    """Values of ``determinant`` that come with more than one value of ``dependent``.

    Counted on its own: two steps of counts, which no single grouping has.
    """
    return KeyRule((KeyCount(view, (determinant, dependent)),), _split(determinant, dependent))


def listing(view: str, labels: Mapping[str, str]) -> KeyRule:
    """Rows per combination of columns, most frequent first; ``labels`` renames the columns."""

    def combine(counted: DataFrame) -> DataFrame:
        named = (F.col(column).alias(label) for column, label in labels.items())
        return counted.select(*named, F.col(ROWS).alias("baris")).orderBy(F.desc("baris"))

    return KeyRule((KeyCount(view, tuple(labels)),), combine, labels=tuple(labels.values()))
