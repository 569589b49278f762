"""Scans along an order, in two levels, so that no key is sorted in one task.

A table is dealt by ranges of keys and order and written once with the number of its range.
Inside a range a scan is a window; each range hands what it ends with (or begins with) to
the ranges after (or before) it. Only keys that lie in several ranges need that: there is at
most one at each border, so the rows that are handed on number at most twice the ranges and
are broadcast. Where all keys are small beside a task's share, none is cut: the scans are then
windows over whole keys, and nothing is dealt or handed on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import forget, materialize

#: Kinds of scans. ``previous`` and ``next``: the neighbouring row's value, null too. ``last``, ``last_before``,
#: ``first_after``: the nearest value that isn't null, with this row or without. ``max``, ``max_before``, ``sum``: over all rows up to here.
KINDS = ("previous", "next", "last", "last_before", "first_after", "max", "max_before", "sum")
_BACKWARD = ("next", "first_after")
#: Rows of a key that any task can sort, whatever its share.
FEW = 10_000


class Ranges:
    """Rows in ranges of (keys, order), to which scans are added.

    ``order`` must be total in all that a scan reads: rows of equal keys and order lie in one
    range and are taken in any order. Null keys are a key, null orders come first. If no key has
    more rows than ``FEW`` or than a task's share of the table, keys stay ``whole``. With ``written``
    the table is one that is cheap to read again, and is not written before its keys are counted.
    """

    def __init__(self, df: DataFrame, keys: list[str], order: list[str], partitions: int | None = None, written: bool = False):
        n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.keys, self.order = list(keys), list(order)
        self.df = df if written else materialize(df, "rows")
        counted = self.df.groupBy(*self.keys).count().agg(F.sum("count"), F.max("count")).first()
        self.whole = (counted[1] or 0) <= max(FEW, (counted[0] or 0) // n)
        self._cut = [] if self.whole else ["_part"]
        if not self.whole:
            rows, self.df = self.df, materialize(self.df.repartitionByRange(n, *self.keys, *self.order).withColumn("_part", F.spark_partition_id()), "ranges")
            if not written:
                forget(rows)

    def add(self, **scans: tuple[str, Column]) -> Ranges:
        """One column a scan: ``name=(kind, value)``."""
        inside = Window.partitionBy(*self.keys, *self._cut).orderBy(*self.order)
        upto, before = (inside.rowsBetween(Window.unboundedPreceding, x) for x in (0, -1))
        # from the end backwards: a frame that follows a row would be gone through anew for each row
        after = Window.partitionBy(*self.keys, *self._cut).orderBy(*(F.col(c).desc() for c in self.order)).rowsBetween(Window.unboundedPreceding, -1)
        at = F.struct(*self.order)
        parts = Window.partitionBy(*self.keys).orderBy("_part")
        earlier, later = parts.rowsBetween(Window.unboundedPreceding, -1), parts.rowsBetween(1, Window.unboundedFollowing)
        own, edge, hand, meet, alone = {}, {}, {}, {}, {}
        for name, (kind, value) in scans.items():
            packed = F.struct(value.alias("v"))
            if kind in ("last", "last_before", "first_after"):
                packed = F.when(value.isNotNull(), packed)
            o, h = f"_own_{name}", f"_hand_{name}"
            if kind in ("previous", "next"):
                own[o] = (F.lag if kind == "previous" else F.lead)(packed).over(inside)
            elif kind in ("last", "last_before"):
                own[o] = F.last(packed, ignorenulls=True).over(upto if kind == "last" else before)
            elif kind == "first_after":
                own[o] = F.last(packed, ignorenulls=True).over(after)
            elif kind in ("max", "max_before"):
                own[o] = F.max(value).over(upto if kind == "max" else before)
            elif kind == "sum":
                own[o] = F.sum(value).over(upto)
            else:
                raise ValueError(f"{kind} is none of {KINDS}")
            alone[name] = F.col(o) if kind in ("max", "max_before", "sum") else F.col(o)["v"]
            if kind in ("max", "max_before", "sum"):
                total = F.sum if kind == "sum" else F.max
                edge[h], hand[h] = total(value), total(h).over(earlier)
                meet[name] = F.coalesce(F.col(o) + F.col(h), o, h) if kind == "sum" else F.greatest(o, h)
            else:
                near = F.min_by if kind in _BACKWARD else F.max_by
                edge[h] = near(packed, at) if kind in ("previous", "next") else near(packed, F.when(value.isNotNull(), at))
                hand[h] = F.first(h, ignorenulls=True).over(later) if kind in _BACKWARD else F.last(h, ignorenulls=True).over(earlier)
                meet[name] = F.coalesce(o, h)["v"]
        if self.whole:
            self.df = self.df.withColumns(own).withColumns(alone).drop(*own)
            return self
        edges = self.df.groupBy(*self.keys, "_part").agg(*(c.alias(h) for h, c in edge.items()))
        edges = edges.withColumns(hand).where(reduce(lambda a, b: a | b, (F.col(h).isNotNull() for h in hand)))
        on = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in (*self.keys, "_part")]
        joined = self.df.withColumns(own).alias("l").join(F.broadcast(edges.alias("r")), on, "left").select("l.*", *hand)
        self.df = joined.withColumns(meet).drop(*own, *hand)
        return self

    def runs(self, value: Column, out: str) -> Ranges:
        """Number the runs of equal values (null equals null) per key, from 1."""
        self.add(_before=("previous", F.struct(value.alias("v"))))
        changed = F.col("_before").isNull() | ~value.eqNullSafe(F.col("_before.v"))
        self.df = self.df.withColumn("_new", changed.cast("long")).drop("_before")
        self.add(**{out: ("sum", F.col("_new"))})
        self.df = self.df.drop("_new")
        return self

    def where(self, condition: Column | str) -> Ranges:
        """Fewer rows, in the same ranges."""
        self.df = self.df.where(condition)
        return self

    def rows(self) -> DataFrame:
        return self.df.drop("_part")
