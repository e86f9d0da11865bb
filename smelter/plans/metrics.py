"""Semantic layer: metric views whose measures are defined once.

A ``MetricView`` names a source frame, left joins to dimension frames,
dimensions (name -> SQL expression over the joined row) and measures (name ->
SQL aggregate expression).  ``query`` re-aggregates the chosen measures from
the source rows at whatever grouping is asked, so ratios stay ratios of sums
under any filter or grain.  The result is an ordinary ``groupBy().agg()``
plan.  Left joins are declared on unique keys, so a query joins only the
dimensions that it names.

Relative periods are taken from a reference day (``as_of``, by default the
last day of a fact, one cheap maximum) and become date literals, which reach
the scan.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.functions.columns import round_half_up
from smelter.operators.sizing import broadcast_if_small
from smelter.operators.states import MeasureStates, over_states


@dataclass
class ViewJoin:
    name: str
    frame: DataFrame
    on: str  # SQL condition over ``source.<col>`` and ``<name>.<col>``
    how: str = "left"


@dataclass
class MetricView:
    source: DataFrame
    dimensions: dict[str, str]
    measures: dict[str, str]
    joins: Sequence[ViewJoin] = field(default_factory=tuple)

    def _joins_for(self, text: str) -> list[ViewJoin]:
        """Joins whose columns ``text`` names, directly or through the
        condition of a join that is needed; inner joins always filter."""
        own = set(self.source.columns) | set(self.dimensions)
        words = set(re.findall(r"\w+", text))
        used = [j for j in self.joins if j.how != "left" or j.name in words or words & (set(j.frame.columns) - own)]
        more = " ".join([text, *(j.on for j in used)])
        return used if more == text or set(re.findall(r"\w+", more)) <= words else self._joins_for(more)

    def rows(self, used: Sequence[str] | None = None) -> DataFrame:
        """Joined source rows with every dimension as a column, or with the
        dimensions and joins that the expressions ``used`` need.  Other columns
        keep their names (the source's win over a dimension table's)."""
        df = self.source.alias("source")
        joins, dimensions = self.joins, self.dimensions
        if used is not None:
            words = set(re.findall(r"\w+", " ".join(used)))
            dimensions = {n: e for n, e in self.dimensions.items() if n in words}
            joins = self._joins_for(" ".join([*used, *dimensions.values()]))
        carried: list[tuple[str, Column]] = [
            (c, F.col(f"source.`{c}`")) for c in self.source.columns]
        seen = set(self.source.columns)
        for j in joins:
            df = df.join(broadcast_if_small(j.frame).alias(j.name), F.expr(j.on), j.how)
            for c in j.frame.columns:
                if c not in seen:
                    carried.append((c, F.col(f"{j.name}.`{c}`")))
                    seen.add(c)
        dims = [F.expr(expr).alias(name) for name, expr in dimensions.items()]
        rest = [col.alias(name) for name, col in carried if name not in self.dimensions]
        return df.select(*dims, *rest)

    def query(self, dimensions: Sequence[str] = (), measures: Sequence[str] = (),
              where: Column | str | None = None, digits: int | None = None,
              within: dict[str, DataFrame] | None = None,
              order_by: Sequence[str | Column] = (), limit: int | None = None) -> DataFrame:
        unknown = [d for d in dimensions if d not in self.dimensions]
        unknown += [m for m in measures if m not in self.measures]
        if unknown:
            raise KeyError(f"not defined in this view: {unknown}")
        condition = F.expr(where) if isinstance(where, str) else where
        named = [*dimensions, *(self.measures[m] for m in measures), *(within or {})]
        df = self.rows(named + ([] if condition is None else [condition._jc.toString()]))
        if condition is not None:
            df = df.filter(condition)
        # dimension values restricted to a (small) frame: an equi semi-join
        for dim, allowed in (within or {}).items():
            df = df.join(allowed.select(F.col(dim)).distinct(), dim, "left_semi")
        aggs = [F.expr(self.measures[m]).alias(m) for m in measures]
        out = df.groupBy(*dimensions).agg(*aggs) if dimensions else df.agg(*aggs)
        if digits is not None:
            # round floating measures only (counts and integer sums stay exact)
            types = dict(out.dtypes)
            out = out.select(*dimensions, *[
                round_half_up(m, digits).alias(m) if types[m] in ("double", "float") else F.col(m)
                for m in measures])
        out = out.orderBy(*order_by) if order_by else out
        return out if limit is None else out.limit(limit)

    def over(self, states: MeasureStates, dimensions: Sequence[str], measures: Sequence[str]) -> MetricView:
        """The view for one question, over the smallest stored states of its
        source that can answer it: the named dimensions' columns decide the
        grain, months suffice unless a dimension takes the date as it is."""
        exprs = [self.dimensions[d] for d in dimensions]
        joins = self._joins_for(" ".join(exprs))
        texts = [*exprs, *(j.on for j in joins)]
        monthly = [t.replace(f"trunc(source.{states.date}, 'MM')", "") for t in texts]
        own = set(re.findall(r"source\.(\w+)", " ".join(monthly)))
        unit = "day" if states.date in own else "month"
        grain = states.covering(own - {states.date}, unit)
        source = states.read(grain).withColumnRenamed("period", states.date)
        return MetricView(source, {d: self.dimensions[d] for d in dimensions},
                          {m: over_states(self.measures[m]) for m in measures}, joins)

    def values(self, dimension: str, where: Column | None = None) -> DataFrame:
        """Distinct values of a dimension (optionally of the rows matching ``where``)."""
        rows = self.rows() if where is None else self.rows().filter(where)
        return rows.select(dimension).distinct()


def last_day(frame: DataFrame, column: str = "date") -> dt.date | None:
    """The reference day of relative periods when none is given."""
    return frame.agg(F.to_date(F.max(column))).first()[0]


def month_begin(day: dt.date, months_back: int = 0) -> dt.date:
    """The first day of the month ``months_back`` months before ``day``'s."""
    months = day.year * 12 + day.month - 1 - months_back
    return dt.date(months // 12, months % 12 + 1, 1)


def between(frame: DataFrame, first: dt.date | None, last: dt.date | None = None, column: str = "date") -> DataFrame:
    """Rows of a date range, both ends included; an open end has no bound."""
    if first is not None:
        frame = frame.where(F.col(column) >= F.lit(first))
    return frame if last is None else frame.where(F.col(column) <= F.lit(last))
