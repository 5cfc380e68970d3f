"""Group a topic by chosen dimensions and compute chosen measures.

Left joins repeat rows: an order appears once per line, a user once per order.
Each measure still counts every row of its own view once. How:

- A measure of the base view, or of a view joined one to one, is summed as is.
- A measure of a view joined many to one is computed from one row per group
  and key of that view. If nothing else needs that view, it is joined after
  that grouping.
- A distinct count groups by the counted value in the same way.
- The joined rows are read once for all of these: they are grouped by the
  dimensions and every key at once, with the measures of the base as partial
  sums, and grouping sets roll that smaller table up for each key.
- A view joined one to many is joined in full only for its own measures. For
  everything else it is cut down to the distinct values the query needs, so
  two such views never multiply each other.

Every grouping is partial before its shuffle, so a group or key that holds
much of the data sends one row per task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.functions.clock import timeframe
from tablework.metrics.model import AccessDenied, Dimension, Filter, Hop, Measure, Model, Topic, UnknownField

Frames = Mapping[str, Callable[..., DataFrame]]


def output_name(field_name: str) -> str:
    """``orders.created_at[month]`` -> ``orders_created_at_month``."""
    return field_name.replace(".", "_").replace("[", "_").replace("]", "")


def _source(view: str, column: str) -> str:
    return f"{view}__{column}"


def _view_of(field_name: str) -> str:
    return field_name.partition(".")[0]


@dataclass
class _Keyed:
    """Measures counted once per key of a view, or once per counted value."""

    owner: str
    key: Column
    names: list[str] = field(default_factory=list)


@dataclass(eq=False)
class _Pass:
    """One scan: joined rows and the measures taken from them."""

    owner: str  # the base view, or a one-to-many view that is joined in full
    keyed: list[_Keyed] = field(default_factory=list)
    summed: list[str] = field(default_factory=list)  # summed over the rows


class TopicQuery:
    def __init__(self, model: Model, topic: Topic, frames: Frames, fields: Sequence[str], as_of: dt.date,
                 filters: Sequence[Filter] = (), attributes: Mapping[str, str] | None = None,
                 default_filters: bool = True):
        self.model, self.topic, self.frames, self.as_of = model, topic, frames, as_of
        self.hops = model.hops(topic)
        attributes = attributes or {}
        self.dims = []
        self.measures = []
        for name in fields:
            found = model.require_field(topic, name, attributes)
            (self.dims if isinstance(found, Dimension) else self.measures).append(name)
        replaced = {f.field for f in filters}
        defaults = [f for f in topic.default_filters if f.field not in replaced] if default_filters else []
        for f in defaults:  # the author of the topic may test what it does not offer
            if not model.allowed(model.field_of(f.field), attributes):
                raise AccessDenied(f.field)
        views = {topic.base, *self.hops}
        # A filter on a measure tests the groups; it needs the measure, shown or not.
        self.having = [f for f in filters
                       if not isinstance(model.require_filter(topic, views, f.field, attributes), Dimension)]
        self.filters = [*defaults, *[f for f in filters if f not in self.having]]
        self.shown = list(self.measures)
        self.measures += [n for n in dict.fromkeys(f.field for f in self.having) if n not in self.measures]

    # Fields -> Columns

    def lookup(self, view: str) -> Callable[[str], Column]:
        def find(name: str) -> Column:
            return self.column(name if "." in name else f"{view}.{name}")
        return find

    def column(self, name: str) -> Column:
        """A dimension as a Column over the prefixed source columns."""
        plain, _, unit = name.partition("[")
        view, _, column = plain.partition(".")
        dimension = self.model.field_of(plain)
        value = dimension.expression(self.lookup(view)) if dimension.expression else F.col(_source(view, column))
        if not unit:
            return value
        if unit.rstrip("]") not in dimension.timeframes:
            raise UnknownField(name)
        return timeframe(value, unit.rstrip("]"))

    def key(self, view: str) -> Column:
        return self.column(f"{view}.{self.model.views[view].primary_key}")

    def is_base_grain(self, view: str) -> bool:
        while view != self.topic.base:
            if self.hops[view].grain != "one_to_one":
                return False
            view = self.hops[view].parent
        return True

    def below_a_many(self, view: str) -> str | None:
        """The one-to-many view on the way to ``view``, if there is one."""
        while view != self.topic.base:
            if self.hops[view].grain == "one_to_many":
                return view
            view = self.hops[view].parent
        return None

    # Joins

    def needed_views(self, one: _Pass) -> set[str]:
        """The views to join before the grouping. An owner that only its own measures need waits until after it."""
        wanted = {self.topic.base, one.owner}
        wanted |= {_view_of(n) for n in [*one.summed, *self.dims, *(f.field for f in self.filters)]}
        for part in one.keyed:
            hop = self.hops.get(part.owner)
            may_wait = hop is not None and hop.grain == "many_to_one" and not any(map(self.is_distinct, part.names))
            wanted.add(hop.parent if may_wait else part.owner)
        for name in list(wanted):
            while name != self.topic.base:
                name = self.hops[name].parent
                wanted.add(name)
        return wanted

    def source(self, view: str) -> DataFrame:
        """The view's own rows. A generated view starts at the first day asked for."""
        bound = self.model.views[view].bounded_by
        for f in self.filters:
            if (bound and view == self.topic.base and f.field == f"{view}.{bound}"
                    and f.kind == "time_for_duration" and f.value[0] == "days"):
                return self.frames[view](first_day=self.as_of - dt.timedelta(days=f.value[1]))
        return self.frames[view]()

    def rows(self, view: str, needed: set[str], owner: str) -> DataFrame:
        """The view's rows with everything needed below it joined on."""
        source = self.source(view)
        df = source.select(*[F.col(c).alias(_source(view, c)) for c in source.columns])
        # A joined view's measures ask only whether it has a key: one bit moves on, not the key.
        df = df.withColumn(_source(view, "_present"), self.key(view).isNotNull())
        # A one-to-one view has the widest key, one per row: joined first, its key does not move in the joins after it.
        for child, hop in sorted(self.hops.items(), key=lambda item: item[1].grain != "one_to_one"):
            if hop.parent != view or child not in needed:
                continue
            below = self.rows(child, needed, owner)
            on = F.col(_source(view, hop.parent_field)) == F.col(_source(child, hop.child_field))
            if hop.grain == "one_to_many" and self.below_a_many(owner) == child:
                # Rows without a match have no measure of this view, and an
                # inner join lets Spark split a hot key on the many side.
                df = df.join(below, on, "inner")
            elif hop.grain == "one_to_many":
                df = df.join(self.distinct_values(below, hop), on, "left")
            else:
                df = df.join(below, on, "left")
        return df

    def distinct_values(self, df: DataFrame, hop: Hop) -> DataFrame:
        """What a one-to-many view adds to a query that has no measure of it."""
        under = {v for v in self.hops if self.below_a_many(v) == hop.child}
        dims = [self.column(n).alias(output_name(n)) for n in self.dims if _view_of(n) in under]
        tests = [f.predicate(self.column(f.field), self.as_of).alias(f"_filter_{i}")
                 for i, f in enumerate(self.filters) if _view_of(f.field) in under]
        return df.select(_source(hop.child, hop.child_field), *dims, *tests).distinct()

    def joined(self, one: _Pass) -> DataFrame:
        """All joins, filters applied, dimensions added under their output names."""
        df = self.rows(self.topic.base, self.needed_views(one), one.owner)
        for i, f in enumerate(self.filters):
            ready = f"_filter_{i}" in df.columns
            df = df.filter(F.col(f"_filter_{i}") if ready else f.predicate(self.column(f.field), self.as_of))
        done = set(df.columns)
        return df.withColumns({output_name(n): self.column(n) for n in self.dims if output_name(n) not in done})

    # Measures

    def condition(self, name: str) -> Column:
        """Rows the measure counts: its filters hold and its view matched."""
        measure, view = self.model.field_of(name), _view_of(name)
        holds = F.lit(True) if view == self.topic.base else F.col(_source(view, "_present"))
        for f in measure.filters:
            holds = holds & f.predicate(self.column(f"{view}.{f.field}"), self.as_of)
        return holds

    def value(self, name: str) -> Column:
        """What the measure adds up: NULL where a row does not take part."""
        measure = self.model.field_of(name)
        value = measure.expression(self.lookup(_view_of(name))) if measure.expression else F.lit(1)
        return F.when(self.condition(name), value)

    def base_measures(self, names: Sequence[str]) -> list[str]:
        found: dict[str, None] = {}
        for name in names:
            measure: Measure = self.model.field_of(name)
            if measure.kind == "derived":
                found.update(dict.fromkeys(self.base_measures(self.inputs(name))))
            else:
                found[name] = None
        return list(found)

    def inputs(self, name: str) -> list[str]:
        measure = self.model.field_of(name)
        return [n if "." in n else f"{_view_of(name)}.{n}" for n in measure.inputs]

    def is_distinct(self, name: str) -> bool:
        return self.model.field_of(name).kind == "count_distinct"

    def passes(self) -> list[_Pass]:
        """One pass over the base view, and one over each one-to-many view that has measures."""
        found: dict[str | None, _Pass] = {}
        keyed: dict[tuple[str, str], _Keyed] = {}
        for name in self.base_measures(self.measures):
            view = _view_of(name)
            many = self.below_a_many(view)
            one = found.setdefault(many, _Pass(many or self.topic.base))
            if not self.is_distinct(name) and (self.is_base_grain(view) or many == view):
                one.summed.append(name)
                continue
            key = self.model.field_of(name).expression(self.lookup(view)) if self.is_distinct(name) else self.key(view)
            by = (view, str(key) if self.is_distinct(name) else "key")
            if by not in keyed:
                keyed[by] = _Keyed(view, key)
                one.keyed.append(keyed[by])
            keyed[by].names.append(name)
        if self.dims and None not in found:
            found[None] = _Pass(self.topic.base)  # groups that have no row of a joined view
        return list(found.values())

    def late(self, one: _Pass) -> list[_Keyed]:
        """Those whose owner's columns matter only after its key is grouped by."""
        needed = self.needed_views(one)
        return [p for p in one.keyed if p.owner not in needed]

    def grouped(self, one: _Pass) -> DataFrame:
        """The pass's joined rows, read and grouped once by all of its keys, then rolled up per key."""
        dims = [output_name(n) for n in self.dims]
        df, late = self.joined(one), self.late(one)
        if not one.keyed:
            return df.groupBy(*dims).agg(*self.sums(one.summed)) if one.summed else df.select(*dims).distinct()
        sets: list[list[str]] = []
        keys: list[Column] = []
        flags: list[Column] = []
        final: list[Column] = []
        for i, part in enumerate(one.keyed):
            distinct = [n for n in part.names if self.is_distinct(n)]
            once = [n for n in part.names if n not in distinct]
            keys.append((self.reference(part.owner) if part in late else part.key).alias(f"_key_{i}"))
            # Values that depend on the key are grouped by, which keeps the grouping a hash one.
            keys += [] if part in late else [self.value(n).alias(f"_value_{output_name(n)}") for n in once]
            flags += [F.max(F.coalesce(self.condition(n), F.lit(False))).alias(f"_flag_{output_name(n)}") for n in distinct]
            sets.append([f"_key_{i}", *[f"_value_{output_name(n)}" for n in once]])
            final += [c for n in once for c in self.aggregates(n, F.col(f"_value_{output_name(n)}"))]
            final += [F.count_if(F.col(f"_flag_{output_name(n)}") & F.col(f"_key_{i}").isNotNull()).alias(output_name(n))
                      for n in distinct]
        partial = [*flags, *self.sums(one.summed)]
        per_keys = df.groupBy(*dims, *keys).agg(*partial) if partial else df.select(*dims, *keys).distinct()
        for i, part in enumerate(one.keyed):
            if part in late:
                per_keys = self.with_owner(per_keys, part, f"_key_{i}")
        if len(sets) > 1:
            per_keys = self.per_key(per_keys, dims, sets, one)
        return per_keys.groupBy(*dims).agg(*final, *self.resums(one.summed))

    def reference(self, owner: str) -> Column:
        hop = self.hops[owner]
        return F.col(_source(hop.parent, hop.parent_field))

    def with_owner(self, per_keys: DataFrame, part: _Keyed, key: str) -> DataFrame:
        """Join an owner by the grouped column that refers to it: one row moves per group and reference, not every row."""
        owner = self.rows(part.owner, {part.owner}, part.owner)
        joined = per_keys.join(owner, F.col(key) == F.col(_source(part.owner, self.hops[part.owner].child_field)), "left")
        return joined.withColumns({f"_value_{output_name(n)}": self.value(n) for n in part.names}).drop(*owner.columns)

    def per_key(self, per_keys: DataFrame, dims: list[str], sets: list[list[str]], one: _Pass) -> DataFrame:
        """One row per group and key of each set; the columns of the other sets are NULL in it.

        The partial sums stand in the rows of the first set alone.
        """
        flags = [f"_flag_{output_name(n)}" for part in one.keyed for n in part.names if self.is_distinct(n)]
        sums = self.resums(one.summed)
        columns = [*dims, *[c for s in sets for c in s]]
        rolled = per_keys.groupingSets([[F.col(c) for c in (*dims, *s)] for s in sets], *columns).agg(
            F.grouping("_key_0").alias("_other"), *[F.max(c).alias(c) for c in flags], *sums)
        names = self.partial_names(one.summed)
        return rolled.withColumns({c: F.when(F.col("_other") == 0, F.col(c)) for c in names}) if names else rolled

    def aggregates(self, name: str, value: Column) -> list[Column]:
        out, kind = output_name(name), self.model.field_of(name).kind
        if kind == "count":
            return [F.count(value).alias(out)]
        if kind == "sum":
            return [F.sum(value).alias(out)]
        return [F.sum(value).alias(f"{out}__sum"), F.count(value).alias(f"{out}__n")]

    def sums(self, names: Sequence[str]) -> list[Column]:
        return [c for n in names for c in self.aggregates(n, self.value(n))]

    def partial_names(self, names: Sequence[str]) -> list[str]:
        found: list[str] = []
        for n in names:
            out, kind = output_name(n), self.model.field_of(n).kind
            found += [out] if kind in ("count", "sum") else [f"{out}__sum", f"{out}__n"]
        return found

    def resums(self, names: Sequence[str]) -> list[Column]:
        """Totals of the partial sums; the same columns under the same names."""
        return [F.sum(c).alias(c) for c in self.partial_names(names)]

    def result(self, name: str) -> Column:
        """A measure as a Column over the grouped columns."""
        measure, out = self.model.field_of(name), output_name(name)
        if measure.kind == "derived":
            return measure.combine(*[self.result(n) for n in self.inputs(name)])
        if measure.kind == "average":
            return F.try_divide(F.col(f"{out}__sum").cast("double"), F.col(f"{out}__n").cast("double"))
        if measure.kind in ("count", "count_distinct"):
            return F.coalesce(F.col(out), F.lit(0)).cast("bigint")
        return F.col(out)

    def run(self) -> DataFrame:
        dims = [output_name(n) for n in self.dims]
        if not self.measures:
            return self.joined(_Pass(self.topic.base)).select(*dims).distinct()
        grouped = [self.grouped(p) for p in self.passes()]
        df = grouped[0]
        if len(grouped) > 1:
            # Each pass holds the same groups and its own columns.
            for other in grouped[1:]:
                df = df.unionByName(other, allowMissingColumns=True)
            df = df.groupBy(*dims).agg(*[F.max(c).alias(c) for c in df.columns if c not in dims])
        df = df.select(*dims, *[self.result(n).alias(output_name(n)) for n in self.measures])
        for f in self.having:
            df = df.filter(f.predicate(F.col(output_name(f.field)), self.as_of))
        return df.select(*dims, *[output_name(n) for n in self.shown])


def topic_query(model: Model, topic: str, frames: Frames, fields: Sequence[str], as_of: dt.date,
                filters: Sequence[Filter] = (), attributes: Mapping[str, str] | None = None,
                default_filters: bool = True) -> DataFrame:
    """One row per group of the chosen dimensions, one column per chosen field."""
    return TopicQuery(model, model.topics[topic], frames, fields, as_of, filters, attributes, default_filters).run()
