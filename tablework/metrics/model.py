"""Declarations of a semantic model: views, fields, joins, topics, grants.

Field expressions are functions from a lookup to a Column. The lookup takes
``"field"`` or ``"view.field"``, with ``[timeframe]`` for part of a timestamp,
and returns the Column in the frame at hand.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

Lookup = Callable[[str], Column]
Expression = Callable[[Lookup], Column]


class AccessDenied(Exception):
    """The field needs a grant that the user's attributes do not give."""


class UnknownField(Exception):
    """The topic does not offer the field."""


@dataclass(frozen=True)
class Grant:
    attribute: str
    allowed: tuple[str, ...]

    def given_to(self, attributes: Mapping[str, str]) -> bool:
        return attributes.get(self.attribute) in self.allowed


@dataclass(frozen=True)
class Dimension:
    name: str
    expression: Expression | None = None  # none: the source column of that name
    timeframes: tuple[str, ...] = ()
    hidden: bool = False
    grants: tuple[str, ...] = ()


@dataclass(frozen=True)
class Filter:
    """One predicate: ``kind`` is is, greater_than or time_for_duration.

    ``time_for_duration`` takes (unit, n): from n units before the as-of date,
    for n units, which is up to and without the as-of date.
    """

    field: str
    kind: str
    value: object

    def predicate(self, column: Column, as_of: dt.date) -> Column:
        if self.kind == "is":
            return column == F.lit(self.value)
        if self.kind == "greater_than":
            return column > F.lit(self.value)
        if self.kind == "time_for_duration":
            unit, n = self.value
            end = F.lit(as_of)
            start = F.add_months(end, -n) if unit == "months" else F.date_sub(end, n)
            return (column >= start) & (column < end)
        raise ValueError(f"unknown filter kind: {self.kind}")


@dataclass(frozen=True)
class Measure:
    """``kind`` is count, sum, average, count_distinct, or derived.

    A derived measure is a function of other measures, named in ``inputs``.
    """

    name: str
    kind: str
    expression: Expression | None = None
    filters: tuple[Filter, ...] = ()
    inputs: tuple[str, ...] = ()
    combine: Callable[..., Column] | None = None
    grants: tuple[str, ...] = ()
    hidden: bool = False


@dataclass(frozen=True)
class View:
    name: str
    primary_key: str
    dimensions: tuple[Dimension, ...]
    measures: tuple[Measure, ...] = ()
    bounded_by: str | None = None  # date dimension by which the view's rows can be made from a first day on

    def dimension(self, name: str) -> Dimension | None:
        return next((d for d in self.dimensions if d.name == name), None)

    def measure(self, name: str) -> Measure | None:
        return next((m for m in self.measures if m.name == name), None)


@dataclass(frozen=True)
class Relationship:
    """A left join from many (or one) rows of ``from_view`` to one of ``to_view``."""

    from_view: str
    to_view: str
    from_field: str
    to_field: str
    cardinality: str = "many_to_one"
    reversible: bool = False


@dataclass(frozen=True)
class Hop:
    """One step of a topic's join tree, seen from the base view outwards."""

    parent: str
    child: str
    parent_field: str
    child_field: str
    grain: str  # one_to_one, many_to_one, or one_to_many for a reversed join


@dataclass(frozen=True)
class Topic:
    name: str
    base: str
    joins: Mapping[str, object]
    fields: tuple[str, ...]
    default_filters: tuple[Filter, ...] = ()


@dataclass(frozen=True)
class Model:
    views: Mapping[str, View]
    relationships: tuple[Relationship, ...]
    topics: Mapping[str, Topic]
    grants: Mapping[str, Grant] = field(default_factory=dict)

    def hop(self, parent: str, child: str) -> Hop:
        for r in self.relationships:
            if (r.from_view, r.to_view) == (parent, child):
                return Hop(parent, child, r.from_field, r.to_field, r.cardinality)
        for r in self.relationships:
            if r.reversible and (r.to_view, r.from_view) == (parent, child):
                return Hop(parent, child, r.to_field, r.from_field, "one_to_many")
        raise ValueError(f"no relationship from {parent} to {child}")

    def hops(self, topic: Topic) -> dict[str, Hop]:
        """The hop that leads to each joined view, parents before children."""
        found: dict[str, Hop] = {}

        def walk(parent: str, children: Mapping[str, object]) -> None:
            for child, below in children.items():
                found[child] = self.hop(parent, child)
                walk(child, below)

        walk(topic.base, topic.joins)
        return found

    def field_of(self, name: str) -> Dimension | Measure:
        view_name, _, rest = name.partition(".")
        view = self.views.get(view_name)
        found = view and (view.dimension(rest.partition("[")[0]) or view.measure(rest))
        if not found:
            raise UnknownField(name)
        return found

    def allowed(self, found: Dimension | Measure, attributes: Mapping[str, str]) -> bool:
        return all(self.grants[g].given_to(attributes) for g in found.grants)

    def topic_fields(self, topic: Topic, attributes: Mapping[str, str]) -> list[str]:
        """Field list with wildcards opened and exclusions taken out.

        Hidden fields and fields the user has no grant for are not part of a
        wildcard.
        """
        listed: list[str] = []
        for pattern in topic.fields:
            if pattern.startswith("-"):
                listed = [f for f in listed if f != pattern[1:]]
            elif pattern.endswith(".*"):
                view = self.views[pattern[:-2]]
                listed += [f"{view.name}.{f.name}" for f in (*view.dimensions, *view.measures)
                           if not f.hidden and self.allowed(f, attributes)]
            elif self.allowed(self.field_of(pattern), attributes):
                listed.append(pattern)
        return list(dict.fromkeys(listed))

    def require_field(self, topic: Topic, name: str, attributes: Mapping[str, str]) -> Dimension | Measure:
        """The field, if the topic offers it and the user may see it.

        A hidden field is left out of wildcards but may be used by name.
        """
        found = self.field_of(name)
        if not self.allowed(found, attributes):
            raise AccessDenied(name)
        plain = name.partition("[")[0]
        offered = set(topic.fields)
        if f"-{plain}" in offered or not ({plain, plain.partition(".")[0] + ".*"} & offered):
            raise UnknownField(f"{name} in topic {topic.name}")
        return found

    def require_filter(self, topic: Topic, views: Iterable[str], name: str,
                       attributes: Mapping[str, str]) -> Dimension | Measure:
        """The field, if it may be tested: in a view of the topic, not excluded from it, and the user may see it."""
        found = self.field_of(name)
        plain = name.partition("[")[0]
        if plain.partition(".")[0] not in views or f"-{plain}" in topic.fields:
            raise UnknownField(f"{name} in topic {topic.name}")
        if not self.allowed(found, attributes):
            raise AccessDenied(name)
        return found
