"""Which column of a flat table fills which field of the model."""

from __future__ import annotations

from typing import NamedTuple

from stationtide.model.definitions import TableGraph


class FieldSource(NamedTuple):
    """``how``: ``suffixed`` (named for its table), ``found`` (same name) or ``foreign`` (the key of a child that refers to it)."""

    table: str
    field: str
    column: str
    how: str


def field_sources(columns, graph: TableGraph) -> list[FieldSource]:
    """Every use of every column, in model order. A suffixed column displaces the plain one of its field."""
    owners: dict[str, list[str]] = {}
    for name, definition in graph.items():
        for field in definition.fields:
            owners.setdefault(field, []).append(name)
    links = [k for k in graph.foreign_keys if k.parent in graph and k.field != k.parent_field]
    uses = []
    for column in columns:
        field, mark, table = column.partition("|")
        fitting = [t for t in owners.get(field, ()) if not mark or t == table]
        uses += [FieldSource(t, field, column, "suffixed" if mark else "found") for t in fitting]
        uses += [FieldSource(k.parent, k.parent_field, column, "foreign") for k in links if k.field == column]
    named = {(u.table, u.field) for u in uses if u.how == "suffixed"}
    kept = [u for u in uses if u.how != "found" or (u.table, u.field) not in named]
    tables = list(graph)
    return sorted(kept, key=lambda u: (tables.index(u.table), u.how == "foreign"))


def table_columns(columns, graph: TableGraph, name: str) -> dict[str, str]:
    """Field -> column of one table; empty if nothing but keys, or not the first key, can be filled.

    Keys may be borrowed over a link: a child's key from its parent's field and a parent's field from the key of a child.
    """
    definition, present = graph[name], set(columns)
    sources = [s for s in field_sources(columns, graph) if s.table == name]
    own = {s.field: s.column for s in sources if s.how != "foreign"}
    borrowed = {s.field: s.column for s in sources if s.how == "foreign"}
    borrowed |= {k.field: k.parent_field for k in definition.foreign_keys if k.parent_field in present}
    filled = own | {f: c for f, c in borrowed.items() if f not in own}
    keys = definition.primary_keys
    return filled if set(own) - set(keys) and keys[0] in filled else {}
