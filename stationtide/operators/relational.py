"""Flat observation table <-> relational tables, driven by the key graph."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stationtide.config import ConfigError
from stationtide.model.definitions import FIELD_TABLES, ONE_TO_ONE_TABLES, TableGraph
from stationtide.model.mapping import table_columns
from stationtide.operators.joins import join_tables

FACTS = "observations_table"


def normalise(df: DataFrame, graph: TableGraph) -> dict[str, DataFrame]:
    """Distinct rows of every table that the columns can fill."""
    filled = {name: normalise_table(df, graph, name) for name in graph}
    return {name: frame for name, frame in filled.items() if frame is not None}


def normalise_table(df: DataFrame, graph: TableGraph, name: str) -> DataFrame | None:
    """Distinct rows of one table, or None if its first key or all of its data is missing."""
    columns = table_columns(df.columns, graph, name)
    return df.select(*[F.col(f"`{c}`").alias(f) for f, c in columns.items()]).distinct() if columns else None


def denormalise(tables: dict[str, DataFrame], graph: TableGraph, use=None, ignore_missing: bool = False,
                restrict: dict[str, Column] | None = None) -> DataFrame:
    """One flat table: a walk over the key graph that starts at the observations.

    A table is complete before it is joined: rows that ``restrict`` excludes are gone and its own parents are joined to it,
    so that filters on reports or stations act before the observations are reached. Parents follow in the order of the
    keys, then the tables that extend the observations row by row. ``use`` limits the extensions and the
    ``<table>_optional`` companions; loaded tables that no key reaches are an error unless ``ignore_missing``.
    """
    use, restrict = set(tables if use is None else use), restrict or {}
    reached: set[str] = set()

    def keys(child: str, parent: str) -> list[tuple[str, str]]:
        return [(k.field, k.parent_field) for k in graph[child].foreign_keys if k.parent == parent] if child in graph else []

    def complete(name: str) -> DataFrame:
        reached.add(name)
        frame = tables[name].where(restrict[name]) if name in restrict else tables[name]
        companion = f"{name}_optional"
        if companion in use and companion in tables:
            reached.add(companion)
            frame = join_tables(tables[companion], frame, keys(companion, name), companion, name, ignore_missing)
        for parent in dict.fromkeys(k.parent for k in graph[name].foreign_keys):
            if parent in tables and parent not in reached:
                frame = join_tables(frame, complete(parent), keys(name, parent), name, parent, ignore_missing)
        return frame

    flat = complete(FACTS)
    for name in (*ONE_TO_ONE_TABLES, *FIELD_TABLES):
        if name in tables and name not in reached:
            reached.add(name)
            if name in FIELD_TABLES or name in use:
                linked = keys(name, FACTS) or [(p, c) for c, p in keys(FACTS, name)]
                flat = join_tables(tables[name], flat, linked, name, FACTS)
    stray = sorted(set(tables) - reached - {n for n in tables if n.endswith("_optional") and n not in use})
    if stray and not ignore_missing:
        raise ConfigError(f"no key links {stray} with {FACTS}")
    return flat


def key_integrity(tables: dict[str, DataFrame], graph: TableGraph) -> DataFrame:
    """Per link between loaded tables: child rows, rows with a null in the key and rows without a parent.

    The columns of a link between two tables are one key and are looked up together. Child keys are counted first, so a
    key shared by many rows is shuffled once.
    """
    reports = []
    for child, parent in dict.fromkeys((k.table, k.parent) for k in graph.foreign_keys):
        if child not in tables or parent not in tables or parent not in graph:
            continue
        link = [(k.field, k.parent_field) for k in graph[child].foreign_keys if k.parent == parent]
        link = [(c, p) for c, p in link if c in tables[child].columns and p in tables[parent].columns]
        if not link:
            continue
        key = [f"k{i}" for i in range(len(link))]
        counted = tables[child].groupBy(*[F.col(c).cast("string").alias(k) for k, (c, _) in zip(key, link)]).agg(F.count(F.lit(1)).alias("n"))
        parents = tables[parent].select(*[F.col(p).cast("string").alias(k) for k, (_, p) in zip(key, link)]).distinct().withColumn("known", F.lit(True))
        incomplete = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
        reports.append(counted.join(parents, key, "left").agg(
            F.lit(child).alias("child"), F.lit(",".join(c for c, _ in link)).alias("field"),
            F.lit(parent).alias("parent"), F.lit(",".join(p for _, p in link)).alias("parent_field"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.coalesce(F.sum(F.when(incomplete, F.col("n"))), F.lit(0)).alias("n_null"),
            F.coalesce(F.sum(F.when(~incomplete & F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("n_orphans"),
        ))
    return reduce(DataFrame.unionByName, reports)
