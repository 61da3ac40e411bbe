"""Tables of value combinations as few boxes of value sets, and back.

A set of values goes by its fingerprint while boxes are merged: the XOR of 128-bit hashes of its members. Boxes that agree in
all other columns have disjoint sets in the one that is left, so the fingerprint of their union is the XOR of theirs, and
no round groups by a set, shuffles one as a key or looks into one. The members of each different set stand in a side table
for each column, which only changes where boxes were merged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from stationtide.session import cut_lineage

#: Equal rounds in a row that end a compression: the order of the columns may change between two of them.
STEADY = 3


def _mark(i: int) -> list[str]:
    """Columns with the fingerprint of the set in column i."""
    return [f"a{i}", f"b{i}"]


def _fingerprint(value: Column) -> list[Column]:
    """Two 64-bit hashes; null is a value of its own."""
    known = value.isNotNull()
    return [F.xxhash64(known, value), F.xxhash64(value, known, F.lit(1))]


@dataclass
class Boxes:
    """``rows``: the fingerprints of each box; ``sets``: for each column its different sets as (a, b, value)."""

    columns: list[str]
    rows: DataFrame
    sets: list[DataFrame]
    n: int

    @classmethod
    def of(cls, rows: DataFrame, columns: list[str]) -> Boxes:
        distinct = cut_lineage(rows.select(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(columns)]).distinct())
        marks = [[m.alias(name) for m, name in zip(_fingerprint(F.col(f"v{i}")), _mark(i))] for i in range(len(columns))]
        sets = [cut_lineage(distinct.select(*marks[i], F.col(f"v{i}").alias("value")).distinct()) for i in range(len(columns))]
        boxes = cut_lineage(distinct.select(*[m for pair in marks for m in pair]))
        return cls(columns, boxes, sets, boxes.count())

    def order(self) -> list[int]:
        """Columns by ascending number of different sets, ties by name."""
        counts = [s.select(*_mark(i)).distinct().count() for i, s in enumerate(self.sets)]
        return sorted(range(len(self.columns)), key=lambda i: (counts[i], self.columns[i]))

    def merge(self, i: int) -> None:
        """Join the boxes that agree on all columns but i."""
        rest = [m for j in range(len(self.columns)) if j != i for m in _mark(j)]
        a, b = _mark(i)
        merged = self.rows.groupBy(*rest).agg(F.bit_xor(a).alias(a), F.bit_xor(b).alias(b), F.collect_set(F.struct(a, b)).alias("kids"))
        merged = cut_lineage(merged)
        n = merged.count()
        if n < self.n:
            kids = merged.select(F.col(a).alias("_a"), F.col(b).alias("_b"), F.explode("kids").alias("k")).select("_a", "_b", f"k.{a}", f"k.{b}").distinct()
            self.sets[i] = cut_lineage(kids.join(self.sets[i], [a, b]).select(F.col("_a").alias(a), F.col("_b").alias(b), "value").distinct())
        self.rows, self.n = merged.drop("kids"), n

    def arrays(self) -> DataFrame:
        """One row for each box with the sorted members of its sets. A member is looked up for different sets only."""
        out = self.rows
        for i, s in enumerate(self.sets):
            members = s.groupBy(*_mark(i)).agg(F.collect_list(F.struct(F.col("value"))).alias("m"))
            named = members.select(*_mark(i), F.transform(F.array_sort("m"), lambda x: x["value"]).alias(f"s{i}"))
            out = out.join(named, _mark(i))
        return out.select(*[F.col(f"s{i}").alias(c) for i, c in enumerate(self.columns)])


def compress(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Boxes (one array per column) whose product is exactly the distinct input.

    Rounds go on until the number of boxes has been the same ``STEADY`` times in
    a row; it never grows, so that they end. A group only ever gathers distinct
    sets of one column, which the calendar, the code table or the station list
    bounds. Each step ends in a reliable checkpoint. Two sets are taken for equal
    with a chance of about 2**-128 for each pair.
    """
    columns = columns or rows.columns
    boxes = Boxes.of(rows, columns)
    steady, n_before = 0, boxes.n
    while steady < STEADY and n_before > 1:
        for i in boxes.order():
            boxes.merge(i)
        steady = steady + 1 if boxes.n >= n_before else 0
        n_before = boxes.n
    return boxes.arrays()


def expand(boxes: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Product of the value sets of each row. Listed columns only; the others keep their arrays."""
    for column in columns or boxes.columns:
        boxes = boxes.withColumn(column, F.explode(F.col(f"`{column}`")))
    return boxes


def partial_expand(boxes: DataFrame, keep: list[str]) -> DataFrame:
    """Expand all but ``keep`` and join the kept lists of equal combinations."""
    keys = [c for c in boxes.columns if c not in keep]
    return expand(boxes, keys).groupBy(*keys).agg(
        *[F.array_sort(F.flatten(F.collect_list(c))).alias(c) for c in keep]
    )


def request_set(boxes: DataFrame, keep: list[str], n: int, name: str, csv_share: int = 10) -> DataFrame:
    """First ``n`` request combinations of one class; about ``csv_share`` percent ask for CSV, chosen by hash."""
    combos = partial_expand(boxes, keep)
    keys = [c for c in combos.columns if c not in keep]
    chosen = combos.orderBy(*keys).limit(n)
    bucket = F.pmod(F.crc32(F.concat_ws("|", *keys)), F.lit(100))
    return chosen.withColumns({
        "request_class": F.lit(name), "format": F.when(bucket < csv_share, "csv").otherwise("netcdf")
    })
