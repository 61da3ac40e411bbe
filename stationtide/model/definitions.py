"""Table definitions with their primary and foreign keys."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from stationtide.config import DEFAULT_TABLES
from stationtide.model.literals import literal_table

# Numbered uncertainty fields and how many kinds there are.
UNCERTAINTY_KINDS = 17
NUMBERED_FIELDS = ("uncertainty_type", "uncertainty_units", "uncertainty_value")
# Tables that describe reports, in joining order.
HEADER_CONFIGURATION_TABLES = ("profile_configuration", "source_configuration", "station_configuration")
OBSERVATION_CONFIGURATION_TABLES = ("sensor_configuration",)
FIELD_TABLES = ("homogenenisation_fields", "qc_fields", "uncertainty_fields")
ONE_TO_ONE_TABLES = ("era5fb_table", "advanced_homogenisation", "advanced_uncertainty", "uncertainty_table")


@dataclass(frozen=True)
class ForeignKey:
    table: str
    field: str
    parent: str
    parent_field: str


@dataclass(frozen=True)
class TableDefinition:
    """Fields of one table as (name, kind, external "table:field" or "")."""

    name: str
    rows: tuple[tuple[str, str, str], ...]

    @property
    def fields(self) -> list[str]:
        return [r[0] for r in self.rows]

    @property
    def primary_keys(self) -> list[str]:
        return [name for name, kind, _ in self.rows if "(pk)" in kind]

    @property
    def foreign_keys(self) -> list[ForeignKey]:
        return [
            ForeignKey(self.name, name, *external.strip().split(":")[:2])
            for name, _, external in self.rows if external.strip()
        ]

    def kind(self, field: str) -> str:
        """Kind without key and optionality marks."""
        raw = next(k for n, k, _ in self.rows if n == field)
        return raw.replace(" (pk)", "").replace("*", "").strip()


class TableGraph(dict):
    """``name -> TableDefinition`` plus the key graph between them."""

    @classmethod
    def of(cls, definitions) -> "TableGraph":
        return cls({d.name: d for d in definitions})

    @property
    def foreign_keys(self) -> list[ForeignKey]:
        return [fk for d in self.values() for fk in d.foreign_keys]

    def children(self, table: str) -> list[str]:
        """Tables with a foreign key to ``table``, provided ``table`` is loaded."""
        return sorted({fk.table for fk in self.foreign_keys if fk.parent == table and table in self})

    @property
    def ambiguous_fields(self) -> list[str]:
        """Fields of several tables that are not foreign keys."""
        seen: dict[str, int] = {}
        for definition in self.values():
            for name in definition.fields:
                seen[name] = seen.get(name, 0) + 1
        linking = {fk.field for fk in self.foreign_keys}
        return sorted(n for n, times in seen.items() if times > 1 and n not in linking)

    @property
    def legal_fields(self) -> list[str]:
        """Every column name the model accepts, in model order and without repeats."""
        plain = [f for d in self.values() for f in d.fields]
        suffixed = [f"{f}|{d.name}" for d in self.values() for f in d.fields]
        numbered = []
        if "uncertainty_table" in self:
            numbered = [f"{f}{n}" for f in NUMBERED_FIELDS for n in range(1, UNCERTAINTY_KINDS + 1)]
        return list(dict.fromkeys(plain + suffixed + numbered))

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """One row per field: (table, field, kind, parent, parent_field)."""
        rows = []
        for definition in self.values():
            links = {fk.field: fk for fk in definition.foreign_keys}
            for name, kind, _ in definition.rows:
                link = links.get(name)
                rows.append((definition.name, name, kind,
                             link.parent if link else None, link.parent_field if link else None))
        text = pa.string()
        return literal_table(
            spark, [("table", text), ("field", text), ("kind", text), ("parent", text), ("parent_field", text)], rows
        )


def read_definitions(spark: SparkSession, folder: str, tables=DEFAULT_TABLES) -> TableGraph:
    """Read ``<folder>/<table>.csv`` definition files and apply the standing patches."""
    definitions = []
    for name in tables:
        frame = (
            spark.read.option("header", True).option("comment", "#").option("quote", '"')
            .option("nullValue", "\u0000").option("emptyValue", "").csv(f"{folder}/{name}.csv")
        )
        if "kind" not in frame.columns:
            frame = frame.withColumnRenamed("type", "kind")
        frame = frame.select(
            "element_name", "kind", F.coalesce("external_table", F.lit("")).alias("external_table")
        )
        definitions.append(patched(TableDefinition(name, tuple((r[0], r[1], r[2]) for r in frame.collect()))))
    return TableGraph.of(definitions)


def patched(definition: TableDefinition) -> TableDefinition:
    """Corrections to the published definitions."""
    rows = definition.rows
    if definition.name == "header_table":
        rows = tuple(r for r in rows if r[0] != "duplicates")
    if definition.name == "uncertainty_table":
        fixed = {
            "observation_id": ("observation_id", "varchar (pk)", None),
            "uncertainty_type": ("uncertainty_type", "int (pk)", "uncertainty_type:type"),
        }
        rows = tuple(
            (r[0], fixed[r[0]][1], fixed[r[0]][2] or r[2]) if r[0] in fixed else r for r in rows
        )
    return TableDefinition(definition.name, rows)


# The part of the published definitions that the default tables need.
_DEFAULT_ROWS = {
    "station_configuration": (
        ("primary_id", "varchar (pk)", ""),
        ("record_number", "int (pk)", ""),
        ("station_name", "varchar", ""),
        ("longitude", "numeric", ""),
        ("latitude", "numeric", ""),
        ("station_type", "int", "station_type:type"),
        ("platform_type", "int", "platform_type:type"),
        ("country", "int", ""),
        ("city", "varchar", ""),
    ),
    "observations_table": (
        ("observation_id", "varchar (pk)", ""),
        ("report_id", "varchar", "header_table:report_id"),
        ("date_time", "timestamp with timezone", ""),
        ("observed_variable", "int", "observed_variable:variable"),
        ("observation_value", "numeric", ""),
        ("units", "int", "units:units"),
        ("original_units", "int", "units:units"),
        ("z_coordinate", "numeric", ""),
        ("z_coordinate_type", "int", "z_coordinate_type:type"),
        ("longitude", "numeric", ""),
        ("latitude", "numeric", ""),
        ("quality_flag", "int", "quality_flag:flag"),
        ("processing_level", "int", "processing_level:level"),
        ("sensor_id", "varchar", "sensor_configuration:sensor_id"),
        ("source_id", "varchar", ""),
    ),
    "header_table": (
        ("report_id", "varchar (pk)", ""),
        ("report_timestamp", "timestamp with timezone", ""),
        ("report_meaning_of_timestamp", "int", "meaning_of_timestamp:meaning"),
        ("report_duration", "int", "duration:duration"),
        ("report_type", "int", "report_type:type"),
        ("station_name", "varchar", ""),
        ("height_of_station_above_sea_level", "numeric", ""),
        ("primary_station_id", "varchar", "station_configuration:primary_id"),
        ("station_record_number", "int", "station_configuration:record_number"),
        ("longitude", "numeric", ""),
        ("latitude", "numeric", ""),
        ("duplicates", "varchar*", "header_table:report_id"),
    ),
    "uncertainty_table": (
        ("observation_id", "varchar", "observations_table:observation_id"),
        ("uncertainty_type", "int", ""),
        ("uncertainty_value", "numeric", ""),
        ("uncertainty_units", "int", "units:units"),
    ),
    "sensor_configuration": (
        ("sensor_id", "varchar (pk)", ""),
        ("sensor_model", "varchar", ""),
        ("date_start", "timestamp with timezone", ""),
        ("date_end", "timestamp with timezone", ""),
    ),
}


def default_graph(tables=DEFAULT_TABLES) -> TableGraph:
    return TableGraph.of(patched(TableDefinition(t, _DEFAULT_ROWS[t])) for t in tables)
