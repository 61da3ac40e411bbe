"""Declarative dataset configuration: driver-side metadata, never data."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any

# Columns every homogenised source is expected to have.
MANDATORY_COLUMNS = (
    "station_name",
    "primary_station_id",
    "report_id",
    "observation_id",
    "longitude",
    "latitude",
    "report_timestamp",
    "height_of_station_above_sea_level",
    "report_meaning_of_time_stamp",
    "report_duration",
    "observed_variable",
    "units",
    "observation_value",
)

# Accepted tile sizes in degrees.
LATITUDE_TILE_SIZES = (180, 90, 45, 30, 20, 15, 10, 5, 3, 2, 1)
LONGITUDE_TILE_SIZES = (360, 180, 90, 45, 30, 20, 15, 10, 5, 3, 2, 1)

# Dtype names used in configurations -> Spark types.
DTYPES = {
    "object": "string",
    "str": "string",
    "bool": "boolean",
    "int8": "tinyint",
    "uint8": "smallint",
    "int16": "smallint",
    "int32": "int",
    "int64": "bigint",
    "int": "bigint",
    "float32": "float",
    "float64": "double",
    "float": "double",
    "datetime64[ns]": "timestamp_ntz",
}

# SQL type names of raw tables -> Spark types.
SQL_TYPES = {
    "real": "float",
    "double precision": "double",
    "date": "timestamp_ntz",
    "integer": "bigint",
    "timestamp with time zone": "timestamp_ntz",
    "timestamp without time zone": "timestamp_ntz",
    "character": "string",
    "character varying": "string",
    "text": "string",
    "bigint": "bigint",
    "uuid": "string",
    "numeric": "double",
    "ARRAY": "string",
}

DEFAULT_TABLES = (
    "station_configuration",
    "observations_table",
    "header_table",
    "uncertainty_table",
    "sensor_configuration",
)


class ConfigError(ValueError):
    """The configuration contradicts itself or names something unknown."""


@dataclass(frozen=True)
class SpaceColumns:
    x: str
    y: str
    z: str | None = None


@dataclass(frozen=True)
class UnitChange:
    source_units: str
    target_units: str
    scale: float
    offset: float


@dataclass(frozen=True)
class AuxColumn:
    """A raw column that describes one melted variable."""

    name: str
    main_variable: str
    units: str | None = None


@dataclass(frozen=True)
class Description:
    dtype: str | None
    description: str = ""
    units: str | None = None


@dataclass(frozen=True)
class SourceConfig:
    """How the raw columns of one source map onto the observation model."""

    main_variables: tuple[str, ...]
    descriptions: dict[str, Description]
    data_table: str = "data"
    header_table: str | None = None
    header_columns: tuple[str, ...] = ()
    join_header: str | None = None
    join_data: str | None = None
    rename: dict[str, str] = field(default_factory=dict)
    add: dict[str, Any] = field(default_factory=dict)
    unit_changes: dict[str, UnitChange] = field(default_factory=dict)
    melt: bool = False
    uncertainty: dict[str, tuple[AuxColumn, ...]] = field(default_factory=dict)
    quality_flag: tuple[AuxColumn, ...] = ()
    processing_level: tuple[AuxColumn, ...] = ()
    observation_key: tuple[str, ...] = ()
    space: SpaceColumns | None = None
    mandatory: tuple[str, ...] = MANDATORY_COLUMNS
    columns_to_drop: tuple[str, ...] = ()
    conflicting_columns: dict[str, tuple[str, ...]] = field(default_factory=dict)
    order_by: tuple[str, ...] = ()

    @property
    def two_tables(self) -> bool:
        return self.header_table is not None

    @property
    def aux_columns(self) -> list[str]:
        uncertainty = [c.name for cols in self.uncertainty.values() for c in cols]
        return uncertainty + [c.name for c in self.quality_flag + self.processing_level]

    @property
    def raw_time_column(self) -> str:
        """Raw name of the report time, found by inverting ``rename``."""
        if len(set(self.rename.values())) != len(self.rename):
            raise ConfigError("rename must be one to one")
        if "report_timestamp" not in self.descriptions:
            raise ConfigError("report_timestamp is not described")
        raw = {new: old for old, new in self.rename.items()}
        return raw.get("report_timestamp", "report_timestamp")

    @property
    def time_in_header(self) -> bool:
        return self.two_tables and "report_timestamp" in self.header_columns

    def raw_header_columns(self) -> list[str]:
        """Raw header columns worth reading: declared ones, the join id and mandatory ones."""
        wanted = set(self.header_columns) | set(self.mandatory)
        return [self.join_header] + [old for old, new in self.rename.items() if new in wanted]

    def problems(self) -> list[str]:
        """Contradictions inside this source, as messages."""
        out = [f"{v} not found in descriptions" for v in self.main_variables if v not in self.descriptions]
        known = set(self.descriptions) | set(self.aux_columns)
        out += [
            f"{new} is in rename but neither described nor an auxiliary column"
            for new in self.rename.values() if new not in known
        ]
        out += [
            f"unknown dtype {d.dtype} of {n}" for n, d in self.descriptions.items()
            if d.dtype is not None and d.dtype not in DTYPES
        ]
        if self.two_tables and not (self.join_header and self.join_data):
            out.append("a source with a header table needs join ids")
        return out


@dataclass(frozen=True)
class DatasetConfig:
    """One dataset: its sources, tiling and reader."""

    name: str
    sources: dict[str, SourceConfig]
    lat_tile_size: Any = 5
    lon_tile_size: Any = 5
    time_tile_size: str = "month"
    reader: str | dict[str, str] = "header_and_data"
    reader_args: dict[str, Any] = field(default_factory=dict)
    disabled_fields: tuple[str, ...] | dict[str, tuple[str, ...]] = ()
    tables: tuple[str, ...] = DEFAULT_TABLES
    space: SpaceColumns | None = None
    read_by_space: bool = False

    def __post_init__(self) -> None:
        problems = self.problems()
        if problems:
            raise ConfigError("; ".join(problems))

    def problems(self) -> list[str]:
        out = [f"{s}: {m}" for s, cfg in self.sources.items() for m in cfg.problems()]
        out += _size_problems("lat", self.lat_tile_size, LATITUDE_TILE_SIZES)
        out += _size_problems("lon", self.lon_tile_size, LONGITUDE_TILE_SIZES)
        if self.time_tile_size not in ("month", "year"):
            out.append(f"time tile size {self.time_tile_size!r} is not month or year")
        return out

    def space_of(self, source: str) -> SpaceColumns:
        space = self.space or self.sources[source].space
        if space is None:
            raise ConfigError(f"no space columns for {source}")
        return space

    def reader_of(self, source: str) -> str:
        return self.reader if isinstance(self.reader, str) else self.reader[source]

    def disabled_for(self, source: str) -> tuple[str, ...]:
        if isinstance(self.disabled_fields, dict):
            return tuple(self.disabled_fields.get(source, ()))
        return tuple(self.disabled_fields)

    def tile_size(self, axis: str, source: str, year: int) -> int:
        """Tile size of one axis for one source and year."""
        sizes = self.lat_tile_size if axis == "lat" else self.lon_tile_size
        if isinstance(sizes, dict) and source in sizes:
            sizes = sizes[source]
        if isinstance(sizes, int):
            return sizes
        for period, size in sizes.items():
            first, last = (int(p) for p in period.split("-"))
            if first <= year <= last:
                return size
        raise ConfigError(f"no {axis} tile size for {source} in {year}")

    def with_source(self, name: str, source: SourceConfig) -> "DatasetConfig":
        return replace(self, sources={**self.sources, name: source})


def _size_problems(axis: str, sizes: Any, accepted: tuple[int, ...]) -> list[str]:
    if isinstance(sizes, dict):
        return [m for v in sizes.values() for m in _size_problems(axis, v, accepted)]
    return [] if sizes in accepted else [f"{axis} tile size {sizes} is not one of {accepted}"]


def dataset_from_dict(raw: dict[str, Any]) -> DatasetConfig:
    """Build a configuration from the parsed YAML or JSON layout."""
    sources = {name: _source_from_dict(body) for name, body in raw["sources"].items()}
    plain = {
        k: raw[k]
        for k in ("lat_tile_size", "lon_tile_size", "time_tile_size", "reader", "reader_args", "read_by_space")
        if k in raw
    }
    disabled = raw.get("disabled_fields", ())
    disabled = {k: tuple(v) for k, v in disabled.items()} if isinstance(disabled, dict) else tuple(disabled)
    space = SpaceColumns(**raw["space_columns"]) if raw.get("space_columns") else None
    tables = tuple(raw.get("available_cdm_tables", DEFAULT_TABLES))
    return DatasetConfig(
        name=raw["name"], sources=sources, disabled_fields=disabled, space=space, tables=tables, **plain
    )


def dataset_from_yaml(path: str) -> DatasetConfig:
    try:
        import yaml
    except ImportError as err:  # optional dependency
        raise RuntimeError("reading YAML needs the pyyaml package; use dataset_from_dict instead") from err
    with open(path) as handle:
        return dataset_from_dict(yaml.safe_load(handle))


def _source_from_dict(raw: dict[str, Any]) -> SourceConfig:
    mapping = raw.get("cdm_mapping", {})
    melt = mapping.get("melt_columns")
    aux = melt or {}
    units = {}
    for variable, change in (mapping.get("unit_changes") or {}).items():
        # Only the first pair of names counts.
        source_units, target_units = next(iter(change["names"].items()))
        units[variable] = UnitChange(source_units, target_units, change["scale"], change["offset"])
    join = raw.get("join_ids") or {}
    return SourceConfig(
        main_variables=tuple(raw["main_variables"]),
        descriptions={
            n: Description(d.get("dtype"), d.get("description", ""), d.get("units"))
            for n, d in raw["descriptions"].items()
        },
        data_table=raw["data_table"],
        header_table=raw.get("header_table"),
        header_columns=tuple(raw.get("header_columns") or ()),
        join_header=join.get("header"),
        join_data=join.get("data"),
        rename=dict(mapping.get("rename") or {}),
        add=dict(mapping.get("add") or {}),
        unit_changes=units,
        melt=melt is not None,
        uncertainty={
            kind: tuple(AuxColumn(**c) for c in cols) for kind, cols in (aux.get("uncertainty") or {}).items()
        },
        quality_flag=tuple(AuxColumn(**c) for c in (aux.get("quality_flag") or {}).get("quality_flag", ())),
        processing_level=tuple(
            AuxColumn(**c) for c in (aux.get("processing_level") or {}).get("processing_level", ())
        ),
        observation_key=tuple(raw.get("observation_key") or ()),
        space=SpaceColumns(**raw["space_columns"]) if raw.get("space_columns") else None,
        mandatory=tuple(raw.get("mandatory_columns") or MANDATORY_COLUMNS),
        columns_to_drop=tuple(raw.get("columns_to_drop") or ()),
        conflicting_columns={
            side: tuple(cols) for side, cols in (raw.get("conflicting_columns") or {}).items()
        },
        order_by=tuple(raw.get("order_by") or ()),
    )
