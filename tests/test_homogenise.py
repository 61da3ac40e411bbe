import pytest
from pyspark.sql import functions as F

from stationtide.config import (
    AuxColumn, ConfigError, DatasetConfig, Description, SourceConfig, SpaceColumns, UnitChange, dataset_from_dict,
)
from stationtide.model.definitions import default_graph
from stationtide.operators.codes import decode_units, decode_variables, define_units, encode_variables, backfill_units
from stationtide.operators.homogenise import (
    add_z_coordinate, cast_declared, cast_sql_types, homogenise, legal_field_report, missing_mandatory, select_model_columns,
)
from stationtide.operators.reshape import melt, melt_source


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_steps_run_in_order(frame):
    source = SourceConfig(
        main_variables=(), rename={"t": "temperature", "none": "x"}, columns_to_drop=("junk", "absent"), add={"kind": 3, "temperature": 1.5},
        descriptions={"temperature": Description("float64"), "name": Description("object"), "x": Description(None)},
    )
    out = homogenise(frame([("1.5", None, 1)], "t string, name string, junk int"), source)
    # Casting comes before the constants, and constants may overwrite.
    assert out.columns == ["temperature", "name", "kind"] and out.first() == (1.5, "null", 3)


def test_null_and_bad_integers_raise(frame):
    source = SourceConfig(main_variables=(), descriptions={"n": Description("int64")})
    assert rows_of(cast_declared(frame([("4",)], "n string"), source), "n") == [(4,)]
    for bad in (None, "four"):
        with pytest.raises(Exception, match="null in integer|CAST_INVALID_INPUT"):
            cast_declared(frame([(bad,)], "n string"), source).collect()


def test_sql_types_mark_null_integers(frame):
    out = cast_sql_types(frame([(None, None), (5, 2.0)], "a int, b double"), {"a": "integer", "b": "real"})
    assert out.dtypes == [("a", "bigint"), ("b", "float")]
    assert rows_of(out, "a", "b") == [(-9999, None), (5, 2.0)]


def test_z_coordinate_types(frame):
    df = frame([(10.0,)], "altitude double")
    assert add_z_coordinate(df, SpaceColumns("x", "y", "altitude")).first() == (10.0, 10.0, 0)
    assert add_z_coordinate(df, SpaceColumns("x", "y")).columns == ["altitude"]
    with pytest.raises(ConfigError):
        add_z_coordinate(df.withColumn("depth", F.lit(1)), SpaceColumns("x", "y", "depth"))


def test_mandatory_columns_ignore_join_ids(frame):
    source = SourceConfig(main_variables=(), descriptions={}, header_table="h", join_header="report_id", join_data="rid", mandatory=("report_id", "units"))
    assert missing_mandatory(frame([(1,)], "a int"), source) == ["units"]


def test_unknown_columns_are_refused(frame):
    graph = default_graph()
    with pytest.raises(ConfigError, match="extra_col"):
        select_model_columns(frame([(1, 2)], "observation_id int, extra_col int"), graph)
    kept = select_model_columns(frame([(1, 2, 3, 4)], "uncertainty_value17 int, `latitude|header_table` int, report_id int, observation_id int"), graph)
    assert kept.columns == ["observation_id", "report_id", "latitude|header_table", "uncertainty_value17"]
    report = {r.column: r for r in legal_field_report(frame([(1, 2)], "latitude int, extra_col int"), graph).collect()}
    assert report["latitude"].ambiguous and not report["extra_col"].legal


MELT = SourceConfig(
    main_variables=("t", "p"), observation_key=("id",), melt=True,
    descriptions={"t": Description("float64", units="K"), "p": Description("float64", units="Pa")},
    uncertainty={"random_uncertainty": (AuxColumn("t_unc", "t", "K"),), "structured_random_uncertainty": (AuxColumn("p_unc", "p", "Pa"),)},
    quality_flag=(AuxColumn("t_flag", "t"), AuxColumn("p_flag", "p")), processing_level=(AuxColumn("p_level", "p"),),
)


def test_melt_aligns_auxiliary_columns(frame):
    raw = frame([(1, 280.0, None, 0.5, 3.0, None, 1, 2)],
                "id int, t double, p double, t_unc double, p_unc double, t_flag int, p_flag int, p_level int")
    out = melt_source(raw, MELT)
    rows = {r.observed_variable: r.asDict() for r in out.collect()}
    assert set(rows) == {"t", "p"} and rows["p"]["observation_value"] is None
    assert rows["t"]["observation_id"] == "1-t"
    assert (rows["t"]["uncertainty_value1"], rows["t"]["uncertainty_units1"], rows["t"]["uncertainty_type1"]) == (0.5, "K", 1)
    assert (rows["p"]["uncertainty_value1"], rows["p"]["uncertainty_units1"], rows["p"]["uncertainty_type1"]) == (None, "NA", 1)
    assert (rows["p"]["uncertainty_value4"], rows["p"]["uncertainty_units4"]) == (3.0, "Pa")
    assert (rows["t"]["quality_flag"], rows["p"]["quality_flag"]) == (3, 1)
    assert (rows["t"]["processing_level"], rows["p"]["processing_level"]) == (6, 2)
    assert not {"t_unc", "p_unc", "t_flag", "p_flag", "p_level"} & set(out.columns)
    assert dict(out.dtypes)["uncertainty_value1"] == "float"


def test_melt_needs_a_key_and_keeps_ids(frame):
    with pytest.raises(ConfigError):
        melt(frame([(1, 2.0)], "id int, t double"), ["t"])
    kept = melt(frame([("o1", 2.0)], "observation_id string, t double"), ["t"])
    assert kept.first().observation_id == "o1"


def unit_source(target="m", described="m"):
    return SourceConfig(
        main_variables=("gh", "t"), unit_changes={"gh": UnitChange("Pa", target, 2.0, 1.0)},
        descriptions={"gh": Description("float64", units=described), "t": Description("float64", units="K")},
    )


def test_units_are_defined_and_converted(frame):
    df = frame([("gh", 100.0), ("t", 280.0)], "observed_variable string, observation_value double")
    out = define_units(df, unit_source())
    assert rows_of(out, "observed_variable", "observation_value", "units", "original_units") == [("gh", 201.0, "m", "Pa"), ("t", 280.0, "K", "K")]
    with pytest.raises(ConfigError, match="differ"):
        define_units(df, unit_source(described="ft"))
    with pytest.raises(Exception, match="not described"):
        define_units(df.withColumn("observed_variable", F.lit("other")), unit_source()).collect()


CODES = [(1, " air temperature "), (2, "wind speed"), (7, "air temperature")]


def test_variable_codes(frame):
    codes = frame(CODES, "code int, name string")
    df = frame([("air_temperature",), ("wind_speed",)], "observed_variable string")
    assert rows_of(encode_variables(df, codes), "observed_variable") == [(2,), (7,)]
    with pytest.raises(Exception, match="not in the code table"):
        encode_variables(frame([("ozone",)], "observed_variable string"), codes).collect()
    decoded = decode_variables(frame([(2,), (1,), (99,)], "observed_variable int"), codes)
    # Decoding does not strip, encoding does.
    assert {r.observed_variable for r in decoded.collect()} == {"wind_speed", "_air_temperature_", None}


def test_unit_codes(frame):
    units = frame([(5, "K"), (32, "Pa")], "code int, abbreviation string")
    df = frame([(5, 0, "m")], "units int, original_units int, text_units string")
    assert decode_units(df, units).first().asDict() == {"units": "K", "original_units": "none", "text_units": "m"}
    with pytest.raises(Exception, match="not mapped"):
        decode_units(frame([(6,)], "units int"), units).collect()
    fixed = backfill_units(frame([("5",), ("K",), ("0",)], "units string"), units)
    assert rows_of(fixed, "units") == [("K",), ("K",), ("none",)]
    assert rows_of(backfill_units(fixed, units), "units") == rows_of(fixed, "units")


def test_configuration_from_dict_is_checked():
    raw = {
        "name": "sondes", "lat_tile_size": {"2000-2005": 10, "2006-2010": 5}, "lon_tile_size": 20, "reader": "single_table",
        "disabled_fields": {"a": ["x"]},
        "sources": {"a": {
            "main_variables": ["t"], "data_table": "d", "descriptions": {"t": {"dtype": "float32", "description": "", "units": "m"}, "when": {"dtype": "datetime64[ns]", "description": ""}},
            "cdm_mapping": {"rename": {"T": "t", "F": "flag"}, "unit_changes": {"t": {"names": {"Pa": "m"}, "scale": 1, "offset": 0}},
                            "melt_columns": {"quality_flag": {"quality_flag": [{"name": "flag", "main_variable": "t"}]}}},
        }},
    }
    config = dataset_from_dict(raw)
    assert config.tile_size("lat", "a", 2006) == 5 and config.tile_size("lon", "a", 1990) == 20
    assert config.disabled_for("a") == ("x",) and config.disabled_for("b") == ()
    assert config.sources["a"].unit_changes["t"] == UnitChange("Pa", "m", 1, 0)
    with pytest.raises(ConfigError):
        config.tile_size("lat", "a", 2020)
    raw["sources"]["a"]["main_variables"] = ["t", "undescribed"]
    with pytest.raises(ConfigError, match="undescribed"):
        dataset_from_dict(raw)
    with pytest.raises(ConfigError, match="tile size 7"):
        DatasetConfig(name="x", sources={}, lat_tile_size=7)


def test_observation_ids_tell_keys_apart(frame):
    from stationtide.operators.reshape import melt

    rows = frame([(1, None, "2", 0.0), (1, "2", None, 0.0), (1, "2-v", "x", 0.0), (1, "2", "v-x", 0.0), (1, "~0", "~", 0.0), (1, None, "~", 0.0)],
                 "a int, b string, c string, v double")
    ids = [r.observation_id for r in melt(rows, ["v"], ["a", "b", "c"]).collect()]
    assert len(set(ids)) == 6 and all(i is not None for i in ids)


def test_repeated_codes_do_not_multiply_rows(frame):
    from stationtide.operators.codes import backfill_units, decode_units, decode_variables, repeated_codes

    codes = frame([(1, "a"), (1, "b"), (2, "c")], "code int, name string")
    rows = frame([(1, 7), (2, 7), (3, 0)], "observed_variable int, units int")
    assert sorted(map(str, (r.observed_variable for r in decode_variables(rows, codes).collect()))) == ["None", "b", "c"]
    units = frame([(7, "K"), (7, "k")], "code int, abbreviation string")
    assert sorted(r.units for r in decode_units(rows, units).collect()) == ["k", "k", "none"]
    assert backfill_units(frame([("7",), ("m",)], "units string"), units).count() == 2
    assert [(r.code, r.names) for r in repeated_codes(codes, "code", "name").collect()] == [(1, ["a", "b"])]


def test_half_of_a_composite_key_is_an_orphan(frame):
    from stationtide.model.definitions import default_graph
    from stationtide.operators.relational import key_integrity

    tables = {"header_table": frame([("s1", 2), ("s1", 1), ("s2", None)], "primary_station_id string, station_record_number int"),
              "station_configuration": frame([("s1", 1), ("s2", 2)], "primary_id string, record_number int")}
    row = key_integrity(tables, default_graph()).first()
    assert (row.n_rows, row.n_null, row.n_orphans) == (3, 1, 1) and row.field == "primary_station_id,station_record_number"
