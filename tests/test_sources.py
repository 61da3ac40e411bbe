import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stationtide.config import ConfigError, DatasetConfig, Description, SourceConfig
from stationtide.functions.times import ts
from stationtide.model.codes import read_code_table, read_code_tables
from stationtide.model.definitions import TableDefinition, TableGraph, default_graph, read_definitions
from stationtide.model.lite import lite_columns, long_names
from stationtide.operators.homogenise import merged_types
from stationtide.operators.quality import CheckFailed, assert_period, assert_primary_keys, config_problems, stored_field_report
from stationtide.sources.archive import decode_times, prepare_tables, read_station_index
from stationtide.sources.flat import expand_template, read_flat_csv
from stationtide.sources.registry import read_source, reader_names, register_reader
from stationtide.sources.store import write_json_product
from stationtide.sources.tables import read_header_and_data, read_single_table


def test_delimited_text_with_zoned_times(spark, tmp_path, frame):
    (tmp_path / "obs.psv").write_text(
        "observation_id|report_timestamp|observed_variable|observation_value\n"
        "a|2001-09-16 06:00:00+00|36|285.05\nb|2001-09-30 23:59:59+00|107|3.0\nc|2001-10-01 00:00:00+00|36|1\n")
    codes = frame([("36", "air temperature"), ("107", "wind speed")], "code string, name string")
    out = read_flat_csv(spark, str(tmp_path / "*.psv"), ts("2001-09-01"), ts("2001-10-01"), codes, "|")
    rows = {r.observation_id: r for r in out.collect()}
    assert set(rows) == {"a", "b"} and rows["a"].observed_variable == "air_temperature"
    assert rows["a"].report_timestamp == datetime(2001, 9, 16, 6) and dict(out.dtypes)["report_timestamp"] == "timestamp_ntz"


def test_code_table_keeps_empty_text(spark, tmp_path):
    (tmp_path / "units.csv").write_text('units,name,abbreviation\n# old codes follow\n1,metre,m\n2,"none, really",\n')
    rows = [tuple(r) for r in read_code_table(spark, str(tmp_path), "units").collect()]
    assert rows == [("1", "metre", "m"), ("2", "none, really", "")]
    assert list(read_code_tables(spark, str(tmp_path), ["units"])) == ["units"]


def test_definitions_are_read_and_patched(spark, tmp_path):
    (tmp_path / "header_table.csv").write_text(
        "element_name,kind,external_table,description\nreport_id,varchar (pk),,id\nduplicates,varchar*,header_table:report_id,x\n"
        "primary_station_id,varchar,station_configuration:primary_id,\n")
    (tmp_path / "uncertainty_table.csv").write_text(
        "element_name,type,external_table,description\nobservation_id,varchar,observations_table:observation_id,\nuncertainty_type,int,,\n")
    graph = read_definitions(spark, str(tmp_path), ["header_table", "uncertainty_table"])
    assert graph["header_table"].fields == ["report_id", "primary_station_id"]
    assert graph["uncertainty_table"].primary_keys == ["observation_id", "uncertainty_type"]
    assert [fk.parent for fk in graph["uncertainty_table"].foreign_keys] == ["observations_table", "uncertainty_type"]
    assert "uncertainty_value17" in graph.legal_fields and "report_id|header_table" in graph.legal_fields


def test_key_graph():
    graph = default_graph()
    assert graph.children("station_configuration") == ["header_table"]
    assert graph.children("header_table") == ["observations_table"]
    assert graph.children("units") == []
    assert "latitude" in graph.ambiguous_fields and "report_id" not in graph.ambiguous_fields
    assert graph["station_configuration"].kind("record_number") == "int"


def test_station_index_object(spark, tmp_path):
    (tmp_path / "active.json").write_text(json.dumps({
        "0-20000-0-1": [0, 86400, 10.5, 20.0, "ES", "/a.nc"], "0-20999-0-2": [5, 6, 0.0, 0.0, "", "/b.nc"]}))
    rows = {r.primary_station_id: r for r in read_station_index(spark, str(tmp_path / "active.json")).collect()}
    assert (rows["0-20000-0-1"].record_end, rows["0-20000-0-1"].latitude, rows["0-20000-0-1"].country) == (86400, 10.5, "ES")
    assert len(rows) == 2


def test_templates_pad_only_on_request():
    assert expand_template("{dataset_name}_{source}_{year}_{month}.pq", "d", "s", [(2000, 3)]) == ["d_s_2000_3.pq"]
    assert expand_template("{source}_{year}_{month:02d}", "d", "s", [(2000, 3), (2000, 11)]) == ["s_2000_03", "s_2000_11"]


TWO = SourceConfig(
    main_variables=(), header_table="h", data_table="d", join_header="hid", join_data="did", header_columns=("report_timestamp",),
    rename={"when": "report_timestamp"}, descriptions={"report_timestamp": Description("datetime64[ns]")},
)


def test_header_and_data_agree_or_fail(frame):
    header = frame([(1, datetime(2000, 1, 1), "a"), (2, datetime(2000, 2, 1), None), (-9999, datetime(2000, 1, 1), "z")], "hid int, when timestamp_ntz, network string")
    data = frame([(10, 1, "a", 1.0), (11, 2, None, 2.0), (12, -9999, "z", 3.0), (13, None, "a", 4.0)], "id int, did int, network string, v double")
    source = SourceConfig(**{**TWO.__dict__, "rename": {"when": "report_timestamp", "network": "network"}, "header_columns": ("report_timestamp", "network"),
                             "descriptions": {**TWO.descriptions, "network": Description("object")}})
    joined = read_header_and_data(header, data, source, ts("1999-01-01"), ts("2001-01-01"))
    # Ids that are null or stand for null match nothing; equal nulls agree.
    assert {(r.observation_id, r.network) for r in joined.collect()} == {(10, "a"), (11, None)}
    assert read_header_and_data(header, data, source, ts("2000-02-01"), ts("2001-01-01")).count() == 1
    with pytest.raises(Exception, match="disagree on network"):
        read_header_and_data(header, data.withColumn("network", F.lit("other")), source, ts("1999-01-01"), ts("2001-01-01")).collect()
    with pytest.raises(ConfigError):
        read_header_and_data(header, data, SourceConfig(main_variables=(), descriptions={}), ts("1999-01-01"), ts("2001-01-01"))
    assert merged_types(header, data)["hid"] == "int"


def test_ordered_single_table(frame):
    source = SourceConfig(main_variables=(), order_by=("k",), descriptions={"report_timestamp": Description("datetime64[ns]"), "t": Description("float64")})
    table = frame([(2, datetime(2000, 1, 1)), (1, datetime(2000, 1, 31)), (3, datetime(2000, 2, 1))], "k int, report_timestamp timestamp_ntz")
    assert [r.k for r in read_single_table(table, source, ts("2000-01-01"), ts("2000-02-01"), ordered=True).collect()] == [1, 2]


def test_readers_are_pluggable(spark, frame):
    @register_reader("constant")
    def constant(spark, config, source, start, end, n=1):
        return spark.range(n)

    config = DatasetConfig(name="d", sources={"s": SourceConfig(main_variables=(), descriptions={})}, reader={"s": "constant"}, reader_args={"n": 3})
    assert read_source(spark, config, "s", None, None).count() == 3 and "constant" in reader_names()
    broken = DatasetConfig(name="d", sources=config.sources, reader="nope")
    with pytest.raises(ConfigError, match="nope"):
        read_source(spark, broken, "s", None, None)


def test_archive_tables_are_prepared(spark, frame):
    tables = {
        "observations_table": frame([(0, "o0", 1.0, 2.0, 0.5, 0.5, 10, 1, 5, "e"), (1, "o1", 1.0, 2.0, 0.0, 0.0, 20, 2, 5, "e")],
                                    "row int, observation_id string, latitude double, longitude double, latd double, lond double, date_time bigint, timed bigint, units int, expver string"),
        "station_configuration": frame([("a", 1, "n", 0.0, 0.0), ("a", 1, "m", 0.0, 0.0)], "primary_id string, record_number int, station_name string, latitude double, longitude double"),
        "advanced_uncertainty": frame([(0, 0.1), (1, 0.2)], "row int, desroziers_30 double"),
    }
    out = prepare_tables(tables, ["row"])
    first = out["observations_table"].where("observation_id = 'o0'").first()
    assert (first.latitude, first.longitude, first.date_time) == (1.5, 2.5, 11) and "expver" not in out["observations_table"].columns
    assert [tuple(r) for r in out["station_configuration"].collect()] == [("a", 1, "m")]
    aligned = {r.observation_id: r for r in out["advanced_uncertainty"].collect()}
    assert aligned["o1"].uncertainty_value1 == 0.2 and aligned["o1"].uncertainty_units1 == 5 and aligned["o1"].uncertainty_type1 == 1
    with pytest.raises(ValueError, match="length"):
        prepare_tables({**tables, "advanced_uncertainty": frame([(0, 0.1)], "row int, desroziers_30 double")}, ["row"])
    decoded = decode_times(frame([(3155673600, 1)], "date_time bigint, other int")).first()
    assert decoded.date_time == datetime(2000, 1, 1)


def test_checks_raise_where_they_must(spark, frame):
    df = frame([("o1", datetime(2000, 1, 1)), (None, datetime(2000, 2, 1))], "observation_id string, report_timestamp timestamp_ntz")
    with pytest.raises(CheckFailed, match="observation_id"):
        assert_primary_keys(df, default_graph())
    with pytest.raises(Exception, match="outside the batch"):
        assert_period(df, ts("2000-01-01"), ts("2000-02-01")).collect()
    assert assert_period(df, ts("2000-01-01"), ts("2000-02-02")).count() == 2
    source = SourceConfig(main_variables=("t",), descriptions={"t": Description(None), "crs": Description(None)})
    assert stored_field_report(df, source) == ["crs", "observation_value", "observed_variable"]
    config = DatasetConfig(name="d", sources={"s": source})
    known = frame([("wind speed",)], "name string")
    assert {(r.name, r.problem) for r in config_problems(spark, config, default_graph(), known).collect()} == {("t", "main_variable"), ("crs", "field")}


def test_retrieval_columns():
    assert "observation_value" in lite_columns() and "uncertainty_value17" in lite_columns() and "units" not in lite_columns(("units",))
    assert long_names()["uncertainty_value14"] == "negative_structured_random_uncertainty"


def test_json_product(spark, frame, tmp_path):
    write_json_product(frame([("a", ["x"])], "k string, v array<string>"), str(tmp_path / "p"))
    assert spark.read.json(str(tmp_path / "p")).first().v == ["x"]


def test_custom_graph_joins_optional_tables(frame):
    from stationtide.operators.relational import denormalise

    graph = TableGraph.of([
        TableDefinition("header_table", (("report_id", "varchar (pk)", ""), ("source_key", "varchar", "source_configuration:source_key"))),
        TableDefinition("observations_table", (("observation_id", "varchar (pk)", ""), ("report_id", "varchar", "header_table:report_id"))),
        TableDefinition("source_configuration", (("source_key", "varchar (pk)", ""),)),
        TableDefinition("source_configuration_optional", (("source_key", "varchar (pk)", "source_configuration:source_key"), ("note", "varchar", ""))),
    ])
    flat = denormalise({
        "header_table": frame([("r", "k")], "report_id string, source_key string"),
        "observations_table": frame([("o", "r")], "observation_id string, report_id string"),
        "source_configuration": frame([("k",)], "source_key string"),
        "source_configuration_optional": frame([("k", "hello")], "source_key string, note string"),
    }, graph)
    assert flat.count() == 1 and flat.first().note == "hello" and flat.columns.count("report_id") == 1
    with pytest.raises(ConfigError, match="missing key"):
        denormalise({"header_table": frame([("k",)], "source_key string"), "observations_table": frame([("o", "r")], "observation_id string, report_id string")}, graph)
    loose = denormalise({"header_table": frame([("k",)], "source_key string"), "observations_table": frame([("o", "r")], "observation_id string, report_id string")}, graph, ignore_missing=True)
    assert loose.columns == ["observation_id", "report_id"]


def test_time_mask_of_sorted_tables(spark, frame, tmp_path):
    from datetime import datetime, timedelta

    from pyspark.sql import functions as F

    from stationtide.functions.times import ts
    from stationtide.operators.archive import in_seconds, record_intervals, rows_of_intervals

    rows, position = [], 0
    for variable in (1, 2):
        for hour in range(0, 24 * 90, 6):
            for _ in range(3):
                rows.append(("f", position, variable, datetime(2020, 1, 1) + timedelta(hours=hour)))
                position += 1
    rows += [("g", i, 1, datetime(2020, 1, 31, 23, 59, 59) if i < 2 else datetime(2020, 1, 31, 23, 59, 59, 500_000)) for i in range(4)]
    path = str(tmp_path / "t")
    frame(rows, "file string, row bigint, observed_variable int, at timestamp_ntz").coalesce(1).sortWithinPartitions("file", "row").write.option(
        "parquet.block.size", 4096).parquet(path)
    table = spark.read.parquet(path)
    index = table.groupBy("file", "observed_variable", F.col("at").alias("record_timestamp")).agg(F.min("row").alias("position"))
    intervals = record_intervals(index, ts("2020-01-01"), ts("2020-02-01"))
    assert {(r.file, r.observed_variable): (r.first, r.stop) for r in intervals.collect()} == {("f", 1): (0, 372), ("f", 2): (1080, 1452), ("g", 1): (0, 2)}
    found = rows_of_intervals(table, intervals)
    want = sorted((f, i) for f, i, _, at in rows if at <= datetime(2020, 1, 31, 23, 59, 59))
    assert sorted((r.file, r.row) for r in found.collect()) == want
    # The range of positions reaches the scan.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(row,0)" in plan and "LessThan(row,1452)" in plan
    last = record_intervals(index, ts("2020-03-01"), ts("2020-04-01"))
    assert {(r.file, r.observed_variable): r.stop for r in last.collect()} == {("f", 1): 1080, ("f", 2): None}
    assert rows_of_intervals(table, last).count() == 2 * 30 * 4 * 3
    assert rows_of_intervals(table, record_intervals(index, ts("2021-01-01"), ts("2021-02-01"))).count() == 0
    assert table.where(in_seconds("at", ts("2020-01-31"), ts("2020-02-01"))).where("file = 'g'").count() == 2


def test_archive_reads_only_the_rows_of_the_period(spark):
    from pyspark.sql import functions as F

    from stationtide.functions.times import ts
    from stationtide.sources.archive import read_archive
    from stationtide.suite.relation_queries import _archive_graph, _archive_tables

    folder = "/root/testdata/sf0.001"
    tables = _archive_tables(spark, folder)
    times = tables["header_table"].select("report_id", "report_timestamp")
    tables["observations_table"] = tables["observations_table"].join(times.withColumnRenamed("report_timestamp", "date_time"), "report_id")
    args = (_archive_graph(), ts("1996-01-01"), ts("1996-07-01"), (-100, 100, -60, 60), ["file", "row"])
    key = lambda df: sorted(map(tuple, df.select("report_id", "observed_variable", "observation_value", "`fg_depar@body`").collect()))
    plain = key(read_archive(tables, *args))
    masked = read_archive(tables, *args, sorted_by_date={"observations_table": "date_time"}, check=False)
    assert plain and key(masked) == plain
    index = tables["observations_table"].select("file", F.col("row").alias("position"), "observed_variable", F.col("date_time").alias("record_timestamp"))
    assert key(read_archive(tables, *args, record_index=index)) == plain


def test_aligned_buckets_are_not_shuffled(spark):
    from stationtide.suite.relation_queries import q_aligned_buckets

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = q_aligned_buckets(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_missing_columns_are_named_before_an_ingestion(frame):
    from stationtide.config import DatasetConfig, Description, SourceConfig
    from stationtide.plans.ingest import preparation_warnings

    source = SourceConfig(main_variables=("t",), rename={"when": "report_timestamp"}, descriptions={"report_timestamp": Description("datetime64[ns]"), "t": Description("float64")})
    warnings = preparation_warnings(frame([(None, 1.0)], "when timestamp_ntz, t double"), DatasetConfig(name="d", sources={"s": source}), "s")
    assert "mandatory column latitude is missing" in warnings and not any("report_timestamp" in w for w in warnings)


def test_a_stored_batch_is_known_by_its_period_and_box(spark, frame, tmp_path):
    from datetime import datetime

    from stationtide.plans.ingest import batch_is_stored, ingest
    from stationtide.sources.store import read_catalogue
    from test_store import RAW, config, raw_rows

    root = str(tmp_path / "store")
    ingest(spark, frame(raw_rows((1,)), RAW), config(), "01", "1.0.0", root)
    entries, period = read_catalogue(spark, root), (datetime(2020, 1, 1), datetime(2020, 2, 1))
    assert batch_is_stored(entries, "sondes", "01", "1.0.0", *period)
    assert not batch_is_stored(entries, "sondes", "01", "1.0.0", *period, box=(-10, 10, -10, 10))
    assert not batch_is_stored(entries, "sondes", "01", "2.0.0", *period)
