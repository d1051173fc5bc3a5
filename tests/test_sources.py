"""JSON, CSV and Parquet files, landing of raw lines at once and as they arrive, projection."""

import json
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.frames import plan, rows, sorted_tuples
from voltledger import sources
from voltledger.plans import elt, register, weather
from voltledger.sources.bronze import landing_counts
from voltledger.streaming import land_new_files

STATIONS = "id string, nom string, dateFin string"
STATION_ROWS = [
    {"id": "21000001", "nom": "COL D'EN HAUT", "dateFin": ""},
    {"id": "21000002", "nom": "PORT", "dateFin": "2001-05-31"},
    {"id": "21000003", "nom": "PORT", "dateFin": ""},
    {"id": "21000004", "nom": "PORT", "dateFin": ""},
    {"id": "21000005", "nom": "COL D'EN HAUT", "dateFin": None},
]
RECORD = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("nom", T.StringType()),
        T.StructField("p", T.DoubleType()),
    ]
)


@pytest.fixture
def station_file(tmp_path):
    path = tmp_path / "stations.json"
    path.write_text(json.dumps(STATION_ROWS, indent=4, ensure_ascii=False), encoding="utf-8")
    return str(path)


def test_json_array(spark, station_file):
    stations = sources.read_json_records(spark, station_file, STATIONS)
    assert sorted_tuples(stations) == sorted(
        [tuple(r.values()) for r in STATION_ROWS], key=lambda r: r[0]
    )
    assert stations.filter("dateFin = ''").count() == 3


def test_weather_stations(spark, station_file):
    stations = sources.read_json_records(spark, station_file, STATIONS)
    assert weather.active_stations(stations).count() == 3
    assert rows(weather.station_shapes(stations)) == [(5, 3, 3)]
    names = weather.same_name_stations(stations)
    assert sorted_tuples(names.select("id")) == [("21000003",), ("21000004",)]
    assert rows(weather.station(stations, "21000001").select("nom")) == [("COL D'EN HAUT",)]


def test_a_bad_array_is_refused_whole(spark, tmp_path):
    path = tmp_path / "bad.json"
    path.write_text('[{"id": "1"}, {"id": ]')
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ|not one JSON document"):
        sources.read_json_records(spark, str(path), STATIONS).collect()


def test_json_lines(spark, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text("\n".join(json.dumps(r) for r in STATION_ROWS))
    assert sources.read_json_records(spark, str(path), STATIONS, lines=True).count() == 5


def test_nested_results(spark, tmp_path):
    for name, results in (("a", [{"id": "1"}, {"id": "2"}]), ("b", []), ("c", None)):
        body = {"total_count": 2, "results": results}
        (tmp_path / f"{name}.json").write_text(json.dumps(body, indent=2))
    schema = "total_count long, results array<struct<id: string>>"
    pages = sources.read_json_records(spark, str(tmp_path), schema)
    assert sorted_tuples(sources.flatten_results(pages)) == [("1",), ("2",)]
    kept = sources.flatten_results(pages, keep_empty=True)
    assert sorted_tuples(kept) == [(None,), (None,), ("1",), ("2",)]


def test_csv(spark, tmp_path):
    path = tmp_path / "hours.csv"
    path.write_text("aaaammjjhh,num_poste,t\n2020010100,01001,1.5\n2025123123,21000,\n")
    hours = sources.read_csv(spark, str(path), {"aaaammjjhh": "int", "t": "double"})
    assert rows(hours) == [(2020010100, "01001", 1.5), (2025123123, "21000", None)]
    assert rows(weather.observation_period(hours)) == [(2020010100, 2025123123)]
    assert rows(weather.observation_shape(hours)) == [(2, 3)]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("b;a\ntext;7\n")
    assert rows(sources.read_csv(spark, str(path), {"a": "int"}, ";").select("a")) == [(7,)]
    with pytest.raises(ValueError, match="missing columns"):
        sources.read_csv(spark, str(path), {"c": "int"}, ";")


def test_csv_value_of_another_type_is_an_error(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("a\n1\nx\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ|MALFORMED"):
        sources.read_csv(spark, str(path), {"a": "int"}).collect()


def test_csv_files_of_a_folder_must_share_the_header(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,x\n")
    (tmp_path / "2.csv").write_text("b,a\ny,2\n")
    with pytest.raises(Exception, match="header|FAILED_READ"):
        sources.read_csv(spark, str(tmp_path), {"a": "int"}).collect()


def test_parquet_without_extension(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "register"))
    assert sources.read_parquet(spark, str(tmp_path / "register")).count() == 3


GOOD = ['{"id": 1, "nom": "a", "p": 1.5}', '{"id": 2, "more": true}', "{}"]
GOOD_ODD = ['{"id": 1, "nested": {"a": {}}}  ', '{"nom": "}"}', '{"id": 1} ', '{"nom": "]}{["}', '\t{"id": null}']
BAD = ['{"id": 1', "not json", '{"id": "x"}', '"text"', "17", "null"]
BAD += ['{"id": 1} {"id": 2}', '{"id": 1}, {"id": 2}', '[{"id": 1}, {"id": 2}]', '[{"id": 1}]', '{"id": 1}}']
BAD += ['{"nom": "}"} x}', '{"nested": {}}, {"id": 1}', "}", 'x"}', '{"id": 1}}', '{"id": 2]}']


def write_lines(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_landing(spark, tmp_path):
    raw = tmp_path / "raw"
    write_lines(raw, "1.json", GOOD + ["", "   "])
    write_lines(raw, "2.json", BAD[:4])
    target = str(tmp_path / "bronze")
    counts = sources.land_json_lines(spark, str(raw), target, RECORD)
    assert rows(counts) == [(3, 4)]
    accepted = sources.read_accepted(spark, target, RECORD)
    assert accepted.schema == RECORD
    assert sorted_tuples(accepted) == [(None, None, None), (1, "a", 1.5), (2, None, None)]
    rejected = sources.read_rejected(spark, target, RECORD)
    assert sorted_tuples(rejected) == sorted((line,) for line in BAD[:4])


@pytest.mark.parametrize("line", GOOD_ODD)
def test_lines_that_are_records(spark, tmp_path, line):
    raw = tmp_path / "raw"
    write_lines(raw, "1.json", [line])
    assert rows(
        sources.land_json_lines(spark, str(raw), str(tmp_path / "bronze"), RECORD)
    ) == [(1, 0)]


@pytest.mark.parametrize("line", BAD)
def test_lines_that_are_no_record(spark, tmp_path, line):
    raw = tmp_path / "raw"
    write_lines(raw, "1.json", [line])
    target = str(tmp_path / "bronze")
    assert rows(sources.land_json_lines(spark, str(raw), target, RECORD)) == [(0, 1)]
    assert rows(sources.read_rejected(spark, target, RECORD)) == [(line,)]


def test_landing_all_good_or_empty(spark, tmp_path):
    raw = tmp_path / "raw"
    write_lines(raw, "1.json", GOOD)
    target = str(tmp_path / "good")
    assert rows(sources.land_json_lines(spark, str(raw), target, RECORD)) == [(3, 0)]
    assert rows(sources.read_rejected(spark, target, RECORD)) == []
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        sources.land_json_lines(spark, str(raw), target, RECORD)


def test_landing_of_documents(spark, tmp_path):
    raw, target = tmp_path / "raw", str(tmp_path / "bronze")
    files = {
        "list": json.dumps([{"id": 1, "nom": "x"}, {"id": 2}], indent=4),
        "one": json.dumps({"id": 3}),
        "nothing": "[]",
        "type": json.dumps([{"id": 4}, {"id": "bad"}, {"id": 6}], indent=4),
        "cut": '[{"id": 7},\n {"id": ',
        "mixed": '[{"id": 8}, 5]',
        "lines": '{"id": 9}\n{"id": 10}',
        "two": '[{"id": 11}]\n[{"id": 12}]',
        "after-list": '[{"id": 13}] oops',
        "after-one": '{"id": 14} oops',
        "closed": '{"id": 15}], {"id": 16}',
        "closed-again": '{"id": 17}}, {"id": 18}',
        "null": '[{"id": 19}, null]',
        "empty": "",
    }
    for name, text in files.items():
        write_lines(raw, f"{name}.json", [text])
    assert rows(sources.land_json_documents(spark, str(raw), target, RECORD)) == [(3, 11)]
    accepted = sources.read_accepted(spark, target, RECORD)
    assert sorted_tuples(accepted) == [(1, "x", None), (2, None, None), (3, None, None)]
    names = rows(sources.read_rejected(spark, target, RECORD))
    ends = sorted(row[0].rsplit("/", 1)[1] for row in names)
    assert ends == sorted(f"{name}.json" for name in files if name not in ("list", "one", "nothing"))


@pytest.mark.parametrize(
    "text", ['{"id": 1}\n{"id": 2}', '[{"id": 1}]\n[{"id": 2}]', '[{"id": 1}] oops', '{"id": 1} oops', "[{}, 5]", ""]
)
def test_a_document_that_is_not_whole_is_an_error(spark, tmp_path, text):
    write_lines(tmp_path, "1.json", [text])
    with pytest.raises(Exception, match="not one JSON document"):
        sources.read_json_records(spark, str(tmp_path), RECORD).collect()


def test_a_rejected_document_takes_no_longer(spark, tmp_path):
    """The time grows with the file, not with its square: 16,000 records, one of them faulty."""
    records = [{"id": k, "nom": "x" * 60} for k in range(16_000)]
    seconds = {}
    for name, fault in (("warm", 5), ("good", None), ("bad", 9_000)):
        one = [dict(r, id="bad") if r["id"] == fault else r for r in records]
        raw = tmp_path / name
        write_lines(raw, "1.json", [json.dumps(one, indent=2)])
        start = time.perf_counter()
        counts = sources.land_json_documents(spark, str(raw), str(tmp_path / f"{name}-bronze"), RECORD)
        assert rows(counts) == [(16_000, 0) if fault is None else (0, 1)]
        seconds[name] = time.perf_counter() - start
    assert seconds["bad"] <= 3 * seconds["good"]


def test_landing_names_are_reserved(spark, tmp_path):
    schema = T.StructType([T.StructField("landing", T.StringType())])
    with pytest.raises(ValueError, match="added on landing"):
        sources.land_json_lines(spark, str(tmp_path), str(tmp_path / "x"), schema)


def test_landing_by_year_prunes(spark, tmp_path):
    raw, target = tmp_path / "raw", str(tmp_path / "bronze")
    schema = T.StructType([T.StructField("t", T.TimestampNTZType()), T.StructField("v", T.LongType())])
    lines = [f'{{"t": "20{y}-06-01T00:30:00", "v": {y}}}' for y in (13, 14, 14, 15)]
    write_lines(raw, "1.json", lines + ["bad"])
    counts = sources.land_json_lines(
        spark, str(raw), target, schema, partition_by={"year": F.year("t")}
    )
    assert rows(counts) == [(4, 1)]
    accepted = sources.read_accepted(spark, target, schema)
    assert accepted.columns == ["t", "v", "year"]
    of_2014 = accepted.filter("year = 2014")
    assert sorted_tuples(of_2014.select("v")) == [(14,), (14,)]
    scan = next(line for line in plan(of_2014).splitlines() if "FileScan" in line)
    assert "PartitionFilters" in scan and "year" in scan.split("PartitionFilters")[1]
    assert rows(sources.read_rejected(spark, target, schema)) == [("bad",)]


def test_arriving_files_are_landed_once(spark, tmp_path):
    raw, target = tmp_path / "raw", str(tmp_path / "bronze")
    checkpoint = str(tmp_path / "checkpoint")

    def land():
        land_new_files(
            spark, str(raw), target, RECORD, checkpoint, 1, {"has_name": F.col("nom").isNotNull()}
        ).awaitTermination()
        return rows(landing_counts(spark, target, RECORD))

    write_lines(raw, "1.json", GOOD)
    write_lines(raw, "2.json", BAD[:2])
    assert land() == [(3, 2)]
    assert land() == [(3, 2)]
    write_lines(raw, "3.json", GOOD[:1] + BAD[:1])
    assert land() == [(4, 3)]
    accepted = sources.read_accepted(spark, target, RECORD)
    assert accepted.filter("id = 1").count() == 2
    assert accepted.filter("has_name = 'true'").count() == 2


def test_projection(spark):
    df = spark.createDataFrame([(1, "x", 2)], "id int, nom string, rest int")
    got = sources.project(df, {"nom": "name", "id": ""})
    assert got.columns == ["name", "id"]
    assert rows(got) == [("x", 1)]
    with pytest.raises(ValueError, match=r"missing columns \['zzz'\]"):
        sources.project(df, {"zzz": "", "id": ""})


def test_register_load(spark, tmp_path):
    fields = [T.StructField(name, T.StringType()) for name in register.SILVER_COLUMNS]
    raw_schema = T.StructType([*fields, T.StructField("other", T.LongType())])
    row = {name: name.upper() for name in register.SILVER_COLUMNS} | {"other": 1}
    raw = str(tmp_path / "raw")
    spark.createDataFrame([row], raw_schema).write.parquet(raw)
    silver = elt.silver_schema(raw_schema)
    sources.create_table(spark, "silver_register", silver, str(tmp_path / "silver"))
    elt.load_register(spark, raw, "silver_register")
    elt.load_register(spark, raw, "silver_register")
    got = spark.table("silver_register")
    assert got.columns[:3] == ["idpeps", "nom_installation", "codeeicresourceobject"]
    assert len(got.columns) == 17
    assert [r.date_mise_en_service for r in got.collect()] == ["DATEMISEENSERVICE_DATE"] * 2
    spark.sql("DROP TABLE silver_register")
