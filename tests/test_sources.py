"""Landed files, the keyed merge and the stream load."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from spokecast.sources import api_json, merge, periods, trip_files
from spokecast.streaming import incremental


def bodies(spark, *docs, **extra):
    rows = [(json.dumps(d), *extra.values()) for d in docs]
    return spark.createDataFrame(rows, ["body", *extra])


def test_months_of_a_period(spark):
    assert periods.months_between(spark, "2024-01-31", "2024-04-01") == ["202401", "202402", "202403", "202404"]
    assert periods.months_between(spark, "2023-12-15", "2024-01-10") == ["202312", "202401"]
    assert periods.months_between(spark, "2024-02-01", "2024-01-01") == []
    assert periods.years_between("2023-12-15", "2025-01-10") == [2023, 2024, 2025]


def test_csv_cells_headers_and_schema_drift(spark, tmp_path):
    (tmp_path / "202401-a.csv").write_text(
        "Ride ID,Started At,ended_at,start_lat\n1,2024-01-01 10:00:00,2024-01-01 10:30:30,40.7\n2,broken,2024-01-01 11:00:00,x\n"
    )
    (tmp_path / "202402-a.csv").write_text(
        "ended_at,ride_id,started_at,rideable_type\n2024-02-01 10:01:00,3,2024-02-01 10:00:00.500,classic\n"
    )
    df = trip_files.read_months(spark, str(tmp_path) + "/{month}-*.csv", ["202401", "202402", "202403"])
    rows = {r.ride_id: r for r in df.collect()}
    assert rows["1"].ride_mins == 30.5 and rows["1"].source_month == "202401"
    assert rows["2"].started_at is None and rows["2"].start_lat is None and rows["2"].ride_mins is None
    assert rows["3"].rideable_type == "classic" and rows["3"].ride_mins == 59 / 60
    with pytest.raises(FileNotFoundError):
        trip_files.read_months(spark, str(tmp_path) + "/{month}-*.csv", ["203001"])


def test_given_length_is_kept(spark):
    df = spark.createDataFrame([(7.0,)], "ride_mins double")
    assert trip_files.add_ride_mins(df).first().ride_mins == 7.0


def test_weather_arrays(spark):
    full = {
        "daily": {
            "time": ["2023-11-08", "2023-11-09", "2023-11-10"],
            "temperature_2m_max": [12.25, 9.5, 14.75],
            "temperature_2m_min": [3.75, 1.5],
            "precipitation_sum": [7.25, 0.0, 1.25],
        }
    }
    rows = sorted(api_json.parse_weather(bodies(spark, full), "40.73,-73.94").collect(), key=lambda r: r.date)
    assert [(r.tmax, r.tmin, r.precip, r.wind_max) for r in rows] == [
        (12.25, 3.75, 7.25, None),
        (9.5, 1.5, 0.0, None),
        (14.75, None, 1.25, None),
    ]
    assert rows[0].source_location == "40.73,-73.94" and rows[0]._dlt_load_timestamp is not None
    assert api_json.parse_weather(bodies(spark, {"error": "No data"})).count() == 0


def holiday(date="2024-09-19", name="Harvest Fair", **more):
    return {
        "date": date,
        "name": name,
        "localName": name,
        "countryCode": "US",
        "fixed": False,
        "global": False,
        "types": ["Public"],
        "counties": None,
        "launchYear": None,
    } | more


def merged(spark, *entries):
    return api_json.merge_holidays(api_json.parse_holidays(bodies(spark, list(entries), source_year=2024))).collect()


def test_two_holidays_on_one_date(spark):
    (row,) = merged(
        spark,
        holiday(counties=["US-VT", "US-ID"], launchYear=1983),
        holiday(name="Lantern Walk", counties=["US-AZ", "US-ME"], launchYear=2004),
    )
    assert row.holiday_name == "Harvest Fair and Lantern Walk"
    assert (row.counties, row.holiday_types, row.launch_year) == ("US-AZ,US-ID,US-ME,US-VT", "Public", 1983)
    assert (row.is_global, row.is_fixed, row.source_year) == (False, False, 2024)


def test_types_are_ordered_when_merged_but_not_alone(spark):
    (row,) = merged(spark, holiday(types=["Optional"]), holiday(name="B", types=["School", "Federal", "Public"]))
    assert row.holiday_types == "Public,Federal,Optional,School"
    (row,) = merged(spark, holiday(types=["Optional", "Public"], counties=["US-WY", "US-DE", "US-KS"]))
    assert (row.holiday_types, row.counties) == ("Optional,Public", "US-WY,US-DE,US-KS")


def test_repeated_names_and_nulls(spark):
    (row,) = merged(spark, holiday(), holiday(**{"global": True}))
    assert (row.holiday_name, row.is_global, row.counties) == ("Harvest Fair", True, None)
    (row,) = merged(spark, holiday(counties=None, types=[]))
    assert (row.counties, row.holiday_types, row.is_fixed) == (None, None, False)


def test_empty_holiday_response(spark):
    assert api_json.merge_holidays(api_json.parse_holidays(bodies(spark, [], source_year=2024))).count() == 0


def game(pk, home, **more):
    return {
        "gamePk": pk,
        "gameDate": "2024-05-01T23:05:00Z",
        "teams": {"home": {"team": {"id": home, "name": "H"}}, "away": {"team": {"id": 9, "name": "A"}}},
    } | more


def test_schedule_keeps_home_games_and_nulls(spark):
    doc = {"dates": [{"games": [game(1, 147), game(2, 9), {"gamePk": 3}]}, {"games": []}, {"games": [game(4, 121)]}]}
    rows = {r.game_id: r for r in api_json.parse_schedule(bodies(spark, doc)).collect()}
    assert set(rows) == {1, 4}
    assert (rows[1].game_date, rows[1].venue_name, rows[1].game_status) == ("2024-05-01", None, None)
    asked = api_json.parse_schedule(bodies(spark, doc, team_id=121))
    assert [r.game_id for r in asked.collect()] == [4]
    assert api_json.parse_schedule(bodies(spark, {"error": "x"})).count() == 0


def test_response_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"daily": {"time": ["2024-01-01"]}}, indent=2))
    (tmp_path / "b.json").write_text(json.dumps({"daily": {"time": ["2024-01-02"]}}))
    assert api_json.parse_weather(api_json.read_bodies(spark, str(tmp_path))).count() == 2


ROWS = "k int, v string, at int, month string"


def stored(spark, path):
    return sorted((r.k, r.v, str(r.month)) for r in merge.read_table(spark, path, "month").collect())


def test_merge_replaces_and_adds(spark):
    target = spark.createDataFrame([(1, "old", 0, "a"), (2, "old", 0, "a")], ROWS)
    batch = spark.createDataFrame([(2, "first", 1, "a"), (2, "last", 2, "a"), (3, "new", 1, "b")], ROWS)
    out = merge.merge_by_key(target, batch, ["k"], [F.desc("at")])
    assert sorted((r.k, r.v) for r in out.collect()) == [(1, "old"), (2, "last"), (3, "new")]


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")

    def load(*rows):
        merge.upsert_partitions(spark, path, spark.createDataFrame(rows, ROWS), ["k"], "month", [F.desc("at")])

    load((1, "x", 0, "202401"), (2, "x", 0, "202401"), (3, "x", 0, "202402"), (4, "x", 0, "202403"))
    def files(month):
        table = merge.read_table(spark, path, "month")
        return {r[0] for r in table.where(F.col("month") == month).select(F.input_file_name()).distinct().collect()}

    untouched = files("202403")
    load((2, "y", 1, "202401"), (5, "y", 1, "202402"))
    load((2, "y", 1, "202401"), (5, "y", 1, "202402"))  # a rerun changes nothing
    assert stored(spark, path) == [
        (1, "x", "202401"),
        (2, "y", "202401"),
        (3, "x", "202402"),
        (4, "x", "202403"),
        (5, "y", "202402"),
    ]
    assert files("202403") == untouched != files("202402")


def test_upsert_moves_a_key_between_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    for rows in ([(1, "x", 0, "202401"), (2, "x", 0, "202402")], [(1, "moved", 1, "202402")]):
        merge.upsert_partitions(spark, path, spark.createDataFrame(rows, ROWS), ["k"], "month", [F.desc("at")])
    assert stored(spark, path) == [(1, "moved", "202402"), (2, "x", "202402")]


def test_stream_load_is_repeatable(spark, tmp_path):
    folder, table, mark = (str(tmp_path / n) for n in ("in", "table", "mark"))
    (tmp_path / "in").mkdir()
    header = "Ride ID,Started At,Ended At\n"
    (tmp_path / "in" / "1.csv").write_text(header + "1,2024-01-01 10:00:00,2024-01-01 10:10:00\n2,bad,2024-01-01 10:00:00\n")

    def run():
        stream = incremental.landed_trips(spark, folder, ("Ride ID", "Started At", "Ended At"))
        incremental.merge_stream(stream, table, mark, ["ride_id"], "source_month", [F.desc("_dlt_load_timestamp")])
        return {r.ride_id: r.ride_mins for r in merge.read_table(spark, table, "source_month").collect()}

    assert run() == {"1": 10.0, "2": None}
    (tmp_path / "in" / "2.csv").write_text(header + "1,2024-01-01 10:00:00,2024-01-01 10:20:00\n3,2024-02-01 10:00:00,2024-02-01 10:05:00\n")
    assert run() == {"1": 20.0, "2": None, "3": 5.0}
    assert run() == {"1": 20.0, "2": None, "3": 5.0}


def test_files_of_one_month_keep_their_own_headers(spark, tmp_path):
    (tmp_path / "202401-a.csv").write_text("ride_id,started_at,ended_at\na,2024-01-02 08:00:00,2024-01-02 08:30:00\n")
    (tmp_path / "202401-b.csv").write_text("ended_at,extra,ride_id,started_at\n2024-01-03 09:15:00,x,b,2024-01-03 09:00:00\n")
    rows = {r.ride_id: r for r in trip_files.read_trips(spark, f"{tmp_path}/202401-*.csv", "202401").collect()}
    assert (rows["a"].ride_mins, rows["a"].extra) == (30.0, None)
    assert (rows["b"].ride_mins, rows["b"].extra) == (15.0, "x")


def test_stream_refuses_another_header(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_text("Started At,Ride ID\n2024-01-01 10:00:00,1\n")
    stream = incremental.landed_trips(spark, str(tmp_path / "in"), ("Ride ID", "Started At"))
    with pytest.raises(Exception, match="header|CSV|schema"):
        incremental.merge_stream(stream, str(tmp_path / "t"), str(tmp_path / "m"), ["ride_id"], "source_month", [F.desc("ride_id")])


def test_upsert_keeps_the_null_partition(spark, tmp_path):
    path = str(tmp_path / "t")

    def load(*rows):
        merge.upsert_partitions(spark, path, spark.createDataFrame(rows, ROWS), ["k"], "month", [F.desc("at")])

    load((1, "x", 0, None), (2, "x", 0, "202401"))
    load((3, "x", 0, None))
    assert stored(spark, path) == [(1, "x", "None"), (2, "x", "202401"), (3, "x", "None")]
    load((1, "y", 1, "202402"), (3, "y", 1, "202402"))  # the null partition is left empty
    load((2, "z", 1, None))
    assert stored(spark, path) == [(1, "y", "202402"), (2, "z", "None"), (3, "y", "202402")]


def test_a_load_that_fails_leaves_the_old_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")

    def load(*rows, columns=ROWS):
        merge.upsert_partitions(spark, path, spark.createDataFrame(rows, columns), ["k"], "month", [F.desc("at")])

    load((1, "x", 0, "202401"), (2, "x", 0, "202402"))
    before = stored(spark, path)
    ranges = merge._ranges

    def broken(df, keys, partition):
        if "load=" in "".join(df.inputFiles()):
            raise OSError("killed after the data, before the log")
        return ranges(df, keys, partition)

    monkeypatch.setattr(merge, "_ranges", broken)
    with pytest.raises(OSError):
        load((1, "y", 1, "202402"))
    assert stored(spark, path) == before
    monkeypatch.undo()
    load((1, "y", 1, "202402"))
    assert stored(spark, path) == [(1, "y", "202402"), (2, "x", "202402")]
    assert [merge.clear_superseded(spark, path, "month") for _ in range(2)] == [2, 0]  # the first load and the killed one
    assert stored(spark, path) == [(1, "y", "202402"), (2, "x", "202402")]
    load((3, "z", 2, "202403", 7), columns=ROWS + ", extra int")
    assert {(r.k, r.extra) for r in merge.read_table(spark, path, "month").collect()} == {(1, None), (2, None), (3, 7)}


def test_only_partitions_in_the_range_of_keys_are_searched(spark, tmp_path, monkeypatch):
    path, searched = str(tmp_path / "t"), []
    read = merge._stored

    def spied(spark, path, partition, entries):
        searched.append(sorted(str(e.part) for e in entries))
        return read(spark, path, partition, entries)

    def load(*rows):
        searched.clear()
        merge.upsert_partitions(spark, path, spark.createDataFrame(rows, ROWS), ["k"], "month", [F.desc("at")])

    load(*[(i, "x", 0, f"m{i // 10}") for i in range(50)])
    monkeypatch.setattr(merge, "_stored", spied)
    load((12, "y", 1, "m9"), (15, "y", 1, "m9"))
    assert searched == [["m1"], ["m1"]]  # of five, one may hold the keys, and does
    load((100, "y", 1, "m8"))
    assert searched == []
    load((None, "y", 1, "m7"))
    load((None, "z", 2, "m6"))
    assert searched == [["m7"], ["m7"]]
    table = merge.read_table(spark, path, "month")
    assert table.count() == 52 and table.where("k is null").first().v == "z"
    from test_plans import scanned_files

    assert scanned_files(table.where("month = 'm2'").select("k")) == 1


def test_newest_response_of_a_year(spark, tmp_path):
    for name, at, body in (("a", 1, [holiday(name="Old Fair")]), ("b", 2, [holiday(types=["Optional", "Public"])])):
        (tmp_path / f"{name}.json").write_text(json.dumps(body))
        os.utime(tmp_path / f"{name}.json", (at, at))
    found = api_json.read_bodies(spark, str(tmp_path)).withColumn("source_year", F.lit(2024))
    (row,) = api_json.merge_holidays(api_json.parse_holidays(api_json.newest_response(found, "source_year"))).collect()
    assert (row.holiday_name, row.holiday_types) == ("Harvest Fair", "Optional,Public")


def test_line_items_without_a_date_are_merged(spark, sf_dir, tmp_path):
    from compare import connect, differences

    from __spark_entry__ import oracle_sql, queries

    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    place = items.columns.index("l_shipdate")
    base = items.orderBy("l_orderkey", "l_linenumber").limit(1).collect()[0]
    rows = []
    for order, dates in enumerate([[None], [None, None], [None, "1996-05-01"], [None, "1998-05-01"], ["1996-05-01", "1998-05-01"]]):
        for price, date in enumerate(dates):
            row = dict(zip(items.columns, base, strict=True)) | {"l_orderkey": order, "l_linenumber": 1, "l_extendedprice": type(base["l_extendedprice"])(price)}
            like = base[place]
            row["l_shipdate"] = None if date is None else like.replace(*map(int, date.split("-")))
            rows.append(tuple(row[c] for c in items.columns))
    spark.createDataFrame(rows, items.schema).write.parquet(str(tmp_path / "lineitem.parquet"))
    got = queries()["merge_upsert"](spark, str(tmp_path))
    assert differences(got, connect(str(tmp_path)), oracle_sql()["merge_upsert"]) == []
    assert got.filter("l_shipdate is null").count() == 3
