"""From landed files to marts."""

from __future__ import annotations

import json

from test_sources import game, holiday

from spokecast.plans import build, ingest
from spokecast.sources.tables import Warehouse

HEADER = "ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,end_station_name,end_station_id,start_lat,start_lng,end_lat,end_lng,member_casual\n"


def landed(folder):
    for name in ("trips", "weather", "holidays", "games"):
        (folder / name).mkdir()
    for month in ("05", "06"):
        rows = []
        for day in range(1, 29):
            for n in range(6):
                at = f"2024-{month}-{day:02d} {8 + n * 2:02d}"
                a, b = n % 4, (n + day) % 5
                rows.append(
                    f"{month}{day:02d}{n},classic_bike,{at}:00:00,{at}:2{n}:00,Stop {a},{a},Stop {b},{b},"
                    f"{40.825 + a / 1000},{-73.925 - a / 1000},40.83,-73.93,{'member' if n % 2 else 'casual'}"
                )
        (folder / "trips" / f"2024{month}-a.csv").write_text(HEADER + "\n".join(rows) + "\n")
    days = [f"2024-05-{d:02d}" for d in range(1, 31)]
    weather = {"time": days, "temperature_2m_max": [20.0] * 30, "temperature_2m_min": [10.0] * 30}
    (folder / "weather" / "may.json").write_text(json.dumps({"daily": weather}))
    (folder / "holidays" / "2024.json").write_text(json.dumps([holiday("2024-05-27", "Memorial Day", types=["Public"])]))
    schedule = {
        "dates": [
            {
                "games": [
                    game(pk, 147, gameDate=f"2024-05-{pk:02d}T18:05:00", season="2024", venue={"id": 1, "name": "Yankee Stadium"})
                ]
            }
            for pk in (7, 14, 21)
        ]
    }
    (folder / "games" / "may.json").write_text(json.dumps(schedule))


def load(spark, folder, root):
    ingest.load_trips(spark, f"{folder}/trips/{{month}}-*.csv", "2024-04-30", "2024-06-15", root)
    ingest.load_weather(spark, f"{folder}/weather", "40.73,-73.94", root)
    ingest.load_holidays(spark, f"{folder}/holidays/{{year}}.json", "2024-05-01", "2024-06-15", root)
    ingest.load_games(spark, f"{folder}/games", root)
    return {name: df.count() for name, df in ingest.raw_tables(spark, root).items()}


def test_load_is_repeatable_and_feeds_the_marts(spark, tmp_path):
    landed(tmp_path)
    root = str(tmp_path / "raw")
    counts = load(spark, tmp_path, root)
    assert counts == {"bike_trips": 336, "weather": 30, "holidays": 1, "games": 3}
    assert load(spark, tmp_path, root) == counts

    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    raw = ingest.raw_tables(spark, root)
    models = build.refresh(warehouse, raw, k=3)
    assert models["mart_demand_daily"].count() == 56
    assert {str(r.date) for r in models["stg_holidays"].collect()} == {"2024-05-27", "2024-06-09", "2024-11-03"}
    assert models["mart_holiday_impact_summary"].filter("holiday_name = 'Memorial Day'").first().baseline_days_count > 10
    assert models["mart_game_day_demand"].select("game_id").distinct().count() == 3
    assert models["mart_game_rebalancing"].count() > 0
    records = build.check_quality(raw, models, str(tmp_path / "quality"))
    status = {r.test_name: r.status for r in records.collect()}
    assert status["gx_bike_trips_validation"] == status["gx_holidays_validation"] == "pass"
