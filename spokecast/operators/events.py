"""Demand around scheduled games.

Trips are read once.  Each end of a trip at a station near a venue is counted by day, station and quarter
hour, together with the quarter hour of the trip's other end (``leg_counts``), combined before the shuffle.  Game
starts are whole hours, so windows begin and half hours change at quarter hours only, and every game, clock time
and baseline day is read from these counts; no trip meets a game or a start hour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spokecast.functions import calendar as cal
from spokecast.functions import measures as m
from spokecast.operators.staging import home_games

# Hours watched before the start and after the estimated end, hours of a game,
# least number of games behind a recommendation, longest ride in days (rounded up).
HOURS_BEFORE = 3
HOURS_AFTER = 3
GAME_HOURS = 3
MIN_GAMES = 2
MAX_RIDE_DAYS = 1

# Windows and half hours around whole hours change at these.
QUARTER_SECONDS = 900

GAME_KEYS = ("game_id", "game_date", "game_datetime", "stadium_name", "home_team_name", "away_team_name")
COUNTS = ("trips_started", "trips_ended")


def _windows(games: DataFrame) -> DataFrame:
    """Games with their watched window; it runs from 3 h before to 6 h after the start."""
    start, end = F.col("game_datetime_rounded"), F.col("estimated_end_datetime")
    return home_games(games).select(
        "game_id",
        "game_date",
        start.alias("game_datetime"),
        "stadium_name",
        *[
            (F.col(c) if c in games.columns else F.lit(None).cast("string")).alias(c)
            for c in ("home_team_name", "away_team_name")
        ],
        (start - cal.hours(HOURS_BEFORE)).alias("window_start"),
        (end + cal.hours(HOURS_AFTER)).alias("window_end"),
    )


def _quarter(at: Column, day: Column) -> Column:
    """Quarter hours from the day's midnight to ``at``, rounded down."""
    return F.floor(cal.seconds_between(day.cast("timestamp_ntz"), at) / QUARTER_SECONDS)


def _on_quarter(at: Column) -> Column:
    return (F.pmod(cal.whole_seconds(at), F.lit(QUARTER_SECONDS)) == 0) & (F.extract(F.lit("SECOND"), at) == F.second(at))


def leg_counts(trips: DataFrame, near: DataFrame | None = None, parts: tuple[str, ...] = ()) -> DataFrame:
    """Starts and ends by day of the trip, station, quarter hour, and quarter hour of the trip's other end.

    A trip gives one leg per distinct station: its start station at the start time (also counted as an end when it
    returned there), its end station at the end time.  That replaces the OR over both stations by two equality
    legs.  ``exact`` tells moments on a quarter hour from those inside it, as windows include both their ends and
    an interval takes its later edge before the anchor.  With ``near`` only legs at its stations are kept,
    before they are grouped; ``parts`` names columns of the trips to count apart.  However many trips there are, rows are bounded by days, stations and quarter hours.
    """
    start, end = F.col("start_station_id"), F.col("end_station_id")
    round_trip = start.eqNullSafe(end)

    def leg(station: Column, at: str, other: str, started: int, ended: Column) -> Column:
        day = F.col("ride_date")
        return F.struct(
            station.alias("station_id"),
            _quarter(F.col(at), day).alias("quarter"),
            _on_quarter(F.col(at)).alias("exact"),
            _quarter(F.col(other), day).alias("other_quarter"),
            _on_quarter(F.col(other)).alias("other_exact"),
            F.lit(started).alias("started"),
            ended.alias("ended"),
        )

    legs = F.array(
        leg(start, "started_at", "ended_at", 1, F.when(round_trip, 1).otherwise(0)),
        leg(F.when(~round_trip, end), "ended_at", "started_at", 0, F.lit(1)),
    )
    rows = trips.select(*parts, "ride_date", F.explode(legs).alias("leg")).select(*parts, "ride_date", "leg.*")
    rows = rows.filter("station_id is not null")
    if near is not None:
        rows = rows.join(near.select("station_id").distinct(), "station_id", "left_semi")
    return rows.groupBy(*parts, "ride_date", "station_id", "quarter", "exact", "other_quarter", "other_exact").agg(
        F.sum("started").alias("trips_started"), F.sum("ended").alias("trips_ended")
    )


def _inside(quarter: str, exact: str) -> Column:
    """Does a moment lie from 3 h before the anchor to 6 h after it, both included."""
    begin, end = F.col("anchor") - 4 * HOURS_BEFORE, F.col("anchor") + 4 * (GAME_HOURS + HOURS_AFTER)
    return (F.col(quarter) >= begin) & ((F.col(quarter) < end) | ((F.col(quarter) == end) & F.col(exact)))


def _half_hours(legs: DataFrame, *keys: str) -> DataFrame:
    """Starts and ends per key, station and signed half hour around ``anchor``, a quarter hour of the legs' day.

    A trip counts when its start or its end lies in the window (C7).  Its legs go to the nearest half hour, halves
    away from the anchor.
    """
    past = F.col("quarter") - F.col("anchor")
    before = F.when(past % 2 == 0, past).when(F.col("exact"), past - 1).otherwise(past + 1)
    offset = F.floor(F.when(past >= 0, past + 1).otherwise(before) / 2)
    counted = legs.filter(_inside("quarter", "exact") | _inside("other_quarter", "other_exact"))
    return counted.groupBy(*keys, "station_id", offset.alias("interval_offset")).agg(*[F.sum(c).alias(c) for c in COUNTS])


def _anchor(day: str) -> Column:
    return _quarter(F.col("game_datetime"), F.col(day)).alias("anchor")


def game_day_counts(legs: DataFrame, games: DataFrame) -> DataFrame:
    """Counts of the game day itself; games starting together share them."""
    windows = _windows(games)
    slots = windows.select(F.col("game_date").alias("ride_date"), "game_datetime", _anchor("game_date")).distinct()
    counts = _half_hours(legs.join(slots, "ride_date"), "game_datetime")
    return windows.select(*GAME_KEYS).join(counts, "game_datetime")


def _free_days(games: DataFrame, holidays: DataFrame) -> DataFrame:
    """Dates no baseline may use: game days and holidays."""
    return (
        home_games(games)
        .select(F.col("game_date").alias("ride_date"))
        .unionByName(holidays.select(F.col("date").alias("ride_date")))
        .distinct()
    )


def same_window_baseline(legs: DataFrame, games: DataFrame, holidays: DataFrame) -> DataFrame:
    """The mart's own baseline: other dates of the same weekday inside the game's window.

    A window lasts nine hours and a ride at most twelve, so a matching trip starts within a
    day of the window; those few candidate days replace the join on the weekday alone.  No
    candidate is another date of the same weekday, hence the baseline is empty, as in the
    mart; ``time_of_day`` is the usable form.
    """
    first = F.date_sub(F.to_date("window_start"), MAX_RIDE_DAYS)
    days = (
        _windows(games)
        .withColumn("ride_date", F.explode(F.sequence(first, F.to_date("window_end"))))
        .filter("ride_date <> game_date")
        .filter(F.dayofweek("ride_date") == F.dayofweek("game_date"))
        .join(_free_days(games, holidays), "ride_date", "left_anti")
        .select("game_id", "ride_date", _anchor("ride_date"))
    )
    daily = _half_hours(legs.join(days, "ride_date"), "game_id", "ride_date")
    # One row per day, so the rows are the observed days.
    return daily.groupBy("game_id", "station_id", "interval_offset").agg(
        *[(F.sum(c) / F.count(F.lit(1))).alias(f"avg_{c}") for c in COUNTS]
    )


def _with_same_window(legs: DataFrame, games: DataFrame, holidays: DataFrame) -> DataFrame:
    usual = same_window_baseline(legs, games, holidays)
    return game_day_counts(legs, games).join(usual, ["game_id", "station_id", "interval_offset"], "left")


def _with_time_of_day(legs: DataFrame, games: DataFrame, holidays: DataFrame) -> DataFrame:
    """Game-day counts beside the mean at the same time of day on other dates of the weekday.

    Game starts are whole hours, so the counts are read once per (day, start hour), with at most 24 start
    hours.  The mean is a window over what they give, whose partitions hold one row per date; game days then pick
    their rows.
    """
    windows = _windows(games).withColumn("hour", F.hour("game_datetime"))
    # At most 7 x 24 rows by construction, hence safe to broadcast whatever the data.
    slots = windows.select(F.dayofweek("game_date").alias("dow"), "hour", (F.col("hour") * 4).cast("bigint").alias("anchor"))
    candidates = legs.withColumn("dow", F.dayofweek("ride_date")).join(F.broadcast(slots.distinct()), "dow")
    per_day = _half_hours(candidates, "ride_date", "hour")
    taken = _free_days(games, holidays).withColumn("taken", F.lit(True))
    same = Window.partitionBy(F.dayofweek("ride_date"), "hour", "station_id", "interval_offset")
    usable = F.col("taken").isNull()
    days = F.nullif(F.count(F.when(usable, 1)).over(same), F.lit(0))
    with_mean = per_day.join(taken, "ride_date", "left").select(
        F.col("ride_date").alias("game_date"),
        "hour",
        "station_id",
        "interval_offset",
        *COUNTS,
        *[(F.sum(F.when(usable, F.col(c))).over(same) / days).alias(f"avg_{c}") for c in COUNTS],
    )
    return windows.select(*GAME_KEYS, "hour").join(with_mean, ["game_date", "hour"])


def game_day_demand(
    trips: DataFrame,
    games: DataFrame,
    proximity: DataFrame,
    holidays: DataFrame,
    baseline: str = "same_window",
) -> DataFrame:
    """Game x nearby station x half hour: counts, baseline and change.

    ``baseline`` is ``same_window`` (the mart's definition, always empty) or ``time_of_day``.
    """
    near = proximity.filter("within_1km").select("stadium_name", "station_id", "station_name")
    return demand_from_legs(leg_counts(trips, near), games, proximity, holidays, baseline)


def demand_from_legs(
    legs: DataFrame, games: DataFrame, proximity: DataFrame, holidays: DataFrame, baseline: str = "same_window"
) -> DataFrame:
    """The same from counts of legs at the near stations at least, as ``leg_counts`` gives them."""
    build = {"same_window": _with_same_window, "time_of_day": _with_time_of_day}[baseline]
    near = proximity.filter("within_1km").select("stadium_name", "station_id", "station_name")
    joined = build(legs, games, holidays).join(near, ["stadium_name", "station_id"])
    started, ended = F.col("trips_started"), F.col("trips_ended")
    avg = {c: F.coalesce(F.col(f"avg_{c}"), F.lit(0.0)) for c in COUNTS}

    def change(c: str) -> Column:
        base = F.col(f"avg_{c}")
        return F.when(base > 0, m.pct_change(F.col(c), base))

    return joined.select(
        *GAME_KEYS,
        "station_id",
        "station_name",
        "interval_offset",
        (F.col("interval_offset") * 0.5).cast("double").alias("hour_offset"),
        started.alias("trips_started_game_day"),
        ended.alias("trips_ended_game_day"),
        (ended - started).alias("net_flow_game_day"),
        avg["trips_started"].alias("trips_started_baseline"),
        avg["trips_ended"].alias("trips_ended_baseline"),
        (avg["trips_ended"] - avg["trips_started"]).alias("net_flow_baseline"),
        change("trips_started").alias("trips_started_pct_change"),
        change("trips_ended").alias("trips_ended_pct_change"),
    )


def rebalancing(demand: DataFrame, stations: DataFrame) -> DataFrame:
    """Venue x station x half hour seen in at least two games, with the move to make."""
    net = F.col("avg_net_flow")
    patterns = (
        demand.groupBy("stadium_name", "station_id", "interval_offset", "hour_offset")
        .agg(
            F.avg("trips_started_game_day").alias("avg_trips_started"),
            F.avg("trips_ended_game_day").alias("avg_trips_ended"),
            F.avg("net_flow_game_day").alias("avg_net_flow"),
            F.countDistinct("game_id").alias("num_games"),
        )
        .filter(F.col("num_games") >= MIN_GAMES)
    )
    return patterns.join(stations.select("station_id", "station_name"), "station_id", "left").select(
        "stadium_name",
        "station_id",
        "station_name",
        "interval_offset",
        "hour_offset",
        "avg_trips_started",
        "avg_trips_ended",
        "avg_net_flow",
        "num_games",
        m.station_move(net).alias("bikes_to_add_or_remove"),
        m.station_move_text(net).alias("rebalancing_recommendation"),
        m.capacity_share(net).alias("pct_capacity_adjustment"),
    )


def rebalancing_slice(plan: DataFrame, stadium_name: str, hour_offset: float) -> DataFrame:
    """One venue and time, largest move first."""
    return (
        plan.filter((F.col("stadium_name") == stadium_name) & (F.col("hour_offset") == hour_offset))
        .orderBy(F.abs("avg_net_flow").desc(), "station_id")
        .select(
            "station_name",
            "hour_offset",
            F.round("avg_net_flow", 2).alias("avg_net_flow"),
            "bikes_to_add_or_remove",
            "rebalancing_recommendation",
            F.round("avg_trips_started", 1).alias("avg_trips_started"),
            F.round("avg_trips_ended", 1).alias("avg_trips_ended"),
            "num_games",
            F.round("pct_capacity_adjustment", 1).alias("pct_capacity_adjustment"),
        )
    )


def rebalancing_extremes(plan: DataFrame) -> DataFrame:
    """Stations analysed, worst depletion and worst accumulation per venue and time."""
    return plan.groupBy("stadium_name", "hour_offset").agg(
        F.count(F.lit(1)).alias("stations_analyzed"),
        F.min("avg_net_flow").alias("max_depletion"),
        F.max("avg_net_flow").alias("max_accumulation"),
    )


def event_profile(demand: DataFrame) -> DataFrame:
    """Mean counts and baselines by time from the start, per venue."""
    return demand.groupBy("stadium_name", "hour_offset").agg(
        F.avg("trips_started_game_day").alias("avg_trips_started_game"),
        F.avg("trips_started_baseline").alias("avg_trips_started_baseline"),
        F.avg("trips_ended_game_day").alias("avg_trips_ended_game"),
        F.avg("trips_ended_baseline").alias("avg_trips_ended_baseline"),
    )


def game_list(games: DataFrame) -> DataFrame:
    """Home games with their matchup and weekday."""
    return home_games(games).select(
        "stadium_name",
        "game_id",
        "game_date",
        F.col("game_datetime_rounded").alias("game_datetime"),
        F.concat(F.col("home_team_name"), F.lit(" vs "), F.col("away_team_name")).alias("matchup"),
        cal.day_name(F.col("game_date")).alias("day_of_week"),
    )
