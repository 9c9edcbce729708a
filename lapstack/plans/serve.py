"""Parameterised queries over the marts and the roll-ups of the report pages.

Parameters are plain values; only the result leaves the cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapstack.functions.scalars import count_where, display_text, exact_avg, finish_band
from lapstack.operators.groups import five_numbers, pivot_matrix

# Career metrics a leaderboard can be ranked by.
CAREER_METRICS = ["wins", "podiums", "poles", "fastest_laps", "total_points", "championships_won", "dnfs"]


def plain(value):
    """A numpy scalar as the Python value Spark takes as a literal."""
    return value.item() if hasattr(value, "item") else value


def where_equal(df: DataFrame, **params) -> DataFrame:
    for name, value in params.items():
        df = df.filter(F.col(name) == F.lit(plain(value)))
    return df


def _asc(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def seasons(standings: DataFrame) -> DataFrame:
    return standings.select("season").distinct().orderBy(*_asc("season"))


def standings_of(standings: DataFrame, season) -> DataFrame:
    return where_equal(standings, season=season).orderBy(*_asc("round", "championship_position"))


def summary_of(summary: DataFrame, season) -> DataFrame:
    """Driver or constructor standings of a season."""
    return where_equal(summary, season=season).orderBy(*_asc("championship_position"))


def results_of(hub: DataFrame, season) -> DataFrame:
    return where_equal(hub, season=season).orderBy(*_asc("round", "finish_position", "driver_id"))


def qualifying_of(qualifying: DataFrame, season) -> DataFrame:
    return where_equal(qualifying, season=season).orderBy(*_asc("round", "finish_position", "driver_id"))


def season_race_summary(hub: DataFrame, season) -> DataFrame:
    """Winner, winning team, classified drivers and retirements of every race."""
    won = F.col("is_win")
    return (
        where_equal(hub, season=season)
        .groupBy("race_id", "round", "race_name", "race_date")
        .agg(
            F.max(F.when(won, F.col("driver_name"))).alias("winner"),
            F.max(F.when(won, F.col("constructor_name"))).alias("winning_team"),
            F.count_distinct("driver_id").alias("classified_drivers"),
            count_where(F.col("is_dnf")).alias("dnfs"),
        )
        .orderBy(*_asc("round", "race_id"))
    )


def constructors_of(hub: DataFrame, season=None) -> DataFrame:
    rows = where_equal(hub, season=season) if season else hub
    return rows.select("constructor_name").distinct().orderBy(*_asc("constructor_name"))


def career_table(career: DataFrame, entity: str) -> DataFrame:
    return career.orderBy(F.col("total_points").desc_nulls_first(), F.col(entity).asc())


def circuit_table(stats: DataFrame) -> DataFrame:
    return stats.orderBy(F.col("races_hosted").desc_nulls_first(), *_asc("circuit_name"))


def races_with_detail(analysis: DataFrame, season) -> DataFrame:
    """Races of a season that have lap (or stop) data."""
    return (
        where_equal(analysis, season=season)
        .select("race_id", "round", "race_name", "circuit_name", "race_date")
        .distinct()
        .orderBy(*_asc("round", "race_id"))
    )


def of_race(df: DataFrame, race_id, season=None) -> DataFrame:
    """Rows of one race; the race's season, where the caller knows it, leaves one partition to read."""
    return where_equal(df, race_id=race_id) if season is None else where_equal(df, season=season, race_id=race_id)


def laps_of(laps: DataFrame, race_id, season=None) -> DataFrame:
    return of_race(laps, race_id, season).orderBy(*_asc("lap_number", "driver_name"))


def stops_of(stops: DataFrame, race_id, season=None) -> DataFrame:
    return of_race(stops, race_id, season).orderBy(*_asc("stop_number", "constructor_name", "driver_name"))


def season_overview(drivers: DataFrame, constructors: DataFrame, races: DataFrame, season) -> DataFrame:
    """One row: championship leaders, races completed, latest race and its winner."""
    driver = where_equal(drivers, season=season).agg(
        F.min_by("driver_name", "championship_position").alias("driver_leader"),
        F.min_by("points", "championship_position").alias("leader_points"),
    )
    constructor = where_equal(constructors, season=season).agg(
        F.min_by("constructor_name", "championship_position").alias("constructor_leader")
    )
    last = F.struct("round", "race_id")
    race = races.agg(
        F.count(F.lit(1)).alias("races_completed"),
        F.max_by("race_name", last).alias("latest_race"),
        F.max_by("winner", last).alias("latest_winner"),
    )
    # three one-row frames under each other; each column has one value to keep
    stacked = driver.unionByName(constructor, allowMissingColumns=True).unionByName(race, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def leaders(summary: DataFrame, season, n: int = 10) -> DataFrame:
    return where_equal(summary, season=season).orderBy(*_asc("championship_position")).limit(n)


def team_progression(standings: DataFrame, season) -> DataFrame:
    """Sum of the cumulative points of a team's current drivers, round by round."""
    return where_equal(standings, season=season).groupBy("round", "team").agg(
        F.sum("cumulative_points").alias("cumulative_points")
    )


def top_teams(progression: DataFrame, n: int = 5) -> DataFrame:
    return (
        progression.groupBy("team")
        .agg(F.max("cumulative_points").alias("best_points"))
        .orderBy(F.col("best_points").desc_nulls_last(), *_asc("team"))
        .limit(n)
    )


def progression_of_top_drivers(standings: DataFrame, season, places: int = 5) -> DataFrame:
    """All rounds of the drivers who were ever among the first places."""
    rows = where_equal(standings, season=season)
    ever = rows.filter(F.col("championship_position") <= places).select("driver_id").distinct()
    return rows.join(ever, "driver_id", "left_semi")


def results_matrix(hub: DataFrame, season, rounds) -> DataFrame:
    """Drivers by rounds with the finishing position, drivers ordered by points."""
    rows = where_equal(hub, season=season)
    points = rows.groupBy("driver_id").agg(F.sum("points").alias("points"))
    matrix = pivot_matrix(rows, ["driver_id", "driver_name"], "round", rounds, "finish_position", "r")
    return matrix.join(points, "driver_id").orderBy(F.col("points").desc_nulls_last(), *_asc("driver_id"))


def results_cells(hub: DataFrame, season) -> DataFrame:
    """The matrix in long form, with the shown text and the band of each cell."""
    return where_equal(hub, season=season).select(
        "driver_id",
        "driver_name",
        "round",
        "race_name",
        "finish_position",
        display_text("finish_position", "DNF").alias("label"),
        finish_band("finish_position").alias("band"),
    )


def race_by_race(hub: DataFrame, season) -> DataFrame:
    """First in finishing order, finishers and retirements of every race."""
    rows = where_equal(hub, season=season)
    order = F.struct(F.coalesce(F.col("finish_position").cast("bigint"), F.lit((1 << 62))), F.col("driver_id"))
    return (
        rows.groupBy("race_name", "round")
        .agg(
            F.min_by("driver_name", order).alias("winner"),
            F.count("finish_position").alias("total_finishers"),
            count_where(F.col("is_dnf")).alias("total_dnfs"),
        )
        .orderBy(*_asc("round", "race_name"))
    )


def pole_conversion(qualifying: DataFrame, season) -> DataFrame:
    rows = where_equal(qualifying, season=season).agg(
        count_where(F.col("is_pole")).alias("poles"),
        count_where(F.col("is_pole") & F.col("is_win")).alias("pole_wins"),
    )
    rate = F.when(F.col("poles") > 0, F.col("pole_wins") / F.col("poles") * 100).otherwise(F.lit(0.0))
    return rows.withColumn("conversion_rate", rate)


def driver_qualifying(qualifying: DataFrame, season) -> DataFrame:
    place, gain = F.col("qualifying_position"), F.col("positions_gained_lost")
    return (
        where_equal(qualifying, season=season)
        .groupBy("driver_name", "constructor_name")
        .agg(
            F.bround(F.avg(place), 1).alias("avg_quali"),
            F.bround(F.avg("finish_position"), 1).alias("avg_finish"),
            count_where(F.col("is_pole")).alias("poles"),
            count_where(place <= 3).alias("top3"),
            F.count("race_name").alias("races"),
            F.bround(F.avg(gain), 1).alias("avg_positions_gained"),
        )
        .orderBy(*_asc("avg_quali", "driver_name", "constructor_name"))
    )


def gain_histogram(qualifying: DataFrame, season) -> DataFrame:
    return (
        where_equal(qualifying, season=season)
        .groupBy("constructor_name", "positions_gained_lost")
        .agg(F.count(F.lit(1)).alias("entries"))
    )


HEAD_TO_HEAD = ["points", "wins", "podiums", "poles", "dnfs", "avg_finish"]


def driver_record(hub: DataFrame) -> DataFrame:
    """The six compared statistics per driver, team and season; no finish averages to 0."""
    return hub.groupBy("season", "constructor_name", "driver_name").agg(
        F.sum("points").alias("points"),
        count_where(F.col("is_win")).alias("wins"),
        count_where(F.col("is_podium")).alias("podiums"),
        count_where(F.col("qualifying_position") == 1).alias("poles"),
        count_where(F.col("is_dnf")).alias("dnfs"),
        F.coalesce(exact_avg("finish_position", 20, 4), F.lit(0).cast("decimal(20,4)")).alias("avg_finish"),
    )


def compare_pairs(records: DataFrame, pairs: DataFrame) -> DataFrame:
    """Statistics of named team-mates side by side.

    ``pairs`` holds ``season, constructor_name, first_driver, second_driver``: the caller
    names the pairs wanted, so a large team never expands into all its pairs.
    """
    def side(which: str) -> DataFrame:
        return records.select(
            "season",
            "constructor_name",
            F.col("driver_name").alias(f"{which}_driver"),
            *[F.col(c).alias(f"{which}_{c}") for c in HEAD_TO_HEAD],
        )

    group = ["season", "constructor_name"]
    return (
        pairs.filter(F.col("first_driver") < F.col("second_driver"))
        .join(side("first"), [*group, "first_driver"])
        .join(side("second"), [*group, "second_driver"])
    )


def head_to_head(hub: DataFrame, season, team: str, first: str, second: str) -> DataFrame:
    """One selected pair of team-mates."""
    rows = where_equal(hub, season=season, constructor_name=team).filter(F.col("driver_name").isin(first, second))
    pair = rows.sparkSession.createDataFrame(
        [(int(plain(season)), team, min(first, second), max(first, second))],
        "season int, constructor_name string, first_driver string, second_driver string",
    )
    return compare_pairs(driver_record(rows), pair)


def career_leaders(career: DataFrame, metric: str, entity: str, n: int = 15) -> DataFrame:
    if metric not in CAREER_METRICS:
        raise ValueError(f"unknown metric {metric}")
    return career.orderBy(F.col(metric).desc_nulls_last(), F.col(entity).asc()).limit(n)


def race_pace(laps: DataFrame, race_id, season=None) -> DataFrame:
    return (
        of_race(laps, race_id, season)
        .groupBy("driver_name", "constructor_name")
        .agg(
            exact_avg("delta_to_race_best_ms", 20, 4).alias("avg_delta_ms"), F.count("lap_number").alias("laps")
        )
        .orderBy(*_asc("avg_delta_ms", "driver_name", "constructor_name"))
    )


def most_laps(laps: DataFrame, race_id, n: int = 6, season=None) -> DataFrame:
    counts = of_race(laps, race_id, season).groupBy("driver_name").agg(F.count("lap_number").alias("laps"))
    return counts.orderBy(F.col("laps").desc(), *_asc("driver_name")).limit(n)


def lap_cards(laps: DataFrame, race_id, season=None) -> DataFrame:
    """Fastest lap, who drove it, and the average, in seconds."""
    rows = of_race(laps, race_id, season)
    order = F.struct("lap_ms", "driver_id", "lap_number")
    return rows.agg(
        (F.min("lap_ms") / 1000).alias("fastest_seconds"),
        F.min_by("driver_name", F.when(F.col("lap_ms").isNotNull(), order)).alias("fastest_driver"),
        (exact_avg("lap_ms", 20, 4).cast("double") / 1000).alias("average_seconds"),
    )


def stop_cards(stops: DataFrame, race_id, season=None) -> DataFrame:
    return of_race(stops, race_id, season).agg(
        F.count(F.lit(1)).alias("total_stops"),
        (exact_avg("stop_ms", 20, 4).cast("double") / 1000).alias("average_seconds"),
        (F.min("stop_ms") / 1000).alias("fastest_seconds"),
        (F.max("stop_ms") / 1000).alias("slowest_seconds"),
    )


def slowest_stops(stops: DataFrame, race_id, n: int = 20, season=None) -> DataFrame:
    rows = of_race(stops, race_id, season)
    order = [F.col("stop_ms").desc_nulls_last(), *_asc("driver_id", "stop_number")]
    return rows.orderBy(*order).limit(n).withColumn("duration_seconds", F.col("stop_ms") / 1000)


def stop_distribution(stops: DataFrame, race_id, season=None) -> DataFrame:
    """Five-number summary of stop times per team, in milliseconds."""
    return five_numbers(of_race(stops, race_id, season), ["constructor_name"], "stop_ms")
