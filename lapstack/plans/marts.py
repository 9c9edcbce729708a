"""The ten analytics tables.

Every mart takes typed tables (or the hub) and returns one table of a fixed grain.
Dimension attributes the hub already carries are read from it, so the marts built on it
need no second join; joins that remain happen after aggregation. Sort orders end with an
id, which settles ties the original orderings leave open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapstack.functions.scalars import (
    composite_text_key,
    count_where,
    exact_avg,
    flag,
    full_name,
    surrogate_key,
)
from lapstack.operators.groups import best_per_key, distinct_list, distinct_rows, rank_with_gap, with_group_stats
from lapstack.operators.scans import GroupProfile, ordered_scan, previous, profile_groups, row_number, running_sum
from lapstack.schemas import STATUS_FINISHED
from lapstack.session import few, settle

# A lap this much slower than the one before may hold a stop; a stop this
# much slower than the one before is slow; the rank of a result without a position.
PIT_LAP_GAP_MS = 5000
SLOW_STOP_GAP_MS = 3000
UNPLACED_RANK = 999

ENTRY = ["race_id", "driver_id"]


def top(column: str):
    """Descending as PostgreSQL sorts it: NULL counts as largest."""
    return F.col(column).desc_nulls_first()


def first_result(results: DataFrame) -> DataFrame:
    """One result per race and driver: most points, then best place, then most laps."""
    place = F.coalesce(F.col("finish_position").cast("int"), F.lit(UNPLACED_RANK))
    order = [top("points"), place.asc(), top("laps_completed"), F.col("result_id").asc_nulls_last()]
    return best_per_key(results, ENTRY, order)


def stop_totals(pit_stops: DataFrame) -> DataFrame:
    return pit_stops.groupBy(*ENTRY).agg(
        F.count(F.lit(1)).alias("pit_stop_count"),
        F.sum("stop_milliseconds").cast("bigint").alias("total_pit_ms"),
        F.min("stop_milliseconds").cast("bigint").alias("best_pit_ms"),
        F.max("stop_milliseconds").cast("bigint").alias("worst_pit_ms"),
    )


def lap_totals(lap_times: DataFrame) -> DataFrame:
    return lap_times.groupBy(*ENTRY).agg(
        F.min("lap_milliseconds").cast("bigint").alias("best_lap_ms"),
        exact_avg("lap_milliseconds", 38, 6).alias("avg_lap_ms"),
        F.count(F.lit(1)).cast("int").alias("total_laps"),
    )


def _driver_columns(drivers: DataFrame, *extra: str) -> DataFrame:
    return drivers.select("driver_id", full_name("forename", "surname").alias("driver_name"), *extra)


def _race_columns(races: DataFrame) -> DataFrame:
    return races.select(
        "race_id", "circuit_id", F.col("year").alias("season"), "round", F.col("name").alias("race_name"), "race_date"
    )


def _constructor_columns(constructors: DataFrame) -> DataFrame:
    return constructors.select(
        "constructor_id",
        F.col("name").alias("constructor_name"),
        F.col("nationality").alias("constructor_nationality"),
    )


def _circuit_columns(circuits: DataFrame) -> DataFrame:
    return circuits.select(
        "circuit_id",
        F.col("name").alias("circuit_name"),
        F.col("country").alias("circuit_country"),
        F.col("location").alias("circuit_location"),
    )


def _venue_columns(races: DataFrame, circuits: DataFrame) -> DataFrame:
    """Races with their circuit: two small tables become one before a fact sees them."""
    return _race_columns(races).join(_circuit_columns(circuits), "circuit_id")


def race_results_detail(
    results: DataFrame,
    qualifying: DataFrame,
    sprints: DataFrame,
    pit_stops: DataFrame,
    lap_times: DataFrame,
    drivers: DataFrame,
    constructors: DataFrame,
    circuits: DataFrame,
    races: DataFrame,
    status: DataFrame,
) -> DataFrame:
    """The hub: one row per race and driver, with all dimensions and per-entry totals."""
    entries = first_result(results).select(
        *ENTRY,
        "constructor_id",
        "status_id",
        "grid_position",
        "finish_position",
        "points",
        "laps_completed",
        "fastest_lap_number",
        "fastest_lap_rank",
        "fastest_lap_time",
        "source",
    )
    sprint = sprints.select(
        *ENTRY,
        F.col("grid_position").alias("sprint_grid"),
        F.col("finish_position").alias("sprint_finish"),
        F.col("points").alias("sprint_points"),
    )
    driver = _driver_columns(
        drivers, F.col("nationality").alias("driver_nationality"), F.col("code").alias("driver_code"), "driver_number"
    )
    # the four joins on (race, driver) come first: they share one partitioning
    joined = (
        entries.join(qualifying.select(*ENTRY, "qualifying_position"), ENTRY, "left")
        .join(sprint, ENTRY, "left")
        .join(stop_totals(pit_stops), ENTRY, "left")
        .join(lap_totals(lap_times), ENTRY, "left")
        .join(_venue_columns(races, circuits), "race_id")
        .join(driver, "driver_id")
        .join(_constructor_columns(constructors), "constructor_id")
        .join(status.select("status_id", "status_category"), "status_id")
    )
    return joined.select(
        "race_id",
        "driver_id",
        "constructor_id",
        "status_id",
        "circuit_id",
        surrogate_key(ENTRY).alias("race_driver_key"),
        *[
            surrogate_key([f"{name}_id"]).alias(f"{name}_key")
            for name in ("driver", "constructor", "circuit", "status")
        ],
        "season",
        "round",
        "race_name",
        "race_date",
        "driver_name",
        "driver_nationality",
        "driver_code",
        "driver_number",
        "constructor_name",
        "constructor_nationality",
        "circuit_name",
        "circuit_country",
        "circuit_location",
        "grid_position",
        "finish_position",
        (F.col("grid_position") - F.col("finish_position")).alias("position_change"),
        "points",
        "laps_completed",
        "qualifying_position",
        "sprint_grid",
        "sprint_finish",
        "sprint_points",
        "pit_stop_count",
        "total_pit_ms",
        "best_pit_ms",
        "worst_pit_ms",
        "best_lap_ms",
        "avg_lap_ms",
        "total_laps",
        "status_category",
        *_outcome_flags(),
        flag(F.col("points") > 0).alias("is_points_finish"),
        "fastest_lap_number",
        "fastest_lap_rank",
        "fastest_lap_time",
        "source",
    )


def _outcome_flags():
    return [
        flag(F.col("status_category") != STATUS_FINISHED).alias("is_dnf"),
        flag(F.col("finish_position") <= 3).alias("is_podium"),
        flag(F.col("finish_position") == 1).alias("is_win"),
    ]


def championship_standings(hub: DataFrame, limit: int | None = None) -> DataFrame:
    """Points, wins and podiums after every round, with the place and the gap to the leader.

    ``limit`` stands in for the session's row limit of a group.
    """
    by_driver, by_round = ["driver_id", "season"], ["season", "round"]
    profiles = [profile_groups(hub.select(*keys), keys, limit=limit) for keys in (by_driver, by_round)]
    wide = [*ENTRY, "driver_name", F.col("constructor_name").alias("team"), "source"]
    rows = hub.select(
        *wide,
        "season",
        "round",
        (F.col("points") + F.coalesce(F.col("sprint_points"), F.lit(0))).alias("_points"),
        F.col("is_win").cast("int").alias("_win"),
        F.col("is_podium").cast("int").alias("_podium"),
    )
    # what is stored and sorted for hot groups has keys and values only; names join at the end
    hot = any(p.hot_groups for p in profiles)
    totals = ordered_scan(
        rows.drop("driver_name", "team", "source") if hot else rows,
        by_driver,
        [F.col("round").asc_nulls_last(), F.col("race_id").asc()],
        {
            "cumulative_points": running_sum("_points"),
            "wins_so_far": running_sum("_win"),
            "podiums_so_far": running_sum("_podium"),
        },
        profiles[0],
        limit,
    ).drop("_points", "_win", "_podium")
    order = [top("cumulative_points"), top("wins_so_far"), top("podiums_so_far"), F.col("driver_id").asc()]
    ranked = rank_with_gap(totals, by_round, order, "cumulative_points", limit=limit, profile=profiles[1])
    if hot:
        ranked = ranked.join(hub.select(*wide), ENTRY)
    return ranked.select(
        composite_text_key("driver_id", "race_id").alias("driver_race_key"),
        "driver_id",
        "race_id",
        "season",
        "round",
        "driver_name",
        "team",
        "cumulative_points",
        "championship_position",
        "points_behind_leader",
        "wins_so_far",
        "podiums_so_far",
        "source",
    )


def season_rollup(hub: DataFrame, entity: str, *extra) -> DataFrame:
    """Counts and sums per entity and season, the shared first level of summaries and careers.

    A season's few races are counted as a set, so rows move once; a distinct count would move them by race first.
    """
    return hub.groupBy(entity, "season").agg(
        F.size(F.collect_set("race_id")).cast("bigint").alias("races_entered"),
        count_where(F.col("is_win")).alias("wins"),
        count_where(F.col("is_podium")).alias("podiums"),
        F.sum(F.col("points") + F.coalesce(F.col("sprint_points"), F.lit(0))).alias("points"),
        F.sum("points").alias("race_points"),
        count_where(F.col("qualifying_position") == 1).alias("poles"),
        count_where(F.col("fastest_lap_rank") == 1).alias("fastest_laps"),
        count_where(F.col("is_dnf")).alias("dnfs"),
        F.max("source").alias("source"),
        *extra,
    )


def _title_order(entity: str):
    return [top("points"), top("wins"), top("podiums"), F.col(entity).asc()]


def driver_season_summary(hub: DataFrame, average: tuple[int, int] = (4, 2)) -> DataFrame:
    rollup = season_rollup(
        hub,
        "driver_id",
        F.max("driver_name").alias("driver_name"),
        F.max("constructor_name").alias("team"),
        exact_avg("finish_position", *average).alias("avg_finish_position"),
    )
    ranked = ordered_scan(
        rollup,
        ["season"],
        _title_order("driver_id"),
        {"championship_position": row_number()},
        profile=profile_groups(rollup, ["season"], within=hub),
    )
    return ranked.select(
        composite_text_key("driver_id", "season").alias("driver_id_season"),
        "driver_id",
        "season",
        "driver_name",
        "team",
        "races_entered",
        "wins",
        "podiums",
        "points",
        "poles",
        "fastest_laps",
        "dnfs",
        "avg_finish_position",
        "championship_position",
        "source",
    )


def one_two_finishes(hub: DataFrame) -> DataFrame:
    """Races in which a constructor took exactly the first two places, per season."""
    place = F.col("finish_position")
    front = hub.filter(place <= 2).groupBy("constructor_id", "season", "race_id").agg(
        F.count(F.lit(1)).alias("cars"), F.min(place).alias("best"), F.max(place).alias("worst")
    )
    doubles = front.filter((F.col("cars") == 2) & (F.col("best") == 1) & (F.col("worst") == 2))
    return doubles.groupBy("constructor_id", "season").agg(F.count(F.lit(1)).alias("one_two_finishes"))


def constructor_season_summary(hub: DataFrame) -> DataFrame:
    rollup = season_rollup(hub, "constructor_id", F.max("constructor_name").alias("constructor_name"))
    with_doubles = rollup.join(one_two_finishes(hub), ["constructor_id", "season"], "left").withColumn(
        "one_two_finishes", F.coalesce(F.col("one_two_finishes"), F.lit(0))
    )
    ranked = ordered_scan(
        with_doubles,
        ["season"],
        _title_order("constructor_id"),
        {"championship_position": row_number()},
        profile=profile_groups(rollup, ["season"], within=hub),
    )
    return ranked.select(
        composite_text_key("constructor_id", "season").alias("constructor_id_season"),
        "constructor_id",
        "season",
        "constructor_name",
        "races_entered",
        "wins",
        "podiums",
        "points",
        "one_two_finishes",
        "poles",
        "fastest_laps",
        "dnfs",
        "championship_position",
        "source",
    )


def titles(season_summary: DataFrame, entity: str) -> DataFrame:
    """Seasons led per entity; the leader of a running season counts, as in the source data."""
    champions = best_per_key(season_summary, ["season"], _title_order(entity))
    return champions.groupBy(entity).agg(F.count(F.lit(1)).alias("championships_won"))


def _career(hub: DataFrame, entity: str, other: str, other_name: str, counted: str, listed: str) -> DataFrame:
    # a race belongs to one season, so distinct races add up over seasons
    totals = season_rollup(hub, entity).groupBy(entity).agg(
        F.min("season").alias("first_season"),
        F.max("season").alias("last_season"),
        F.count(F.lit(1)).alias("seasons"),
        *[F.sum(c).alias(c) for c in ("races_entered", "wins", "podiums", "poles", "fastest_laps")],
        F.sum("race_points").alias("total_points"),
        F.sum("dnfs").alias("dnfs"),
    )
    partners = hub.select(entity, other, other_name).distinct()
    counts = partners.groupBy(entity).agg(F.count_distinct(other).alias(counted))
    return totals.join(counts, entity).join(distinct_list(partners, [entity], other_name, listed), entity)


def career_partners(hub: DataFrame, entity: str, other_name: str) -> DataFrame:
    """The names a career lists (``teams``, ``drivers``) as rows of entity, place and name, for careers of any length."""
    return distinct_rows(hub.select(entity, other_name), [entity], other_name)


def driver_career(hub: DataFrame, drivers: DataFrame, summary: DataFrame) -> DataFrame:
    career = _career(hub, "driver_id", "constructor_id", "constructor_name", "teams_raced_for", "teams")
    who = _driver_columns(drivers, F.col("code").alias("driver_code"), "nationality", "date_of_birth", "source")
    joined = career.join(who, "driver_id").join(titles(summary, "driver_id"), "driver_id", "left")
    return joined.select(
        "driver_id",
        "driver_name",
        "driver_code",
        "nationality",
        "date_of_birth",
        "first_season",
        "last_season",
        "seasons",
        "races_entered",
        "wins",
        "podiums",
        "poles",
        "fastest_laps",
        "total_points",
        "dnfs",
        "teams_raced_for",
        "teams",
        F.coalesce("championships_won", F.lit(0)).alias("championships_won"),
        "source",
    )


def constructor_career(hub: DataFrame, constructors: DataFrame, summary: DataFrame) -> DataFrame:
    career = _career(hub, "constructor_id", "driver_id", "driver_name", "drivers_raced_for", "drivers")
    who = constructors.select("constructor_id", F.col("name").alias("constructor_name"), "nationality", "source")
    joined = career.join(who, "constructor_id").join(titles(summary, "constructor_id"), "constructor_id", "left")
    return joined.select(
        "constructor_id",
        "constructor_name",
        "nationality",
        "first_season",
        "last_season",
        "seasons",
        "races_entered",
        "wins",
        "podiums",
        "poles",
        "fastest_laps",
        "total_points",
        "dnfs",
        "drivers_raced_for",
        "drivers",
        F.coalesce("championships_won", F.lit(0)).alias("championships_won"),
        "source",
    )


def circuit_stats(
    hub: DataFrame,
    circuits: DataFrame,
    qualifying: DataFrame,
    count_average: tuple[int, int] = (6, 2),
    ms_average: tuple[int, int] = (10, 2),
) -> DataFrame:
    """Totals, record holders and the latest race of every circuit."""
    # the hub is read three times: for sums, per driver and team, and per race
    totals = hub.groupBy("circuit_id").agg(
        count_where(F.col("is_win")).alias("total_wins"),
        count_where(F.col("is_podium")).alias("total_podiums"),
        count_where(F.col("is_dnf")).alias("total_dnfs"),
        exact_avg("laps_completed", *count_average).alias("avg_laps_completed"),
        exact_avg("pit_stop_count", *count_average).alias("avg_pit_stops_per_driver"),
        exact_avg("total_pit_ms", *ms_average).alias("avg_total_pit_ms"),
        F.max("source").alias("source"),
    )
    place = circuits.select(
        "circuit_id",
        F.col("name").alias("circuit_name"),
        F.col("country").alias("circuit_country"),
        F.col("location").alias("circuit_location"),
        "latitude",
        "longitude",
        "altitude",
    )
    poles = qualifying.filter(F.col("qualifying_position") == 1).groupBy(*ENTRY).agg(F.count(F.lit(1)).alias("_poles"))
    starts = hub.select("circuit_id", *ENTRY, "driver_name", "constructor_id", "is_win", "is_podium").join(poles, ENTRY, "left")
    per_team = starts.groupBy("circuit_id", "driver_id", "driver_name", "constructor_id").agg(
        count_where(F.col("is_win")).alias("wins"), count_where(F.col("is_podium")).alias("podiums"), F.sum("_poles").alias("poles")
    )
    per_driver = per_team.groupBy("circuit_id", "driver_id", "driver_name").agg(
        F.sum("wins").alias("wins"),
        F.sum("podiums").alias("podiums"),
        F.sum("poles").alias("poles"),
    )

    def holder(count: str) -> Column:
        """Of the driver with most, and of those the smallest id."""
        best = F.struct(F.col(count), -F.col("driver_id"))
        return F.max_by("driver_name", F.when(F.col(count) > 0, best))

    people = per_driver.groupBy("circuit_id").agg(
        F.count_distinct("driver_id").alias("unique_drivers"),
        holder("wins").alias("most_wins_driver"),
        holder("podiums").alias("most_podiums_driver"),
        holder("poles").alias("most_poles_driver"),
    )
    teams = per_team.groupBy("circuit_id").agg(F.count_distinct("constructor_id").alias("unique_constructors"))

    winner = F.min(F.when(F.col("is_win"), F.struct("driver_id", "driver_name")))
    per_race = hub.groupBy("circuit_id", "season", "round", "race_date", "race_id", "race_name").agg(winner.alias("winner"))
    # a NULL counts as the latest, as in ``top``
    when = [part for c in ("season", "round", "race_date") for part in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]
    races = per_race.groupBy("circuit_id").agg(
        F.count_distinct("season").alias("seasons_hosted"),
        F.count_distinct("race_id").alias("races_hosted"),
        F.min("season").alias("first_season"),
        F.max("season").alias("last_season"),
        F.max_by(F.struct("season", "race_name", "race_date"), F.struct(*when, -F.col("race_id"))).alias("latest"),
        F.max_by("winner.driver_name", F.when(F.col("winner").isNotNull(), F.struct(*when, -F.col("winner.driver_id")))).alias(
            "latest_winner"
        ),
    )
    races = races.select(
        "*",
        F.col("latest.season").alias("latest_season"),
        F.col("latest.race_name").alias("latest_race_name"),
        F.col("latest.race_date").alias("latest_race_date"),
    ).drop("latest")
    joined = totals.join(place, "circuit_id")
    for part in (races, people, teams):
        joined = joined.join(part, "circuit_id", "left")
    return joined.select(
        "circuit_id",
        "circuit_name",
        "circuit_country",
        "circuit_location",
        "latitude",
        "longitude",
        "altitude",
        "seasons_hosted",
        "races_hosted",
        "first_season",
        "last_season",
        "unique_drivers",
        "unique_constructors",
        "total_wins",
        "total_podiums",
        "total_dnfs",
        "avg_laps_completed",
        "avg_pit_stops_per_driver",
        "avg_total_pit_ms",
        "most_wins_driver",
        "most_podiums_driver",
        "most_poles_driver",
        "latest_season",
        "latest_race_name",
        "latest_race_date",
        "latest_winner",
        "source",
    )


def qualifying_vs_race(
    qualifying: DataFrame,
    results: DataFrame,
    drivers: DataFrame,
    constructors: DataFrame,
    races: DataFrame,
    status: DataFrame,
) -> DataFrame:
    """Qualifying against the race, on all results: a shared drive gives two rows."""
    raced = results.select(
        *ENTRY, "grid_position", "finish_position", "points", "laps_completed", "status_id", "fastest_lap_rank"
    )
    driver = _driver_columns(
        drivers, F.col("nationality").alias("driver_nationality"), F.col("code").alias("driver_code")
    )
    joined = (
        qualifying.select(
            *ENTRY, "constructor_id", "qualifying_position", "q1_time", "q2_time", "q3_time", "source"
        )
        .join(raced, ENTRY)
        .join(driver, "driver_id")
        .join(_constructor_columns(constructors), "constructor_id")
        .join(_race_columns(races), "race_id")
        .join(status.select("status_id", "status_category"), "status_id")
    )
    is_dnf, is_podium, is_win = _outcome_flags()
    return joined.select(
        surrogate_key(ENTRY).alias("quali_race_key"),
        "race_id",
        "driver_id",
        "constructor_id",
        "qualifying_position",
        "grid_position",
        "finish_position",
        (F.col("grid_position") - F.col("finish_position")).alias("positions_gained_lost"),
        "points",
        "laps_completed",
        "status_category",
        is_dnf,
        "q1_time",
        "q2_time",
        "q3_time",
        "fastest_lap_rank",
        flag(F.col("qualifying_position") == 1).alias("is_pole"),
        is_win,
        is_podium,
        "driver_name",
        "driver_nationality",
        "driver_code",
        "constructor_name",
        "constructor_nationality",
        "season",
        "round",
        "race_name",
        "race_date",
        "source",
    )


def _with_results(facts: DataFrame, results: DataFrame) -> DataFrame:
    """Facts once per result of their entry, by keys alone: what dimension joins can only shrink."""
    return facts.select(*ENTRY).join(results.select(*ENTRY), ENTRY)


def _entry_keys(results: DataFrame, parents: list[tuple[DataFrame, str]]) -> DataFrame:
    """The keys of results whose race, driver and so on are known."""
    keys = results.select(*ENTRY, "result_id", "constructor_id")
    for parent, key in parents:
        keys = keys.join(parent.select(key), key, "left_semi")
    return keys.select(*ENTRY, "result_id")


def _with_entry(rows: DataFrame, entry: DataFrame, profile: GroupProfile) -> DataFrame:
    """Rows with the dimensions of their result.

    Without hot entries the result is compared beside the join, on whose keys the rows lie together already: as a key of
    the join it would have every row moved once more.
    """
    if profile.hot_groups:
        return rows.join(entry, [*ENTRY, "result_id"])
    own, other = F.col("result_id"), F.col("_result")
    return rows.join(entry.withColumnRenamed("result_id", "_result"), ENTRY).filter((own <= other) & (own >= other)).drop("_result")


def _with_totals(rows: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Totals of an entry on each of its rows, where no entry has more rows than a task may hold."""
    window = Window.partitionBy(*ENTRY)
    return rows.withColumns({name: total.over(window) for name, total in totals.items()})


def lap_time_analysis(
    lap_times: DataFrame,
    races: DataFrame,
    drivers: DataFrame,
    results: DataFrame,
    circuits: DataFrame,
    constructors: DataFrame,
) -> DataFrame:
    """Every lap against the best of its race, the best of its lap number, and the lap before."""
    # statistics and scans see keys and times only; the dimensions hang on the entry and join once, last
    venues, known_drivers = _venue_columns(races, circuits), _driver_columns(drivers, F.col("code").alias("driver_code"))
    entry = (
        results.select(*ENTRY, "result_id", "constructor_id")
        .join(venues, "race_id")
        .join(known_drivers, "driver_id")
        .join(_constructor_columns(constructors), "constructor_id", "left")
        .drop("constructor_id")
    )
    keys = _entry_keys(results, [(venues, "race_id"), (known_drivers, "driver_id")])
    timed = lap_times.select(
        *ENTRY, "lap_number", "lap_position", "lap_time", F.col("lap_milliseconds").alias("lap_ms"), "source"
    )
    laps = timed.join(keys, ENTRY)

    # statistics per lap number first; the race's best lap follows from those few rows
    per_lap = laps.groupBy("race_id", "lap_number").agg(
        F.min("lap_ms").alias("leader_lap_ms"),
        exact_avg("lap_ms", 38, 6).alias("lap_avg_ms"),
        F.count(F.lit(1)).alias("drivers_on_lap"),
    )

    profile = profile_groups(laps, ENTRY, within=_with_results(lap_times, results))
    by_number = [F.col(c).asc_nulls_last() for c in ("lap_number", "lap_ms", "result_id")]
    by_time = [F.col(c).asc_nulls_last() for c in ("lap_ms", "lap_number", "result_id")]
    scanned = ordered_scan(laps, ENTRY, by_number, {"lap_seq": row_number(), "_before": previous("lap_ms")}, profile)
    scanned = ordered_scan(scanned, ENTRY, by_time, {"driver_lap_rank": row_number()}, profile)
    # a few rows for each race: stored and counted, the laps do not move to them
    per_lap = settle(per_lap)
    per_race = per_lap.groupBy("race_id").agg(F.min("leader_lap_ms").alias("race_best_lap_ms"))
    timed_laps = scanned.join(few(settle(per_lap.join(per_race, "race_id"))), ["race_id", "lap_number"])
    joined = _with_entry(timed_laps, entry, profile)
    lap = F.col("lap_ms")
    return joined.select(
        surrogate_key([*ENTRY, "lap_number"]).alias("lap_analysis_key"),
        "race_id",
        "driver_id",
        "lap_number",
        "lap_position",
        "lap_time",
        "lap_ms",
        (lap - F.col("leader_lap_ms")).alias("delta_to_leader_ms"),
        (lap - F.col("race_best_lap_ms")).alias("delta_to_race_best_ms"),
        flag(lap == F.col("race_best_lap_ms")).alias("is_race_fastest_lap"),
        flag(lap == F.col("leader_lap_ms")).alias("is_lap_fastest"),
        (lap - F.col("lap_avg_ms")).cast("decimal(28,6)").alias("delta_to_lap_avg_ms"),
        "drivers_on_lap",
        "lap_seq",
        "driver_lap_rank",
        flag(lap - F.col("_before") > PIT_LAP_GAP_MS).cast("int").alias("potential_pit_lap"),
        "season",
        "round",
        "race_name",
        "race_date",
        "circuit_id",
        "circuit_name",
        "circuit_country",
        "driver_name",
        "driver_code",
        "constructor_name",
        "constructor_nationality",
        "source",
    )


def pit_stop_analysis(
    pit_stops: DataFrame,
    races: DataFrame,
    drivers: DataFrame,
    results: DataFrame,
    constructors: DataFrame,
    circuits: DataFrame,
) -> DataFrame:
    """Every stop against the others of its number, and against the driver's stop before."""
    # as for laps: keys and times are counted and scanned, the dimensions join last
    venues, known_drivers = _venue_columns(races, circuits), _driver_columns(drivers, F.col("code").alias("driver_code"))
    teams = _constructor_columns(constructors)
    entry = (
        results.select(*ENTRY, "result_id", "constructor_id", "grid_position", "finish_position")
        .join(venues, "race_id")
        .join(known_drivers, "driver_id")
        .join(teams, "constructor_id")
        .drop("constructor_id")
    )
    keys = _entry_keys(results, [(venues, "race_id"), (known_drivers, "driver_id"), (teams, "constructor_id")])
    timed = pit_stops.select(
        *ENTRY, "stop_number", "lap_number", "stop_time", "stop_duration", F.col("stop_milliseconds").alias("stop_ms"), "source"
    )
    stops = timed.join(keys, ENTRY)
    per_stop = stops.groupBy("race_id", "stop_number").agg(
        exact_avg("stop_ms", 38, 6).alias("_avg"), F.min("stop_ms").alias("_best"), F.max("stop_ms").alias("_worst")
    )
    # the scan's own partitioning serves the entry's totals, so no third pass over the stops is made
    totals = {"total_pit_ms": F.sum("stop_ms"), "total_stops": F.count(F.lit(1))}
    order = [F.col(c).asc_nulls_last() for c in ("stop_number", "stop_ms", "result_id")]
    profile = profile_groups(stops, ENTRY, within=_with_results(pit_stops, results))
    scanned = ordered_scan(stops, ENTRY, order, {"stop_seq": row_number(), "_before": previous("stop_ms")}, profile)
    counted = with_group_stats(scanned, ENTRY, totals, nulls=False) if profile.hot_groups else _with_totals(scanned, totals)
    joined = _with_entry(counted.join(few(settle(per_stop)), ["race_id", "stop_number"]), entry, profile)
    stop = F.col("stop_ms")
    return joined.select(
        surrogate_key([*ENTRY, "stop_number"]).alias("pit_analysis_key"),
        "race_id",
        "driver_id",
        "stop_number",
        "lap_number",
        "stop_time",
        "stop_duration",
        "stop_ms",
        (stop - F.col("_avg")).cast("decimal(28,6)").alias("delta_to_avg_stop_ms"),
        flag(stop == F.col("_best")).alias("is_fastest_stop_in_race"),
        flag(stop == F.col("_worst")).alias("is_slowest_stop_in_race"),
        "total_pit_ms",
        "total_stops",
        "stop_seq",
        (stop - F.coalesce(F.col("_before"), F.lit(0))).alias("stop_delta_from_prev"),
        flag(stop - F.col("_before") > SLOW_STOP_GAP_MS).alias("is_slow_stop"),
        "season",
        "round",
        "race_name",
        "race_date",
        "circuit_name",
        "circuit_country",
        "driver_name",
        "driver_code",
        "constructor_name",
        "constructor_nationality",
        "grid_position",
        "finish_position",
        "source",
    )
