"""SQL views over the star tables, the yardstick for the Spark views in ``plans.star``."""

from __future__ import annotations

from collections.abc import Sequence

LINE_ORDER = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)


def half_up(total: str, n: str, digits: int) -> str:
    """``total / n`` of non-negative whole numbers, rounded half up, as an exact decimal."""
    scale = 10**digits
    step = "0." + "0" * (digits - 1) + "1"
    quotient = f"(({2 * scale} * CAST({total} AS HUGEINT) + {n}) // (2 * {n}))"
    return f"(CASE WHEN {n} > 0 THEN CAST({quotient} AS DECIMAL(30,0)) * CAST({step} AS DECIMAL({digits + 1},{digits})) END)"


def half_up_avg(column: str, digits: int) -> str:
    return half_up(f"sum({column})", f"count({column})", digits)


def key_of(*columns: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), '_dbt_utils_surrogate_key_null_')" for c in columns]
    return "md5(" + " || '-' || ".join(parts) + ")"


VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "entry_base": ((), """
        SELECT o_custkey AS driver_id, year(o_orderdate) AS season, month(o_orderdate) AS round,
               sum(CAST(o_totalprice AS DECIMAL(18,2))) AS points, min(o_orderkey) AS first_order,
               max(o_orderstatus) AS last_status, count(*) AS laps_completed
        FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2, 3"""),
    "entry_placed": (("entry_base",), """
        SELECT *, season * 100 + round AS race_id,
               row_number() OVER (PARTITION BY season, round ORDER BY first_order) AS grid_position,
               row_number() OVER (PARTITION BY season, round ORDER BY points DESC, driver_id) AS place
        FROM entry_base"""),
    "entries": (("entry_placed",), """
        SELECT race_id, driver_id, season, round, round % 5 AS circuit_id,
               (driver_id + season) // 10 AS constructor_id,
               CASE last_status WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS status_id,
               grid_position,
               CASE WHEN last_status = 'P' AND grid_position % 2 = 0 THEN NULL ELSE place END AS finish_position,
               points, laps_completed, first_order,
               CASE WHEN season < 2000 THEN 'historical' ELSE 'api' END AS source
        FROM entry_placed"""),
    "results": (("entries",), """
        SELECT (race_id * 1000000000000 + driver_id) * 2 + second AS result_id, race_id, driver_id, constructor_id,
               status_id, grid_position, CASE WHEN second = 0 THEN finish_position END AS finish_position,
               points - second AS points, CASE WHEN second = 0 THEN laps_completed ELSE 0 END AS laps_completed,
               round AS fastest_lap_number, driver_id % 20 + 1 AS fastest_lap_rank,
               '1:' || lpad(CAST(driver_id % 60 AS VARCHAR), 2, '0') || '.000' AS fastest_lap_time, source
        FROM entries, (VALUES (0), (1)) s(second) WHERE second = 0 OR driver_id % 7 = 0"""),
    "quali": (("entries",), """
        SELECT race_id * 1000000000000 + driver_id AS qualify_id, race_id, driver_id, constructor_id,
               grid_position AS qualifying_position,
               '1:1' || CAST(driver_id % 10 AS VARCHAR) || '.5' AS q1_time,
               CAST(NULL AS VARCHAR) AS q2_time, CAST(NULL AS VARCHAR) AS q3_time, source
        FROM entries WHERE driver_id % 5 <> 0"""),
    "sprints": (("entries",), """
        SELECT race_id * 1000000000000 + driver_id AS sprint_result_id, race_id, driver_id, constructor_id, status_id,
               grid_position, finish_position, CAST(driver_id % 9 AS DECIMAL(18,2)) AS points, source
        FROM entries WHERE round IN (4, 8, 12)"""),
    "lap_lines": ((), f"""
        SELECT year(o_orderdate) * 100 + month(o_orderdate) AS race_id, o_custkey AS driver_id,
               row_number() OVER (PARTITION BY year(o_orderdate), month(o_orderdate), o_custkey
                                  ORDER BY {LINE_ORDER}) AS lap_number,
               l_linenumber AS lap_position, CAST(round(l_extendedprice * 100) AS BIGINT) AS lap_milliseconds,
               l_returnflag, l_linestatus, l_linenumber, CAST(round(l_quantity * 1000) AS BIGINT) AS quantity_ms,
               strftime(l_shipdate, '%Y-%m-%d') AS ship_day,
               CASE WHEN year(o_orderdate) < 2000 THEN 'historical' ELSE 'api' END AS source
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey"""),
    "laps": (("lap_lines",), """
        SELECT race_id, driver_id, lap_number, lap_position, CAST(lap_milliseconds AS VARCHAR) AS lap_time,
               lap_milliseconds, source FROM lap_lines"""),
    "pits": (("lap_lines",), """
        SELECT race_id, driver_id,
               row_number() OVER (PARTITION BY race_id, driver_id ORDER BY lap_number) AS stop_number,
               lap_number, ship_day AS stop_time, CAST(quantity_ms AS VARCHAR) AS stop_duration,
               CASE WHEN l_linestatus = 'O' AND l_linenumber = 7 THEN NULL ELSE quantity_ms END AS stop_milliseconds,
               source
        FROM lap_lines WHERE l_returnflag = 'R'"""),
    "drivers": ((), """
        SELECT c_custkey AS driver_id, lower(c_name) AS driver_ref, c_custkey % 100 AS driver_number,
               upper(substr(c_mktsegment, 1, 3)) AS code, c_mktsegment AS forename, c_name AS surname,
               c_mktsegment || ' ' || c_name AS driver_name,
               CAST(DATE '1960-01-01' + CAST(c_custkey % 10000 AS INTEGER) AS DATE) AS date_of_birth,
               n_name AS nationality, CASE WHEN c_custkey % 2 = 0 THEN 'historical' ELSE 'api' END AS source
        FROM customer JOIN nation ON n_nationkey = c_nationkey"""),
    "teams": (("entries",), """
        SELECT constructor_id, 'team ' || constructor_id AS constructor_ref, 'Team ' || constructor_id AS name,
               n_name AS nationality, 'historical' AS source
        FROM (SELECT DISTINCT constructor_id FROM entries) e JOIN nation ON n_nationkey = constructor_id % 25"""),
    "circuits": ((), """
        SELECT CAST(r_regionkey AS BIGINT) AS circuit_id, lower(r_name) AS circuit_ref, 'Ring ' || r_name AS name,
               'Place ' || r_regionkey AS location, r_name AS country, r_regionkey * 1.5 AS latitude,
               r_regionkey * -2.5 AS longitude, r_regionkey * 100 AS altitude FROM region"""),
    "races": ((), """
        SELECT DISTINCT year(o_orderdate) * 100 + month(o_orderdate) AS race_id, year(o_orderdate) AS year,
               month(o_orderdate) AS round, month(o_orderdate) % 5 AS circuit_id,
               'Race ' || (year(o_orderdate) * 100 + month(o_orderdate)) AS name,
               strftime(o_orderdate, '%Y-%m') || '-01' AS race_date,
               CASE WHEN year(o_orderdate) < 2000 THEN 'historical' ELSE 'api' END AS source
        FROM orders"""),
    "status": ((), """
        SELECT DISTINCT CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS status_id,
               CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN '+1 Lap' ELSE 'Engine fire' END AS status,
               CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Other' ELSE 'Engine' END AS status_category
        FROM orders"""),
    "best_results": (("results",), """
        SELECT * FROM results QUALIFY row_number() OVER (
            PARTITION BY race_id, driver_id
            ORDER BY points DESC NULLS FIRST, coalesce(finish_position, 999), laps_completed DESC NULLS FIRST,
                     result_id) = 1"""),
    "stop_sums": (("pits",), """
        SELECT race_id, driver_id, count(*) AS pit_stop_count, sum(stop_milliseconds) AS total_pit_ms,
               min(stop_milliseconds) AS best_pit_ms, max(stop_milliseconds) AS worst_pit_ms
        FROM pits GROUP BY ALL"""),
    "lap_sums": (("laps",), f"""
        SELECT race_id, driver_id, min(lap_milliseconds) AS best_lap_ms,
               {half_up_avg("lap_milliseconds", 6)} AS avg_lap_ms, count(*) AS total_laps
        FROM laps GROUP BY ALL"""),
    "hub": (
        (
            "best_results", "quali", "sprints", "stop_sums", "lap_sums", "drivers", "teams", "circuits", "races",
            "status",
        ),
        f"""
        SELECT b.race_id, b.driver_id, b.constructor_id, b.status_id, r.circuit_id,
               {key_of("b.race_id", "b.driver_id")} AS race_driver_key, {key_of("b.driver_id")} AS driver_key,
               {key_of("b.constructor_id")} AS constructor_key, {key_of("r.circuit_id")} AS circuit_key,
               {key_of("b.status_id")} AS status_key,
               r.year AS season, r.round, r.name AS race_name, r.race_date, d.driver_name,
               d.nationality AS driver_nationality, d.code AS driver_code, d.driver_number,
               t.name AS constructor_name, t.nationality AS constructor_nationality, c.name AS circuit_name,
               c.country AS circuit_country, c.location AS circuit_location, b.grid_position, b.finish_position,
               b.grid_position - b.finish_position AS position_change, b.points, b.laps_completed,
               q.qualifying_position, s.grid_position AS sprint_grid, s.finish_position AS sprint_finish,
               s.points AS sprint_points, p.pit_stop_count, p.total_pit_ms, p.best_pit_ms, p.worst_pit_ms,
               l.best_lap_ms, l.avg_lap_ms, l.total_laps, x.status_category,
               coalesce(x.status_category <> 'Finished', false) AS is_dnf,
               coalesce(b.points > 0, false) AS is_points_finish,
               coalesce(b.finish_position <= 3, false) AS is_podium,
               coalesce(b.finish_position = 1, false) AS is_win,
               b.fastest_lap_number, b.fastest_lap_rank, b.fastest_lap_time, b.source
        FROM best_results b JOIN races r USING (race_id) JOIN drivers d USING (driver_id)
        JOIN teams t USING (constructor_id) JOIN circuits c ON c.circuit_id = r.circuit_id
        JOIN status x USING (status_id)
        LEFT JOIN quali q ON q.race_id = b.race_id AND q.driver_id = b.driver_id
        LEFT JOIN sprints s ON s.race_id = b.race_id AND s.driver_id = b.driver_id
        LEFT JOIN stop_sums p ON p.race_id = b.race_id AND p.driver_id = b.driver_id
        LEFT JOIN lap_sums l ON l.race_id = b.race_id AND l.driver_id = b.driver_id""",
    ),
    "running": (("hub",), """
        SELECT driver_id, race_id, season, round, driver_name, constructor_name AS team, source,
               sum(points + coalesce(sprint_points, 0)) OVER w AS cumulative_points,
               sum(CAST(is_win AS INTEGER)) OVER w AS wins_so_far,
               sum(CAST(is_podium AS INTEGER)) OVER w AS podiums_so_far
        FROM hub WINDOW w AS (PARTITION BY driver_id, season ORDER BY round, race_id ROWS UNBOUNDED PRECEDING)"""),
    "standings": (("running",), """
        SELECT *, driver_id || '_' || race_id AS driver_race_key, row_number() OVER v AS championship_position,
               first_value(cumulative_points) OVER v - cumulative_points AS points_behind_leader
        FROM running WINDOW v AS (PARTITION BY season, round
            ORDER BY cumulative_points DESC NULLS FIRST, wins_so_far DESC, podiums_so_far DESC, driver_id)"""),
    "driver_seasons": (("hub",), f"""
        SELECT *, driver_id || '_' || season AS driver_id_season, row_number() OVER (
                   PARTITION BY season ORDER BY points DESC, wins DESC, podiums DESC, driver_id) AS championship_position
        FROM (SELECT driver_id, season, max(driver_name) AS driver_name, max(constructor_name) AS team,
                     count(DISTINCT race_id) AS races_entered, count(*) FILTER (is_win) AS wins,
                     count(*) FILTER (is_podium) AS podiums, sum(points + coalesce(sprint_points, 0)) AS points,
                     count(*) FILTER (qualifying_position = 1) AS poles,
                     count(*) FILTER (fastest_lap_rank = 1) AS fastest_laps, count(*) FILTER (is_dnf) AS dnfs,
                     {half_up_avg("finish_position", 2)} AS avg_finish_position, max(source) AS source
              FROM hub GROUP BY driver_id, season) g"""),
    "one_twos": (("hub",), """
        SELECT constructor_id, season, count(DISTINCT race_id) AS one_two_finishes
        FROM (SELECT constructor_id, season, race_id FROM hub WHERE finish_position <= 2 GROUP BY ALL
              HAVING count(*) = 2 AND min(finish_position) = 1 AND max(finish_position) = 2) d
        GROUP BY ALL"""),
    "team_seasons": (("hub", "one_twos"), """
        SELECT g.*, coalesce(o.one_two_finishes, 0) AS one_two_finishes,
               g.constructor_id || '_' || g.season AS constructor_id_season, row_number() OVER (
                   PARTITION BY g.season ORDER BY points DESC, wins DESC, podiums DESC, g.constructor_id
               ) AS championship_position
        FROM (SELECT constructor_id, season, max(constructor_name) AS constructor_name,
                     count(DISTINCT race_id) AS races_entered, count(*) FILTER (is_win) AS wins,
                     count(*) FILTER (is_podium) AS podiums, sum(points + coalesce(sprint_points, 0)) AS points,
                     count(*) FILTER (qualifying_position = 1) AS poles,
                     count(*) FILTER (fastest_lap_rank = 1) AS fastest_laps, count(*) FILTER (is_dnf) AS dnfs,
                     max(source) AS source
              FROM hub GROUP BY constructor_id, season) g
        LEFT JOIN one_twos o ON o.constructor_id = g.constructor_id AND o.season = g.season"""),
    "driver_careers": (("hub", "drivers", "driver_seasons"), """
        SELECT h.driver_id, d.driver_name, d.code AS driver_code, d.nationality,
               CAST(d.date_of_birth AS VARCHAR) AS date_of_birth, first_season, last_season, seasons, races_entered,
               wins, podiums, poles, fastest_laps, total_points, dnfs, teams_raced_for, teams,
               (SELECT count(DISTINCT season) FROM driver_seasons y
                WHERE y.championship_position = 1 AND y.driver_id = h.driver_id) AS championships_won, d.source
        FROM (SELECT driver_id, min(season) AS first_season, max(season) AS last_season,
                     count(DISTINCT season) AS seasons, count(DISTINCT race_id) AS races_entered,
                     count(*) FILTER (is_win) AS wins, count(*) FILTER (is_podium) AS podiums,
                     count(*) FILTER (qualifying_position = 1) AS poles,
                     count(*) FILTER (fastest_lap_rank = 1) AS fastest_laps, sum(points) AS total_points,
                     count(*) FILTER (is_dnf) AS dnfs, count(DISTINCT constructor_id) AS teams_raced_for,
                     string_agg(DISTINCT constructor_name, ', ' ORDER BY constructor_name) AS teams
              FROM hub GROUP BY driver_id) h JOIN drivers d ON d.driver_id = h.driver_id"""),
    "team_careers": (("hub", "teams", "team_seasons"), """
        SELECT h.constructor_id, t.name AS constructor_name, t.nationality, first_season, last_season, seasons,
               races_entered, wins, podiums, poles, fastest_laps, total_points, dnfs, drivers_raced_for, drivers,
               (SELECT count(DISTINCT season) FROM team_seasons y
                WHERE y.championship_position = 1 AND y.constructor_id = h.constructor_id) AS championships_won,
               t.source
        FROM (SELECT constructor_id, min(season) AS first_season, max(season) AS last_season,
                     count(DISTINCT season) AS seasons, count(DISTINCT race_id) AS races_entered,
                     count(*) FILTER (is_win) AS wins, count(*) FILTER (is_podium) AS podiums,
                     count(*) FILTER (qualifying_position = 1) AS poles,
                     count(*) FILTER (fastest_lap_rank = 1) AS fastest_laps, sum(points) AS total_points,
                     count(*) FILTER (is_dnf) AS dnfs, count(DISTINCT driver_id) AS drivers_raced_for,
                     string_agg(DISTINCT driver_name, ', ' ORDER BY driver_name) AS drivers
              FROM hub GROUP BY constructor_id) h JOIN teams t ON t.constructor_id = h.constructor_id"""),
    "circuit_records": (("hub", "circuits", "quali"), f"""
        SELECT g.*, c.name AS circuit_name, c.country AS circuit_country, c.location AS circuit_location, c.latitude,
               c.longitude, c.altitude, w.driver_name AS most_wins_driver, p.driver_name AS most_podiums_driver,
               q.driver_name AS most_poles_driver, z.season AS latest_season, z.race_name AS latest_race_name,
               z.race_date AS latest_race_date, v.driver_name AS latest_winner
        FROM (SELECT circuit_id, count(DISTINCT season) AS seasons_hosted, count(DISTINCT race_id) AS races_hosted,
                     min(season) AS first_season, max(season) AS last_season,
                     count(DISTINCT driver_id) AS unique_drivers,
                     count(DISTINCT constructor_id) AS unique_constructors, count(*) FILTER (is_win) AS total_wins,
                     count(*) FILTER (is_podium) AS total_podiums, count(*) FILTER (is_dnf) AS total_dnfs,
                     {half_up_avg("laps_completed", 2)} AS avg_laps_completed,
                     {half_up_avg("pit_stop_count", 2)} AS avg_pit_stops_per_driver,
                     {half_up_avg("total_pit_ms", 2)} AS avg_total_pit_ms, max(source) AS source
              FROM hub GROUP BY circuit_id) g
        JOIN circuits c ON c.circuit_id = g.circuit_id
        LEFT JOIN (SELECT circuit_id, driver_name FROM hub WHERE is_win GROUP BY circuit_id, driver_id, driver_name
                   QUALIFY row_number() OVER (PARTITION BY circuit_id ORDER BY count(*) DESC, driver_id) = 1) w
               ON w.circuit_id = g.circuit_id
        LEFT JOIN (SELECT circuit_id, driver_name FROM hub WHERE is_podium GROUP BY circuit_id, driver_id, driver_name
                   QUALIFY row_number() OVER (PARTITION BY circuit_id ORDER BY count(*) DESC, driver_id) = 1) p
               ON p.circuit_id = g.circuit_id
        LEFT JOIN (SELECT circuit_id, driver_name FROM hub SEMI JOIN (
                       SELECT race_id, driver_id FROM quali WHERE qualifying_position = 1) f
                       ON f.race_id = hub.race_id AND f.driver_id = hub.driver_id
                   GROUP BY circuit_id, hub.driver_id, driver_name
                   QUALIFY row_number() OVER (PARTITION BY circuit_id ORDER BY count(*) DESC, hub.driver_id) = 1) q
               ON q.circuit_id = g.circuit_id
        LEFT JOIN (SELECT DISTINCT ON (circuit_id) circuit_id, season, race_name, race_date FROM hub
                   ORDER BY circuit_id, season DESC, round DESC, race_date DESC) z ON z.circuit_id = g.circuit_id
        LEFT JOIN (SELECT DISTINCT ON (circuit_id) circuit_id, driver_name FROM hub WHERE is_win
                   ORDER BY circuit_id, season DESC, round DESC, race_date DESC, driver_id) v
               ON v.circuit_id = g.circuit_id"""),
    "quali_race": (("quali", "results", "drivers", "teams", "races", "status"), f"""
        SELECT {key_of("q.race_id", "q.driver_id")} AS quali_race_key, q.race_id, q.driver_id, q.constructor_id,
               q.qualifying_position, e.grid_position, e.finish_position,
               e.grid_position - e.finish_position AS positions_gained_lost, e.points, e.laps_completed,
               x.status_category, coalesce(x.status_category <> 'Finished', false) AS is_dnf, q.q1_time, q.q2_time,
               q.q3_time, e.fastest_lap_rank, coalesce(q.qualifying_position = 1, false) AS is_pole,
               coalesce(e.finish_position = 1, false) AS is_win,
               coalesce(e.finish_position <= 3, false) AS is_podium, d.driver_name,
               d.nationality AS driver_nationality, d.code AS driver_code, t.name AS constructor_name,
               t.nationality AS constructor_nationality, r.year AS season, r.round, r.name AS race_name, r.race_date,
               q.source
        FROM quali q JOIN results e ON e.race_id = q.race_id AND e.driver_id = q.driver_id
        JOIN drivers d ON d.driver_id = q.driver_id JOIN teams t ON t.constructor_id = q.constructor_id
        JOIN races r ON r.race_id = q.race_id JOIN status x ON x.status_id = e.status_id"""),
    "lap_joined": (("laps", "races", "drivers", "results", "circuits"), """
        SELECT l.race_id, l.driver_id, l.lap_number, l.lap_position, l.lap_time, l.lap_milliseconds AS lap_ms,
               l.source, r.year AS season, r.round, r.name AS race_name, r.race_date, c.circuit_id,
               c.name AS circuit_name, c.country AS circuit_country, d.driver_name, d.code AS driver_code,
               e.constructor_id, e.result_id
        FROM laps l JOIN races r ON r.race_id = l.race_id JOIN drivers d ON d.driver_id = l.driver_id
        JOIN results e ON e.race_id = l.race_id AND e.driver_id = l.driver_id
        JOIN circuits c ON c.circuit_id = r.circuit_id"""),
    "lap_analysis": (("lap_joined", "teams"), f"""
        SELECT {key_of("race_id", "driver_id", "lap_number")} AS lap_analysis_key, w.*,
               lap_ms - leader_ms AS delta_to_leader_ms, lap_ms - race_best_ms AS delta_to_race_best_ms,
               lap_ms = race_best_ms AS is_race_fastest_lap, lap_ms = leader_ms AS is_lap_fastest,
               lap_ms - lap_avg AS delta_to_lap_avg_ms,
               CASE WHEN lap_ms - before_ms > 5000 THEN 1 ELSE 0 END AS potential_pit_lap,
               t.name AS constructor_name, t.nationality AS constructor_nationality
        FROM (SELECT *, min(lap_ms) OVER (PARTITION BY race_id, lap_number) AS leader_ms,
                     min(lap_ms) OVER (PARTITION BY race_id) AS race_best_ms,
                     {half_up("sum(lap_ms) OVER (PARTITION BY race_id, lap_number)",
                              "count(lap_ms) OVER (PARTITION BY race_id, lap_number)", 6)} AS lap_avg,
                     count(*) OVER (PARTITION BY race_id, lap_number) AS drivers_on_lap,
                     row_number() OVER (PARTITION BY race_id, driver_id ORDER BY lap_number, lap_ms, result_id) AS lap_seq,
                     row_number() OVER (PARTITION BY race_id, driver_id ORDER BY lap_ms, lap_number, result_id) AS driver_lap_rank,
                     lag(lap_ms) OVER (PARTITION BY race_id, driver_id ORDER BY lap_number, lap_ms, result_id) AS before_ms
              FROM lap_joined) w
        LEFT JOIN teams t ON t.constructor_id = w.constructor_id"""),
    "pit_analysis": (("pits", "races", "drivers", "results", "teams", "circuits"), f"""
        SELECT {key_of("race_id", "driver_id", "stop_number")} AS pit_analysis_key, w.*,
               stop_ms - stop_avg AS delta_to_avg_stop_ms,
               coalesce(stop_ms = stop_best, false) AS is_fastest_stop_in_race,
               coalesce(stop_ms = stop_worst, false) AS is_slowest_stop_in_race,
               stop_ms - coalesce(before_ms, 0) AS stop_delta_from_prev,
               coalesce(stop_ms - before_ms > 3000, false) AS is_slow_stop
        FROM (SELECT p.race_id, p.driver_id, p.stop_number, p.lap_number, p.stop_time, p.stop_duration,
                     p.stop_milliseconds AS stop_ms, p.source, r.year AS season, r.round, r.name AS race_name,
                     r.race_date, c.name AS circuit_name, c.country AS circuit_country, d.driver_name,
                     d.code AS driver_code, t.name AS constructor_name, t.nationality AS constructor_nationality,
                     e.grid_position, e.finish_position,
                     {half_up("sum(p.stop_milliseconds) OVER (PARTITION BY p.race_id, p.stop_number)",
                              "count(p.stop_milliseconds) OVER (PARTITION BY p.race_id, p.stop_number)", 6)} AS stop_avg,
                     min(p.stop_milliseconds) OVER (PARTITION BY p.race_id, p.stop_number) AS stop_best,
                     max(p.stop_milliseconds) OVER (PARTITION BY p.race_id, p.stop_number) AS stop_worst,
                     sum(p.stop_milliseconds) OVER (PARTITION BY p.race_id, p.driver_id) AS total_pit_ms,
                     count(*) OVER (PARTITION BY p.race_id, p.driver_id) AS total_stops,
                     row_number() OVER (PARTITION BY p.race_id, p.driver_id
                                        ORDER BY p.stop_number, p.stop_milliseconds, e.result_id) AS stop_seq,
                     lag(p.stop_milliseconds) OVER (PARTITION BY p.race_id, p.driver_id
                                        ORDER BY p.stop_number, p.stop_milliseconds, e.result_id) AS before_ms
              FROM pits p JOIN races r ON r.race_id = p.race_id JOIN drivers d ON d.driver_id = p.driver_id
              JOIN results e ON e.race_id = p.race_id AND e.driver_id = p.driver_id
              JOIN teams t ON t.constructor_id = e.constructor_id
              JOIN circuits c ON c.circuit_id = r.circuit_id) w"""),
}


def with_views(names: Sequence[str], query: str) -> str:
    """Prefix a query with the views it uses, dependencies first."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for needed in VIEWS[name][0]:
                visit(needed)
            order.append(name)

    for name in names:
        visit(name)
    if not order:
        return query
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n][1]})" for n in order) + " " + query
