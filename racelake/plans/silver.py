"""Bronze tables cleaned: facts without footnotes, footnotes apart, dimensions.

Each fact is one pass over its source (filter and projection, no shuffle), except practices, which
need the leader's time of their session.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelake import schemas
from racelake.functions import dates, durations, links, rules, text
from racelake.operators.sessions import leader_times
from racelake.operators.shape import cast_to, notes, rename, split_rows, union_all

_LINEAGE = {
    "source_url": "Source_Url", "event_title": "Event_Title", "scraped_at_utc": "Scraped_Timestamp",
    "race_id": "Race_Id", "gp_slug": "Gp_Slug", "season": "Season",
}
_DRIVER = {"clean_name": "Driver_Name", "driver_code": "Driver_Code"}

# source column of each clean column
_RESULTS = {
    "label": "Position", "car_number": "Car_Number", "team": "Team", "laps": "Laps",
    "clean_time": "Time_Or_Retired", "clean_points": "Points", **_DRIVER, "clean_status": "Status",
    "race_time_s": "Race_Time_S", "gap_to_winner_s": "Gap_To_Winner_S", **_LINEAGE, "Fix_Points": "Fix_Points",
}
_QUALIFYING = {
    "label": "Position", "car_number": "Car_number", "team": "Team", "q1": "Q1", "q2": "Q2", "q3": "Q3",
    "laps": "Laps", "q1_clean": "Q1_Segs", "q2_clean": "Q2_Segs", "q3_clean": "Q3_Segs", **_DRIVER, **_LINEAGE,
}
_OLD_QUALIFYING = {
    "label": "Position", "car_number": "Car_Number", "team": "Team", "time": "Time", "time_s": "Time_Segs",
    "clean_laps": "Laps", "points": "Points", **_DRIVER, **_LINEAGE,
}
_GRID = {
    "grid_position": "Grid_Position", "car_number": "Car_Number", "team": "Team", "time_or_note": "Time",
    **_DRIVER, **_LINEAGE,
}
_FAST_LAPS = {
    "position": "Position", "car_number": "Car_Number", "team": "Team", "lap": "Lap", "lap_time": "Lap_Time",
    "clean_time_s": "Lap_Time_S", **_DRIVER, **_LINEAGE,
}
_PIT_STOPS = {
    "stop": "Stops", "car_number": "Car_Number", **_DRIVER, "team": "Team", "lap": "Lap",
    "time_of_day": "Time_Of_Day", "pit_time": "Pit_Time", "pit_secs": "Pit_Secs",
    "total_time": "Total_Time", "total_secs": "Total_Secs", **_LINEAGE,
}
_PRACTICES = {
    "position": "Position", "car_number": "Car_number", "driver": "Driver", "team": "Team", "time": "Time",
    "time_s": "Time_s", "gap": "Gap", "gap_s": "Gap_s", "base_time_s": "Base_time_s",
    "real_time_s": "Real_time_s", "laps": "Laps", **_DRIVER, **_LINEAGE,
    "practice_no": "Practice_No", "label": "Practice",
}

# session -> column that is null on a footnote row, event name of its notes
NOTE_MARKERS = {
    "race": ("points", "Race"),
    "sprint": ("points", "Sprint Race"),
    "qualifying": ("laps", "Qualifying"),
    "sprint_qualifying": ("laps", "Sprint_Qualifying"),
    "old_qualifying": ("car_number", "Old Qualifying"),
    "practice": ("laps", "Practices"),
    "grid": ("grid_position", "Starting Grid"),
    "sprint_grid": ("grid_position", "Sprint Starting Grid"),
}


def _data_rows(bronze: DataFrame, session: str) -> DataFrame:
    data, _ = split_rows(bronze, F.col(NOTE_MARKERS[session][0]).isNotNull())
    return data.withColumn("clean_name", text.plain_spaces(F.col("driver_name")))


def _shaped(df: DataFrame, columns: Mapping[str, str], schema: str) -> DataFrame:
    return cast_to(rename(df, columns), schema)


def clean_results(bronze: DataFrame) -> DataFrame:
    """Race results with labels for missing positions, repaired points and readable times."""
    c = F.col
    labelled = _data_rows(bronze, "race").withColumn(
        "label", rules.race_position(c("position"), c("status"), c("time_or_retired"))
    )
    status = rules.race_status(c("label"), c("status"), c("time_or_retired"), c("laps"))
    return _finished_results(labelled.withColumn("clean_status", status), rules.race_repair, rules.race_points)


def clean_sprint_results(bronze: DataFrame) -> DataFrame:
    c = F.col
    labelled = _data_rows(bronze, "sprint").withColumn("label", rules.sprint_position(c("position"), c("status")))
    status = rules.sprint_status(c("label"), c("status"))
    return _finished_results(labelled.withColumn("clean_status", status), rules.sprint_repair, rules.sprint_points)


def _finished_results(labelled: DataFrame, repair, scale) -> DataFrame:
    c = F.col
    flagged = labelled.withColumns(
        {
            "clean_time": rules.time_label(c("time_or_retired"), c("clean_status"), c("gap_to_winner_s")),
            "Fix_Points": repair(c("points"), c("position"), c("season")),
        }
    )
    points = rules.repaired(c("Fix_Points"), scale(c("position")), c("points"))
    return _shaped(flagged.withColumn("clean_points", points), _RESULTS, schemas.CLEAN_RESULTS)


def clean_qualifying(bronze: DataFrame, session: str = "qualifying") -> DataFrame:
    """Qualifying (or sprint qualifying) with 0 for a session without time."""
    cleaned = _data_rows(bronze, session).withColumns(
        {
            "label": rules.classified_position(F.col("position")),
            **{f"{q}_clean": durations.millis_or_zero(F.col(f"{q.upper()}_Segs")) for q in ("q1", "q2", "q3")},
        }
    )
    return _shaped(cleaned, _QUALIFYING, schemas.CLEAN_QUALIFYING)


def clean_old_qualifying(bronze: DataFrame) -> DataFrame:
    cleaned = _data_rows(bronze, "old_qualifying").withColumns(
        {
            "label": rules.classified_position(F.col("position")),
            "clean_laps": F.coalesce("laps", F.lit(0)),
        }
    )
    return _shaped(cleaned, _OLD_QUALIFYING, schemas.CLEAN_OLD_QUALIFYING)


def clean_practices(bronze: DataFrame, strict: bool = False) -> DataFrame:
    """Practices with the session leader's time and every driver's own."""
    data = _data_rows(bronze, "practice").drop("interval", "interval_s")
    timed = leader_times(data, strict).withColumn("label", text.label("Practice", F.col("practice_no")))
    return _shaped(timed, _PRACTICES, schemas.CLEAN_PRACTICES)


def clean_grid(bronze: DataFrame, session: str = "grid") -> DataFrame:
    """Starting grid (or sprint grid)."""
    return _shaped(_data_rows(bronze, session), _GRID, schemas.CLEAN_GRID)


def _named_rows(bronze: DataFrame, present: str) -> DataFrame:
    kept = bronze.filter(F.col(present).isNotNull())
    return kept.withColumn("clean_name", text.plain_spaces(F.col("driver_name")))


def clean_fast_laps(bronze: DataFrame) -> DataFrame:
    timed = _named_rows(bronze, "lap_time_s").withColumn("clean_time_s", durations.to_millis(F.col("lap_time_s")))
    return _shaped(timed, _FAST_LAPS, schemas.CLEAN_FAST_LAPS)


def clean_pit_stops(bronze: DataFrame) -> DataFrame:
    return _shaped(_named_rows(bronze, "stop"), _PIT_STOPS, schemas.CLEAN_PIT_STOPS)


def race_notes(sessions: Mapping[str, DataFrame]) -> DataFrame:
    """The footnotes of all given bronze tables, keyed as in ``NOTE_MARKERS``."""
    return union_all(
        notes(df, *NOTE_MARKERS[name], drop_broken=name == "old_qualifying") for name, df in sessions.items()
    )


def races_dimension(races: DataFrame) -> DataFrame:
    """Races with month, day and date read from their date text."""
    month = dates.month_abbreviation(F.col("date_text"))
    parted = races.withColumns(
        {"Month": month, "Id_Month": dates.month_number(month), "Id_Day": dates.leading_day(F.col("date_text"))}
    )
    day = dates.date_of(F.col("season").cast("int"), F.col("Id_Month"), F.col("Id_Day"))
    return parted.withColumns({"Date": day, "Gold": F.lit("N")})


def country_dimension(countries: DataFrame) -> DataFrame:
    return countries.withColumn("URL_Download", links.download_link(F.col("Sharepoint_Image_URL")))


def drivers_dimension(drivers: DataFrame) -> DataFrame:
    columns = {"driver_name_clean": "Driver_Name"} | {c: c for c in schemas.names(schemas.DIM_DRIVERS)[1:]}
    return _shaped(drivers, columns, schemas.DIM_DRIVERS)


def tracks_dimension(tracks: DataFrame) -> DataFrame:
    return tracks.selectExpr("TrackKey AS Track_Key", "TrackName AS Track_Name", "Country", "YearBuilt AS Year_Built")
