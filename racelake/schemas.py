"""Column names and types of every table, as DDL text."""

from __future__ import annotations

NUMERIC = ("int", "bigint", "double")


def fields(schema: str) -> list[tuple[str, str]]:
    """``(name, type)`` pairs of a DDL schema of plain column types."""
    return [tuple(part.split()[:2]) for part in schema.split(",")]


def names(schema: str) -> list[str]:
    return [name for name, _ in fields(schema)]


# The stored column names and types.
LINEAGE = "source_url string, event_title string, scraped_at_utc string, race_id int, gp_slug string, season int"
LINEAGE_RESULTS = "source_url string, event_title string, scraped_at_utc string, race_id int, season int, gp_slug string"

RACES = (
    "season int, gp string, date_text string, url string, sprint string, scraped_at_utc string, "
    "silver string, bronze string, race_id int"
)
RESULTS = (
    "position int, car_number int, driver string, team string, laps int, time_or_retired string, "
    "points double, driver_name string, driver_code string, status string, race_time_s double, "
    f"gap_to_winner_s double, {LINEAGE_RESULTS}"
)
SPRINT_RESULTS = RESULTS.replace("points double", "points int")
QUALIFYING = (
    "position int, car_number int, driver string, team string, q1 string, q2 string, q3 string, "
    "laps int, Q1_Segs double, Q2_Segs double, Q3_Segs double, driver_name string, "
    f"driver_code string, {LINEAGE}"
)
OLD_QUALIFYING = (
    "position int, car_number int, driver string, team string, time string, time_s double, "
    f"laps int, points int, driver_name string, driver_code string, {LINEAGE}"
)
GRID = (
    "grid_position int, car_number int, driver string, team string, time_or_note string, "
    f"points int, driver_name string, driver_code string, {LINEAGE}"
)
FAST_LAPS = (
    "position int, car_number int, driver string, team string, lap int, lap_time string, "
    "lap_time_s double, gap string, gap_s double, avg_speed_kph double, points int, "
    f"driver_name string, driver_code string, {LINEAGE}"
)
PIT_STOPS = (
    "stop int, car_number int, driver string, driver_name string, driver_code string, team string, "
    "lap int, time_of_day string, pit_time string, pit_secs double, total_time string, "
    f"total_secs double, {LINEAGE}"
)
PRACTICE = (
    "position int, car_number int, driver string, team string, time string, time_s double, "
    "gap string, gap_s double, interval string, interval_s double, laps int, driver_name string, "
    f"driver_code string, {LINEAGE}, practice_no int"
)
SEASONS = "year int, IsCurrentSeason string"
RUN_LOG = (
    "Datetime_Star timestamp not null, Datetime_end timestamp not null, User_Name string, "
    "IsPipeline boolean, Coment string, Action string, NotebookName string, NotebookId string, "
    "DestinationTable string, Target_path string, Src_Path string"
)

# Names and types after cleaning.
CLEAN_LINEAGE = (
    "Source_Url string, Event_Title string, Scraped_Timestamp string, Race_Id int, Gp_Slug string, Season int"
)
CLEAN_LINEAGE_RESULTS = (
    "Source_Url string, Event_Title string, Scraped_Timestamp string, Race_Id int, Season int, Gp_Slug string"
)
CLEAN_RESULTS = (
    "Position string, Car_Number int, Team string, Laps int, Time_Or_Retired string, Points double, "
    "Driver_Name string, Driver_Code string, Status string, Race_Time_S double, "
    f"Gap_To_Winner_S double, {CLEAN_LINEAGE_RESULTS}, Fix_Points string"
)
CLEAN_QUALIFYING = (
    "Position string, Car_number int, Team string, Q1 string, Q2 string, Q3 string, Laps int, "
    "Q1_Segs double, Q2_Segs double, Q3_Segs double, Driver_Name string, Driver_Code string, "
    f"{CLEAN_LINEAGE}"
)
CLEAN_OLD_QUALIFYING = (
    "Position string, Car_Number int, Team string, Time string, Time_Segs double, Laps int, "
    f"Points int, Driver_Name string, Driver_Code string, {CLEAN_LINEAGE}"
)
CLEAN_GRID = (
    "Grid_Position int, Car_Number int, Team string, Time string, Driver_Name string, "
    f"Driver_Code string, {CLEAN_LINEAGE}"
)
CLEAN_FAST_LAPS = (
    "Position int, Car_Number int, Team string, Lap int, Lap_Time string, Lap_Time_S double, "
    f"Driver_Name string, Driver_Code string, {CLEAN_LINEAGE}"
)
CLEAN_PIT_STOPS = (
    "Stops int, Car_Number int, Driver_Name string, Driver_Code string, Team string, Lap int, "
    "Time_Of_Day string, Pit_Time string, Pit_Secs double, Total_Time string, Total_Secs double, "
    f"{CLEAN_LINEAGE}"
)
CLEAN_PRACTICES = (
    "Position int, Car_number int, Driver string, Team string, Time string, Time_s double, "
    "Gap string, Gap_s double, Base_time_s double, Real_time_s double, Laps int, "
    f"Driver_Name string, Driver_Code string, {CLEAN_LINEAGE}, Practice_No int, Practice string"
)
NOTES = "Note string, Race_Id int, Season int, Gp_Slug string, Event string"
DIM_DRIVERS = "Driver_Name string, Nationality string, LastSeason int, FirstSeason int, DOB date"
