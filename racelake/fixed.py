"""Word lists, scales and page layouts that the results depend on."""

from __future__ import annotations

# Texts that mean "no value" in a time cell (compared in lower case).
NULL_TOKENS = ("", "-", "—", "na", "n/a")
NO_TIME_TOKENS = ("no time", "dns", "dnf")

# Reasons for not finishing, and the mark of a car scratched before the start.
NOT_FINISHED = ("DNF", "DNS", "DSQ")
LATE_SCRATCH = "SHC"

# Points by position, from first place down.
RACE_POINTS = (25, 18, 15, 12, 10, 8, 6, 4, 2, 1)
SPRINT_POINTS = (8, 7, 6, 5, 4, 3, 2, 1)

# Last scoring position and first season of the points repair.
RACE_REPAIR = (10, 2010)
SPRINT_REPAIR = (8, 2022)

# The boilerplate footnote, and the word that marks a broken one.
BOILERPLATE_NOTE = "* Provisional results."
BROKEN_NOTE = "Error"

# Month abbreviations, English and (where they differ) Spanish.
MONTH_NUMBERS = {
    "JAN": 1, "FEB": 2, "MAR": 3, "APR": 4, "MAY": 5, "JUN": 6,
    "JUL": 7, "AUG": 8, "SEP": 9, "OCT": 10, "NOV": 11, "DEC": 12,
    "ENE": 1, "ABR": 4, "AGO": 8, "DIC": 12,
}

# Calendar names.
MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# First and last day of the master calendar, first and last season.
CALENDAR_RANGE = ("1950-01-01", "2050-12-31")
SEASON_RANGE = (1950, 2025)

# First season of each kind of session page.
PIT_STOPS_SINCE = 1994
MODERN_QUALIFYING_SINCE = 2006
SPRINTS_SINCE = 2021
SPRINT_QUALIFYING_SINCE = 2023
