"""Parameters of the registered queries (fixed values, shared with the oracle SQL)."""

from __future__ import annotations

from clickflow.sources.task_params import TaskParams

# date range of the action scans
START_DATE = "2024-01-05"
END_DATE = "2024-01-20"

# session filter of the session task
START_AGE = 5
END_AGE = 55
PROFESSIONALS = ["AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY"]
CITIES = [f"NATION_{i}" for i in range(20)]
SEXES = ["male"]
KEYWORDS = ["kw1", "kw2", "kw3", "kw4", "kw5", "kw6", "kw7", "kw8", "kw9"]
CATEGORY_IDS = list(range(0, 90))

# page funnel
PAGE_FLOW = [1, 2, 5, 7]

# sampling
SAMPLE_SIZE = 3000
SAMPLE_SEED = "42"

# histograms: length unit in seconds
VISIT_UNIT_SECONDS = 30
# step buckets of the registered queries (name, from, to, to included): every one holds sessions of the test data
STEP_BUCKETS = [("1", 1, 1, True), ("2", 2, 2, True), ("3", 3, 3, True), ("4", 4, 4, True), ("5", 5, None, False)]

# rankings of the session task
TOP_SESSIONS = 3

# ads
CLICK_THRESHOLD = 2
SLIDE_MINUTES = 10
SLIDE_SECONDS_REFERENCE = 10  # the reference's slide: 360 windows per click
WINDOW_MINUTES = 60
LAST_MINUTES = 1440


def session_task_params() -> TaskParams:
    return TaskParams(
        start_date=START_DATE, end_date=END_DATE, start_age=START_AGE, end_age=END_AGE,
        professionals=PROFESSIONALS, cities=CITIES, sex=SEXES, keywords=KEYWORDS,
        category_ids=[str(c) for c in CATEGORY_IDS],
    )
