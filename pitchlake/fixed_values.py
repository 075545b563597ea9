"""Fixed values.

Everything in this file has to equal the published data format, metric
definition or model for results to be right; nothing here is tuned.
"""

# Pitch sizes: provider units and metres. The goal centre is the attacked one.
SOURCE_LENGTH = 120.0
SOURCE_WIDTH = 80.0
PITCH_LENGTH = 105.0
PITCH_WIDTH = 68.0
GOAL_X = 105.0
GOAL_Y = 34.0

# A completed pass is progressive from this share of the distance to goal on.
PROGRESSIVE_RATIO = 0.25

# Median shot position below which a team may be attacking the wrong way.
ORIENTATION_MIN_X = 60.0

# Event types and outcomes with a meaning in the metrics.
PASS = "Pass"
CARRY = "Carry"
SHOT = "Shot"
GOAL = "Goal"

# Expected-threat model: 8 rows (pitch width) x 12 columns (pitch length).
XT_MODEL_VERSION = "open_xt_12x8_v1"
XT_ROWS = 8
XT_COLUMNS = 12
XT_GRID = [
    [0.00638303, 0.00779616, 0.00844854, 0.00977659, 0.01126267, 0.01248344,
     0.01473596, 0.0174506, 0.02122129, 0.02756312, 0.03485072, 0.0379259],
    [0.00750072, 0.00878589, 0.00942382, 0.0105949, 0.01214719, 0.0138454,
     0.01611813, 0.01870347, 0.02401521, 0.02953272, 0.04066992, 0.04647721],
    [0.0088799, 0.00977745, 0.01001304, 0.01110462, 0.01269174, 0.01429128,
     0.01685596, 0.01935132, 0.0241224, 0.02855202, 0.05491138, 0.06442595],
    [0.00941056, 0.01082722, 0.01016549, 0.01132376, 0.01262646, 0.01484598,
     0.01689528, 0.0199707, 0.02385149, 0.03511326, 0.10805102, 0.25745362],
    [0.00941056, 0.01082722, 0.01016549, 0.01132376, 0.01262646, 0.01484598,
     0.01689528, 0.0199707, 0.02385149, 0.03511326, 0.10805102, 0.25745362],
    [0.0088799, 0.00977745, 0.01001304, 0.01110462, 0.01269174, 0.01429128,
     0.01685596, 0.01935132, 0.0241224, 0.02855202, 0.05491138, 0.06442595],
    [0.00750072, 0.00878589, 0.00942382, 0.0105949, 0.01214719, 0.0138454,
     0.01611813, 0.01870347, 0.02401521, 0.02953272, 0.04066992, 0.04647721],
    [0.00638303, 0.00779616, 0.00844854, 0.00977659, 0.01126267, 0.01248344,
     0.01473596, 0.0174506, 0.02122129, 0.02756312, 0.03485072, 0.0379259],
]

# Gold facts.
METRIC_VERSION = "1.0"
INTERVAL_MINUTES = 5
STOPPAGE_SLOT = 45

# Five-minute intervals in the order in which reports show them.
INTERVAL_ORDER = [
    "0-5", "5-10", "10-15", "15-20", "20-25", "25-30", "30-35", "35-40",
    "40-45", "45+",
    "45-50", "50-55", "55-60", "60-65", "65-70", "70-75", "75-80", "80-85",
    "85-90", "90+",
]

# Match summary report: label, column of the team fact, decimals, suffix.
SUMMARY_METRICS = [
    ("Goals", "goals", 0, ""),
    ("Shots", "shots", 0, ""),
    ("xG", "xg", 2, ""),
    ("Pass completion", "pass_completion_pct", 1, "%"),
    ("Progressive passes", "progressive_passes", 0, ""),
    ("Carries", "carries", 0, ""),
]

# Chart marker sizes: (factor, offset); missing xG counts as SHOT_MAP_DEFAULT_XG.
SHOT_MAP_DEFAULT_XG = 0.05
SHOT_MAP_MARKER = (1200.0, 60.0)
TIMELINE_MISS_MARKER = (250.0, 20.0)
TIMELINE_GOAL_MARKER = (350.0, 80.0)

# Run metadata.
STAGES = ["INGEST", "BRONZE", "SILVER", "GOLD_TEAM", "GOLD_INTERVAL", "REPORTS"]
UPSTREAM_STAGE = {
    "BRONZE": "INGEST",
    "SILVER": "BRONZE",
    "GOLD_TEAM": "SILVER",
    "GOLD_INTERVAL": "SILVER",
}
SUCCEEDED = "SUCCEEDED"
FAILED = "FAILED"
NOT_RUN = "NOT_RUN"
TASK_RETRY = "TASK_RETRY"
TASK_FAILED = "TASK_FAILED"
DAG_FAILED = "DAG_FAILED"

# Volume monitor: size of the baseline window and alarm ratios.
BASELINE_RUNS = 10
HIGH_VOLUME_RATIO = 1.5
LOW_VOLUME_RATIO = 0.5

# Matches handed out by one discovery run.
DISCOVERY_LIMIT = 5
