"""Fixed parameters the registered queries run with (shared with the oracle).

They are query parameters, not data: every registered query still reads the
driver tables in full.
"""

import datetime as _dt

# "now" for the explorer (event_date > as_of) and the rule-marking stamp.
AS_OF = _dt.datetime(2024, 2, 10, 0, 0, 0)
# Optional report filters used by the *_filtered keys.
GENRE = "ECONOMY"
CITY = "EUROPE"
# Explorer search text (case-insensitive contains on artist or event name).
SEARCH = "RED"
# Thresholds (defaults of the original models and reports).
MIN_OBSERVATIONS = 5
MIN_SNAPSHOTS = 3
Z_THRESHOLD = 2.0
SELLOUT_LIMIT = 50
SELLOUT_TABLE_ROWS = 15
ANOMALY_REPORT_LIMIT = 50
ANOMALY_ALERT_LIMIT = 20
EXPLORER_PAGE_ROWS = 100
DIGEST_LINES_PER_KIND = 10
HISTOGRAM_MAX_BINS = 15
# Columns of the registered duplicate check (several events of an artist share
# a day, so it returns rows; the store's own key never repeats here).
DUPLICATE_KEY = ["artist_name", "snapshot_date"]

# Alert rules the alert keys check: (target_price, created_at, triggered,
# event_id, artist_name).  rule_id is the list position.  They cover: rule by
# event id, by artist (case-insensitive), both (id wins), neither, blank
# strings, already triggered, wildcards inside the artist text, a target equal
# to the price, a wildcard-only text, no match, unknown id, blank id with an
# artist.
RULES = [
    (50.0, "2024-01-02 09:00:00.000001", False, "14", None),
    (10.0, "2024-01-03 10:00:00", False, None, "Widget"),
    (900.0, "2024-01-04 11:00:00", False, "7", "ring"),
    (40.0, "2024-01-05 12:00:00", False, None, None),
    (40.0, "2024-01-06 13:00:00", False, "", ""),
    (500.0, "2024-01-07 14:00:00", True, None, "ANVIL"),
    (60.0, "2024-01-08 15:00:00", False, None, "r%d"),
    (2.62, "2024-01-09 16:00:00", False, None, "hot"),
    (1.0, "2024-01-10 17:00:00", False, None, "%"),
    (100.0, "2024-01-11 18:00:00", False, None, "zz"),
    (100.0, "2024-01-12 19:00:00", False, "999999", None),
    (5.0, "2024-01-13 20:00:00", False, None, "_ _"),
    (4.0, "2024-01-14 21:00:00", False, "", "bolt"),
]
