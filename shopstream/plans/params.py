"""Parameters of the registered queries.

The driver data spans days and years, far sparser than the reference's
seconds-apart logs, so time parameters are scaled: windows of 60 min sliding
by 5 min (reference: 5 min / 5 s), a join interval of 30 days (reference:
30 min), documents per 30 min (reference: per minute). The operators take
the reference's values as defaults.
"""

DAU_DATE = "2024-01-15"
ORDER_DATE = "1996-06-15"
EMPTY_ORDER_DATE = "2030-01-01"
AS_OF = "2024-01-01 00:00:00"
SEEN_BEFORE_HOUR = "12"
WINDOW = "60 minutes"
SLIDE = "5 minutes"
WINDOW_MS = 60 * 60 * 1000
SLIDE_MS = 5 * 60 * 1000
DOC_BUCKET_MS = 30 * 60 * 1000
JOIN_INTERVAL = "30 days"
JOIN_INTERVAL_MS = 30 * 24 * 3600 * 1000
#: From when the second edition of the users holds (1998-01-01 UTC).
USERS_CHANGE_MS = 883_612_800_000
DOC_WRITER = "documents"
#: Slices in which the streamed queries' topics arrive.
SLICES = 4
#: State partitions of a new checkpoint, fixed from then on (None: one for each
#: core there is; a job sizes them by its state).
STATE_PARTITIONS = None
