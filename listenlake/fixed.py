"""Labels, thresholds and column lists that results must carry exactly."""

# Play classification. Shares of the track's duration: 0.2 and 0.5, as exact fractions.
MEANINGFUL_SHARE = (1, 5)
PARTIAL_SHARE = (1, 2)
ABANDONED = "Abandoned"
SKIPPED = "Skipped"
PARTIAL = "partial"
COMPLETED = "Completed"

# Engagement tiers: lowest score that earns the tier, best tier first.
TIER_CUTS = (("Platinum", 20), ("Gold", 10), ("Silver", 5))
TIER_FLOOR = "Bronze"

# Engagement score weights.
MEANINGFUL_WEIGHT = 2
ABANDONED_WEIGHT = 3

# Track duration buckets, in seconds.
DURATION_LOW_BELOW = 150
DURATION_MEDIUM_UPTO = 300

# Quality rules for users and artists.
PLANS = ("Premium", "Free", "Family")
SHORT_NAME_UPTO = 2
ARTIST_NAME_MIN = 3

# Columns a later fact event may change on an existing fact row.
FACT_UPDATE_COLS = ("date_key", "listen_duration", "device_type")

# Columns whose change opens a new user version.
USER_TRACKED_COLS = ("user_name", "country", "subscription_type")

# Rows kept by the top-track and leaderboard views.
TOP_N = 10

# Files one micro-batch takes at most.
MAX_FILES = 1000
