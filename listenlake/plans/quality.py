"""Quality rules of the silver tables."""

from __future__ import annotations

from collections.abc import Sequence

from listenlake import fixed
from listenlake.operators.rules import Rule

# Reason texts and their order are read by downstream reports.

FACT_RULES = (
    Rule("Missing stream_id", "stream_id IS NULL"),
    Rule("Missing user_id", "user_id IS NULL"),
    Rule("Missing track_id", "track_id IS NULL"),
    Rule("Missing stream_timestamp", "stream_timestamp IS NULL"),
    Rule("Missing device_type", "device_type IS NULL"),
    Rule("Missing listen_duration", "listen_duration IS NULL"),
    Rule("Invalid listen_duration", "listen_duration <= 0"),
)

ARTIST_RULES = (
    Rule("artist_id is null", "artist_id IS NULL"),
    Rule("artist_name is null", "artist_name IS NULL"),
    Rule("genre is null", "genre IS NULL"),
    Rule("country is null", "country IS NULL"),
)

ARTIST_EXPECTATION = ("valid_artist_name", f"length(artist_name) >= {fixed.ARTIST_NAME_MIN}")

USER_EXPECTATIONS = {"rule_1": "user_id IS NOT NULL", "rule_2": "user_name IS NOT NULL"}

FACT_EXPECTATIONS = {"rule_1": "stream_id IS NOT NULL"}

# no validity interval can start without a date, so this one is hard
USER_START_RULE = Rule("Missing start_date", "start_date IS NULL AND updated_at IS NULL")

# events without a time have no place in a sequence
USER_SEQUENCE_RULE = Rule("Missing updated_at", "updated_at IS NULL")


def user_rules(plans: Sequence[str] = fixed.PLANS) -> tuple[Rule, ...]:
    """Short names and unknown plans are named as reasons but let the row pass."""
    known = ", ".join(f"'{p}'" for p in plans)
    return (
        Rule("Missing user_id", "user_id IS NULL"),
        Rule("Missing user_name", "user_name IS NULL"),
        Rule("Invalid user_name", f"length(user_name) <= {fixed.SHORT_NAME_UPTO}", hard=False),
        Rule("Missing country", "country IS NULL"),
        Rule("Missing subscription_type", "subscription_type IS NULL"),
        Rule("Invalid subscription_type", f"subscription_type NOT IN ({known})", hard=False),
    )
