"""Event schema, page vocabulary and feature lists."""

from __future__ import annotations

from pyspark.sql import types as T

# Fields of a raw event as sent on the wire. ``length`` is the
# name some senders use for ``duration``.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("ts", T.LongType()),
        T.StructField("userId", T.StringType()),
        T.StructField("sessionId", T.LongType()),
        T.StructField("page", T.StringType()),
        T.StructField("auth", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("status", T.LongType()),
        T.StructField("level", T.StringType()),
        T.StructField("itemInSession", T.LongType()),
        T.StructField("location", T.StringType()),
        T.StructField("userAgent", T.StringType()),
        T.StructField("lastName", T.StringType()),
        T.StructField("firstName", T.StringType()),
        T.StructField("registration", T.LongType()),
        T.StructField("gender", T.StringType()),
        T.StructField("artist", T.StringType()),
        T.StructField("song", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("length", T.DoubleType()),
    ]
)

EVENT_KEY = ("userId", "ts", "sessionId")
SESSION_KEY = ("userId", "sessionId")

PLAY_PAGE = "NextSong"

# Position in this list is the page code; unknown pages take 0.
PAGE_VOCABULARY = (
    "<PAD>",
    "Home",
    "NextSong",
    "Thumbs Up",
    "Thumbs Down",
    "Add to Playlist",
    "Roll Advert",
    "Add Friend",
    "Logout",
    "Settings",
    "Help",
    "About",
    "Login",
    "Register",
    "Submit Registration",
    "Error",
    "Downgrade",
    "Submit Downgrade",
    "Upgrade",
    "Submit Upgrade",
    "Cancellation Confirmation",
    "Cancel",
    "Save Settings",
)

MAX_SESSION_LENGTH = 50
MIN_SESSION_LENGTH = 3

# Features watched for drift.
MONITOR_FEATURES = (
    "total_songs",
    "thumbs_down",
    "thumbs_up",
    "settings_visits",
    "help_visits",
    "total_sessions",
    "days_active",
    "dislike_ratio",
    "avg_sessions_per_day",
)

# Numeric inputs of the churn classifier. ``level`` and the
# counts that define the label stay out, or the label would leak.
CHURN_FEATURES = MONITOR_FEATURES

# What the extended feature set adds to the base set.
CHURN_EXTENDED_FEATURES = CHURN_FEATURES + (
    "error_visits",
    "error_rate",
    "social_actions",
    "like_dislike_ratio",
)

# Seeds of the repeated-split validation.
VALIDATION_SEEDS = (1, 7, 13, 42, 99, 123, 2024)
