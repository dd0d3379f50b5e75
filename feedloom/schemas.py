"""Schemas of landed payloads, the feedback table and model output."""

from __future__ import annotations

from collections.abc import Sequence

# Other systems read these names, so they stay as they are.
CATEGORIES = (
    "gameplay_mechanics",
    "matchmaking_game_balance",
    "game_performance",
    "replayability",
    "character",
    "monetization",
    "bugs_glitches_techissues",
    "graphics_audio",
    "suggestion_feedback",
    "account_issues",
    "cheating_hacking",
    "toxicity",
    "player_retention",
    "onboarding",
)
SENTIMENTS = ("positive", "negative", "neutral")
STEAM = "Steam Review"
PLAY = "Google Play Review"
FORUM = "Reddit Comment"
FORUM_ALIAS = "Reddit Post"
PLAY_LANGUAGES = ("en", "fr", "es", "ja", "ko", "zh", "pt", "hi")
AUTHOR_FIELDS = (
    "steamid",
    "num_reviews",
    "num_games_owned",
    "last_played",
    "playtime_forever",
    "playtime_at_review",
    "playtime_at_last_two_weeks",
)
# Payloads have this field under another name than the tables.
AUTHOR_KEYS = {"playtime_at_last_two_weeks": "playtime_last_two_weeks"}
STEAM_METADATA = (
    "author",
    "comment_count",
    "language",
    "received_for_free",
    "steam_purchase",
    "timestamp_created",
    "timestamp_updated",
    "voted_up",
    "votes_funny",
    "votes_up",
    "weighted_vote_score",
    "written_during_early_access",
    "primarily_steam_deck",
)
PLAY_METADATA = (
    "userImage",
    "score",
    "thumbsUpCount",
    "reviewCreatedVersion",
    "replyContent",
    "repliedAt",
    "appVersion",
)
FORUM_METADATA = ("post_id", "score", "post_title", "post_text")
FORUM_BASE_URL = "https://reddit.com"

# Landed payloads, as DDL. Every field is nullable.
STEAM_REVIEW = (
    "author map<string,string>, comment_count bigint, language string, "
    "received_for_free boolean, recommendationid string, review string, "
    "steam_purchase boolean, timestamp_created bigint, timestamp_updated bigint, "
    "voted_up boolean, votes_funny bigint, votes_up bigint, weighted_vote_score string, "
    "written_during_early_access boolean, primarily_steam_deck boolean"
)
STEAM_PAGE = f"reviews array<struct<{STEAM_REVIEW}>>, cursor string"
PLAY_REVIEW = (
    "reviewId string, userName string, userImage string, content string, score int, "
    "thumbsUpCount bigint, reviewCreatedVersion string, at timestamp, "
    "replyContent string, repliedAt timestamp, appVersion string, language string"
)
FORUM_POST = (
    "id string, title string, score int, created_utc timestamp, num_comments int, "
    "author string, url string, permalink string, selftext string, subreddit string"
)
FORUM_COMMENT = (
    "post_id string, comment_id string, body string, author string, score int, "
    "created_utc timestamp"
)

# The one schema every source is mapped onto, and the bronze table holds. This and the column
# lists below are fixed values too: other systems read these tables.
FEEDBACK = (
    "content_id string, content_type string, game_name string, content_text string, "
    "timestamp timestamp, author_id string, content_metadata string"
)
FEEDBACK_COLUMNS = tuple(field.split()[0] for field in FEEDBACK.split(", "))


def extraction_ddl(categories: Sequence[str] = CATEGORIES) -> str:
    """Shape of the JSON an extraction model must answer with."""
    if len(set(categories)) != len(categories):
        raise ValueError("category names must be unique")
    per_category = [f"`{c}` struct<sentiment string, sub_topic string>" for c in categories]
    fields = ["overall string", "summary string", *per_category]
    return ", ".join([*fields, "other array<struct<topic string, sentiment string>>"])


def parsed_ddl(categories: Sequence[str] = CATEGORIES) -> str:
    """Columns of the parsed table: items, two columns per category, the rest."""
    per_category = [f"`{c}` string, `{c}_sub_topic` string" for c in categories]
    return ", ".join(
        [
            "content_id string, game_name string, author_id string, content_text string",
            "translated_content_text string, content_type string, timestamp timestamp",
            "overall string, summary string",
            *per_category,
            "other array<struct<topic string, sentiment string>>, content_metadata string",
        ]
    )


TRANSLATED = f"{FEEDBACK}, translated_content_text string"
EXTRACTED = f"{TRANSLATED}, content_topic string"
ITEMS = (
    "content_id string, game_name string, content_text string, "
    "translated_content_text string, content_type string, author_id string, "
    "timestamp timestamp, overall_sentiment string, ai_summary string, content_metadata string"
)
TOPICS = (
    "content_id string, game_name string, category string, sentiment string, sub_category string"
)
