"""Parameters of the jobs."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    bucket_minutes: int = 10
    trigger_seconds: int = 600  # of a stream that stays up: as often as the periodic tasks run
    lookback_days: int = 2  # calendar days before the day of as_of
    window_days: int = 15
    z: float = 1.96
    min_rank_online: int = 5  # a row must exceed it to take part in picking the newest batch
    min_online: int = 15
    min_rate: int = -350
    missing_rate: int = -500
    grade_low: int = -50
    grade_high: int = 30
    fresh_minutes: int = 10
    dedupe_channels: bool = False
    rates_by_value: bool = False  # a name's rates only on rows of the count they were computed for


@dataclass(frozen=True)
class PagePatterns:
    """What marks a live page and where its link and count are."""

    # Fixed values of the platform's page format.
    live_marker: str = "hqdefault_live.jpg"
    watch_url: str = "https://www.youtube.com/watch"
    id_offset: int = 32  # length of https://www.youtube.com/watch?v=
    short_url: str = "https://youtu.be/"
    count_token: str = "originalViewCount"
    count_prefix: str = '"originalViewCount":"'
    count_suffix: str = '"}}'


DEFAULTS = Settings()
PAGE_PATTERNS = PagePatterns()
