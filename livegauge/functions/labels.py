"""Platforms, grades, trends and the text of a report line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from livegauge.settings import DEFAULTS, Settings

# Fixed values of the report format.
SIGN_WITHIN = "🔸 "
SIGN_LOW = "✖️ "
SIGN_HIGH = "✔️ "
SYMBOL_UP = "🟢 +"
SYMBOL_DOWN = "🔴 "
SYMBOL_FLAT = "🟡 "
HEADER = "⭐️ Online Streams: ⭐️"
NOBODY_LIVE = "❌ Not Online Streams:"

# Fixed patterns that assign a link to a section of the report; the dot matches any character.
SECTIONS = {"youtube": "youtu.be", "twitch": "twitch.tv"}


def platform_of(link: Column) -> Column:
    return F.when(link.like("%youtu%"), "youtube").when(link.like("%twitch%"), "twitch")


def sections_of(link: Column) -> Column:
    """Every section the link belongs to; empty for other links and for NULL."""
    return F.array_compact(
        F.array(*[F.when(link.rlike(pattern), F.lit(name)) for name, pattern in SECTIONS.items()])
    )


def grade(rate: Column, settings: Settings = DEFAULTS) -> Column:
    return (
        F.when((rate > settings.grade_low) & (rate < settings.grade_high), "within")
        .when(rate <= settings.grade_low, "low")
        .otherwise("high")
    )


def trend(diff: Column) -> Column:
    return F.when(diff > 0, "up").when(diff < 0, "down").otherwise("flat")


def line(name: Column, link: Column, online: Column, diff: Column, grade: Column, trend: Column) -> Column:
    sign = F.when(grade == "within", SIGN_WITHIN).when(grade == "low", SIGN_LOW).otherwise(SIGN_HIGH)
    symbol = F.when(trend == "up", SYMBOL_UP).when(trend == "down", SYMBOL_DOWN).otherwise(SYMBOL_FLAT)
    return F.concat(
        sign, F.lit(" ["), F.coalesce(name, F.lit("None")), F.lit("]("), link, F.lit(") [["), online.cast("string"), F.lit("]] "),
        symbol, diff.cast("string"),
    )


def message(flag: Column, youtube: Column, twitch: Column) -> Column:
    """Header and one block of lines per platform, or the notice that nobody is live."""
    blocks = F.concat_ws(
        "\n\n", F.lit(HEADER), F.coalesce(youtube, F.lit("")), F.coalesce(twitch, F.lit(""))
    )
    return F.when(flag == 0, NOBODY_LIVE).otherwise(blocks)
