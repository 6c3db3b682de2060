"""Categories, bands and display text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed_values as fv


def comparison_category(phrase: Column) -> Column:
    """A feed's comparison phrase to one of five categories."""
    text = F.lower(phrase)
    result = None
    for category, prefixes in fv.COMPARISON_PREFIXES.items():
        hit = reduce(lambda a, b: a | b, [text.startswith(p) for p in prefixes])
        result = F.when(hit, category) if result is None else result.when(hit, category)
    return result.when(text.contains(fv.TOO_FEW_PHRASE), "too_few_cases").otherwise("not_available")


def is_rated(score: Column, category: Column) -> Column:
    return F.coalesce(score.isNotNull() & category.isin(fv.RATED_CATEGORIES), F.lit(False))


def ownership_group(owner: Column) -> Column:
    government = owner.startswith(fv.GOVERNMENT_PREFIX) | owner.isin(fv.GOVERNMENT_OWNERS)
    return (F.when(owner.startswith(fv.NON_PROFIT_PREFIX), "Non-profit")
             .when(owner == fv.FOR_PROFIT_OWNER, "For-profit")
             .when(government, "Government")
             .when(owner == fv.PHYSICIAN_OWNER, "Physician-owned")
             .otherwise("Other"))


def is_star_item(item: Column) -> Column:
    return item.endswith(fv.STAR_ITEM_SUFFIX)


def outcome_tier(composite: Column) -> Column:
    tier = F.when(composite.isNull(), fv.NO_TIER)
    for floor, name in fv.TIER_FLOORS:
        tier = tier.when(composite >= floor, name)
    return tier.otherwise(fv.LOWEST_TIER)


def only_with_support(value: Column, n: Column, at_least: int) -> Column:
    """The value where at least ``at_least`` observations stand behind it."""
    return F.when(n >= at_least, value)


def star_glyphs(stars: Column) -> Column:
    n = stars.cast("int")
    filled = F.when(n > 5, 5).when(n < 0, 0).otherwise(n)
    glyphs = F.concat(F.repeat(F.lit("★"), filled), F.repeat(F.lit("☆"), F.lit(5) - filled))
    return F.coalesce(glyphs, F.lit("—"))


def change_text(change: Column) -> Column:
    size = F.abs(change).cast("int").cast("string")
    return (F.when(change > 0, F.concat(F.lit("▲ "), size))
             .when(change < 0, F.concat(F.lit("▼ "), size))
             .otherwise(""))


def rating_label(rating: Column) -> Column:
    return F.coalesce(F.concat(rating.cast("string"), F.lit(" ★")), F.lit("Not rated"))


def hash_prefix(digest: Column, length: int = 12) -> Column:
    return F.substring(digest, 1, length)
