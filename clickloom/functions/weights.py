"""Interaction scoring presets and the columns built from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scoring:
    """Points per interaction type, and the points of any other type."""

    points: Mapping[str, int]
    default: int = 1


@dataclass(frozen=True)
class FamilyRule:
    """Interaction types that count towards one behaviour family."""

    types: Sequence[str]
    family: str
    points: int


# The published scoring tables.
PREFERENCE = Scoring({"view": 1, "click": 2, "click_add_to_cart": 5, "recommendation_click": 3})
TRENDING = Scoring({"view": 1, "click": 3, "click_add_to_cart": 10})
ENGAGEMENT = Scoring({"view": 1, "click": 3, "purchase": 5})
INSTANT = Scoring({"click": 3, "product_click": 3, "view": 2, "product_view": 2})
CASCADE = (
    FamilyRule(("click", "product_click"), "clicked", 3),
    FamilyRule(("view", "product_view"), "viewed", 2),
    FamilyRule(("search",), "searched", 1),
    FamilyRule(("category_view",), "viewed", 1),
)
SIMPLE = (
    FamilyRule(("click", "view", "product_click", "product_view"), "clicked", 3),
    FamilyRule(("search",), "viewed", 1),
)
RECENCY = (
    FamilyRule(("click", "product_click", "recommendation_click"), "clicked", 15),
    FamilyRule(("view", "product_view"), "clicked", 12),
    FamilyRule(("search",), "viewed", 4),
)
ADD_TO_CART_BONUS = 5
CLICK_TYPES = ("click", "product_click")
VIEW_TYPES = ("view", "product_view")


def score_of(interaction_type: Column, scoring: Scoring) -> Column:
    """Points of an interaction type under a preset."""
    out = None
    for name, points in scoring.points.items():
        test = interaction_type == name
        out = F.when(test, F.lit(points)) if out is None else out.when(test, F.lit(points))
    return out.otherwise(F.lit(scoring.default)).cast("long")


def family_of(interaction_type: Column, rules: Sequence[FamilyRule]) -> Column:
    """Behaviour family of an interaction type, NULL when no rule matches."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(interaction_type.isin(*rule.types), F.lit(rule.family)).otherwise(out)
    return out


def family_points(interaction_type: Column, rules: Sequence[FamilyRule]) -> Column:
    """Points of an interaction type under family rules, 0 when none matches."""
    out = F.lit(0).cast("long")
    for rule in reversed(rules):
        out = F.when(
            interaction_type.isin(*rule.types), F.lit(rule.points).cast("long")
        ).otherwise(out)
    return out
