"""Small scalar columns used by several operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom.model import PRICE_EDGES, PRICE_LABELS

# Browser event type -> interaction type.
BROWSER_TYPES = {
    "click": ("product_card_click", "product_link_click", "recommendation_click", "action_button_click"),
    "view": ("product_view", "page_load"),
    "search": ("search_submit",),
}


def price_band(
    price: Column, edges: Sequence[float] = PRICE_EDGES, labels: Sequence[str] = PRICE_LABELS
) -> Column:
    """Label of the price range; NULL for a missing or non-numeric price."""
    value = price.try_cast("double")
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        out = out.when(value < edge, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def normalised_type(event_type: Column) -> Column:
    """Browser event type -> click / view / search / other."""
    out = F.lit("other")
    for name, types in BROWSER_TYPES.items():
        out = F.when(event_type.isin(*types), F.lit(name)).otherwise(out)
    return out


def product_id_of(data: Column) -> Column:
    """First numeric id under the keys a payload may carry it in."""
    names = ("product_id", "product", "id")
    return F.coalesce(*[F.try_element_at(data, F.lit(n)).try_cast("long") for n in names])


def payload_map(payload: Column) -> Column:
    """JSON object text as map<string,string>; other text becomes {info: text}."""
    parsed = F.from_json(payload, "map<string,string>")
    broken = parsed.isNull() | ~F.ltrim(payload).startswith("{")
    return F.when(payload.isNull(), F.create_map().cast("map<string,string>")).when(
        broken, F.create_map(F.lit("info"), payload)
    ).otherwise(parsed)


def exact_money(price: Column) -> Column:
    """Price as a decimal, so sums do not depend on the order of the rows."""
    return price.cast("decimal(18,4)")


def ratio(total: Column, count: Column) -> Column:
    """``total / count`` as a double, NULL when there is nothing to count."""
    return F.when(count > 0, total.cast("double") / count)


def contains_click(interaction_type: Column) -> Column:
    return interaction_type.contains("click")
