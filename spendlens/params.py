"""Every constant a run depends on, in one immutable object."""

from __future__ import annotations

from dataclasses import dataclass, field

# Category names, platform names, plans and dates of the national programme.
PLANS = (3, 6, 12, 18, 24)
RESIDUAL_CATEGORIES = ("First Data E-Commerce", "Otros")
ECOMMERCE_CATEGORY = "First Data E-Commerce"
APPLIANCES = ("Pequeños electrodomésticos", "Línea Blanca", "Televisores")
APPLIANCES_NAME = "Electrodomésticos"
TOOLS = "Máquinas y Herramientas"
BUILDING_MATERIALS = "Materiales para la construcción"
DOMINANT_SELLER = "Mercado Libre"


@dataclass(frozen=True)
class Params:
    """Defaults are the programme's own; dates are ISO first-of-month strings."""

    cutoff: str = "2022-08-01"
    plans: tuple[int, ...] = PLANS
    residual_categories: tuple[str, ...] = RESIDUAL_CATEGORIES
    ecommerce_category: str = ECOMMERCE_CATEGORY
    synonyms: dict[str, str] = field(default_factory=lambda: {TOOLS: BUILDING_MATERIALS})
    merges: dict[str, str] = field(default_factory=lambda: dict.fromkeys(APPLIANCES, APPLIANCES_NAME))
    dominant_platform: str = DOMINANT_SELLER
    dominant_aggregator: str = DOMINANT_SELLER
    fill_plan: int = 24
    fill_after: str = "2021-08-01"
    early_until: str = "2020-09-01"
    backcast_from: str = "2015-01-01"
    backcast_to: str = "2020-03-01"
    actual_from: str = "2020-04-01"
    recent_from: str = "2020-01-01"
    accumulate_from: str = "2021-01-01"
    years: tuple[int, int] = (2021, 2022)
    new_month: str = "2021-08-01"
    base_month: str | None = None  # None: the month before today's
    series_plans: tuple[int, ...] = (3, 6, 12, 18)
    ratio_plans: tuple[int, int] = (18, 3)
    top_categories: int = 7
    top_merchants: int = 10
    listing_rows: int | None = None  # rows of the registry listings; None: all
    allocated_brand: str = "allocated"
    operations_top_year: int | None = None  # None: each year is ranked by its own operations
    amount_weight: str = "operations"  # share that splits a merchant's e-commerce amount
