"""Fixed values of the business: policies, thresholds, tables. Operators take them as arguments."""

from __future__ import annotations

from dataclasses import dataclass, field

# Service level -> safety factor Z, used by both replenishment models.
SERVICE_LEVEL_Z = {0.90: 1.28, 0.95: 1.65, 0.97: 1.88, 0.98: 2.05, 0.99: 2.33}


@dataclass(frozen=True)
class MenuTypes:
    """The values of the menu's type column."""

    mains: str = "主食"
    sides: str = "副食"
    desserts: str = "甜點"
    drinks: str = "酒水"
    # The types a drink is recommended for; without them mains and sides, so that desserts are left out.
    antecedents: tuple[str, ...] = ()

    @property
    def foods(self) -> tuple[str, ...]:
        return self.antecedents or (self.mains, self.sides)


ENGLISH_TYPES = MenuTypes("main", "side", "dessert", "drink")


@dataclass(frozen=True)
class RuleThresholds:
    min_support: str = "0.01"
    min_confidence: str = "0.05"


BUZZ_HOUR = 21
CLOSED_WEEKDAY = 0
PEAK_WEEKDAYS = (4, 5)
DAYPARTS = {"dinner": (17, 20), "buzz": (21, 24)}

# Fixed values: (food tag, drink id) that must not be paired, with the reason shown to staff.
TABOO = [
    ("Seafood", "W06", "Negroni 的金巴利苦味會蓋掉海鮮鮮甜,並帶出腥味"),
    ("Seafood", "W07", "Old Fashioned 的橡木桶與糖漿風味過重,壓過白肉魚"),
    ("Seafood", "W02", "卡本內蘇維翁單寧太強,與海鮮蛋白質作用會產生金屬味"),
    ("Seafood", "W11", "威士忌基調與海鮮衝突"),
    ("Dessert", "W09", "IPA 的苦度與甜點互相打架"),
    ("Dessert", "W10", "小麥啤酒的酵母味不適合搭甜點"),
    ("Dessert", "W02", "乾型紅酒配甜點會顯得更酸澀"),
]

# Fixed values: (food tag, drink tag) pairs that are allowed but less suited, with their factor.
SOFT_PENALTY = [
    ("Red_Meat", "Seafood", "0.75"),
    ("Seafood", "Red_Meat", "0.70"),
]

# Drink ids by category; alcohol-free drinks are told by their name.
COCKTAILS = ("W06", "W07", "W08", "W11", "W12")
BEERS = ("W09", "W10")
REDS = ("W01", "W02", "W07")
WINES = ("W01", "W02", "W03", "W04")
ALCOHOL_FREE_MARK = "無酒精"


@dataclass(frozen=True)
class HourFactors:
    """Late-evening score factors: cocktails up from 21h, still wines down from 23h."""

    cocktail_from: int = 21
    cocktail_factor: str = "1.20"
    wine_from: int = 23
    wine_factor: str = "0.70"


@dataclass(frozen=True)
class ProfitPolicy:
    """Replenishment by profit class (model A)."""

    abc_cuts: tuple[tuple[str, str], ...] = (("A", "0.70"), ("B", "0.90"))
    # Days an item keeps and days to delivery, by tag; drinks have their own.
    shelf_life: dict = field(
        default_factory=lambda: {
            "Seafood": 2,
            "Dessert": 3,
            "Red_Meat": 4,
            "Universal": 7,
            "Cheese": 14,
            "Fried": 30,
        }
    )
    lead_time: dict = field(
        default_factory=lambda: {
            "Seafood": 1,
            "Dessert": 1,
            "Red_Meat": 2,
            "Universal": 2,
            "Cheese": 3,
            "Fried": 3,
        }
    )
    drink_shelf_life: int = 365
    drink_lead_time: int = 5
    other_shelf_life: int = 7
    other_lead_time: int = 2
    service_level: dict = field(default_factory=lambda: {"A": 0.98, "B": 0.95, "C": 0.90})


@dataclass(frozen=True)
class SupplierDefaults:
    lead_time_days_avg: float
    lead_time_days_std: float
    moq: int
    pack_size: int
    payment_term_days: int


@dataclass(frozen=True)
class StockPolicy:
    """Replenishment by usage value and demand variation (model B)."""

    abc_cuts: tuple[tuple[str, str], ...] = (("A", "0.80"), ("B", "0.95"))
    x_below: str = "0.5"
    y_upto: str = "1.0"
    review_period_days: int = 1
    exception_threshold: str = "0.30"
    service_level: dict = field(default_factory=lambda: {"A": 0.98, "B": 0.95, "C": 0.90})
    review_cycle: dict = field(default_factory=lambda: {"A": 1, "B": 3, "C": 7})


# Supplier terms assumed per category until the real ones are known.
SUPPLIER_DEFAULTS = {
    "酒水": SupplierDefaults(5.0, 1.2, 12, 12, 45),
    "前菜": SupplierDefaults(2.0, 0.5, 20, 10, 30),
    "主餐": SupplierDefaults(2.0, 0.6, 10, 5, 30),
    "甜點": SupplierDefaults(1.0, 0.3, 12, 6, 30),
}
SUPPLIER_FALLBACK = SupplierDefaults(2.0, 0.5, 10, 1, 30)
SHELF_LIFE_BY_CATEGORY = {"酒水": 365, "前菜": 5, "主餐": 3, "甜點": 3}
SHELF_LIFE_FALLBACK = 5

ENGLISH_CATEGORIES = {"drink": "酒水", "side": "前菜", "main": "主餐", "dessert": "甜點"}


def in_english(table: dict) -> dict:
    """A table by category, keyed by the English category names."""
    return {english: table[name] for english, name in ENGLISH_CATEGORIES.items()}


# Share of revenue each cost line should lie in.
COST_BANDS = {
    "食材成本": ("0.28", "0.35"),
    "人事費用": ("0.25", "0.32"),
    "房租": ("0.08", "0.15"),
    "水電雜支": ("0.03", "0.06"),
    "行銷雜支": ("0.01", "0.03"),
}
ENGLISH_COST_BANDS = dict(zip(("food", "labour", "rent", "utilities", "marketing"), COST_BANDS.values()))

# Weights of the supplier score.
SCORE_WEIGHTS = {"on_time_rate": "0.35", "quality": "0.30", "price_competitiveness": "0.25", "payment_term": "0.10"}
FULL_PAYMENT_TERM_DAYS = 45
MISSING_METRIC = "0.5"

VARIANCE_THRESHOLD = "0.15"
ANOMALY_CONTAMINATION = 0.05
ANOMALY_MIN_ROWS = 60

MIN_VISITS = 2
MAX_SEGMENTS = 4
DRINK_RATIO_TARGET = "0.40"
UPSELL_FEATURES = ("party_size", "arrival_hour", "is_buzz_hour", "is_weekend", "is_repeat")
