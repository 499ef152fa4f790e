"""Every threshold, list and label the operators read, as plain dataclasses."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace
from typing import Any

# ---------------------------------------------------------------------------
# Feed layout, thresholds, lists and labels that results depend on.
# ---------------------------------------------------------------------------

COLUMN_MAP = {
    "InvoiceNo": "invoice_no",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_ts",
    "UnitPrice": "unit_price",
    "CustomerID": "customer_id",
    "Country": "country",
}

# Month and day may come with one digit or two, as may the hour.
DATE_FORMAT = "M/d/yyyy H:mm"

# Texts a CSV field may hold to say "no value".
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

NON_PRODUCT_CODES = (
    "POST", "DOT", "M", "C2", "S", "BANK CHARGES", "AMAZONFEE", "CRUK", "PADS",
    "B", "D",
)

ROSTER = {
    "Category Management": 18,
    "Merchandising": 14,
    "Online Trading": 11,
    "Marketing": 9,
    "Store Ops": 10,
}

DOMESTIC = ("United Kingdom",)

EUROPE = (
    "Austria", "Belgium", "Channel Islands", "Cyprus", "Czech Republic",
    "Denmark", "EIRE", "European Community", "Finland", "France", "Germany",
    "Greece", "Iceland", "Italy", "Lithuania", "Malta", "Netherlands", "Norway",
    "Poland", "Portugal", "Spain", "Sweden", "Switzerland",
)

REGION_LABELS = {
    "domestic": "1. United Kingdom",
    "europe": "2. Europe",
    "rest": "3. Rest of world",
    "unspecified": "4. Unspecified",
}

# Lower bound of each band, inclusive; a band ends where the next one begins.
PRICE_BANDS = (
    (0.0, "1. Under GBP 1"),
    (1.0, "2. GBP 1 - 2.50"),
    (2.5, "3. GBP 2.50 - 5"),
    (5.0, "4. GBP 5 - 10"),
    (10.0, "5. GBP 10+"),
)

# Revenue percentile a customer must exceed to enter each segment.
SEGMENTS = (
    (0.90, "1. Top 10%"),
    (0.70, "2. Next 20%"),
    (0.40, "3. Middle 30%"),
)
LAST_SEGMENT = "4. Bottom 40%"
GUEST_SEGMENT = "5. Guest checkout"

ENTITLEMENTS = (
    ("uk.analyst@example.com", "United Kingdom"),
    ("eire.analyst@example.com", "EIRE"),
    ("dach.analyst@example.com", "Germany"),
    ("dach.analyst@example.com", "Austria"),
    ("dach.analyst@example.com", "Switzerland"),
    ("emea.analyst@example.com", "France"),
    ("emea.analyst@example.com", "Spain"),
    ("emea.analyst@example.com", "Netherlands"),
    ("emea.analyst@example.com", "Belgium"),
    ("groupbi@example.com", "*"),
)

NO_DATA_MESSAGE = "No sales in the selected period. The retailer is shut on Saturdays."

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Extract:
    column_map: dict[str, str] = field(default_factory=lambda: dict(COLUMN_MAP))
    date_format: str = DATE_FORMAT
    na_tokens: tuple[str, ...] = NA_TOKENS
    # Fields may hold line breaks; each file is then read by one task.
    multi_line: bool = False
    # The share of records that may be unreadable and are then kept aside; None: none may.
    max_reject_rate: float | None = None


@dataclass(frozen=True)
class Quality:
    min_unit_price: float = 0.01
    max_unit_price: float = 1000.0
    non_product_codes: tuple[str, ...] = NON_PRODUCT_CODES
    max_quarantine_rate: float = 0.30


@dataclass(frozen=True)
class Recommend:
    min_support_count: int = 30
    min_confidence: float = 0.10
    min_lift: float = 1.0
    top_n: int = 5
    # None pairs the items of baskets of any size.
    max_basket_size: int | None = 60
    # Fewer usable descriptions than this give no text matches.
    min_catalogue: int = 5


@dataclass(frozen=True)
class Adoption:
    roster: dict[str, int] = field(default_factory=lambda: dict(ROSTER))
    active_window_weeks: int = 4
    analysis_as_of: str | None = None
    csat_scale: tuple[int, int] = (1, 5)
    target_reach_pct: float | None = 70.0
    target_action_rate_pct: float | None = 25.0
    target_csat: float | None = 4.0


@dataclass(frozen=True)
class Semantic:
    domestic: tuple[str, ...] = DOMESTIC
    europe: tuple[str, ...] = EUROPE
    unspecified: tuple[str, ...] = ("Unspecified",)
    entitlements: tuple[tuple[str, str], ...] = ENTITLEMENTS


@dataclass(frozen=True)
class Settings:
    extract: Extract = field(default_factory=Extract)
    quality: Quality = field(default_factory=Quality)
    recommend: Recommend = field(default_factory=Recommend)
    adoption: Adoption = field(default_factory=Adoption)
    semantic: Semantic = field(default_factory=Semantic)

    @classmethod
    def from_dict(cls, sections: dict[str, dict[str, Any]]) -> Settings:
        """Settings from nested dicts, e.g. a parsed YAML file.

        Keys a section does not know are refused, so a misspelt threshold
        cannot silently leave the default in force.
        """
        built = cls()
        for name, values in sections.items():
            section = getattr(built, name, None)
            if section is None:
                raise ValueError(f"unknown settings section: {name}")
            known = {f.name for f in fields(section)}
            unknown = sorted(set(values) - known)
            if unknown:
                raise ValueError(f"unknown setting(s) in {name}: {', '.join(unknown)}")
            typed = {k: tuple(v) if isinstance(v, list) else v for k, v in values.items()}
            built = replace(built, **{name: replace(section, **typed)})
        return built
