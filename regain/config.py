"""Thresholds, weights, word patterns and labels used by the operators.

Every number that enters money arithmetic is a ``Decimal``: a float literal would turn exact
decimal columns into doubles and could reorder customers whose scores tie.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

# ---------------------------------------------------------------------------------------------
# Thresholds, weights, cut-offs, patterns and labels the results depend on.
# ---------------------------------------------------------------------------------------------

BEHIND_PCT = Decimal("0.10")
QUIET_GAP_MULTIPLE = 4
RHYTHM_MIN_INVOICES = 5
MIN_LOST_PROFIT = Decimal("1000")
MIN_BRAND_PROFIT = Decimal("1000")
BRAND_DROP_PCT = Decimal("0.80")
MIN_PRODUCT_PROFIT = Decimal("250")
SHARP_DROP_PCT = Decimal("0.25")
WEIGHT_EARLY_WARNING = Decimal("1.0")
WEIGHT_DECLINING = Decimal("0.7")
WEIGHT_RECOVERING = Decimal("0.4")
HEADER_TOLERANCE = Decimal("0.01")
HOUSE_REP_ID = "HSE"

# Customer PO text that names consignment: a (mis)spelt "consign" word, or a known abbreviation.
CONSIGN_WORD = r"\bCO[MN]?S[IOG][A-Z]*"
CONSIGN_ABBREVIATION = (
    r"\b(CON|CONS|CONT|COS|CONN|CONB|CONBILL|CONBILLING|CONTFER|CONTRASNFER|CONTRA?N?S?F?E?R?)\b"
)
PAYMENT_WORD = r"\bPAYMENT\b"
STOCK_MOVE = r"TRANSFER|TRANSFR|XFER|STOCK|RETURN|MOVE"

# Header-only invoices: customer PO pattern -> line type, first match wins.
SERVICE_CHARGE_SOURCE = "SR"
HEADER_PATTERNS = (
    (r"SERV\w*\s*CH", "service_charge"),
    (r"SURCHARGE|\bFEE\b|FREIGHT|HANDLING", "surcharge_fee"),
    (r"PRE\W*BUY|PRE\W*PA?Y|PREPMT|DEPOSIT", "prebuy_prepayment"),
    (r"REBATE|LOYAL|SPIF|PROPERKS|ICP", "rebate_loyalty"),
    (r"BAD\W*DEBT|WRITE\W*OFF", "bad_debt"),
    (r"AR\W*ADJ|\bADJ", "ar_adjustment"),
    (r"\bACH\b|\bCHE?C?K\b|PAYMENT|\bPMT\b", "payment_correction"),
)
CHARGE_TYPES = ("service_charge", "surcharge_fee")
REBATE_TYPE = "rebate_loyalty"
ZERO_TYPE = "other_zero_dollar"
OTHER_HEADER_TYPE = "other_adjustment"

# Text the source system saved twice through the wrong encoding: (garbled, intended), in order.
TEXT_REPAIRS = (
    ("\u00e2\u0080\u0099", "'"),
    ("\u00c3\u00a1", "á"),
    ("\u00c3\u00a8", "è"),
    ("\u00c2\u00a0", " "),
    ("\u00a0", " "),
    ("\u0000", ""),
)

# Source files: table -> file name pattern.
EXTRACT_PATTERNS = {
    "sales": "sales_*.txt",
    "orders": "orders_*.txt",
    "purchases": "purch_*.txt",
    "products": "proddata*.txt",
    "customers": "custdata.txt",
    "inventory": "invendata.txt",
    "branches": "branchdata.txt",
    "buylines": "blinedata.txt",
    "gltypes": "gltypedata.txt",
    "salespeople": "slspdata.txt",
}

HOUSE_LABEL = "House account (executive team)"
NO_REP_LABEL = "No dedicated rep"
TYPE_LABELS = {
    "early_warning": "Early warning",
    "declining": "Declining",
    "recovering": "Recovering",
}
STATUS_REPLACED = "Likely replaced"
STATUS_IN_STOCK = "In stock"
STATUS_NOT_IN_STOCK = "Sold, not in stock"


@dataclass(frozen=True)
class Settings:
    """One run's settings. A run covers one company; ``company_id`` is stamped on every row."""

    company_id: str = "company_1"

    behind_pct: Decimal = BEHIND_PCT
    quiet_gap_multiple: int = QUIET_GAP_MULTIPLE
    rhythm_min_invoices: int = RHYTHM_MIN_INVOICES
    min_lost_profit: Decimal = MIN_LOST_PROFIT
    min_brand_profit: Decimal = MIN_BRAND_PROFIT
    brand_drop_pct: Decimal = BRAND_DROP_PCT
    min_product_profit: Decimal = MIN_PRODUCT_PROFIT
    sharp_drop_pct: Decimal = SHARP_DROP_PCT
    weight_early_warning: Decimal = WEIGHT_EARLY_WARNING
    weight_declining: Decimal = WEIGHT_DECLINING
    weight_recovering: Decimal = WEIGHT_RECOVERING

    # The words that name line types and header-only invoices; another company writes others.
    consign_word: str = CONSIGN_WORD
    consign_abbreviation: str = CONSIGN_ABBREVIATION
    payment_word: str = PAYMENT_WORD
    stock_move: str = STOCK_MOVE
    header_patterns: tuple = HEADER_PATTERNS
    # Whether a marker field of spaces only counts as empty.
    trim_markers: bool = False

    header_tolerance: Decimal = HEADER_TOLERANCE
    house_rep_id: str = HOUSE_REP_ID

    # Recoverability: (cut-off, factor) by multiple of the customer's own gap, then by plain days.
    gap_steps: tuple = ((2, Decimal("1.0")), (4, Decimal("0.8")))
    day_steps: tuple = ((90, Decimal("1.0")), (365, Decimal("0.8")))
    cold_factor: Decimal = Decimal("0.5")

    top_brands_in_reason: int = 3
