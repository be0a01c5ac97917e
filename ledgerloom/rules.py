"""Every date, threshold and lookup the job uses, in one frozen object."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from decimal import Decimal

# Texts, codes and limits the results must agree on.
PAYMENT_MODES = {"CASH": "Cash", "CARD": "Card", "UPI": "UPI"}
SETTLEMENT_MODES = {"Upi": "UPI", "Cash": "Cash", "Card": "Card"}
UNKNOWN_MODE = "Unknown"
BRAND_FIXES = {
    "ramraj cotton": "Ramraj Cotton",
    "rcm": "RCM",
    "sp apparels": "SP Apparels",
    "CO-OPTEX": "Co-optex",
}
GST_RATES = (0, 5, 12, 18, 28)
GST_DEFAULT = 18
GODOWN_ROLE = "Stock/Godown Staff"
STOCKOUT_EVENT = "Stockout"
SALARY_EXPENSES = ("Salary-Permanent", "Salary-Seasonal")
ORPHAN_EMPLOYEE = "Orphan Employee ID"
ORPHAN_STORE = "Orphan Store ID"
ORPHAN_PRODUCT = "Orphan Product ID"
FUTURE_DATE = "Future Date (Data Leakage)"
GODOWN_BILLING = "Billed by Godown Staff"
PROMO_WINDOW = "Promo Outside Valid Date Range"


@dataclass(frozen=True)
class Rules:
    as_of: date = date(2023, 12, 31)
    leakage_cutoff: date = date(2024, 1, 1)
    join_date_limit: date = date(2023, 12, 31)
    join_date_default: date = date(2023, 1, 1)
    date_formats: tuple[str, ...] = ("yyyy-MM-dd",)

    glitch_ratio: Decimal = Decimal("0.05")
    quantity_quantile: float = 0.99
    high_value_quantile: float = 0.95
    iqr_factor: float = 1.5
    salary_line: int = 30000
    bulk_quantity: int = 50
    cost_ratio: Decimal = Decimal("0.7")
    tolerance: Decimal = Decimal("0.01")
    spike_range: tuple[int, int] = (20, 80)
    rebound_range: tuple[int, int] = (-100, -20)
    sentinel_employee: int = -1

    payment_modes: dict[str, str] = field(default_factory=lambda: dict(PAYMENT_MODES))
    settlement_modes: dict[str, str] = field(default_factory=lambda: dict(SETTLEMENT_MODES))
    brand_fixes: dict[str, str] = field(default_factory=lambda: dict(BRAND_FIXES))
    gst_rates: tuple[int, ...] = GST_RATES
    gst_default: int = GST_DEFAULT

    surge_festival: str = "Deepavali"
    period_before: tuple[int, int] = (2018, 2019)
    period_after: tuple[int, int] = (2022, 2023)
