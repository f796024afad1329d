"""Run parameters and fixed values of the scoring model."""
from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    """Everything a scoring run depends on besides its input tables.

    ``processing_date`` is the run date D; history covers ``[D - window_days, D]``.
    ``fixed_start`` is where the extraction with a fixed start begins.
    ``constants`` are c1..c5 (drawn once per processing date in production,
    injected in tests so results are reproducible).
    """

    processing_date: _dt.date = _dt.date(2001, 8, 1)
    window_days: int = 729
    fixed_start: _dt.date = _dt.date(1998, 1, 1)
    min_max_constant: float = 0.01
    international_type_id: int = 4
    excluded_supplier: str | None = None
    constants: dict = field(default_factory=lambda: dict(CONSTANTS))

    @property
    def window_start(self) -> _dt.date:
        return self.processing_date - _dt.timedelta(days=self.window_days)

    def c(self, name: str) -> float:
        return float(self.constants[name])



# ---------------------------------------------------------------------------
# Fixed values — these must equal the scoring model's published settings.
# ---------------------------------------------------------------------------

# Level cut points (right-closed): (-1, 250] -> 1, (250, 400] -> 2, (400, 800] -> 3.
LEVEL_BOUNDS = ((1, -1.0, 250.0), (2, 250.0, 400.0), (3, 400.0, 800.0))
# Score range of each level: level -> (min score, max score).
LEVEL_RANGE = {1: (0, 250), 2: (251, 400), 3: (401, 800)}

# Linear maps from a weighted sum s to the 0..800 scale.
PAIR_SCALE = (3.0, 133.3333)                      # (s + 3) * 133.3333
INTERNATIONAL_SCALE = (57.0, 2.7708333333333335)  # (s + 57) * 2.7708333333333335
SUPPLIER_PAIR_SCALE = (3.0, 133.33)               # (s + 3) * 133.33
AGG_SCALE = (3.0, 133.3333)                       # supplier aggregate and group score

# Test constants c1..c5 (production draws c1, c2 in U(0,1), c3..c5 in U(-1,1)).
CONSTANTS = {"c1": 0.35, "c2": 0.6, "c3": -0.4, "c4": 0.25, "c5": 0.1}

# The 19 pair metrics that are weighted into a pair score, in model order.
PAIR_METRICS = (
    "total_invoice", "paid_invoice", "unpaid_invoice", "open_ar", "aging_balance",
    "outstanding_balance", "payment_timeliness_ratio", "late_payment_ratio_lt10",
    "late_payment_ratio_gt10", "dbt", "payment_cycle", "delinquent_payment_lt10",
    "delinquent_overdueday_lt10", "delinquent_payment_gt10", "delinquent_overdueday_gt10",
    "chargeback_freq", "chargeback_vol_amt", "overdue_chargebacks", "early_chargeback",
)

# Pair weights used when data-driven weights are not possible, same order as PAIR_METRICS.
PAIR_FIXED_WEIGHTS = (
    0.3, 0.3, 0, -0.5, -0.05, 0, 0.33, 1, -0.33, -1, -0.3, 0.14, 0.1, -0.2, -0.2, 0, -0.07, -0.06, 0,
)
# Group (ndg) weights for the same branch, same order.
GROUP_FIXED_WEIGHTS = (
    0.68, 0.31, 0, -1, -1, 0, 0.21, 1, -0.09327659717169373, -0.01, -0.01, 0.14, 0.11,
    -0.07, -0.06, 0, -0.07, -0.06, 0,
)
# Sign sets for data-driven weights (customer and group level).
POSITIVE_METRICS = (
    "paid_invoice", "total_invoice", "payment_timeliness_ratio", "delinquent_payment_lt10",
    "delinquent_overdueday_lt10",
)
NEGATIVE_METRICS = (
    "open_ar", "aging_balance", "outstanding_balance", "late_payment_ratio_gt10", "dbt",
    "payment_cycle", "delinquent_payment_gt10", "delinquent_overdueday_gt10",
    "chargeback_vol_amt", "overdue_chargebacks",
)
ZEROED_METRICS = ("unpaid_invoice", "chargeback_freq", "early_chargeback")

# Supplier metrics weighted into a supplier score, and their sign sets.
SUPPLIER_METRICS = (
    "total_invoice", "total_ar", "unapplied_amount", "open_payable", "open_credit_memo",
    "other_open_payables", "cash_balance", "wallet", "risk_balance", "customer_score",
)
SUPPLIER_NEGATIVE = ("open_payable", "open_credit_memo", "other_open_payables")
SUPPLIER_POSITIVE = ("total_invoice", "total_ar", "risk_balance", "wallet", "unapplied_amount")
# Weights injected instead of fitted ones in tests: positive .4, negative -.3, free .2.
SUPPLIER_TEST_WEIGHTS = {m: (0.4 if m in SUPPLIER_POSITIVE else -0.3 if m in SUPPLIER_NEGATIVE else 0.2)
                         for m in SUPPLIER_METRICS}

# Customer aggregate score metrics: the 19 without these four.
CUSTOMER_AGG_EXCLUDED = ("unpaid_invoice", "delinquent_payment_lt10", "chargeback_freq", "early_chargeback")
CUSTOMER_AGG_METRICS = tuple(m for m in PAIR_METRICS if m not in CUSTOMER_AGG_EXCLUDED)

# Aggregation spec for customer / group roll-ups: these are averaged, dbt and
# payment_cycle are invoice-weighted, every other numeric pair metric is summed.
MEAN_METRICS = (
    "early_payment_perc", "early_payment_days", "aging_balance", "delinquent_overdueday_lt10",
    "delinquent_overdueday_gt10", "payment_predictor", "timeliness_of_chargeback", "w_o_open_cb",
    "payment1_percent", "payment2_percent", "payment2_percent_wo_cb",
)

# Weight of an override reason that has none stored (the reasons themselves are an input table).
DEFAULT_REASON_WEIGHT = 0.1

DEFAULT = Params()
