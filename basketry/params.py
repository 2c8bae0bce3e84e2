"""Parameters of the jobs. Every date, threshold and word list a job depends on is here."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Territory codes of each sales region. Codes in no list are UNKNOWN.
REGION_CODES = {
    "Midwest": ("IA", "IL", "IN", "KS", "MI", "MN", "MO", "ND", "NE", "OH", "SD", "WI"),
    "Northeast": ("ME", "NH", "NJ", "NY", "PA", "RI", "VT"),
    "South": (
        "AL", "AR", "DC", "DE", "FL", "GA", "KY", "LA", "MD",
        "MS", "NC", "OK", "SC", "TN", "TX", "VA", "WV",
    ),
    "West": (
        "AK", "AZ", "CA", "CO", "HI", "ID", "MT",
        "NM", "NV", "OR", "UT", "WA", "WY",
    ),
}
UNKNOWN_REGION = "UNKNOWN"

# Days before and after a life-stage event during which it counts.
LIFE_STAGE_DAYS = {
    "WEDDING": (547, 365),
    "NEW MOVER": (60, 300),
    "BABY": (90, 1095),
    "RETIREMENT": (304, 1367),
}
# Flag column of each life-stage event.
LIFE_STAGE_FLAGS = {
    "WEDDING": "WEDDING",
    "NEW MOVER": "MOVER",
    "BABY": "BABY",
    "RETIREMENT": "RETIREMENT",
}

# Model features, in model order.
FEATURES = (
    "BBB_INSTORE_M_DECILE_2Y",
    "A_AAP000447N_ASET_PRPN_DIS_INC",
    "time_interval",
    "PH_DM_RECENCY",
    "AVG_NET_SALES_PER_TXN",
    "COUPON_SALES_Q_08",
    "A_A3101N_RACE_WHITE",
    "BBB_R_2Y",
    "MOVER",
    "NUM_MERCH_DIVISIONS",
    "AVG_TOTAL_ITEMS_PER_TXN",
    "A_A8588N_HM_SQR_FT",
    "PH_MREDEEM730D_PERC",
)
# Fill value by part of the feature name; the first match wins, else FILL_DEFAULT.
FILL_RULES = (("DECILE", 11.0), ("_R_2Y", 720.0), ("RECENCY", 365.0))
FILL_DEFAULT = 0.0


@dataclass(frozen=True)
class PairParams:
    """Type and SKU pairs."""

    as_of: dt.date
    window_months: int = 6
    concept_format_id: int = 1
    min_types: int = 2
    rank_limit: int = 50
    reference_ranks: int = 4
    region_codes: dict = field(default_factory=lambda: dict(REGION_CODES))

    @property
    def regions(self) -> tuple[str, ...]:
        return (*self.region_codes, UNKNOWN_REGION)


@dataclass(frozen=True)
class FactorParams:
    """Implicit-feedback matrix factorization."""

    rank: int = 10
    reg_param: float = 0.1
    alpha: float = 1.0
    max_iter: int = 10
    seed: int = 42
    min_support: int = 1
    parallelism: int = 5
    # Blocks of users; None takes the cluster's parallelism. There are few items, so few blocks of them.
    user_blocks: int | None = None
    item_blocks: int = 8


@dataclass(frozen=True)
class ReactivationParams:
    """Purchases of returning customers and the features known before them."""

    as_of: dt.date
    window_months: int = 12
    concept_format_id: int = 1
    min_gap_days: int = 365
    max_gap_days: int = 720
    earliest_previous: dt.date = dt.date(2017, 1, 1)
    top_types: int = 100
    keep_null_type: bool = True
    period_lag_months: int = 3
    sale_types: tuple[str, ...] = ("S", "M")
    # Features and events after the day of the run don't count in scoring; False takes the tables as they are.
    known_only: bool = True
    lapsed_days: int = 365
    at_risk_days: int = 183


@dataclass(frozen=True)
class TreeParams:
    """One boosted-tree classifier per product type.

    method "histogram" grows the trees of all types at once, with a share of the features per tree and l2; "node" fits
    one model after the other, with a share of the features per node and without l2.
    """

    learning_rate: float = 0.01
    trees: int = 1000
    max_depth: int = 5
    min_gain: float = 0.0
    row_share: float = 0.9
    feature_share: float = 0.6
    positive_weight: float = 1.0
    seed: int = 42
    train_share: float = 0.6
    calibration: str = "isotonic"
    parallelism: int = 8
    checkpoint_interval: int = 10
    method: str = "histogram"
    l2: float = 1.0

    def __post_init__(self):
        if not 0 < self.learning_rate < 1:
            raise ValueError(f"learning_rate must lie between 0 and 1: {self.learning_rate}")
        if self.trees <= 0:
            raise ValueError(f"trees must be positive: {self.trees}")
        if self.parallelism <= 0:
            raise ValueError(f"parallelism must be positive: {self.parallelism}")
        if not 0 < self.train_share <= 1:
            raise ValueError(f"train_share must lie in (0, 1]: {self.train_share}")
        if self.method not in ("histogram", "node"):
            raise ValueError(f"unknown method: {self.method}")
        if self.calibration not in ("none", "isotonic"):
            raise ValueError(f"unknown calibration: {self.calibration}")


@dataclass(frozen=True)
class ClusterParams:
    """K-means over the score vectors; clusters=None takes log10 of the row count, 2 at least, which changes what
    a cluster means as the table grows. With candidates the number of them with the best silhouette is taken, each
    fitted from `starts` seeds, `parallelism` fits at a time."""

    clusters: int | None = 4
    standardize: bool = True
    max_iter: int = 20
    seed: int = 42
    candidates: tuple[int, ...] = ()
    starts: int = 3
    parallelism: int = 4

    def __post_init__(self):
        if any(k < 2 for k in self.candidates):
            raise ValueError(f"clusters to choose from must be 2 at least: {self.candidates}")
        if self.starts <= 0:
            raise ValueError(f"starts must be positive: {self.starts}")
