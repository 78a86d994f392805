"""Frozen configuration dataclasses.

Every stage takes an optional config object; defaults reproduce the
reference behaviour.  Override per call with ``dataclasses.replace``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# These must equal the reference's settings for equal results.
# Risk weights (interval width, forecast error, historical volatility,
# calibration penalty), risk percentile bounds, per-level action texts,
# interventions and stock buffer percentiles, cost rates, sensitivity sweeps,
# calibration levels and the volatility percentile.
# ---------------------------------------------------------------------------
RISK_WEIGHTS = {
    "interval_width": 0.30,
    "forecast_error": 0.25,
    "historical_volatility": 0.25,
    "calibration_penalty": 0.20,
}
RISK_LOW_MAX_PCT = 0.60
RISK_MEDIUM_MAX_PCT = 0.85
RISK_ACTIONS = {
    "Low": "Standard replenishment. Order predicted quantity.",
    "Medium": "Increase safety stock moderately. Monitor demand closely.",
    "High": "Increase safety stock significantly. Increase replenishment frequency.",
}
RISK_INTERVENTIONS = {
    "Low": "No intervention required.",
    "Medium": "Review supplier lead time.",
    "High": "Notify planners immediately. Escalate to supply chain manager.",
}
RISK_BUFFER_PCT = {"Low": 0.50, "Medium": 0.75, "High": 0.95}
ROOT_CAUSE_LOW = "Demand is stable and predictable."
ROOT_CAUSE_TEMPLATE = "High uncertainty driven by {}."
ROOT_CAUSE_FACTORS = (  # tie order: first listed wins
    ("comp_volat", "volatile historical demand"),
    ("comp_error", "large historical forecast errors"),
    ("comp_calib", "poor historical calibration for this segment"),
    ("comp_width", "exceptionally wide prediction intervals"),
)
HOLDING_COST_RATE = 0.05
STOCKOUT_PENALTY_RATE = 0.40
HIGH_VOLATILITY_PCT = 0.75
SENSITIVITY_HOLDING_RATES = (0.02, 0.05, 0.10, 0.15)
SENSITIVITY_STOCKOUT_RATES = (0.10, 0.40, 0.80, 1.20)
CONFIDENCE_LEVELS = (0.50, 0.80, 0.90, 0.95)
QR_NATIVE_LEVEL = 0.90
CONFORMAL_ALPHA = 0.10
QUANTILES = (0.05, 0.50, 0.95)
LAGS = (7, 14, 28)
ROLLING_MEAN_WINDOWS = (7, 14, 28)
ROLLING_STD_WINDOWS = (7, 28)
EVENT_TYPES = ("Sporting", "Cultural", "National", "Religious")
NO_EVENT = "no_event"
ZERO_RATE_BOUNDS = (0.60, 0.80)
PRICE_EPS = 1e-6
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class PanelConfig:
    """How the item-store-day panel is cut out of the shipment tables."""

    start_date: str = "1999-11-02"  # day_index 1
    n_days: int = 730               # day_index 1..n_days
    train_end: int = 674
    val_end: int = 702
    # day columns of the wide table (the last ones of the window)
    wide_days: int = 28

    @classmethod
    def spanning(cls, first, last, eval_days: int = 28) -> "PanelConfig":
        """The window from ``first`` to ``last`` (dates, inclusive): its last
        ``eval_days`` are the test split, those before them the validation split."""
        n = (last - first).days + 1
        return cls(first.isoformat(), n, max(0, n - 2 * eval_days), max(0, n - eval_days), n)


@dataclass(frozen=True)
class FeatureConfig:
    lags: tuple = LAGS
    rolling_mean_windows: tuple = ROLLING_MEAN_WINDOWS
    rolling_std_windows: tuple = ROLLING_STD_WINDOWS
    rolling_min_periods: int = 1
    event_types: tuple = EVENT_TYPES
    causal_price_mean: bool = False
    point_window: int = 28          # point forecast = rolling_mean_<point_window>


@dataclass(frozen=True)
class UncertaintyConfig:
    alpha: float = CONFORMAL_ALPHA
    quantiles: tuple = QUANTILES
    calibration_split: str = "val"
    eval_split: str = "test"
    confidence_levels: tuple = CONFIDENCE_LEVELS
    qr_native_level: float = QR_NATIVE_LEVEL
    volatility_pct: float = HIGH_VOLATILITY_PCT
    # "auto"   -> exact percentile up to 5M rows, exact distributed selection above;
    # "exact"  -> percentile (value->count map merged in one task);
    # "select" -> exact distributed selection (bounded memory, a few passes);
    # "approx" -> percentile_approx
    quantile_mode: str = "select"
    approx_accuracy: int = 100_000


@dataclass(frozen=True)
class DecisionConfig:
    weights: dict = field(default_factory=lambda: dict(RISK_WEIGHTS))
    low_max_pct: float = RISK_LOW_MAX_PCT
    medium_max_pct: float = RISK_MEDIUM_MAX_PCT
    actions: dict = field(default_factory=lambda: dict(RISK_ACTIONS))
    interventions: dict = field(default_factory=lambda: dict(RISK_INTERVENTIONS))
    buffer_pct: dict = field(default_factory=lambda: dict(RISK_BUFFER_PCT))
    calibration_method: str = "Conformal"


@dataclass(frozen=True)
class SimulationConfig:
    holding_rate: float = HOLDING_COST_RATE
    stockout_rate: float = STOCKOUT_PENALTY_RATE
    high_volatility_pct: float = HIGH_VOLATILITY_PCT
    holding_rates: tuple = SENSITIVITY_HOLDING_RATES
    stockout_rates: tuple = SENSITIVITY_STOCKOUT_RATES


@dataclass(frozen=True)
class EngineConfig:
    panel: PanelConfig | None = None  # None: the whole span of the tables' dates
    features: FeatureConfig = field(default_factory=FeatureConfig)
    uncertainty: UncertaintyConfig = field(default_factory=UncertaintyConfig)
    decision: DecisionConfig = field(default_factory=DecisionConfig)
    simulation: SimulationConfig = field(default_factory=SimulationConfig)


DEFAULT = EngineConfig()
