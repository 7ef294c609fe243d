"""Parameters of the operators, as frozen dataclasses passed in by the caller."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values -----------------------------------------------------------
# Winsorising bounds per signal (inclusive).
CLIP_RANGES = {
    "hr": (30.0, 220.0),
    "sbp": (60.0, 240.0),
    "dbp": (30.0, 140.0),
    "spo2": (70.0, 100.0),
    "wbc": (0.5, 60.0),
    "creatinine": (0.2, 12.0),
    "lactate": (0.2, 20.0),
}
# Soft bounds used by the quality checks: values outside are flagged, not changed.
SOFT_RANGES = {
    "hr": (20.0, 220.0),
    "sbp": (50.0, 250.0),
    "spo2": (0.0, 100.0),
    "rr": (5.0, 60.0),
    "temp_c": (30.0, 45.0),
    "wbc": (0.0, 50.0),
    "creatinine": (0.2, 10.0),
    "lactate": (0.0, 15.0),
}
SEX_VALUES = ("M", "F")
OUTCOME_TYPES = ("ICU_TRANSFER", "RRT")
TOOLTIP_COLUMNS = (
    "age", "sex_m", "comorbidity_count", "admit_acuity", "diabetes", "ckd", "copd", "chf",
    "hr_mean_6h", "hr_last_6h", "hr_count_6h", "spo2_min_6h",
    "lactate_mean_6h", "lactate_count_6h", "creatinine_last_6h",
    "hr_mean_24h", "spo2_min_24h", "lactate_mean_24h", "creatinine_last_24h",
)
# ----------------------------------------------------------------------------

KEYS = ("patient_id", "admission_id")
ANCHOR_KEYS = (*KEYS, "anchor_time")


@dataclass(frozen=True)
class TimeGrid:
    """Regular grid of anchors over each stay, and the trailing windows behind them."""

    cadence_h: int = 4
    warmup_h: int = 0
    windows_h: tuple[int, ...] = (6, 12, 24)
    start: str = "admit_time"
    end: str = "discharge_time"

    def __post_init__(self) -> None:
        if self.cadence_h <= 0 or self.warmup_h < 0 or not self.windows_h or min(self.windows_h) <= 0:
            raise ValueError("cadence and windows must be positive, warm-up not negative")


@dataclass(frozen=True)
class Horizon:
    """Label horizon behind an anchor: open at min_h, closed at max_h."""

    min_h: int = 24
    max_h: int = 48

    def __post_init__(self) -> None:
        if not self.min_h < self.max_h:
            raise ValueError("min_h must be below max_h")


@dataclass(frozen=True)
class SplitFractions:
    train: float = 0.70
    val: float = 0.15

    @property
    def cuts(self) -> tuple[int, int]:
        """Upper bucket bounds (of 100) of the train and the validation part."""
        if self.train < 0 or self.val < 0 or self.train + self.val > 1 + 1e-9:
            raise ValueError("fractions must not be negative or add up to more than one")
        return round(self.train * 100), round((self.train + self.val) * 100)


@dataclass(frozen=True)
class AlertPolicy:
    rates: tuple[float, ...] = (0.05, 0.10, 0.20)
    primary: float = 0.10


@dataclass(frozen=True)
class BandCutoffs:
    high: float = 0.80
    medium: float = 0.50


@dataclass(frozen=True)
class DashboardSpec:
    rows: int = 50_000
    alerted_fraction: float = 0.50
    alert_rate: float = 0.10
    seed: int = 42
    tiles: int = 10
    bands: BandCutoffs = field(default_factory=BandCutoffs)
    tooltips: tuple[str, ...] = TOOLTIP_COLUMNS


@dataclass(frozen=True)
class SignalStats:
    """The statistics wanted for one signal, e.g. ``SignalStats("hr", ("mean", "last"))``."""

    signal: str
    stats: tuple[str, ...]


# The default feature set: seven statistics per window.
DEFAULT_VITAL_STATS = (
    SignalStats("hr", ("mean", "last", "count")),
    SignalStats("spo2", ("min",)),
)
DEFAULT_LAB_STATS = (
    SignalStats("lactate", ("mean", "count")),
    SignalStats("creatinine", ("last",)),
)
