"""Settings as frozen values; an override merges into them, nothing global changes."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields, replace


@dataclass(frozen=True)
class Split:
    train_ratio: float = 0.70
    test_ratio: float = 0.15
    holdout_ratio: float = 0.15
    random_state: int = 42
    time_col: str | None = None
    valid_months: int = 3
    min_valid_samples: int = 50


@dataclass(frozen=True)
class Eda:
    missing_threshold: float = 0.5
    psi_stable: float = 0.1
    psi_warning: float = 0.25
    corr_threshold: float = 0.7
    vif_threshold: float = 10.0
    monotone_spearman_min: float = 0.6
    woe_bins: int = 10


@dataclass(frozen=True)
class Model:
    primary_metric: str = "ks"
    cv_folds: int = 5
    trials: int = 50
    tune: bool = False
    tune_trees: tuple[int, int] = (100, 500)
    importance: bool = True
    woe_missing_min_samples: int = 50
    monotone: bool = True
    monotone_min_abs_corr: float = 0.02
    lr_c: float = 1.0
    scorecard: dict = field(default_factory=lambda: {"pdo": 20.0, "base": 600.0, "base_odds": 1 / 15})
    booster: dict = field(default_factory=lambda: {"trees": 80, "depth": 2})


@dataclass(frozen=True)
class Strategy:
    rule_max_coverage: float = 0.05
    rule_min_lift: float = 2.0
    rule_min_hit_count: int = 5
    rule_max_lift_drop: float = 0.35
    rule_overlap_threshold: float = 0.8
    tree_max_depth: int = 3
    tree_max_features: int = 3
    tree_min_samples_leaf: int = 50
    score_reject_quantile: float = 0.95
    score_review_quantile: float = 0.85
    segment_features: tuple[str, ...] = ("channel", "region")
    segment_min_samples: int = 50
    segment_use_discrimination_filter: bool = True
    reject_rate_grid: tuple[float, ...] = (0.03, 0.05, 0.08, 0.10)
    review_rate_grid: tuple[float, ...] = (0.05, 0.10, 0.15)
    segment_reject_rate_grid: tuple[float, ...] = (0.03, 0.05, 0.08)
    segment_min_valid_hits: int = 10
    segment_min_lift: float = 2.0
    segment_max_lift_gap: float = 0.5


@dataclass(frozen=True)
class Config:
    split: Split = field(default_factory=Split)
    eda: Eda = field(default_factory=Eda)
    model: Model = field(default_factory=Model)
    strategy: Strategy = field(default_factory=Strategy)

    def override(self, given: dict) -> Config:
        """A section's values replaced one by one, dictionaries merged; an unknown section or value is a KeyError."""
        if not isinstance(given, dict):
            raise ValueError("an override is an object of sections")
        out = self
        for section, values in given.items():
            if section not in {f.name for f in fields(self)}:
                raise KeyError(section)
            if not isinstance(values, dict):
                raise ValueError(f"section {section} is an object")
            old = getattr(out, section)
            if unknown := set(values) - {f.name for f in fields(old)}:
                raise KeyError(f"{section}: {sorted(unknown)}")
            merged = {k: {**getattr(old, k), **v} if isinstance(v, dict) else tuple(v) if isinstance(v, list) else v for k, v in values.items()}
            out = replace(out, **{section: replace(old, **merged)})
        return out

    def snapshot(self) -> str:
        return json.dumps(asdict(self), indent=2)
