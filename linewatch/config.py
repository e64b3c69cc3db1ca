"""Settings shared by training, scoring and monitoring."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # The defaults the results depend on.
    shift_rows: int = 10
    rolling_rows: int = 5
    raw_train_share: float = 0.85
    test_share: float = 0.15
    folds: int = 3
    seed: int = 42
    contamination: float = 0.01
    drift_delta: float = 0.01
    drift_sample_rows: int = 1000
    ewma_alpha: float = 0.01
    ewma_every: int = 50
    log_rows: int = 100
    kept_predictions: int = 1000
    latest_predictions: int = 100
    board_kept: int = 500
    board_rows: int = 20
    publish_interval_seconds: int = 30
    trees: tuple[int, ...] = (200, 400)
    depths: tuple[int, ...] = (6, 10)
    learning_rates: tuple[float, ...] = (0.1,)

    # Ours: rows in one ordered bucket, and whether the row counter is a feature.
    bucket_rows: int = 10_000
    include_row_id_feature: bool = True


DEFAULTS = Settings()
