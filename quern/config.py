"""Policies and thresholds of the click pipeline; every operator takes them as parameters."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ClickPolicy:
    """``no_click_position`` marks rows without a click; None counts every row as a click."""

    no_click_position: int | None = 0
    position_cap: int = 100


@dataclass(frozen=True)
class QualityThresholds:
    high: float = 0.80
    medium: float = 0.60
    high_min_clicks: int = 3
    max_words: int = 20
    max_chars: int = 200


@dataclass(frozen=True)
class SplitConfig:
    seed: int = 42
    valid_fraction: float = 0.20
    min_stratum: int = 5
    rare_max_clicks: int = 2
    medium_max_clicks: int = 20
    short_max_words: int = 2
    middle_max_words: int = 5
