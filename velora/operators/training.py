"""Checks of a training run's inputs, and evaluation day by day."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velora.operators.ranking import capture_at_k, capture_summary


def input_problems(end: date, window: int, months: Sequence[str], have: Sequence[str], ready_until: date, least_window: int = 7) -> list[str]:
    """What stops a training run: an end beyond the ready labels, too short a window, or months without data."""
    wrong = []
    if end > ready_until:
        wrong.append(f"labels are ready until {ready_until}, before {end}")
    if window < least_window:
        wrong.append(f"a window of {window} days is shorter than {least_window}")
    missing = sorted(set(months) - set(have))
    return wrong + ([f"months without data: {missing}"] if missing else [])


def months_between(first: date, last: date) -> list[str]:
    """All months of the closed range as ``yyyy-mm``."""
    out, at = [], first.replace(day=1)
    while at <= last:
        out.append(at.strftime("%Y-%m"))
        at = (at + timedelta(days=32)).replace(day=1)
    return out


def walk_forward(samples: DataFrame, folds: Sequence[tuple[Sequence[date], Sequence[date]]], fit: Callable[[DataFrame], Callable[[DataFrame], DataFrame]], k: int, day: str = "snapshot_date", key: str = "bike_id") -> list[dict]:
    """For each fold (anchors to train on, later anchors to evaluate) a model and its capture of positives among the k best.

    ``fit`` gets the training rows and returns a function that adds ``score``; an anchor to evaluate must lie behind all
    anchors to train on, so no fold sees its own future.
    """
    out = []
    for train, held in folds:
        if max(train) >= min(held):
            raise ValueError(f"anchors up to {max(train)} cannot train a model for {min(held)}")
        on = lambda days: samples.where(F.col(day).isin(*days))
        scored = fit(on(train))(on(held).where("NOT excluded"))
        capture = capture_at_k(scored, scored.where("label = 1").select(day, key), k, day, key)
        out.append({"train": len(train), "held": len(held)} | capture_summary(capture).first().asDict())
    return out
