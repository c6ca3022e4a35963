"""Which collected snapshot of a day is promoted."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from velora.sources.objects import ObjectStore

FINAL, PRELIMINARY = "FINAL", "PRELIMINARY"
NORMAL, DEGRADED = "NORMAL", "DEGRADED"
#: Fixed value: minutes that a preliminary snapshot may be old.
MAX_AGE = 120


@dataclass(frozen=True)
class Candidate:
    day: date
    kind: str
    cutoff: datetime
    collected_at: datetime
    hours: int
    has_payload: bool = True


@dataclass(frozen=True)
class Choice:
    candidate: Candidate | None
    reason: str


def choose(candidates: list[Candidate], day: date, cutoff: datetime, now: datetime) -> Choice:
    """The final snapshot of the exact cut-off; else the newest fresh preliminary one of the run's day or the day before."""
    mine = [c for c in candidates if c.day == day]
    if not mine:
        return Choice(None, "NO_CANDIDATE")
    whole = [c for c in mine if c.has_payload]
    if not whole:
        return Choice(None, "PAYLOAD_MISSING")
    final = [c for c in whole if c.kind == FINAL and c.cutoff == cutoff]
    if final:
        return Choice(max(final, key=lambda c: c.collected_at), "FINAL_SELECTED")
    early = [c for c in whole if c.kind == PRELIMINARY]
    if not early:
        return Choice(None, "FINAL_CUTOFF_MISMATCH")
    if day not in (now.date(), now.date() - timedelta(days=1)):
        return Choice(None, "PRELIMINARY_NOT_ALLOWED")
    fresh = [c for c in early if c.collected_at.date() == now.date() and now - c.collected_at <= timedelta(minutes=MAX_AGE)]
    if not fresh:
        return Choice(None, "PRELIMINARY_STALE")
    return Choice(max(fresh, key=lambda c: c.collected_at), "PRELIMINARY_SELECTED")


def manifest_problem(manifest: Mapping, day: date, kind: str, hours: Sequence[int]) -> str | None:
    """Why a manifest is no candidate for a day and kind; None if it is one."""
    if manifest.get("target_date") != day.isoformat():
        return "DATE_MISMATCH"
    if manifest.get("snapshot_type") != kind:
        return "TYPE_MISMATCH"
    if manifest.get("status") != "COMPLETE":
        return "NOT_COMPLETE"
    if sorted(manifest.get("hours", ())) != sorted(hours):
        return "HOURS_MISSING"
    if not isinstance(manifest.get("rows"), int) or manifest["rows"] < 0:
        return "ROWS_INVALID"
    return None


def listed_candidates(store: ObjectStore, dataset: str, day: date) -> list[Candidate]:
    """The candidates under a day's prefix: a manifest of each collection, and whether its payload is there."""
    prefix, out = f"raw/{dataset}/{day.isoformat()}", []
    for name in store.keys(prefix):
        doc = store.get_json(f"{prefix}/{name}/manifest.json") if store.exists(f"{prefix}/{name}/manifest.json") else None
        if doc is None or manifest_problem(doc, day, doc.get("snapshot_type"), doc.get("hours", ())) is not None:
            continue
        out.append(Candidate(day, doc["snapshot_type"], datetime.fromisoformat(doc["cutoff"]), datetime.fromisoformat(doc["collected_at"]), len(doc["hours"]), store.exists(f"{prefix}/{name}/payload.json")))
    return out


@dataclass(frozen=True)
class Selection:
    chosen: dict[date, Candidate]
    missing: dict[date, str]

    @property
    def complete(self) -> bool:
        """Whether every required day has a snapshot; nothing is promoted in part."""
        return not self.missing

    @property
    def mode(self) -> str:
        return DEGRADED if any(c.kind == PRELIMINARY for c in self.chosen.values()) else NORMAL


def choose_all(required: Sequence[date], candidates: Sequence[Candidate], cutoff: datetime, now: datetime, fallback: bool = True) -> Selection:
    """A choice for every required day; without ``fallback`` only final snapshots count."""
    allowed = candidates if fallback else [c for c in candidates if c.kind == FINAL]
    choices = {day: choose(list(allowed), day, cutoff, now) for day in required}
    return Selection({d: c.candidate for d, c in choices.items() if c.candidate}, {d: c.reason for d, c in choices.items() if not c.candidate})


def inherited_mode(mode: str | None, kind: str) -> str:
    """A day is degraded if its promotion was or if its own snapshot is preliminary."""
    return DEGRADED if mode == DEGRADED or kind == PRELIMINARY else NORMAL


def collection_windows(watermark: date, cutoff: datetime) -> list[tuple[date, list[int]]]:
    """All hours of the days after the watermark, and the current day's hours before the cut-off."""
    out, day = [], watermark + timedelta(days=1)
    while day < cutoff.date():
        out.append((day, list(range(24))))
        day += timedelta(days=1)
    if cutoff.hour and day == cutoff.date():
        out.append((day, list(range(cutoff.hour))))
    return out


def completion_status(promoted_rows: int | None, manifest_rows: int | None) -> str:
    """COMPLETE from a promotion, COMPLETE_EMPTY from a manifest without rows, else FAILED."""
    if promoted_rows:
        return "COMPLETE"
    return "COMPLETE_EMPTY" if manifest_rows == 0 else "FAILED"
