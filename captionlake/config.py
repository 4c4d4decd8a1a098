"""Thresholds of cues, chunk plans, polarity and quality checks; times are whole milliseconds."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class CueConfig:
    """Published subtitle timing rules."""

    cpl: int = 42
    lines: int = 2
    cps: int = 15
    min_ms: int = 1500
    max_ms: int = 7000
    floor_ms: int = 300
    pause_ms: int = 600
    long_pause_ms: int = 2000
    isolation_ms: int = 8000
    sentence_end: str = ".!?:;"
    soft_end: str = ",;:"
    gap_ms: int = 84
    butt_ms: int = 500
    vad_pad_ms: int = 300


@dataclass(frozen=True)
class PlanConfig:
    """Chunk length and the search for silent cut points."""

    target_ms: int = 600_000
    rest_ms: int = 150_000
    search_ms: int = 90_000
    least_ms: int = 300_000
    speech_ms: int = 30_000
    speech_share: float = 0.5


@dataclass(frozen=True)
class PolarityConfig:
    """Decibels and seconds of the polarity rules."""

    signal_db: float = -50.0
    margin_db: float = 6.0
    merge_sec: int = 3
    section_sec: int = 5
    drop_db: float = 10.0
    check_sec: int = 5
    per_sec: int = 20


@dataclass(frozen=True)
class QcConfig:
    """Quality flags."""

    omission_ms: int = 5000
    review_ms: int = 2000
    run_words: int = 10
    pad_ms: int = 300
    seam_words: int = 30
    words_per_min: int = 60
    score_m: int = 500
    sentence_words: int = 40


CUE, PLAN, POLARITY, QC = CueConfig(), PlanConfig(), PolarityConfig(), QcConfig()


def parse_threshold(text: str | None) -> float:
    """A score threshold as typed: empty is 0.5, one decimal comma is allowed, and it must lie in (0, 1]."""
    text = (text or "").strip()
    value = float(text.replace(",", ".", 1)) if text else 0.5
    if not 0 < value <= 1:
        raise ValueError(f"threshold {text!r} is not in (0, 1]")
    return value
