"""Thresholds of the page, text and section operators, passed as literals."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Triage:
    """Page routing."""

    min_chars: int = 120
    dense_chars: int = 600
    blank_chars: int = 15
    max_mojibake: float = 0.02
    big_image: float = 0.55
    hybrid_image: float = 0.25
    blank_image: float = 0.05
    blank_drawings: int = 20
    vector_paths: int = 400
    doc_scanned: float = 0.85
    doc_digital: float = 0.05


@dataclass(frozen=True)
class Gate:
    """Acceptance of recognised text."""

    min_words: int = 40
    min_conf: float = 0.72
    max_symbols: float = 0.25
    long_token: int = 30
    repeat_run: int = 8


@dataclass(frozen=True)
class Section:
    """Section quality."""

    long_token: int = 28
    too_short: int = 250
    too_long: int = 25_000
    table_digits: float = 0.25
    least_paragraphs: int = 5
    window: int = 2_000
    furniture_share: float = 0.35
    furniture_pages: int = 4
    orphan_gate: float = 0.03


TRIAGE, GATE, SECTION = Triage(), Gate(), Section()
