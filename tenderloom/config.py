"""Settings and vocabulary of the core operators, as frozen values that each operator takes as parameters."""

from __future__ import annotations

import os
from dataclasses import dataclass


def env_int(name: str, fallback: int) -> int:
    """A positive integer from the environment, else ``fallback``."""
    try:
        value = int(os.environ.get(name, ""))
    except ValueError:
        return fallback
    return value if value > 0 else fallback


# Patterns of position codes and the vocabulary of the line and block filters.
THREE_PART = r"\d{2}\.\d{2}\.\d{3,5}"
FIVE_PART = r"[A-Z]{2}\.\d{2}\.\d{2}\.\d{2}\.\d{2}"
PREAMBLE = r"00\.00\.00\.\d{2}\.\d{2}"
CANCELLED_MARKERS = ("entf[äa]llt", "not applicable", "n/a", "cancelled", "voided", "omitted", "sans objet", "supprim", "soppress", "annull", "anulad")
COLUMN_WORDS = ("EUR", "PP", "EP", "SO", "ST", "LO", "LM")
DEFAULT_HEADING = "General Requirements"


@dataclass(frozen=True)
class Profiling:
    sample_min: int = 30
    sample_max: int = 60
    sample_share: float = 0.1
    ligature_limit: float = 0.01
    repeated_share: float = 0.6
    positions_over: int = 5
    preambles_over: int = 10


@dataclass(frozen=True)
class Layout:
    line_tolerance: float = 0.5
    word_gap: float = 0.25
    default_size: float = 10.0


@dataclass(frozen=True)
class Chunking:
    heading_ratio: float = 1.2
    heading_length: int = 60
    chars_per_token: int = 4
    token_limit: int = 3000


@dataclass(frozen=True)
class Linking:
    full_pairwise: int = 300
    threshold: float = 0.5
    per_block: int = 25
    total: int = 600
