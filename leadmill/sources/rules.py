"""Scoring rules."""

from __future__ import annotations

import json
from pathlib import Path


def load_scoring_rules(path: str | Path) -> dict:
    """Read the rules from a JSON settings file on the driver (tens of rules)."""
    return json.loads(Path(path).read_text(encoding="utf-8"))
