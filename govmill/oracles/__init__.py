"""Checking queries in plain SQL, one per registered key, over the same fixture views."""

from __future__ import annotations

from pathlib import Path

from govmill.sources.fixtures import FIXTURES_SQL
from govmill.sources.sqlviews import load_views, with_clause

_HERE = Path(__file__).parent


def load_oracles() -> dict[str, str]:
    """``answers.sql`` holds one block per key; ``steps.sql`` holds the views they share."""
    views = load_views(FIXTURES_SQL) | load_views(str(_HERE / "steps.sql"))
    return {key: with_clause(sql, views) for key, sql in load_views(str(_HERE / "answers.sql")).items()}
