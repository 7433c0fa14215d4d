"""Named SELECT statements kept in ``.sql`` files and joined into one WITH query on demand."""

from __future__ import annotations

import re
from functools import cache
from pathlib import Path

_NAME = re.compile(r"^-- view: (\w+)\s*$", re.MULTILINE)
_WORD = re.compile(r"\b\w+\b")


@cache
def load_views(path: str) -> dict[str, str]:
    """Read ``-- view: name`` blocks, in file order."""
    parts = _NAME.split(Path(path).read_text())[1:]
    return {name: body.strip() for name, body in zip(parts[::2], parts[1::2])}


def with_clause(sql: str, views: dict[str, str]) -> str:
    """Prefix ``sql`` with the views it needs, directly or through other views."""
    needed: set[str] = set()
    todo = [w for w in set(_WORD.findall(sql)) if w in views]
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo += [w for w in set(_WORD.findall(views[name])) if w in views and w != name]
    ctes = ",\n".join(f"{name} AS (\n{views[name]}\n)" for name in views if name in needed)
    return f"WITH {ctes}\n{sql}" if ctes else sql
