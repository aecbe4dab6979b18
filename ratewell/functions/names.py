"""Column-name cleaning."""

from __future__ import annotations

import re
from collections.abc import Iterable


def snake(names: Iterable[str]) -> list[str]:
    """Lower-case snake names; repeats get a numeric suffix."""
    seen: dict[str, int] = {}
    cleaned = []
    for name in names:
        text = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name.strip())
        text = text.replace("%", "_percent_").replace("#", "_number_")
        text = re.sub(r"[^0-9A-Za-z]+", "_", text).strip("_").lower() or "x"
        if text[0].isdigit():
            text = "x" + text
        seen[text] = seen.get(text, 0) + 1
        cleaned.append(text if seen[text] == 1 else f"{text}_{seen[text]}")
    return cleaned


def matching(names: Iterable[str], wanted: str) -> str | None:
    """The first column equal to ``wanted`` once spaces and case are ignored."""
    target = wanted.replace(" ", "").lower()
    return next((n for n in names if n.replace(" ", "").lower() == target), None)
