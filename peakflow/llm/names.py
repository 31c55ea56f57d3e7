"""Column names that stay clear of those a caller's table has."""

from __future__ import annotations


def free_names(taken: list[str], *wanted: str) -> list[str]:
    """The wanted names, each with underscores in front until no column has it (in any case)."""
    used, out = {t.lower() for t in taken}, []
    for name in wanted:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out
