"""Names in statements."""

from __future__ import annotations


def quoted(name: str) -> str:
    """A name, with or without its database, safe to stand in a statement."""
    if name.startswith("`"):
        return name
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))
