"""Words by the rule of the queries, for plain counting in tests."""

from __future__ import annotations


def split_words(text: str | None) -> list[str]:
    """Split on bytes, so that other white space stays inside words."""
    return [w.decode() for w in (text or "").encode().split()]
