"""Matches of fixed patterns as (start, end) code points, and their digests."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable


def runs(pattern: str, flags: int = 0, keep: Callable[[re.Match], bool] | None = None):
    """A finder of the leftmost matches that don't overlap; those that fail ``keep`` are dropped."""
    find = re.compile(pattern, flags).finditer

    def spans(text: str) -> list[tuple[int, int]]:
        return [m.span() for m in find(text) if keep is None or keep(m)]
    return spans


def joined(found: Iterable[tuple[int, int, int]], kinds: list[str]) -> str:
    """kind:start:end of (start, kind number, end), by start and then kind, comma-joined."""
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(found))


def sha256(text: str | bytes) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text).hexdigest()
