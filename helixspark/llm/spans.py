"""Text spans found in documents: digests and replacement."""

from __future__ import annotations

import hashlib

# A span is (start, end, kind number): code points, end exclusive.
Span = tuple[int, int, int]


def listed(spans: list[Span], kinds: tuple[str, ...]) -> str:
    """``kind:start:end`` by start, then kind order, comma-joined."""
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2], s[1])))


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def replaced(text: str, spans: list[Span], kinds: tuple[str, ...]) -> str:
    """``text`` with each span, overlapping ones joined, replaced by ``[kind]`` of its first."""
    out, at = [], 0
    for a, b, k in sorted(spans, key=lambda s: (s[0], -s[1], s[2])):
        if a >= at:
            out += [text[at:a], f"[{kinds[k]}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])
