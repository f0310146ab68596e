"""Packing by plain loops, for comparison."""

import re


def packed_lines(text: str, limit: int) -> list[str]:
    """Runs of whole lines of at most ``limit`` characters; a longer line stands alone, blanks at a start vanish."""
    pieces, held, size = [], [], 0
    for line in text.split("\n"):
        if held and size + 1 + len(line) > limit:
            pieces.append("\n".join(held))
            held, size = [], 0
        if not held and not line:
            continue
        size += len(line) + (1 if held else 0)
        held.append(line)
    return [*pieces, "\n".join(held)] if held else pieces


def sentences(text: str, lossless: bool = False) -> list[str]:
    """Sentences with the blank after them. Not lossless: a tail without an end and text before an inner dot are lost."""
    if not lossless:
        return [m.group() for m in re.finditer(r"[^.!?]+[.!?]+(?:\s|\Z)", text)]
    cuts = [m.end() for m in re.finditer(r"[.!?]+\s", text)]
    return [p for p in (text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])) if p]


def long_parts(text: str, limit: int, lossless: bool = False) -> list[str]:
    """A text beyond the limit as runs of whole sentences within it; a longer sentence stays whole."""
    if len(text) <= limit:
        return [text]
    parts, held = [], ""
    for s in sentences(text, lossless) or [text]:
        if held and len(held) + len(s) > limit:
            parts.append(held.strip())
            held = ""
        held += s
    return [*parts, held.strip()] if held.strip() else parts


def halves(text: str, share: float = 0.15) -> list[str]:
    """Two parts: at the middle line if neither is too small, else at the first space from the middle on."""
    lines = text.split("\n")
    mid = len(lines) // 2 or 1
    first, second = "\n".join(lines[:mid]), "\n".join(lines[mid:])
    if len(lines) > 1 and min(len(first), len(second)) > share * len(text):
        return [first, second]
    at = text.find(" ", len(text) // 2)
    at = len(text) // 2 if at < 0 else at
    return [text[:at], text[at:]]
