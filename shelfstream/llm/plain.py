"""Words for comparing texts: lower case, ASCII punctuation between words, inside Python tasks."""

from __future__ import annotations

_BREAK = bytes.maketrans(bytes(c for c in range(128) if not chr(c).isalnum()), b" " * (128 - 62))


def plain_words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_BREAK).split()
