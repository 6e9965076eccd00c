"""Terms of a text: runs of digits, ASCII letters in lower case, and characters beyond ASCII."""

from __future__ import annotations

#: Byte by byte: A-Z to lower case, other ASCII that is no letter or digit to a blank. Bytes of longer characters stay.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """Terms of a text in UTF-8; null has none."""
    return (text or b"").translate(FOLD).split()
