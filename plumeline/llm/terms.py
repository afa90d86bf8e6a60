"""Terms of a text: runs of ASCII letters, digits and all characters beyond ASCII, with only A-Z lower-cased.

On UTF-8 bytes this is a byte table and a split, as every byte of a character beyond ASCII is 0x80 or more.
"""

from __future__ import annotations

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
_TO_TERMS = bytes(b if b in _KEPT else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """Terms of a whole text in order, repeats included; null has none."""
    return text.translate(_TO_TERMS).split() if text else []
