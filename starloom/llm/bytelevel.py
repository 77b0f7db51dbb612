"""The byte alphabet of byte-level vocabularies: every byte is written as one printable character."""

from __future__ import annotations


def byte_characters() -> list[str]:
    """Character of each byte: printable Latin-1 stands for itself, the others follow from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + other.index(b)) for b in range(256)]
