"""Where the public vocabulary files lie."""

from __future__ import annotations


def vocabulary(name: str) -> str:
    """Path of a file of the installed ``public_tokenizers`` package, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
