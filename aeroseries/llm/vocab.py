"""Where the public tokenizers' files are."""

from __future__ import annotations


def public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
