"""Memo of per-word results, for tokenizers whose pieces never span words."""

from __future__ import annotations

from collections.abc import Callable, Iterable


class WordMemo:
    """``encode_many`` applied once per distinct word.

    Holds at most ``capacity`` words beyond those of the current batch: when it
    would outgrow that, it keeps only the current batch's words.  Results never
    depend on what is held.
    """

    def __init__(self, encode_many: Callable[[list], Iterable], capacity: int = 300_000):
        self._encode_many = encode_many
        self._capacity = capacity
        self._held: dict = {}

    def lookup(self, vocabulary: set) -> dict:
        """A mapping that has every word of ``vocabulary``."""
        held = self._held
        missing = [w for w in vocabulary if w not in held]
        if missing:
            if len(held) + len(missing) > self._capacity:
                held = self._held = {w: held[w] for w in vocabulary if w in held}
            held.update(zip(missing, self._encode_many(missing)))
        return held
