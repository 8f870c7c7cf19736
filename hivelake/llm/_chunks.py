"""Encoding by chunks: where a tokenizer never joins across certain blanks, equal chunks are encoded once."""

from __future__ import annotations

from collections.abc import Callable
from typing import Generic, TypeVar

V = TypeVar("V")

#: Chunks that a worker remembers in each of two generations.
REMEMBERED = 150_000


class ChunkCache(dict[str, V], Generic[V]):
    """Values of chunks by chunk, computed when first asked for.

    When the young generation is full it becomes the old one, whose chunks are young again once asked for; so
    common chunks stay and the memory is bounded.
    """

    def __init__(self, one: Callable[[str], V], most: int = REMEMBERED) -> None:
        super().__init__()
        self.one, self.most = one, most
        self.old: dict[str, V] = {}

    def __missing__(self, chunk: str) -> V:
        value = self.old.pop(chunk, None)
        if value is None:
            value = self.one(chunk)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[chunk] = value
        return value
