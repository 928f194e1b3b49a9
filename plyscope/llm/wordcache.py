"""A bounded cache from a piece of text to a value, in two generations.

When the young generation is full it becomes the old one, whose entries are taken over again as they
are used: frequent pieces stay, rare ones go, and memory never exceeds twice the limit."""

from __future__ import annotations


class Generations(dict):
    def __init__(self, make, limit: int, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.old = make, limit, longest, {}

    def __missing__(self, piece):
        value = self.old.get(piece)
        if value is None:
            value = self.make(piece)
            if len(piece) > self.longest:
                return value
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[piece] = value
        return value

    def take(self, pieces, values) -> None:
        """Remember the values of pieces that are not in the young generation, as if each had been asked for."""
        items = [x for x in zip(pieces, values) if len(x[0]) <= self.longest]
        at = 0
        while at < len(items):
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            room = self.limit - len(self)
            self.update(items[at:at + room])
            at += room
