"""A memo for values that repeat, bounded by bytes."""

from __future__ import annotations

from collections.abc import Callable


class Memo(dict):
    """A dict that makes missing values (bytes) and keeps those of short texts, as longer ones seldom return.

    Two generations of ``most`` bytes at most are held; what is still asked for outlives the older one. An
    entry counts as two objects' heads, its place in the dict, four bytes a letter, and its value.
    """

    HEADS = 220

    def __init__(self, make: Callable[[str], bytes], most: int, longest: int = 32) -> None:
        super().__init__()
        self.make, self.most, self.longest, self.used, self.old = make, most, longest, 0, {}

    def __missing__(self, key: str) -> bytes:
        out = self.old.get(key)
        if out is None:
            out = self.make(key)
            if len(key) > self.longest:
                return out
        if self.used >= self.most:
            self.old, self.used = dict(self), 0
            self.clear()
        self.used += self.HEADS + 4 * len(key) + len(out)
        self[key] = out
        return out
