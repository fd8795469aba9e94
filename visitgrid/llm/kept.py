"""A table of results that a Python worker keeps, bounded in bytes."""

from __future__ import annotations

#: Bytes of keys and values that a table holds before it is emptied and filled anew, and
#: those of the longest entry it takes.
MOST_BYTES, LONGEST_ENTRY = 96 << 20, 256
#: What an entry takes besides the characters of its key and the bytes of its value.
ENTRY_BYTES = 190


class Kept(dict):
    """Strings to byte strings, or to several.  Emptying it changes no result, only time."""

    def __init__(self, most_bytes: int = MOST_BYTES):
        super().__init__()
        self.most_bytes, self.held = most_bytes, 0

    def keep(self, keys: list[str], values: list[bytes] | list[tuple[bytes, ...]]) -> None:
        """Take new entries.  One that is longer than all others may be is left out."""
        if not keys:
            return
        sizes = list(map(len, values)) if isinstance(values[0], bytes) else [sum(map(len, v)) for v in values]
        if max(sizes) + max(map(len, keys)) > LONGEST_ENTRY:
            short = [n for n, size in enumerate(sizes) if size + len(keys[n]) <= LONGEST_ENTRY]
            keys, values, sizes = ([x[n] for n in short] for x in (keys, values, sizes))
        if self.held > self.most_bytes:
            self.clear()
            self.held = 0
        self.update(zip(keys, values))
        self.held += sum(sizes) + sum(map(len, keys)) + ENTRY_BYTES * len(keys)
