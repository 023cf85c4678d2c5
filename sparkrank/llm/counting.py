"""Word counts made inside tasks in bounded memory, before anything is shuffled."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Hashable, Iterator

import pyarrow as pa

#: Different counted keys that a task holds before it passes them on.
HELD = 400_000
#: Bytes of a text that are split into words at a time.
PART = 1 << 22


def parts_of(data: bytes, part: int = PART) -> Iterator[bytes]:
    """``data`` in slices of about ``part`` bytes, cut at spaces only."""
    at = 0
    while len(data) - at > part:
        cut = data.find(b" ", at + part)
        if cut < 0:
            break
        yield data[at:cut]
        at = cut + 1
    yield data[at:] if at else data


class Tally:
    """Counts per group; ``flushed`` gives the rows of ``rows`` and empties the tally once it is full."""

    def __init__(self, rows: Callable[[Hashable, Counter, Counter], pa.RecordBatch], held: int = HELD):
        self.rows, self.held, self.groups, self.size = rows, held, {}, 0

    def group(self, key: Hashable) -> tuple[Counter, Counter]:
        """Occurrences and documents of the group ``key``."""
        return self.groups.setdefault(key, (Counter(), Counter()))

    def add(self, key: Hashable, words: list, seen: set | None = None) -> None:
        """Count ``words``; those not yet in ``seen`` count one document more."""
        occurrences, documents = self.group(key)
        before = len(occurrences)
        occurrences.update(words)
        self.size += len(occurrences) - before
        if seen is not None:
            new = set(words) - seen if seen else set(words)
            documents.update(new)
            seen |= new

    def flushed(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        if last or self.size > self.held:
            for key, (occurrences, documents) in self.groups.items():
                if occurrences:
                    yield self.rows(key, occurrences, documents)
            self.groups, self.size = {}, 0
