"""A bounded memory of what was computed for a word, one per Python worker."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import pyarrow as pa

_CACHES: dict = {}


def give_back() -> None:
    """Hands what this worker has freed back to the system; its allocators would keep it through all later tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # not glibc
        pass


def slices(sizes: list[int], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes add up to ``most`` or little more; one that is larger stands alone."""
    start = total = 0
    for k, size in enumerate(sizes):
        if total and total + size > most:
            yield start, k
            start, total = k, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


class WordCache:
    """``get`` maps words through ``compute`` (a function of a list of new words), remembering results.

    Two generations: when the young one holds ``limit`` words it becomes the old one, and what was in the old one
    and has not been asked for since is forgotten. So at most twice ``limit`` words are kept, frequent
    words always; results do not depend on it.
    """

    def __init__(self, compute: Callable[[list], list], limit: int = 300_000):
        self.compute, self.limit, self.known, self.old = compute, limit, {}, {}

    @classmethod
    def of(cls, key, compute: Callable[[list], list], limit: int = 300_000) -> WordCache:
        """The cache of this worker under ``key``; tasks that follow in the same worker share it."""
        if key not in _CACHES:
            _CACHES[key] = cls(compute, limit)
        return _CACHES[key]

    def learn(self, words: set) -> dict:
        """A mapping that has all ``words``; very long ones are computed, not kept."""
        known, old = self.known, self.old
        missing = {w for w in words if w not in known}
        if not missing:
            return known
        if len(known) + len(missing) > self.limit:
            self.old, self.known = known, {}
            known, old, missing = self.known, self.old, set(words)
        if old:
            again = {w for w in missing if w in old}
            known.update((w, old[w]) for w in again)
            missing -= again
        new = [w for w in missing if len(w) <= 200]
        known.update(zip(new, self.compute(new)))
        if len(new) == len(missing):
            return known
        long = [w for w in missing if len(w) > 200]
        return {**{w: known[w] for w in words if len(w) <= 200}, **dict(zip(long, self.compute(long)))}

    def forget(self) -> None:
        """Gives back the memory; words are computed again when they are asked for."""
        self.known, self.old = {}, {}

    def get(self, words: Iterable) -> list:
        words = words if isinstance(words, list) else list(words)
        known = self.known
        try:
            return [known[w] for w in words]
        except KeyError:
            known = self.learn(set(words))
        return [known[w] for w in words]

    def many(self, lists: list[list]) -> list[list]:
        """``get`` for several lists; words are looked up once, in the large mapping, for all of them."""
        words = set(chain.from_iterable(lists))
        known = self.learn(words)
        near = {w: known[w] for w in words}
        return [[near[w] for w in words] for words in lists]
