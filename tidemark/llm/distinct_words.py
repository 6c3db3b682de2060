"""A bounded memory of what distinct words give, so that a word is worked out once per process and not once per use."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from typing import Any


class WordMemory:
    """``found[word]`` for the words of the latest :meth:`learn`; ``work`` maps a list of new words to their values.

    Once it holds ``most`` words or ``most * 32`` characters, the memory starts
    anew; with ``keep``, words of the memory before are taken over when they are
    used again.  A corpus of any size needs the same space.  A process holds one
    memory only: the first use of another one, or :func:`release`, empties it, so
    that a worker which serves one step after another does not gather them all.
    """

    def __init__(self, work: Callable[[list[str]], Sequence[Any]], most: int = 400_000, keep: bool = True,
                 forgotten: Callable[[], None] | None = None) -> None:
        self.work, self.most, self.keep, self.forgotten = work, most, keep, forgotten
        self.found, self.before, self.size = {}, {}, 0

    def forget(self) -> None:
        self.found, self.before, self.size = {}, {}, 0
        if self.forgotten:
            self.forgotten()

    def learn(self, words: Iterable[str]) -> dict[str, Any]:
        release(self)
        if len(self.found) > self.most or self.size > 32 * self.most:
            self.found, self.before, self.size = {}, self.found if self.keep else {}, 0
        new = set(words).difference(self.found)
        if new:
            known = new.intersection(self.before)
            self.found.update((w, self.before[w]) for w in known)
            fresh = list(new - known)
            self.found.update(zip(fresh, self.work(fresh), strict=True) if fresh else ())
            self.size += sum(map(len, new))
        return self.found


_HELD: list[WordMemory] = []


def release(keep: WordMemory | None = None) -> None:
    """Empty the process's memory of words, unless it is ``keep``, which becomes the process's memory."""
    if _HELD and _HELD[0] is not keep:
        _HELD.pop().forget()
    if keep is not None and not _HELD:
        _HELD.append(keep)
