"""A bounded memory of encoded chunks for one task."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

CHUNKS = 250_000  # of each generation

SLICE_CHARS = 1 << 21  # of the texts that are cut at once


def slices(texts: list[str], chars: int = SLICE_CHARS) -> Iterator[list[str]]:
    """The texts in order, in lists of about ``chars`` characters."""
    held: list[str] = []
    size = 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


class ChunkCache:
    """Two generations: when the young one is full it becomes the old one, and hits there come back."""

    def __init__(
        self, learn: Callable[[list[str]], list[bytes]], size: int = CHUNKS,
        dropped: Callable[[Callable[[str], bool]], None] | None = None,
    ):
        """``dropped`` is told, each time chunks were forgotten, how to ask which are still known."""
        self.learn, self.size, self.dropped = learn, size, dropped
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def prepare(self, texts: Iterable[list[str]]) -> dict[str, bytes]:
        """Values of the texts' chunks that the young generation lacks; the unknown are learned in one batch."""
        missing = set().union(*texts).difference(self.young)
        found = {c: self.old[c] for c in missing if c in self.old}
        new = sorted(missing.difference(found))
        if new:
            found.update(zip(new, self.learn(new)))
        if len(self.young) + len(found) > self.size:
            self.old, self.young = self.young, {}
            if self.dropped:
                self.dropped(lambda chunk: chunk in self.old or chunk in found)
        self.young.update(found)
        return found

    def values(self, chunks: list[str]) -> list[bytes]:
        found = list(map(self.young.get, chunks))
        if None in found:
            known = self.prepare([chunks])
            found = [known[c] if v is None else v for c, v in zip(chunks, found)]
        return found
