"""Stores that are listed by key: pages after a key, and ranges of keys that tasks list on their own.

Object stores list in order of keys, from any key on, at most so many objects a call. That is all that is
asked of a store here, so a store without folders, or with all objects in one folder, is listed by many
tasks, and a listing can be resumed after any key.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from abc import ABC, abstractmethod
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import unquote, urlsplit

# What one call of a store lists.
PAGE = 1_000
_LAST = chr(0x10FFFF)


class Listed(NamedTuple):
    key: str
    etag: str | None
    size: int


class Store(ABC):
    """A store that lists its objects in order of keys (by code points, as by UTF-8 bytes).

    Subclass it for a client of an object store, whose listing call is ``page``.
    """

    @abstractmethod
    def page(self, prefix: str, after: str, limit: int) -> list[Listed]:
        """The first ``limit`` objects whose key starts with ``prefix`` and comes after ``after``."""

    def between(self, prefix: str, after: str, upto: str | None) -> Iterator[Listed]:
        """All objects with ``after`` < key <= ``upto`` (None: to the end), a page held at a time."""
        while True:
            page = self.page(prefix, after, PAGE)
            for listed in page:
                if upto is not None and listed.key > upto:
                    return
                yield listed
            if len(page) < PAGE:
                return
            after = page[-1].key

    def split_points(self, prefix: str, ranges: int) -> list[str]:
        """Up to ``ranges - 1`` ascending keys that part the objects into ranges of about one size.

        Nothing is listed whole: a page at the start of a range tells how close together keys stand there,
        so how many the range may hold, the better the smaller it is. So the range that seems largest is
        parted until there are a few times as many, and these are put together again.
        """
        waiting: list[tuple[float, str, str]] = []

        def add(after: str, upto: str) -> None:
            page = self.page(prefix, after, PAGE)
            if not page or page[0].key > upto:
                return
            if len(page) < PAGE or page[-1].key >= upto:
                count = float(sum(listed.key <= upto for listed in page))
            else:
                first, last, end = (_place(key, page[0].key, upto) for key in (page[0].key, page[-1].key, upto))
                count = PAGE * max(1.0, (end - first) / max(1, last - first))
            heapq.heappush(waiting, (-count, after, upto))

        add("", prefix + _LAST)
        for _ in range(_PROBES * ranges):
            if len(waiting) >= _FINER * ranges or not waiting or -waiting[0][0] <= PAGE:
                break
            _, after, upto = heapq.heappop(waiting)
            page = self.page(prefix, after, PAGE)
            first, shared = page[0].key, os.path.commonprefix([page[0].key, page[-1].key])
            # Keys that have more in common than the ends of their range are parted from the rest, by half
            # of what they have more.
            ends = _common(first, upto)
            middle = shared[: (ends + len(shared) + 1) // 2] + _LAST if len(shared) > ends else _between(first, upto)
            if not first < middle < upto:
                heapq.heappush(waiting, (-1.0, after, upto))
                continue
            add(after, middle)
            add(middle, upto)
        fine = sorted((upto, -count) for count, _, upto in waiting)
        total, before, ends = sum(count for _, count in fine), 0.0, []
        for upto, count in fine[:-1]:
            # A range ends where its number of even shares is full, or would be passed by more than half.
            before += count
            if before >= total * (len(ends) + 1) / ranges - count / 2 and len(ends) < ranges - 1:
                ends.append(upto)
        return ends


# Partings for each range that is wanted; one that finds a side empty makes no new range.
_PROBES, _FINER = 64, 4
# Keys are compared by so many characters behind what both ends of a range have in common. On their scale
# the ASCII characters of most keys take four fifths, all others the rest.
_WIDTH, _ASCII, _STEP = 4, 128, 34_816
_BASE = _ASCII * _STEP * 5 // 4


def _common(a: str, b: str) -> int:
    return len(os.path.commonprefix([a, b]))


def _number(text: str) -> int:
    number = 0
    for code in map(ord, text[:_WIDTH].ljust(_WIDTH, "\0")):
        digit = code * _STEP if code < _ASCII else _ASCII * (_STEP - 1) + code
        number = number * _BASE + digit
    return number


def _place(key: str, low: str, high: str) -> int:
    return _number(key[_common(low, high) :])


def _between(low: str, high: str) -> str:
    """A key about halfway between two keys."""
    shared = _common(low, high)
    middle, chars = (_number(low[shared:]) + _number(high[shared:])) // 2, []
    for _ in range(_WIDTH):
        middle, digit = divmod(middle, _BASE)
        code = digit // _STEP if digit < _ASCII * _STEP else min(digit - _ASCII * (_STEP - 1), 0x10FFFF)
        chars.append(chr(0xD7FF if 0xD800 <= code < 0xE000 else code))
    return low[:shared] + "".join(reversed(chars)).rstrip("\0")


def is_folder(root: str) -> bool:
    """Whether an address is that of a local or mounted folder."""
    return urlsplit(root).scheme in ("", "file")


class FolderStore(Store):
    """A local or mounted folder. Its keys are paths below ``root``, taken literally; every file is an object.

    A folder cannot be read in order, so each call runs over the names of the folders that it may concern,
    one at a time, and looks at the files that it returns only.
    """

    # Of so many names for each range, the split points are quantiles.
    SAMPLE = 256

    def __init__(self, root: str):
        if not is_folder(root):
            raise ValueError(f"not a folder: {root}")
        self.root = (unquote(urlsplit(root).path) if root.startswith("file:") else root).rstrip("/")

    def _names(self, prefix: str, after: str = "", upto: str | None = None) -> Iterator[tuple[str, os.DirEntry]]:
        """Keys in any order; folders that cannot hold one of them are not entered."""
        waiting = [prefix.rpartition("/")[0]]
        while waiting:
            folder = waiting.pop()
            try:
                entries = os.scandir(f"{self.root}/{folder}")
            except (FileNotFoundError, NotADirectoryError):
                continue
            with entries:
                for entry in entries:
                    key = f"{folder}/{entry.name}" if folder else entry.name
                    if entry.is_dir():
                        # All keys in it lie between "key/" and "key0", as 0 follows the slash.
                        inside = f"{key}/".startswith(prefix) or prefix.startswith(f"{key}/")
                        if inside and f"{key}0" > after and (upto is None or f"{key}/" <= upto):
                            waiting.append(key)
                    elif key.startswith(prefix) and key > after and (upto is None or key <= upto):
                        yield key, entry

    def page(self, prefix: str, after: str, limit: int) -> list[Listed]:
        first = heapq.nsmallest(limit, self._names(prefix, after), key=lambda found: found[0])
        return [Listed(key, None, entry.stat().st_size) for key, entry in first]

    def between(self, prefix: str, after: str, upto: str | None) -> Iterator[Listed]:
        for key, entry in self._names(prefix, after, upto):
            yield Listed(key, None, entry.stat().st_size)

    def split_points(self, prefix: str, ranges: int) -> list[str]:
        def drawn(key: str) -> bytes:
            return hashlib.blake2b(key.encode("utf-8", "surrogateescape"), digest_size=8).digest()

        names = (key for key, _ in self._names(prefix))
        sample = sorted(heapq.nsmallest(self.SAMPLE * ranges, names, key=drawn))
        return sorted({sample[len(sample) * k // ranges] for k in range(1, ranges)}) if sample else []
