"""Whether a body is the one that a listing told of: plain and composite digests."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Sequence

MIB = 1 << 20
# The part sizes, in MiB, that clients of object stores use unless told otherwise.
PART_SIZES = tuple(MIB * n for n in (5, 8, 10, 15, 16, 20, 25, 32, 50, 64, 100, 128, 256, 512, 1024, 5120))

_ETAG = re.compile(r'"?([0-9a-f]{32})(?:-([1-9][0-9]*))?"?')


def part_sizes(size: int, parts: int, known: Sequence[int] = PART_SIZES) -> list[int]:
    """The part sizes by which an object of ``size`` bytes may have been put in so many parts.

    Besides the known ones, the least whole MiB that gives no more parts, which clients choose that must
    keep under a store's limit of parts.
    """
    if parts == 1:
        return [max(1, size)]
    least, most = -(-size // parts), (size - 1) // (parts - 1)
    fitted = -(-least // MIB) * MIB
    return sorted(s for s in {*known, fitted} if max(1, least) <= s <= most)


class Composite:
    """The digest of the digests of parts, as stores give it for objects that were put in parts."""

    def __init__(self, part_size: int):
        self._size, self._room, self._parts = part_size, part_size, 0
        self._part, self._whole = hashlib.md5(), hashlib.md5()

    def update(self, stretch: bytes) -> None:
        rest = memoryview(stretch)
        while rest:
            if not self._room:
                self._close()
            piece, rest = rest[: self._room], rest[self._room :]
            self._part.update(piece)
            self._room -= len(piece)

    def _close(self) -> None:
        self._whole.update(self._part.digest())
        self._part, self._room, self._parts = hashlib.md5(), self._size, self._parts + 1

    def etag(self) -> str:
        """Of all that was given; nothing may be added after."""
        self._close()
        return f"{self._whole.hexdigest()}-{self._parts}"


class _Plain:
    def __init__(self) -> None:
        self._digest = hashlib.md5()
        self.update = self._digest.update

    def etag(self) -> str:
        return self._digest.hexdigest()


def body_matches(etag: str, size: int, body: Iterable[bytes], known: Sequence[int] = PART_SIZES) -> bool:
    """Whether the stretches of a body, ``size`` bytes in all, have this ETag, read once.

    A composite ETag tells the number of parts, not their size: all sizes that may be are tried side by
    side. One of another form, or of a part size that nobody is known to use, is not matched.
    """
    form = _ETAG.fullmatch(etag)
    if not form:
        return False
    if form[2] is None:
        digests = [_Plain()]
    else:
        digests = [Composite(s) for s in part_sizes(size, int(form[2]), known)]
    if digests:
        for stretch in body:
            for digest in digests:
                digest.update(stretch)
    return any(digest.etag() == etag.strip('"') for digest in digests)
