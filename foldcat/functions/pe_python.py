"""The same header metadata read by a small Python function, for bytes that Spark columns do not hold.

It asks for byte ranges instead of a whole body, so a remote object is only read where its headers are.
"""

from __future__ import annotations

import struct
from collections.abc import Callable

from foldcat.functions import pe

# (offset, width) -> the bytes there; fewer or none past the end of the file.
ReadAt = Callable[[int, int], bytes]

_CHUNK = 8192
_KEPT_BLOCKS = 8


class ExtractionError(Exception):
    """The content is not a readable PE file."""


def reader_of(body: bytes) -> ReadAt:
    return lambda offset, width: body[offset : offset + width]


def in_blocks(read: ReadAt, size: int) -> ReadAt:
    """The same reads, made of whole blocks; the last few are kept, whatever the file holds."""
    blocks: dict[int, bytes] = {}

    def read_blocks(offset: int, width: int) -> bytes:
        first, last = offset // size, (offset + width - 1) // size
        for index in range(first, last + 1):
            blocks[index] = blocks.pop(index) if index in blocks else read(index * size, size)
        joined = b"".join([blocks[index] for index in range(first, last + 1)])
        while len(blocks) > _KEPT_BLOCKS:
            del blocks[next(iter(blocks))]  # the one used longest ago
        return joined[offset - first * size :][:width]

    return read_blocks


def extract_pe(read: ReadAt, length: int) -> dict:
    def number(offset: int, width: int) -> int | None:
        raw = read(offset, width) if 0 <= offset else b""
        return struct.unpack("<H" if width == 2 else "<I", raw)[0] if len(raw) == width else None

    def table(offset: int | None, count: int, width: int) -> list[bytes]:
        """Up to ``count`` whole entries, read at once."""
        if offset is None or count <= 0:
            return []
        raw = read(offset, min(count * width, length - offset))
        return [raw[i : i + width] for i in range(0, len(raw) - width + 1, width)]

    dos = read(0, pe.DOS_HEADER_SIZE)
    if len(dos) < pe.DOS_HEADER_SIZE or dos[:2] != pe.DOS_MAGIC:
        raise ExtractionError("no DOS header")
    nt = struct.unpack_from("<I", dos, pe.NT_OFFSET_AT)[0]
    if read(nt, 4) != pe.NT_SIGNATURE:
        raise ExtractionError("no PE signature")
    coff = nt + len(pe.NT_SIGNATURE)
    optional = coff + pe.COFF_HEADER_SIZE
    magic = number(optional, 2)
    if magic is None:
        raise ExtractionError("no optional header")

    sections = []
    for raw in table(
        optional + number(coff + 16, 2), number(coff + 2, 2), pe.SECTION_HEADER_SIZE
    ):
        virtual_size, start, raw_size, at = struct.unpack_from("<4I", raw, 8)
        sections.append((start, start + max(virtual_size, raw_size), at))

    def mapped(rva: int | None) -> int | None:
        if rva is None:
            return None
        offset = next((rva - s + at for s, end, at in sections if s <= rva < end), rva)
        return offset if offset < length else None

    wide = magic == pe.MAGIC_PE32_PLUS
    slots = optional + (pe.DIRECTORIES_AT_PE32_PLUS if wide else pe.DIRECTORIES_AT_PE32)

    def directory(index: int) -> int | None:
        rva = number(slots + pe.DIRECTORY_SIZE * index, 4)
        listed = (number(slots - 4, 4) or 0) > index
        return mapped(rva) if listed and rva else None

    def count_symbols(ordinals_at: int | None, names: int, addresses_at: int | None, functions: int) -> int:
        """Names, and functions with an address that no name refers to; both read in stretches."""
        listed, named = 0, bytearray(1 << 16)
        while ordinals_at is not None and listed < names:
            part = table(ordinals_at + 2 * listed, min(_CHUNK, names - listed), 2)
            for raw in part:
                named[raw[0] | raw[1] << 8] = 1
            listed += len(part)
            if len(part) < _CHUNK:
                break
        seen = unnamed = 0
        while addresses_at is not None and seen < functions:
            part = table(addresses_at + 4 * seen, min(_CHUNK, functions - seen), 4)
            unnamed += sum([any(raw) and not (i < 1 << 16 and named[i]) for i, raw in enumerate(part, seen)])
            seen += len(part)
            if len(part) < _CHUNK:
                break
        return listed + unnamed

    imports, at = 0, directory(pe.IMPORT_DIRECTORY)
    per_read = _CHUNK // pe.IMPORT_DESCRIPTOR_SIZE
    while at is not None:
        chunk = table(at, per_read, pe.IMPORT_DESCRIPTOR_SIZE)
        ended = next((i for i, raw in enumerate(chunk) if not any(raw)), None)
        imports += len(chunk) if ended is None else ended
        done = ended is not None or len(chunk) < per_read
        at = None if done else at + per_read * pe.IMPORT_DESCRIPTOR_SIZE

    exports, at = None, directory(pe.EXPORT_DIRECTORY)
    head = read(at, pe.EXPORT_TABLE_SIZE) if at is not None else b""
    if len(head) == pe.EXPORT_TABLE_SIZE:
        functions, names, addresses_rva, _, ordinals_rva = struct.unpack_from("<5I", head, 20)
        exports = count_symbols(mapped(ordinals_rva), names, mapped(addresses_rva), functions)

    return {
        "architecture": "x64" if number(coff, 2) == pe.MACHINE_AMD64 else "x32",
        "num_imports": imports,
        "num_exports": exports or 0,
        "type": "exe" if exports is None else "dll",
        "status": "EXTRACTED",
    }
