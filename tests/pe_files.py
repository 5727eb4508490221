"""PE files built with ``struct``, independent of the code under test."""

from __future__ import annotations

import struct

RAW, RVA, SPAN = 0x400, 0x2000, 0x1000


def build(
    machine=0x8664,
    magic=0x20B,
    imports=0,
    exports=None,
    directories=16,
    end_imports=True,
    e_lfanew=0x80,
    other_sections=1,
    overlay=b"",
):
    """``exports`` is None or (addresses, ordinals of names)."""
    body = bytearray(SPAN)
    export_rva = import_rva = 0
    if exports is not None:
        addresses, ordinals = exports
        export_rva, addresses_at, ordinals_at = RVA, 0x40, 0x640
        struct.pack_into(
            "<5I", body, 20, len(addresses), len(ordinals), RVA + addresses_at, 0, RVA + ordinals_at
        )
        struct.pack_into(f"<{len(addresses)}I", body, addresses_at, *addresses)
        struct.pack_into(f"<{len(ordinals)}H", body, ordinals_at, *ordinals)
    if imports:
        at = 0x800
        import_rva = RVA + at
        for i in range(imports):
            struct.pack_into("<5I", body, at + 20 * i, 1, 0, 0, 2, 3)
        if not end_imports:
            body = body[: at + 20 * imports]
    optional = bytearray(240 if magic == 0x20B else 224)
    slots = 112 if magic == 0x20B else 96
    struct.pack_into("<H", optional, 0, magic)
    struct.pack_into("<I", optional, slots - 4, directories)
    struct.pack_into("<4I", optional, slots, export_rva, 40, import_rva, 20)
    coff = struct.pack("<2H3I2H", machine, 1 + other_sections, 0, 0, 0, len(optional), 0)
    sections = b"".join(
        struct.pack("<8s4I16x", b".bss", 0x100, 0x1000 + 0x100 * i, 0, 0) for i in range(other_sections)
    )
    sections += struct.pack("<8s4I16x", b".rdata", SPAN, RVA, SPAN, RAW)
    head = struct.pack("<2s58xI", b"MZ", e_lfanew).ljust(e_lfanew, b"\x00")
    head += b"PE\x00\x00" + coff + bytes(optional) + sections
    return head.ljust(RAW, b"\x00") + bytes(body) + overlay


GOLDEN_DLL = build(0x8664, 0x20B, 7, ([16] * 6, list(range(6))))
GOLDEN_EXE = build(0x014C, 0x10B, 21)
