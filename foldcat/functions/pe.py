"""Header metadata of PE binaries as SQL expressions over a binary column.

Follows the published PE/COFF layout. Every read yields NULL outside the file, and NULL spreads, so a
damaged file needs no error handling of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldcat.schemas import METADATA

# Fixed values of the PE/COFF layout (offsets in bytes).
DOS_HEADER_SIZE = 64
NT_OFFSET_AT = 60
DOS_MAGIC = b"MZ"
NT_SIGNATURE = b"PE\x00\x00"
COFF_HEADER_SIZE = 20
MACHINE_AMD64 = 0x8664
MAGIC_PE32_PLUS = 0x20B
DIRECTORIES_AT_PE32 = 96
DIRECTORIES_AT_PE32_PLUS = 112
DIRECTORY_SIZE = 8
EXPORT_DIRECTORY = 0
IMPORT_DIRECTORY = 1
SECTION_HEADER_SIZE = 40
EXPORT_TABLE_SIZE = 40
IMPORT_DESCRIPTOR_SIZE = 20

# Descriptors looked at before the rest of a file is searched for the end of its import table.
_FEW_DESCRIPTORS = 32
_STRETCH = 1024


def pe_metadata(df: DataFrame, content: str = "content") -> DataFrame:
    """Replace ``content`` by architecture, num_imports, num_exports, type and status.

    A NULL content gives NULLs. The header steps are plain projections that compile into one stage.
    Only what loops over a table needs higher-order functions, which Spark interprets: there the
    content is bound to a lambda variable first, so that it is taken out of its row once and not once
    per read.
    """
    steps = df.withColumn("_body", F.col(content))
    for name, value in {
        "_nt": _nt_offset(),
        "_coff": _coff(),
        "_h": _headers(),
        "_slots": _slots(),
        "_headers": _section_headers(),
        "_sections": _sections(),
        "_import_at": _mapped(_directory("import")),
        "_export_at": _mapped(_directory("export")),
        "_found": _let([("body", "_body")], _counts()),
    }.items():
        steps = steps.withColumn(name, F.expr(value))
    known = "WHEN _body IS NULL THEN NULL WHEN _h.magic IS NULL THEN"
    results = {
        "architecture": f"CASE {known} NULL WHEN _h.machine = {MACHINE_AMD64} THEN 'x64' ELSE 'x32' END",
        "num_imports": f"CASE {known} NULL ELSE _found.imports END",
        "num_exports": f"CASE {known} NULL ELSE coalesce(_found.exports, 0) END",
        "type": f"CASE {known} NULL WHEN _found.exports IS NULL THEN 'exe' ELSE 'dll' END",
        "status": f"CASE {known} 'ERROR' ELSE 'EXTRACTED' END",
    }
    kept = [name for name in df.columns if name != content]
    fields = [F.expr(results[f.name]).cast(f.dataType).alias(f.name) for f in METADATA.fields]
    return steps.select(*kept, *fields)


def _let(values: list[tuple[str, str]], use: str) -> str:
    """``use`` with each name standing for its value, computed once; later values see earlier names."""
    for name, value in reversed(values):
        use = f"get(transform(array({value}), {name} -> {use}), 0)"
    return use


def _bytes(body: str, offset: str, width: str | int) -> str:
    """``width`` bytes of ``body`` at a zero-based offset, NULL if they are not all there."""
    return (
        f"CASE WHEN {offset} >= 0 AND {offset} + {width} <= octet_length({body}) "
        f"THEN substring({body}, cast({offset} + 1 AS int), cast({width} AS int)) END"
    )


def _record(body: str, offset: str, width: str | int) -> str:
    """Hex digits of a little-endian record, last byte first, so that its numbers read forward."""
    text = f"decode({_bytes(body, offset, width)}, 'ISO-8859-1')"
    return f"hex(encode(reverse({text}), 'ISO-8859-1'))"


def _field(record: str, size: str | int, offset: str | int, width: int) -> str:
    """Unsigned number at ``offset`` of a record of ``size`` bytes."""
    start = f"cast(2 * ({size} - ({offset}) - {width}) + 1 AS int)"
    return f"cast(conv(substring({record}, {start}, {2 * width}), 16, 10) AS bigint)"


def _number(body: str, offset: str, width: int) -> str:
    return _field(_record(body, offset, width), width, 0, width)


def _nt_offset() -> str:
    """Where the PE signature should be, NULL without a whole DOS header."""
    return f"""CASE WHEN substring(_body, 1, 2) = X'{DOS_MAGIC.hex()}'
        AND octet_length(_body) >= {DOS_HEADER_SIZE} THEN {_number("_body", str(NT_OFFSET_AT), 4)} END"""


def _coff() -> str:
    """COFF header behind a PE signature, NULL if there is none."""
    signature = _bytes("_body", "_nt", len(NT_SIGNATURE))
    header = _record("_body", f"(_nt + {len(NT_SIGNATURE)})", COFF_HEADER_SIZE)
    return f"CASE WHEN {signature} = X'{NT_SIGNATURE.hex()}' THEN {header} END"


def _headers() -> str:
    optional = f"(_nt + {len(NT_SIGNATURE) + COFF_HEADER_SIZE})"
    return f"""named_struct(
        'machine', {_field("_coff", COFF_HEADER_SIZE, 0, 2)},
        'num_sections', {_field("_coff", COFF_HEADER_SIZE, 2, 2)},
        'sections_at', {optional} + {_field("_coff", COFF_HEADER_SIZE, 16, 2)},
        'optional_at', {optional},
        'magic', CASE WHEN _coff IS NOT NULL THEN {_number("_body", optional, 2)} END)"""


def _slots() -> str:
    """The directory count, and the export and import slots as far as the file has them."""
    first = f"""_h.optional_at + CASE WHEN _h.magic = {MAGIC_PE32_PLUS}
        THEN {DIRECTORIES_AT_PE32_PLUS} ELSE {DIRECTORIES_AT_PE32} END"""
    return f"""named_struct(
        'number', {_number("_body", f"({first} - 4)", 4)},
        'export', {_number("_body", f"({first} + {DIRECTORY_SIZE * EXPORT_DIRECTORY})", 4)},
        'import', {_number("_body", f"({first} + {DIRECTORY_SIZE * IMPORT_DIRECTORY})", 4)})"""


def _directory(slot: str) -> str:
    """RVA of a directory, NULL if it is absent."""
    index = {"export": EXPORT_DIRECTORY, "import": IMPORT_DIRECTORY}[slot]
    rva = f"_slots.`{slot}`"
    return f"(CASE WHEN _h.magic IS NOT NULL AND _slots.number > {index} AND {rva} > 0 THEN {rva} END)"


def _section_headers() -> str:
    """The bytes of the section headers that are in the file."""
    fitting = f"(octet_length(_body) - _h.sections_at) div {SECTION_HEADER_SIZE}"
    size = f"({SECTION_HEADER_SIZE} * greatest(least(_h.num_sections, {fitting}), 0))"
    return _bytes("_body", "_h.sections_at", size)


def _sections() -> str:
    """Array of (begin, end, file) of the sections."""

    def field(offset: int) -> str:
        return _field("record", SECTION_HEADER_SIZE, offset, 4)

    section = f"""named_struct(
        'begin', {field(12)},
        'end', {field(12)} + greatest({field(8)}, {field(16)}),
        'file', {field(20)})"""
    record = _record("headers", f"(i * {SECTION_HEADER_SIZE})", SECTION_HEADER_SIZE)
    count = f"octet_length(headers) div {SECTION_HEADER_SIZE}"
    sections = f"transform({_indexes(count)}, i -> {_let([('record', record)], section)})"
    return _let([("headers", "_headers")], sections)


def _mapped(rva: str) -> str:
    """File offset of an RVA; one that no section covers is taken as an offset into the file."""
    covering = f"filter(_sections, s -> s.`begin` <= {rva} AND {rva} < s.`end`)"
    return f"coalesce(get(transform({covering}, s -> {rva} - s.`begin` + s.file), 0), {rva})"


def _counts() -> str:
    """Struct of imports and exports; exports is NULL without an export directory."""
    exports = _let(
        [("record", _record("body", "_export_at", EXPORT_TABLE_SIZE)), ("x", _export_table())],
        f"CASE WHEN record IS NOT NULL THEN {_count_symbols()} END",
    )
    return f"named_struct('imports', {_count_imports()}, 'exports', {exports})"


def _export_table() -> str:
    """Counts and places of the export tables."""

    def field(offset: int) -> str:
        return _field("record", EXPORT_TABLE_SIZE, offset, 4)

    return f"""named_struct(
        'functions', {field(20)}, 'names', {field(24)},
        'addresses_at', {_mapped(field(28))}, 'ordinals_at', {_mapped(field(36))})"""


def _count_symbols() -> str:
    """Named symbols, plus functions with an address that no name refers to."""

    def readable(count: str, at: str, width: int) -> str:
        fitting = f"(octet_length(body) - {at}) div {width}"
        return f"greatest(least({count}, {fitting}), 0)"

    names = readable("x.names", "x.ordinals_at", 2)
    ordinal = _number("body", "(x.ordinals_at + i * 2)", 2)
    address = _bytes("body", "(x.addresses_at + i * 4)", 4)
    functions = _indexes(readable("x.functions", "x.addresses_at", 4))
    live = f"filter({functions}, i -> {address} != X'{bytes(4).hex()}')"
    return f"{names} + size(array_except({live}, transform({_indexes(names)}, i -> {ordinal})))"


def _count_imports() -> str:
    """Import descriptors before the all-zero one, or before the end of the file.

    The first few are looked at together. After them the file is searched in stretches, so that a file
    made to have no end of imports costs time but no memory.
    """
    size, long = IMPORT_DESCRIPTOR_SIZE, _STRETCH
    room = f"greatest((octet_length(body) - _import_at) div {size}, 0)"
    is_end = f"{_bytes('body', f'(_import_at + i * {size})', size)} = X'{bytes(size).hex()}'"
    stretch = f"sequence(s * {long}, least(s * {long} + {long}, room) - 1)"
    has_end = f"filter({_indexes(f'(room + {long} - 1) div {long}')}, s -> exists({stretch}, i -> {is_end}))"
    late = _let([("s", f"get({has_end}, 0)")], f"get(filter({stretch}, i -> {is_end}), 0)")
    few = f"get(filter({_indexes(f'least(room, {_FEW_DESCRIPTORS})')}, i -> {is_end}), 0)"
    count = f"coalesce({few}, if(room > {_FEW_DESCRIPTORS}, {late}, NULL), room)"
    return f"if(_import_at IS NULL, 0, {_let([('room', room)], count)})"


def _indexes(count: str) -> str:
    """Array 0 .. count-1 of bigint."""
    empty = "cast(array() AS array<bigint>)"
    return f"if({count} > 0, sequence(0L, cast({count} - 1 AS bigint)), {empty})"
