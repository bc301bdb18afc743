"""Legacy ``.xls`` workbooks: cells of one sheet as text.

The format is public: a compound file (sectors chained by allocation tables)
holds the stream ``Workbook``, a row of records. Read here are the sheet list,
the shared strings (which run on over continuation records, where a string may
change between one and two bytes a character), the date base, and the cell
records: texts, numbers as doubles or packed into 30 bits, booleans, formula
results. A sheet has at most 65,536 rows of 256 columns, so one workbook is
bounded by its format. Encrypted or older workbooks are errors, as is a chain
that breaks off or runs in a circle.

``workbook_bytes`` writes the same subset, for fixture files.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

# Fixed values of the compound file format.
MAGIC = bytes.fromhex("D0CF11E0A1B11AE1")
FREE, END, FAT_SECTOR, DIFAT_SECTOR = 0xFFFFFFFF, 0xFFFFFFFE, 0xFFFFFFFD, 0xFFFFFFFC
MINI_LIMIT, HEADER_FATS = 4096, 109
# Record numbers.
BOF, EOF, BOUNDSHEET, SST, CONTINUE, DATEMODE, FILEPASS = 0x0809, 0x000A, 0x0085, 0x00FC, 0x003C, 0x0022, 0x002F
NUMBER, RK, MULRK, LABELSST, LABEL, RSTRING, BOOLERR = 0x0203, 0x027E, 0x00BD, 0x00FD, 0x0204, 0x00D6, 0x0205
FORMULA, STRING = 0x0006, 0x0207
# Texts of error cells.
ERRORS = {0x00: "#NULL!", 0x07: "#DIV/0!", 0x0F: "#VALUE!", 0x17: "#REF!", 0x1D: "#NAME?", 0x24: "#NUM!", 0x2A: "#N/A"}
MAX_RECORD, MAX_ROWS = 8224, 65536


# --- compound file --------------------------------------------------------------------

def _chain(start: int, table: list[int]) -> Iterator[int]:
    """Sector numbers from ``start`` on."""
    steps = 0
    while start != END:
        if start >= len(table) or steps > len(table):
            raise ValueError("broken sector chain")
        yield start
        start, steps = table[start], steps + 1


def workbook_stream(content: bytes) -> bytes:
    """The stream ``Workbook`` of a compound file."""
    if content[:8] != MAGIC or len(content) < 512:
        raise ValueError("not a compound file")
    sector_size, mini_size = 1 << struct.unpack_from("<H", content, 30)[0], 1 << struct.unpack_from("<H", content, 32)[0]
    first_dir, = struct.unpack_from("<I", content, 48)
    first_mini, _, first_difat, _ = struct.unpack_from("<4I", content, 60)

    def sector(i: int) -> bytes:
        raw = content[(i + 1) * sector_size:(i + 2) * sector_size]
        if not raw:
            raise ValueError("sector beyond the file's end")
        return raw

    def numbers(raw: bytes) -> list[int]:
        return list(struct.unpack(f"<{len(raw) // 4}I", raw[:len(raw) // 4 * 4]))

    fats = [f for f in numbers(content[76:512]) if f != FREE]
    difat, seen = first_difat, 0
    while difat not in (END, FREE):
        *more, difat = numbers(sector(difat))
        fats += [f for f in more if f != FREE]
        seen += 1
        if seen > len(content) // sector_size:
            raise ValueError("broken sector chain")
    fat = [n for f in fats for n in numbers(sector(f))]

    def stream(start: int) -> bytes:
        return b"".join(sector(i) for i in _chain(start, fat))

    directory = stream(first_dir)
    root = wanted = None
    for at in range(0, len(directory) - 127, 128):
        length, kind = struct.unpack_from("<HB", directory, at + 64)
        start, size = struct.unpack_from("<II", directory, at + 116)
        name = directory[at:at + max(length - 2, 0)].decode("utf-16-le", "replace")
        if kind == 5:
            root = start
        elif kind == 2 and name in ("Workbook", "Book"):
            wanted = (start, size, name) if wanted is None or name == "Workbook" else wanted
    if wanted is None:
        raise ValueError("no workbook in the compound file")
    start, size, _ = wanted
    if size >= MINI_LIMIT:
        raw = stream(start)
    else:
        small, mini_fat = stream(root), numbers(stream(first_mini))
        raw = b"".join(small[i * mini_size:(i + 1) * mini_size] for i in _chain(start, mini_fat))
    if len(raw) < size:
        raise ValueError("workbook breaks off")
    return raw[:size]


# --- records --------------------------------------------------------------------------

def _records(raw: bytes, at: int = 0) -> Iterator[tuple[int, bytes]]:
    while at + 4 <= len(raw):
        kind, size = struct.unpack_from("<HH", raw, at)
        if at + 4 + size > len(raw):
            raise ValueError("record breaks off")
        yield kind, raw[at + 4:at + 4 + size]
        at += 4 + size


class _Pieces:
    """A record and its continuations, read as one."""

    def __init__(self, pieces: list[bytes]):
        self.pieces, self.piece, self.at = pieces, 0, 0

    def _left(self) -> int:
        while self.piece < len(self.pieces) and self.at >= len(self.pieces[self.piece]):
            self.piece, self.at = self.piece + 1, 0
        if self.piece >= len(self.pieces):
            raise ValueError("shared strings break off")
        return len(self.pieces[self.piece]) - self.at

    def take(self, n: int) -> bytes:
        out = b""
        while len(out) < n:
            k = min(self._left(), n - len(out))
            out += self.pieces[self.piece][self.at:self.at + k]
            self.at += k
        return out

    def text(self) -> str:
        """A string with its flags; formatting runs and phonetic data are passed over."""
        count, flags = struct.unpack("<HB", self.take(3))
        runs = struct.unpack("<H", self.take(2))[0] if flags & 8 else 0
        extra = struct.unpack("<I", self.take(4))[0] if flags & 4 else 0
        out, wide = [], flags & 1
        while count:
            fresh = self.at >= len(self.pieces[self.piece])
            left = self._left()
            if fresh:   # a continuation says anew how wide its characters are
                wide, left = self.take(1)[0] & 1, left - 1
            k = min(count, left // (1 + wide))
            if not k:
                raise ValueError("shared strings break off")
            out.append(self.take(k * (1 + wide)).decode("utf-16-le" if wide else "latin-1", "replace"))
            count -= k
        self.take(4 * runs + extra)
        return "".join(out)


def _text(raw: bytes, wide_count: bool = True) -> str:
    """A string within one record: its length, flags, characters."""
    head = 3 if wide_count else 2
    count, flags = struct.unpack_from("<HB" if wide_count else "<BB", raw)
    return raw[head:head + count * (1 + (flags & 1))].decode("utf-16-le" if flags & 1 else "latin-1", "replace")


def number_text(x: float) -> str:
    """A number as a sheet's XML would have it."""
    return str(int(x)) if x == int(x) and abs(x) < 1e15 else repr(x)


def _packed(rk: int) -> float:
    """30 bits of an integer or of a double's head; the lowest bit divides by 100."""
    if rk & 2:
        x = float((rk >> 2) - (1 << 30 if rk & 0x80000000 else 0))
    else:
        x, = struct.unpack("<d", struct.pack("<Q", (rk & 0xFFFFFFFC) << 32))
    return x / 100 if rk & 1 else x


def _globals(raw: bytes) -> tuple[list[tuple[str, int]], list[str], bool]:
    """Sheets (name, place), shared strings, and whether dates count from 1904."""
    sheets, pieces, base, last = [], [], False, None
    version = None
    for kind, data in _records(raw):
        if kind == BOF and version is None:
            version = struct.unpack_from("<H", data)[0]
            if version != 0x0600:
                raise ValueError(f"workbook version {version:#06x} is not read")
        elif kind == FILEPASS:
            raise ValueError("workbook is encrypted")
        elif kind == DATEMODE:
            base = data[:2] == b"\x01\x00"
        elif kind == BOUNDSHEET:
            place, _, what = struct.unpack_from("<IBB", data)
            if what == 0:
                sheets.append((_text(data[6:], wide_count=False), place))
        elif kind == SST or kind == CONTINUE and last == SST:
            pieces.append(data)
            kind = SST
        elif kind == EOF:
            break
        last = kind
    if version is None:
        raise ValueError("no workbook globals")
    shared: list[str] = []
    if pieces:
        reader = _Pieces(pieces)
        _, unique = struct.unpack("<II", reader.take(8))
        shared = [reader.text() for _ in range(unique)]
    return sheets, shared, base


def uses_1904(content: bytes) -> bool:
    return _globals(workbook_stream(content))[2]


def iter_sheet_rows(content: bytes, sheet_name: str | None = "Sheet1") -> Iterator[list[str | None]]:
    """The rows of one sheet (the first when None) that have a cell, as text cells."""
    yield from opened(content, sheet_name)[1]


def opened(content: bytes, sheet_name: str | None = "Sheet1") -> tuple[bool, Iterator[list[str | None]]]:
    """``uses_1904`` and ``iter_sheet_rows`` of a workbook whose strings are read once."""
    raw = workbook_stream(content)
    sheets, shared, base = _globals(raw)
    return base, _sheet_rows(raw, sheets, shared, sheet_name)


def _ascending(raw: bytes, at: int) -> bool:
    """Whether the sheet at ``at`` ends and its cells come row by row, as they are
    written: then a row is whole where the next begins."""
    depth, last, end = 0, -1, len(raw)
    head, row_of = struct.Struct("<HH").unpack_from, struct.Struct("<H").unpack_from
    while at + 4 <= end:
        kind, size = head(raw, at)
        if kind == BOF:
            depth += 1
        elif kind == EOF:
            depth -= 1
            if not depth:
                return True
        elif depth == 1 and kind in _CELLS and kind != STRING and at + 6 <= end:
            row, = row_of(raw, at + 4)
            if row < last:
                return False
            last = row
        at += 4 + size
    return False


def _sheet_rows(raw: bytes, sheets: list[tuple[str, int]], shared: list[str],
                sheet_name: str | None) -> Iterator[list[str | None]]:
    if not sheets:
        raise ValueError("workbook has no sheets")
    place = sheets[0][1] if sheet_name is None else next((p for n, p in sheets if n == sheet_name), None)
    if place is None:
        raise ValueError(f"no sheet named {sheet_name!r}")
    rows: dict[int, dict[int, str]] = {}
    waiting, depth, ended, ascending = None, 0, False, _ascending(raw, place)
    for kind, data in _records(raw, place):
        if kind == BOF:
            depth += 1      # charts are nested
        elif kind == EOF:
            depth -= 1
            if not depth:
                ended = True
                break
        if depth != 1 or kind not in _CELLS:
            continue
        if kind == STRING:
            if waiting is not None:
                rows.setdefault(waiting[0], {})[waiting[1]] = _text(data)
            waiting = None
            continue
        row, col = struct.unpack_from("<HH", data)
        if ascending and row not in rows:   # memory for one row, not for the sheet
            yield from map(_row_list, rows.values())
            rows.clear()
        cells = rows.setdefault(row, {})
        if kind == LABELSST:
            cells[col] = shared[struct.unpack_from("<I", data, 6)[0]]
        elif kind == NUMBER:
            cells[col] = number_text(struct.unpack_from("<d", data, 6)[0])
        elif kind == RK:
            cells[col] = number_text(_packed(struct.unpack_from("<I", data, 6)[0]))
        elif kind == MULRK:
            for i in range((len(data) - 6) // 6):
                cells[col + i] = number_text(_packed(struct.unpack_from("<I", data, 6 + 6 * i)[0]))
        elif kind in (LABEL, RSTRING):
            cells[col] = _text(data[6:])
        elif kind == BOOLERR:
            cells[col] = ERRORS.get(data[6], "#N/A") if data[7] else "TRUE" if data[6] else "FALSE"
        elif data[12:14] != b"\xff\xff":
            cells[col] = number_text(struct.unpack_from("<d", data, 6)[0])
        elif data[6] == 0:
            waiting = (row, col)
        elif data[6] == 1:
            cells[col] = "TRUE" if data[8] else "FALSE"
        elif data[6] == 2:
            cells[col] = ERRORS.get(data[8], "#N/A")
    if not ended:
        raise ValueError("sheet breaks off")
    yield from (_row_list(rows[row]) for row in sorted(rows))


def _row_list(cells: dict[int, str]) -> list[str | None]:
    return [cells.get(i) for i in range(max(cells) + 1 if cells else 0)]


_CELLS = {NUMBER, RK, MULRK, LABELSST, LABEL, RSTRING, BOOLERR, FORMULA, STRING}


# --- writing (fixtures) -----------------------------------------------------------------

def _record(kind: int, data: bytes) -> bytes:
    return struct.pack("<HH", kind, len(data)) + data


def _shared_records(strings: list[str], total: int) -> bytes:
    """The shared strings, cut into continuations wherever a record is full."""
    done, piece, first = [], bytearray(struct.pack("<II", total, len(strings))), True

    def full():
        nonlocal piece, first
        done.append(_record(SST if first else CONTINUE, bytes(piece)))
        piece, first = bytearray(), False

    for s in strings:
        wide = any(ord(c) > 255 for c in s)
        raw = s.encode("utf-16-le") if wide else s.encode("latin-1")
        step = 2 if wide else 1
        if len(piece) + 3 > MAX_RECORD:
            full()
        piece += struct.pack("<HB", len(raw) // step, int(wide))
        while raw:
            k = (MAX_RECORD - len(piece)) // step * step
            piece += raw[:k]
            raw = raw[k:]
            if raw:
                full()
                piece.append(int(wide))
    full()
    return b"".join(done)


def _pack(x: float) -> int | None:
    """The 30-bit form of a number, if it has one."""
    for hundred in (0, 1):
        whole = round(x * (100 if hundred else 1))
        if -(1 << 29) <= whole < 1 << 29:
            rk = (whole << 2 & 0xFFFFFFFF) | 2 | hundred
            if _packed(rk) == x:
                return rk
    bits, = struct.unpack("<Q", struct.pack("<d", x))
    return bits >> 32 if not bits & 0x3FFFFFFFF else None


def workbook_bytes(header: list[str], rows: list[list], numeric: set[str], sheet: str = "Sheet1",
                   date1904: bool = False) -> bytes:
    """A workbook of one sheet: ``header``, then ``rows`` of texts; the columns
    ``numeric`` as numbers, neighbouring packed ones in one record."""
    if len(rows) + 1 > MAX_ROWS:
        raise ValueError(f"more than {MAX_ROWS} rows")
    index: dict[str, int] = {}
    total, cells = 0, bytearray()
    for r, values in enumerate([header, *rows]):
        packed: list[tuple[int, int]] = []
        for c, v in [*enumerate(values), (len(values) + 1, None)]:
            x = float(v) if v is not None and r and header[c] in numeric else None
            rk = None if x is None else _pack(x)
            if packed and (rk is None or c != packed[-1][0] + 1):
                first = packed[0][0]
                body = b"".join(struct.pack("<HI", 0, k) for _, k in packed)
                cells += _record(RK, struct.pack("<HH", r, first) + body) if len(packed) == 1 else \
                    _record(MULRK, struct.pack("<HH", r, first) + body + struct.pack("<H", packed[-1][0]))
                packed = []
            if rk is not None:
                packed.append((c, rk))
            elif x is not None:
                cells += _record(NUMBER, struct.pack("<HHHd", r, c, 0, x))
            elif v is not None:
                total += 1
                at = index.setdefault(str(v), len(index))
                cells += _record(LABELSST, struct.pack("<HHHI", r, c, 0, at))
    wide = any(ord(c) > 255 for c in sheet)
    name = struct.pack("<BB", len(sheet), int(wide)) + sheet.encode("utf-16-le" if wide else "latin-1")
    begin = _record(BOF, struct.pack("<HHHHII", 0x0600, 5, 0, 0, 0, 0)) + _record(DATEMODE, struct.pack("<H", date1904))
    end = _shared_records(list(index), total) + _record(EOF, b"")
    place = len(begin) + 4 + 6 + len(name) + len(end)
    book = begin + _record(BOUNDSHEET, struct.pack("<IBB", place, 0, 0) + name) + end
    book += _record(BOF, struct.pack("<HHHHII", 0x0600, 0x10, 0, 0, 0, 0)) + bytes(cells) + _record(EOF, b"")
    return _compound(book)


def _compound(stream: bytes, size: int = 512) -> bytes:
    """A compound file of one stream; a small one lies in the root's mini sectors."""
    small = len(stream) < MINI_LIMIT
    body = [stream]
    if small:   # directory, mini allocation table, mini sectors
        minis = -(-len(stream) // 64)
        table = [*range(1, minis), END] if minis else []
        body.append(struct.pack(f"<{len(table)}I", *table) + struct.pack("<I", FREE) * (-len(table) % (size // 4)))
    counts = [-(-len(b) // size) for b in body]
    plain = 1 + sum(counts)
    fats = difats = 0
    while True:
        need = -(-(plain + fats + difats) // (size // 4))
        more = max(0, -(-(need - HEADER_FATS) // (size // 4 - 1)))
        if (need, more) == (fats, difats):
            break
        fats, difats = need, more
    fat, starts, at = [END], [], 1      # sector 0: the directory
    for n in counts:
        starts.append(at if n else END)
        fat += [*range(at + 1, at + n), END] if n else []
        at += n
    fat_at, difat_at = list(range(at, at + fats)), list(range(at + fats, at + fats + difats))
    fat += [FAT_SECTOR] * fats + [DIFAT_SECTOR] * difats
    fat += [FREE] * (-len(fat) % (size // 4))

    def entry(name: str, kind: int, child: int, start: int, length: int) -> bytes:
        text = name.encode("utf-16-le") + b"\0\0" if name else b""
        return (text.ljust(64, b"\0") + struct.pack("<HBBIII", len(text), kind, 1, FREE, FREE, child) + bytes(36)
                + struct.pack("<IQ", start, length))

    directory = entry("Root Entry", 5, 1, starts[0] if small else END, 64 * -(-len(stream) // 64) if small else 0)
    directory += entry("Workbook", 2, FREE, 0 if small else starts[0], len(stream)) + entry("", 0, FREE, 0, 0) * 2
    listed = [*fat_at[:HEADER_FATS], *[FREE] * (HEADER_FATS - fats)]
    head = (MAGIC + bytes(16) + struct.pack("<HHHHH", 0x3E, 3, 0xFFFE, 9, 6) + bytes(6)
            + struct.pack("<II", 0, fats) + struct.pack("<III", 0, 0, MINI_LIMIT)
            + struct.pack("<II", starts[1] if small else END, counts[1] if small else 0)
            + struct.pack("<II", difat_at[0] if difats else END, difats) + struct.pack(f"<{HEADER_FATS}I", *listed))
    out = [head, directory, *(b.ljust(n * size, b"\0") for b, n in zip(body, counts)), struct.pack(f"<{len(fat)}I", *fat)]
    rest, per = fat_at[HEADER_FATS:], size // 4 - 1
    for k in range(difats):
        own = rest[k * per:(k + 1) * per]
        out.append(struct.pack(f"<{per + 1}I", *own, *[FREE] * (per - len(own)),
                               difat_at[k + 1] if k + 1 < difats else END))
    return b"".join(out)
