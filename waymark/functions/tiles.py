"""Web-Mercator tile arithmetic as expressions, and vector tiles and directories of an archive as bytes.

The formats are public: Mapbox Vector Tile 2.1, and version 3 of the archive format for tiles.
"""

from __future__ import annotations

import gzip
import struct
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from itertools import accumulate

from pyspark.sql import Column
from pyspark.sql import functions as F

EXTENT = 4096
#: Where the square world of the projection ends.
MOST_LATITUDE = 85.0511287798066


def world_units(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    """(px, py): whole units of EXTENT a tile, from the west and the north."""
    size = 2**zoom * EXTENT
    x = (lon + 180.0) / 360.0 * F.lit(float(size))
    north = F.least(F.greatest(lat, F.lit(-MOST_LATITUDE)), F.lit(MOST_LATITUDE))
    y = (0.5 - F.log(F.tan(F.pi() / 4 + F.radians(north) / 2)) / (2 * F.pi())) * F.lit(float(size))
    whole = lambda v: F.least(F.greatest(F.floor(v).cast("long"), F.lit(0)), F.lit(size - 1)).cast("long")
    return whole(x), whole(y)


def tile_number(zoom: str, x: str, y: str) -> Column:
    """The archive's number of a tile: the tiles of smaller zooms, and the place on the zoom's Hilbert curve."""
    m, bx, by = "(shiftleft(1L, k) - 1)", "(shiftright(a.x, k) & 1)", "(shiftright(a.y, k) & 1)"
    lx, ly = f"(a.x & {m})", f"(a.y & {m})"
    turned = lambda straight, crossed: f"if({by} = 1, {straight}, if({bx} = 1, {m} - {crossed}, {crossed}))"
    step = f"(a, k) -> named_struct('x', {turned(lx, ly)}, 'y', {turned(ly, lx)}, 'd', a.d + shiftleft((3 * {bx}) ^ {by}, 2 * k))"
    place = f"aggregate(sequence({zoom} - 1, 0, -1), named_struct('x', cast({x} as bigint), 'y', cast({y} as bigint), 'd', 0L), {step}).d"
    return F.expr(f"if({zoom} = 0, 0L, cast((shiftleft(1L, 2 * {zoom}) - 1) / 3 as bigint) + {place})")


def numbered_tile(number: int) -> tuple[int, int, int]:
    """(zoom, x, y) of a tile's number."""
    zoom = 0
    while number >= 4**zoom:
        number -= 4**zoom
        zoom += 1
    x = y = 0
    for k in range(zoom):
        bits = number >> 2 * k & 3
        bx, by = bits >> 1, (bits ^ bits >> 1) & 1
        if not by:
            x, y = ((1 << k) - 1 - y, (1 << k) - 1 - x) if bx else (y, x)
        x, y = x | bx << k, y | by << k
    return zoom, x, y


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def varints(raw: bytes, at: int = 0, end: int | None = None) -> Iterator[int]:
    value = shift = 0
    for byte in memoryview(raw)[at:end]:
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            yield value
            value = shift = 0


def _field(number: int, payload: bytes) -> bytes:
    return varint(number << 3 | 2) + varint(len(payload)) + payload


class TileLayer:
    """A layer of points with text properties, put together feature by feature."""

    def __init__(self, name: str) -> None:
        self.name, self.keys, self.values, self.features = name, {}, {}, []

    def add(self, x: int, y: int, properties: Sequence[tuple[str, str]]) -> None:
        tags = b"".join(varint(self.keys.setdefault(key, len(self.keys))) + varint(self.values.setdefault(value, len(self.values))) for key, value in properties)
        body = (_field(2, tags) if tags else b"") + b"\x18\x01" + _field(4, b"\x09" + varint(2 * x) + varint(2 * y))
        self.features.append(_field(2, body))

    def packed(self) -> bytes:
        """The tile, compressed; equal layers give equal bytes."""
        keys = b"".join(_field(3, key.encode()) for key in self.keys)
        values = b"".join(_field(4, _field(1, value.encode())) for value in self.values)
        layer = _field(1, self.name.encode()) + b"".join(self.features) + keys + values + b"\x28" + varint(EXTENT) + b"\x78\x02"
        return gzip.compress(_field(3, layer), 6, mtime=0)


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = number()
        size = number()
        if key & 7 == 2:
            yield key >> 3, raw[at : at + size]
            at += size
        else:
            yield key >> 3, size


def tile_points(tile: bytes) -> Iterator[tuple[str, int, int, dict[str, str]]]:
    """(layer, x, y, properties) of each point of a packed tile."""
    for _, layer in _fields(gzip.decompress(tile)):
        parts: dict[int, list] = {}
        for number, value in _fields(layer):
            parts.setdefault(number, []).append(value)
        keys = [key.decode() for key in parts.get(3, [])]
        values = [next(v for n, v in _fields(value) if n == 1).decode() for value in parts.get(4, [])]
        for feature in parts.get(2, []):
            own = dict(_fields(feature))
            tags = list(varints(own.get(2, b"")))
            _, x, y = varints(own[4])
            yield parts[1][0].decode(), x >> 1, y >> 1, {keys[k]: values[v] for k, v in zip(tags[::2], tags[1::2], strict=True)}


#: (tile number, offset, length, run length); a run length of zero points to a leaf directory.
Entry = tuple[int, int, int, int]


def directory(entries: Sequence[Entry]) -> bytes:
    """A directory, compressed; entries are in order of their tiles."""
    numbers = [entry[0] for entry in entries]
    steps = [b - a for a, b in zip([0, *numbers], numbers, strict=False)]
    follows = [k > 0 and entry[1] == entries[k - 1][1] + entries[k - 1][2] for k, entry in enumerate(entries)]
    offsets = [0 if after else entry[1] + 1 for entry, after in zip(entries, follows, strict=True)]
    columns = ([len(entries)], steps, [e[3] for e in entries], [e[2] for e in entries], offsets)
    return gzip.compress(b"".join(varint(n) for column in columns for n in column), 6, mtime=0)


def entries_of(raw: bytes) -> list[Entry]:
    n, *rest = varints(gzip.decompress(raw))
    steps, runs, lengths, offsets = (rest[k * n : (k + 1) * n] for k in range(4))
    out: list[Entry] = []
    for number, run, length, offset in zip(accumulate(steps), runs, lengths, offsets, strict=True):
        out.append((number, offset - 1 if offset else out[-1][1] + out[-1][2], length, run))
    return out


def entry_of(entries: Sequence[Entry], number: int) -> Entry | None:
    """The entry that a tile, or a leaf directory that may have it, is found by."""
    k = bisect_right(entries, number, key=lambda entry: entry[0]) - 1
    if k < 0 or entries[k][3] and number >= entries[k][0] + entries[k][3]:
        return None
    return entries[k]


#: The archive header's fields in order, and codes of compression (gzip) and tile type (vector).
HEADER = struct.Struct("<7sB11QBBBBBBiiiiBii")
FIELDS = "magic version root_at root_size metadata_at metadata_size leaves_at leaves_size data_at data_size tiles entries contents clustered internal compression type least most west south east north centre_zoom centre_lon centre_lat".split()
MAGIC, GZIP, VECTOR = b"PMTiles", 2, 1
#: Bytes from the beginning that hold the header and the root directory.
BEGINNING = 16_384


def packed_header(**fields: object) -> bytes:
    given = {"magic": MAGIC, "version": 3, "clustered": 1, "internal": GZIP, "compression": GZIP, "type": VECTOR, **fields}
    return HEADER.pack(*(given[name] for name in FIELDS))


def read_header(raw: bytes) -> dict:
    header = dict(zip(FIELDS, HEADER.unpack(raw[: HEADER.size]), strict=True))
    if header["magic"] != MAGIC or header["version"] != 3:
        raise ValueError("no tile archive of version 3")
    return header
