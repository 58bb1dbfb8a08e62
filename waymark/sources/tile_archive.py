"""Points to an archive of vector tiles, and an archive to points.

Every kept point is in exactly one tile of the largest zoom, with no limit on a tile. Smaller zooms are thinned for
display: of the points of a cell of THIN units the first by an order stays. Cells of a zoom are four of the next
larger one, so the first of those of the zoom below the largest decide for all others.

Tiles are numbered along the archive's Hilbert curve. Points are partitioned and sorted by that number; a task streams
its tiles, one at a time, into a file of its own, so the archive is the files one behind the other. Entries of equal
neighbours are one run. Directories are made in tasks, a leaf each; the driver holds the leaves' places and the sizes of
the parts. On a file system each part is copied to its place in the archive by a task; on other stores the driver
passes pieces on.

Points without a position are in no tile; null and blank properties are left out of a feature. An empty table gives an archive without tiles.
"""

from __future__ import annotations

import gzip
import json
import os
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions import tiles as T
from waymark.sources.shared import Files, remove, shared_folder
from waymark.sources.sinks import TAGS

LAYER, LEAST, MOST = "addresses", 10, 14
#: Units of a tile's side that one point stays of, at the zooms below the largest.
THIN = 64
#: Entries of a leaf directory, and of a root that needs no leaves.
LEAF = 4096

ENTRIES = "part string, number long, tile long, offset long, length long, run long, points long"
ENTRIES_ARROW = pa.schema([("part", pa.string()), *((name, pa.int64()) for name in "number tile offset length run points".split())])
LEAVES = "leaf long, first long, n long, payload binary"
POINTS = "zoom int, tile_x long, tile_y long, x int, y int, layer string, properties map<string,string>"


def tiled(points: DataFrame, order: Column, least: int = LEAST, most: int = MOST, thin: int = THIN) -> DataFrame:
    """(zoom, tile_x, tile_y, tile, x, y, order, tags): a row for each zoom that a kept point is shown at."""
    px, py = T.world_units(F.col("lon"), F.col("lat"), most)
    kept = points.where("drop_reason is null and lon is not null and lat is not null and not isnan(lon) and not isnan(lat)")
    tags = F.struct(*(F.col(f"addr_{tag}").cast("string").alias(tag) for tag in TAGS))
    full = kept.select(px.alias("px"), py.alias("py"), order.alias("order"), tags.alias("tags"))
    rows = full.withColumn("zoom", F.lit(most))
    if least < most:
        at = lambda column, zoom: F.expr(f"shiftright({column}, {most} - {zoom})")
        first = lambda rows, *cell: rows.groupBy(*cell).agg(F.min(F.struct("order", "px", "py", "tags")).alias("p")).select(*cell, "p.*")
        fine = first(full.withColumns({"cx": F.floor(at("px", most - 1) / thin), "cy": F.floor(at("py", most - 1) / thin)}), "cx", "cy").drop("cx", "cy")
        every = fine.withColumn("zoom", F.explode(F.sequence(F.lit(least), F.lit(most - 1))))
        coarse = first(every.withColumns({"cx": F.floor(at("px", "zoom") / thin), "cy": F.floor(at("py", "zoom") / thin)}), "zoom", "cx", "cy")
        rows = coarse.select("px", "py", "order", "tags", "zoom").unionByName(rows)
    rows = rows.withColumns({"px": F.expr(f"shiftright(px, {most} - zoom)"), "py": F.expr(f"shiftright(py, {most} - zoom)")})
    rows = rows.withColumns({"tile_x": F.floor(F.col("px") / T.EXTENT), "tile_y": F.floor(F.col("py") / T.EXTENT)})
    place = lambda c: F.pmod(F.col(c), F.lit(T.EXTENT)).cast("int")
    return rows.select("zoom", "tile_x", "tile_y", T.tile_number("zoom", "tile_x", "tile_y").alias("tile"), place("px").alias("x"), place("py").alias("y"), "order", "tags")


def _encode(batches: Iterator[pa.RecordBatch], folder: str, layer: str) -> Iterator[pa.RecordBatch]:
    """Rows (tile, x, y, tags) in order of tile to a file of tiles, and the entries of its tiles."""
    from pyspark import TaskContext

    part, files = f"part-{TaskContext.get().partitionId():06d}", Files(folder)
    entries: list[list[int]] = []
    names = [f"addr:{tag}" for tag in TAGS]

    def made() -> Iterator[tuple[int, bytes, int]]:
        current, held = None, None
        for batch in batches:
            for tile, x, y, tags in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if tile != current:
                    if held:
                        yield current, held.packed(), len(held.features)
                    current, held = tile, T.TileLayer(layer)
                held.add(x, y, [(name, value) for name, value in zip(names, tags.values(), strict=True) if value and value.strip()])
        if held:
            yield current, held.packed(), len(held.features)

    def contents() -> Iterator[bytes]:
        offset, before = 0, None
        for tile, payload, points in made():
            if entries and payload == before and tile == entries[-1][0] + entries[-1][3]:
                entries[-1][3] += 1
                entries[-1][4] += points
                continue
            entries.append([tile, offset, len(payload), 1, points])
            offset, before = offset + len(payload), payload
            yield payload

    files.write(part, contents())
    if entries:
        tile, offset, length, run, points = zip(*entries, strict=True)
        yield pa.RecordBatch.from_pydict({"part": [part] * len(tile), "number": range(len(tile)), "tile": tile, "offset": offset, "length": length, "run": run, "points": points}, schema=ENTRIES_ARROW)


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (leaf, tile, offset, length, run) in order to directories."""
    held: list[T.Entry] = []
    current = None

    def finish() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"leaf": [current], "first": [held[0][0]], "n": [len(held)], "payload": [T.directory(held)]})

    for batch in batches:
        for leaf, *entry in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if leaf != current and held:
                yield finish()
                held = []
            current = leaf
            held.append(tuple(entry))
    if held:
        yield finish()


def _place(batches: Iterator[pa.RecordBatch], folder: str, target: str) -> Iterator[pa.RecordBatch]:
    """Copies parts to their places in a file that is as long as it has to be."""
    files = Files(folder)
    for batch in batches:
        for part, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            with open(target, "r+b") as out:
                out.seek(at)
                for piece in files.parts(part):
                    out.write(piece)
        yield batch


def _local(uri: str) -> str | None:
    """The path of a file, if every executor can write to it by that."""
    if uri.startswith("file:"):
        return uri.removeprefix("file://").removeprefix("file:")
    return uri if "://" not in uri else None


def write_archive(points: DataFrame, target: str, order: Column | None = None, least: int = LEAST, most: int = MOST, layer: str = LAYER, metadata: Mapping[str, object] | None = None) -> dict:
    """Writes the archive; gives its sidecar: points, layer, zooms, tags, file and bytes. order decides which points stay in thinned zooms."""
    spark = points.sparkSession
    order = F.xxhash64("lon", "lat", *(f"addr_{tag}" for tag in TAGS)) if order is None else order
    work = shared_folder(spark, "tiles")
    rows = tiled(points, order, least, most).repartitionByRange("tile").sortWithinPartitions("tile", "order", "x", "y", "tags").select("tile", "x", "y", "tags")
    rows.mapInArrow(lambda batches: _encode(batches, f"{work}/data", layer), ENTRIES).write.parquet(f"{work}/entries")
    entries = spark.read.schema(ENTRIES).parquet(f"{work}/entries")

    parts = entries.groupBy("part").agg(F.min("tile").alias("tile"), F.count(F.lit(1)).alias("n"), F.sum("length").alias("size"), F.sum("run").alias("tiles")).orderBy("tile").collect()
    at = n = 0
    places = []
    for row in parts:
        places.append((row.part, n, at))
        n, at = n + row.n, at + row["size"]
    begins = spark.createDataFrame(places, "part string, before long, base long")
    own = entries.join(F.broadcast(begins), "part").select(F.floor((F.col("before") + F.col("number")) / LEAF).alias("leaf"), "tile", (F.col("base") + F.col("offset")).alias("offset"), "length", "run")
    own.repartition("leaf").sortWithinPartitions("leaf", "tile").mapInArrow(_leaves, LEAVES).write.parquet(f"{work}/leaves")
    leaves = spark.read.schema(LEAVES).parquet(f"{work}/leaves").orderBy("leaf")
    index = leaves.select("first", F.octet_length("payload").alias("size"), F.when(F.lit(n <= LEAF), F.col("payload")).alias("payload")).collect()
    if n <= LEAF:
        root, index = index[0].payload if index else T.directory([]), []
    else:
        ends = [0]
        for row in index:
            ends.append(ends[-1] + row["size"])
        root = T.directory([(row["first"], start, row["size"], 0) for row, start in zip(index, ends, strict=False)])
    if T.HEADER.size + len(root) > T.BEGINNING:
        raise ValueError("the root directory is too large; take a larger LEAF")
    tags = [f"addr:{tag}" for tag in TAGS]
    about = {"vector_layers": [{"id": layer, "fields": dict.fromkeys(tags, "String"), "minzoom": least, "maxzoom": most}], **(metadata or {})}
    said = gzip.compress(json.dumps(about, separators=(",", ":")).encode(), 6, mtime=0)

    shown = points.where("drop_reason is null and not isnan(lon) and not isnan(lat)").agg(*(F.coalesce(f(c), F.lit(0.0)).alias(f"{c}_{f.__name__}") for c in ("lon", "lat") for f in (F.min, F.max))).first()
    e7 = lambda v: round(max(-180.0, min(180.0, v)) * 1e7)
    total = entries.where(F.col("tile") >= (4**most - 1) // 3).agg(F.coalesce(F.sum("points"), F.lit(0))).first()[0]
    spans = {"root": len(root), "metadata": len(said), "leaves": sum(row["size"] for row in index), "data": at}
    fields, end = {}, T.HEADER.size
    for name, size in spans.items():
        fields |= {f"{name}_at": end, f"{name}_size": size}
        end += size
    west, east, south, north = map(e7, shown)
    header = T.packed_header(**fields, tiles=sum(row.tiles for row in parts), entries=n, contents=n, least=least, most=most, west=west, south=south, east=east, north=north, centre_zoom=least, centre_lon=(west + east) // 2, centre_lat=(south + north) // 2)

    def beginning() -> Iterator[bytes]:
        yield header + root + said
        if index:
            for row in leaves.select("payload").toLocalIterator():
                yield bytes(row.payload)

    folder, name = target.rsplit("/", 1)
    path = _local(target)
    if path:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        draft = f"{path}.part"
        with open(draft, "wb") as out:
            for piece in beginning():
                out.write(piece)
            out.truncate(end)
        spots = spark.createDataFrame([(part, fields["data_at"] + base) for part, _, base in places], "part string, at long")
        spots.repartition(max(1, min(len(places), 200)), "part").mapInArrow(lambda batches: _place(batches, f"{work}/data", draft), "part string, at long").write.format("noop").mode("overwrite").save()
        os.replace(draft, path)
    else:
        data = Files(f"{work}/data")
        Files(folder).write(name, (piece for pieces in (beginning(), *(data.parts(part) for part, _, _ in places)) for piece in pieces))
    remove(spark, work)
    return {"points": total, "layer": layer, "min_zoom": least, "max_zoom": most, "tags": tags, "file": name, "bytes": end}


class Archive:
    """Tiles of an archive by their place, read by range."""

    def __init__(self, uri: str) -> None:
        folder, self.name = uri.rsplit("/", 1)
        self.files = Files(folder)
        raw = self.files.read(self.name, 0, T.BEGINNING)
        self.header = T.read_header(raw)
        self.root = T.entries_of(raw[self.header["root_at"] : self.header["root_at"] + self.header["root_size"]])

    def metadata(self) -> dict:
        return json.loads(gzip.decompress(self.files.read(self.name, self.header["metadata_at"], self.header["metadata_size"])))

    def leaf(self, entry: T.Entry) -> list[T.Entry]:
        return T.entries_of(self.files.read(self.name, self.header["leaves_at"] + entry[1], entry[2]))

    def content(self, entry: T.Entry) -> bytes:
        return self.files.read(self.name, self.header["data_at"] + entry[1], entry[2])

    def tile(self, number: int) -> bytes | None:
        """The packed tile of a number, if there is one."""
        entry = T.entry_of(self.root, number)
        if entry and not entry[3]:
            entry = T.entry_of(self.leaf(entry), number)
        return self.content(entry) if entry else None


def _read_leaves(batches: Iterator[pa.RecordBatch], uri: str) -> Iterator[pa.RecordBatch]:
    archive = Archive(uri)
    schema = pa.schema([("zoom", pa.int32()), ("tile_x", pa.int64()), ("tile_y", pa.int64()), ("x", pa.int32()), ("y", pa.int32()), ("layer", pa.string()), ("properties", pa.map_(pa.string(), pa.string()))])
    for batch in batches:
        for place in batch.column(0).to_pylist():
            entry = archive.root[place]
            for number, offset, length, run in [entry] if entry[3] else archive.leaf(entry):
                payload = archive.content((number, offset, length, run))
                for tile in range(number, number + run):
                    rows = [(*T.numbered_tile(tile), x, y, layer, list(properties.items())) for layer, x, y, properties in T.tile_points(payload)]
                    yield pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def read_archive(spark: SparkSession, uri: str) -> DataFrame:
    """All points of all tiles, by way of the directories: each leaf's tiles are read by one task."""
    n = len(Archive(uri).root)
    return spark.range(n).repartition(max(1, min(n, 1000))).mapInArrow(lambda batches: _read_leaves(batches, uri), POINTS)
