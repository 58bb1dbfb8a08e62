"""A release archive to the raw table: unpacked, checked, written by state with a manifest."""

from __future__ import annotations

import json
import re
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import SparkSession

from waymark.schema import RAW_COLUMNS
from waymark.sources.sinks import write_by_state
from waymark.sources.text_release import member_bytes, read_text, unpack


def expected_rows(archive: str | Path) -> int | None:
    """The number of features that a metadata file in the archive states, if one does."""
    with zipfile.ZipFile(archive) as opened:
        for info in opened.infolist():
            if info.filename.lower().endswith(".xml"):
                text = b"".join(member_bytes(opened, info)).decode("utf-8", "replace")
                if found := re.search(r"<gmd:geometricObjectCount>\s*<gco:Integer>([0-9]+)</gco:Integer>", text):
                    return int(found[1])
    return None


def ingest(spark: SparkSession, archive: str | Path, folder: str | Path) -> dict:
    """Writes folder/release/raw and manifest.json beside it; gives the manifest."""
    text, release = unpack(archive, folder)
    home = Path(folder) / release
    home.mkdir(parents=True, exist_ok=True)
    rows = read_text(spark, str(text), RAW_COLUMNS, line_breaks=True)
    write_by_state(rows, str(home / "raw"), "State")
    manifest = {"release": release, "zip": Path(archive).name, "rows": spark.read.parquet(str(home / "raw")).count(), "expected_rows": expected_rows(archive), "columns": RAW_COLUMNS}
    (home / "manifest.json").write_text(json.dumps(manifest, indent=1), encoding="utf-8")
    return manifest


def newest(folder: str | Path, pattern: str = r"r(\d+)") -> Path | None:
    """The release folder with the largest number."""

    def numbered() -> Iterator[tuple[int, Path]]:
        for path in Path(folder).iterdir():
            if found := re.fullmatch(pattern, path.name):
                yield int(found[1]), path

    return max(numbered(), default=(0, None))[1] if Path(folder).exists() else None
