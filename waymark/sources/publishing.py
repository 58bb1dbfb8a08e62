"""Files for others: manifests, features per state, tile and upload commands. Commands are built here and run by the caller."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Mapping, Sequence
from pathlib import Path

from pyspark.sql import DataFrame

from waymark.sources.sinks import geojson_lines


def manifest(points: DataFrame, release: str, **constants: object) -> str:
    """How many points there are in all, per state and per source, beside constants, as JSON."""
    kept = points.where("drop_reason is null")
    counted = lambda c: {row[0]: row[1] for row in kept.groupBy(c).count().orderBy(c).collect()}
    by_state = counted("addr_state")
    return json.dumps({"release": release, **constants, "points": sum(by_state.values()), "states": by_state, "sources": counted("nad_source")}, separators=(",", ":"))


def write_features(points: DataFrame, path: str) -> None:
    """Newline-delimited GeoJSON in one folder per state, from one shuffle whose parts are of like size."""
    geojson_lines(points).hint("rebalance", "addr_state").write.mode("overwrite").partitionBy("addr_state").text(path)


def write_single(rows: DataFrame, folder: str, state: str) -> None:
    """One source's rows as one file below its state."""
    rows.coalesce(1).write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/State={state}")


def tile_command(inputs: Sequence[str], target: str, name: str, attribution: str, least: int = 10, most: int = 14) -> list[str]:
    """The tiler's arguments: every point at the largest zoom, once, and no limits on a tile."""
    return ["tippecanoe", "-o", target, "--force", "-l", "addresses", "-n", name, "-A", attribution, "-Z", str(least), "-z", str(most), "--buffer=0", "--no-feature-limit", "--no-tile-size-limit", "--no-duplication", "-P", *inputs]


def credentials(path: Path, environment: Mapping[str, str] = os.environ, names: Sequence[str] = ("ACCESS_KEY_ID", "SECRET_ACCESS_KEY", "ENDPOINT")) -> dict[str, str]:
    """Of each name, the environment's value or else the file's; one that neither has is an error that shows no value."""
    said = dict(line.split("=", 1) for line in path.read_text(encoding="utf-8").splitlines() if "=" in line and not line.startswith("#")) if path.exists() else {}
    found = {name: environment.get(name) or said.get(name, "").strip() for name in names}
    if missing := [name for name, value in found.items() if not value]:
        raise KeyError(f"missing: {', '.join(missing)}")
    return found


def upload_environment(keys: Mapping[str, str], remote: str = "STORE") -> dict[str, str]:
    """Settings of the uploader, by environment, so that no key stands on a command line."""
    prefix = f"RCLONE_CONFIG_{remote.upper()}_"
    return {f"{prefix}TYPE": "s3", f"{prefix}ACCESS_KEY_ID": keys["ACCESS_KEY_ID"], f"{prefix}SECRET_ACCESS_KEY": keys["SECRET_ACCESS_KEY"], f"{prefix}ENDPOINT": keys["ENDPOINT"], f"{prefix}NO_CHECK_BUCKET": "true"}


def publish(file: Path, bucket: str, alias: str, run: Callable[..., object], environment: Mapping[str, str], remote: str = "store") -> None:
    """Uploads the file, then copies it to its alias on the server, so that the alias is never half a file."""
    target = f"{remote}:{bucket}/{file.name}"
    run(["rclone", "copyto", str(file), target], check=True, env=dict(environment))
    run(["rclone", "copyto", target, f"{remote}:{bucket}/{alias}"], check=True, env=dict(environment))


def update_history(current: Path, change: Callable[[dict], dict], upload: Callable[[Path], None]) -> None:
    """Changes a JSON history in place, with the last copy kept; if the change fails nothing is written or uploaded."""
    before = current.read_text(encoding="utf-8")
    after = json.dumps(change(json.loads(before)), separators=(",", ":"))
    current.with_suffix(".previous.json").write_text(before, encoding="utf-8")
    draft = current.with_suffix(".part")
    draft.write_text(after, encoding="utf-8")
    draft.replace(current)
    upload(current)
