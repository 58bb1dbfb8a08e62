"""Downloads and paged services, on the driver; every opener and clock can be given, so that nothing here needs a network to be tested."""

from __future__ import annotations

import csv
import json
import time
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from email.utils import parsedate_to_datetime
from pathlib import Path

CHUNK = 1 << 20
Opener = Callable[..., object]


def portal_metadata(portal: str, dataset: str, opener: Opener = urllib.request.urlopen) -> dict:
    """A portal's description of a dataset."""
    with opener(f"{portal}/api/views/{dataset}.json", timeout=60) as answer:
        return json.load(answer)


def blob_url(portal: str, dataset: str, metadata: Mapping) -> str:
    """Where the file of a described dataset is."""
    return f"{portal}/api/views/{dataset}/files/{metadata['blobId']}?{urllib.parse.urlencode({'filename': metadata['blobFilename']})}"


def download(url: str, target: Path, size: int | None = None, progress: Callable[[int], None] | None = None, opener: Opener = urllib.request.urlopen) -> Path:
    """The file at url; a partial copy is resumed if the server can, a complete one is kept."""
    if target.exists() and (size is None or target.stat().st_size == size):
        return target
    target.parent.mkdir(parents=True, exist_ok=True)
    draft = target.with_name(f"{target.name}.part")
    have = draft.stat().st_size if draft.exists() else 0
    request = urllib.request.Request(url, headers={"Range": f"bytes={have}-"} if have else {})
    with opener(request, timeout=300) as answer:
        resumed = have and getattr(answer, "status", 200) == 206
        have = have if resumed else 0
        with draft.open("ab" if resumed else "wb") as out:
            while part := answer.read(CHUNK):
                have += out.write(part)
                if progress:
                    progress(have)
    if size is not None and have != size:
        raise OSError(f"{url}: {have} bytes, {size} expected")
    draft.replace(target)
    return target


def fetch_release(portal: str, dataset: str, folder: Path, opener: Opener = urllib.request.urlopen, progress: Callable[[int], None] | None = None) -> Path:
    """The dataset's file, named by its blob, with its description beside it."""
    metadata = portal_metadata(portal, dataset, opener)
    target = folder / f"{metadata['blobId']}.zip"
    download(blob_url(portal, dataset, metadata), target, metadata.get("blobFileSize"), progress, opener)
    target.with_suffix(".json").write_text(json.dumps(metadata), encoding="utf-8")
    return target


def get_json(url: str, query: Mapping[str, object] | None = None, tries: int = 4, wait: Callable[[int], float] = lambda n: 10.0 * 3**n, opener: Opener = urllib.request.urlopen, sleep: Callable[[float], None] = time.sleep) -> dict:
    """A JSON answer; failures, and errors that the service reports inside an answer, are tried again after a growing wait."""
    where = f"{url}?{urllib.parse.urlencode(query)}" if query else url
    for attempt in range(tries):
        try:
            with opener(where, timeout=120) as answer:
                said = json.load(answer)
            if "error" not in said:
                return said
            problem: Exception = OSError(f"{url}: {said['error']}")
        except (OSError, ValueError) as failed:
            problem = failed
        if attempt + 1 < tries:
            sleep(wait(attempt))
    raise problem


def id_pages(low: int, high: int, size: int) -> list[tuple[int, int]]:
    """Ranges of ids, both ends included, that cover low to high."""
    return [(start, min(start + size - 1, high)) for start in range(low, high + 1, size)]


def layer_rows(url: str, columns: Sequence[str], get: Callable[..., dict] = get_json, where: str = "", workers: int = 4) -> Iterator[dict]:
    """All rows of a feature layer, in order of id: the id span comes from statistics, pages are asked for side by side."""
    about = get(url, {"f": "json"})
    key = about.get("objectIdField") or next(f["name"] for f in about["fields"] if f["type"].endswith("OID"))
    wanted = [{"statisticType": kind, "onStatisticField": key, "outStatisticFieldName": name} for kind, name in (("min", "LO"), ("max", "HI"))]
    span = get(f"{url}/query", {"f": "json", "where": where or "1=1", "outStatistics": json.dumps(wanted)})["features"]
    if not span or span[0]["attributes"]["LO"] is None:
        return
    low, high = (int(span[0]["attributes"][name]) for name in ("LO", "HI"))

    def page(ids: tuple[int, int]) -> list[dict]:
        condition = f"{key} BETWEEN {ids[0]} AND {ids[1]}" + (f" AND ({where})" if where else "")
        asked = {"f": "json", "where": condition, "outFields": ",".join(columns), "returnGeometry": "true", "outSR": 4326, "orderByFields": key}
        return [{**f["attributes"], **{f"_{'lon' if c == 'x' else 'lat'}": f.get("geometry", {}).get(c) for c in "xy"}} for f in get(f"{url}/query", asked)["features"]]

    with ThreadPoolExecutor(max(1, workers)) as pool:
        for rows in pool.map(page, id_pages(low, high, int(about.get("maxRecordCount") or 1000))):
            yield from rows


def offset_rows(url: str, query: Mapping[str, object], size: int = 1000, get: Callable[..., dict] = get_json) -> Iterator[dict]:
    """All features of a query by offset, until a page is empty."""
    offset = 0
    while found := get(f"{url}/query", {**query, "f": "json", "resultOffset": offset, "resultRecordCount": size}).get("features"):
        yield from found
        offset += len(found)


def write_rows(rows: Iterator[Mapping], columns: Sequence[str], target: Path) -> int:
    """A CSV of the columns, written aside and renamed when complete; says how many rows it has."""
    target.parent.mkdir(parents=True, exist_ok=True)
    draft, n = target.with_name(f"{target.name}.part"), 0
    with draft.open("w", encoding="utf-8", newline="") as out:
        writer = csv.DictWriter(out, list(columns), extrasaction="ignore")
        writer.writeheader()
        for n, row in enumerate(rows, 1):
            writer.writerow(row)
    draft.replace(target)
    return n


def fetch_source(source, folder: Path, get: Callable[..., dict] = get_json, opener: Opener = urllib.request.urlopen) -> Path:
    """The raw CSV of a declared source, kept once it is complete."""
    target = folder / f"{source.id}.csv"
    if target.exists():
        return target
    access = source.access
    if access.protocol == "socrata":
        return download(access.url, target, opener=opener)
    if access.protocol != "arcgis":
        raise ValueError(f"{source.id}: rows cannot be fetched by {access.protocol!r}")
    columns, position = source.layout.asked(), ("_lon", "_lat")
    write_rows(layer_rows(access.url, [c for c in columns if c not in position], get, workers=access.side_by_side), [*columns, *(c for c in position if c not in columns)], target)
    return target


def layer_version(url: str, opener: Opener = urllib.request.urlopen) -> dict[str, str]:
    """The tag and the day of publication of a remote file."""
    with opener(urllib.request.Request(url, method="HEAD"), timeout=60) as answer:
        return {"etag": answer.headers["ETag"], "published": parsedate_to_datetime(answer.headers["Last-Modified"]).date().isoformat()}


def first_answer(endpoints: Sequence[str], body: str, post: Callable[[str, str], dict]) -> dict:
    """The answer of the first endpoint that gives one; what failed is said without the endpoints' addresses, which may hold keys."""
    failures = []
    for place, endpoint in enumerate(endpoints, 1):
        try:
            return post(endpoint, body)
        except OSError as failed:
            failures.append(f"endpoint {place}: {type(failed).__name__}")
    raise OSError("; ".join(failures) or "no endpoint given")


def map_elements(answer: Mapping) -> tuple[list[dict], list[tuple[str, bool]]]:
    """Of a map service's elements, addresses and road names (name, alternate); alternates that are names as well count as names."""
    addresses, names, others = [], set(), set()
    for element in answer.get("elements", ()):
        tags, at = element.get("tags", {}), element.get("center") or element
        if "addr:housenumber" in tags:
            addresses.append({"lat": at.get("lat"), "lon": at.get("lon"), **{key: tags.get(f"addr:{key}") for key in ("housenumber", "street", "city", "postcode")}})
        if "highway" in tags:
            names |= {tags["name"]} if tags.get("name") else set()
            others |= {part.strip() for key in ("alt_name", "official_name", "old_name", "short_name") for part in tags.get(key, "").split(";") if part.strip()}
    return addresses, [*((name, False) for name in sorted(names)), *((name, True) for name in sorted(others - names))]


def post_form(url: str, fields: Mapping[str, str], tries: int = 6, wait: Callable[[int], float] = lambda n: 60.0 * (n + 1), opener: Opener = urllib.request.urlopen, sleep: Callable[[float], None] = time.sleep) -> dict:
    """The JSON answer to a form. A busy service (429, 5xx, no answer in time, a dropped connection) is asked again; other refusals are raised at once."""
    for attempt in range(tries):
        try:
            with opener(urllib.request.Request(url, data=urllib.parse.urlencode(fields).encode()), timeout=1800) as answer:
                return json.load(answer)
        except OSError as failed:
            code = getattr(failed, "code", None)
            if code is not None and code != 429 and code < 500 or attempt + 1 == tries:
                raise
        sleep(wait(attempt))
    raise OSError("no try was allowed")


def history_fields(features: Sequence[Mapping], days: Sequence[str], what: str) -> dict[str, str]:
    """The form that asks for counts of what in features (each with properties.id), at days."""
    return {"bpolys": json.dumps({"type": "FeatureCollection", "features": list(features)}, separators=(",", ":")), "filter": what, "time": ",".join(days), "format": "json"}


def history_series(answer: Mapping, names: Sequence[str], days: Sequence[str]) -> dict[str, list[int]]:
    """Counts by name in the order of days; an answer for other names or days than asked for is an error."""
    said = {group["groupByObject"]: {result["timestamp"][:10]: round(result["value"]) for result in group["result"]} for group in answer["groupByResult"]}
    if said.keys() != set(names):
        raise ValueError(f"asked for {len(names)} areas; {sorted(said.keys() ^ set(names))[:5]} are missing or too many")
    for name, found in said.items():
        if list(found) != list(days):
            raise ValueError(f"{name}: the days are not those asked for")
    return {name: list(said[name].values()) for name in names}
