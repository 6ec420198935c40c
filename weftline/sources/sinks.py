"""Sinks: JSON Lines, matrices, metagraph documents, build records, and small driver-side file helpers."""

from __future__ import annotations

import json
import os
import re
import tarfile
import urllib.request
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def jsonl(df: DataFrame, path: str, mode: str = "error", compression: str | None = None) -> None:
    """JSON Lines; absent values are left out."""
    writer = df.write.mode(mode).option("ignoreNullFields", True)
    (writer.option("compression", compression) if compression else writer).json(path)


def tsv_matrix(df: DataFrame, row: str, column: str, value: str) -> DataFrame:
    """Rows by columns with 0 where there is nothing."""
    return df.groupBy(row).pivot(column).agg(F.sum(value)).na.fill(0).orderBy(row)


def nested_counts(df: DataFrame, keys: list[str], count: str) -> dict:
    """A count table as nested dicts, larger subtrees first; for summaries, whose size is that of the vocabulary."""
    out: dict = {}
    for r in df.select(*keys, count).toLocalIterator():
        at = out
        for k in keys[:-1]:
            at = at.setdefault(r[k], {})
        at[r[keys[-1]]] = r[count]

    def total(x: dict | int) -> int:
        return x if isinstance(x, int) else sum(map(total, x.values()))

    def ordered(x: dict | int) -> dict | int:
        return x if isinstance(x, int) else {k: ordered(v) for k, v in sorted(x.items(), key=lambda kv: (-total(kv[1]), str(kv[0])))}

    return ordered(out)


def metagraph(document: dict, folder: str, graph: str, version: str | None = None) -> str:
    path = Path(folder, f"{graph}{'-' + version if version else ''}_metagraph.json")
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(document, indent=2))
    return str(path)


#: The build record: its required properties with their JSON types, and the optional ones.
BUILD_REQUIRED = {"kg_version": "string", "package_version": "string", "biolink_version": "string", "build_timestamp": "string", "git_commit": "string", "sources": "array", "steps_run": "object", "build_duration_minutes": "number"}
BUILD_OPTIONAL = {"kg_label": "string", "node_count": "integer", "edge_count": "integer", "source_versions": "object"}


def build_schema() -> dict:
    """JSON Schema of the build record, from the tables above; the committed copy must equal it."""
    of = lambda kind: {"type": kind} | ({"items": {"type": "string"}} if kind == "array" else {})
    return {"$schema": "https://json-schema.org/draft/2020-12/schema", "title": "BuildRecord", "type": "object", "additionalProperties": False, "required": sorted(BUILD_REQUIRED), "properties": {k: of(v) for k, v in sorted((BUILD_REQUIRED | BUILD_OPTIONAL).items())}}


def build_record(path: str, **values) -> dict:
    """Check and write a build record; sets are written as sorted lists."""
    values.setdefault("build_timestamp", datetime.now(UTC).isoformat())
    values = {k: sorted(v) if isinstance(v, set | frozenset | tuple) else v for k, v in values.items()}
    if missing := sorted(set(BUILD_REQUIRED) - set(values)):
        raise ValueError(f"missing: {', '.join(missing)}")
    if unknown := sorted(set(values) - set(BUILD_REQUIRED) - set(BUILD_OPTIONAL)):
        raise ValueError(f"unknown: {', '.join(unknown)}")
    kinds = {"string": str, "array": list, "object": dict, "number": (int, float), "integer": int}
    for k, v in values.items():
        if not isinstance(v, kinds[(BUILD_REQUIRED | BUILD_OPTIONAL)[k]]):
            raise ValueError(f"{k} is no {(BUILD_REQUIRED | BUILD_OPTIONAL)[k]}")
    Path(path).write_text(json.dumps(values, indent=2, sort_keys=True))
    return values


def download(url: str, path: str) -> str | None:
    """A file fetched once; half a file is never left under its name. None if the server has none."""
    if os.path.exists(path):
        return path
    try:
        urllib.request.urlretrieve(url, f"{path}.part")
    except urllib.error.HTTPError as e:
        if e.code == 404:
            return None
        raise
    os.replace(f"{path}.part", path)
    return path


def load_or_fetch(path: str, fetch) -> object:
    """The JSON file if it is there, else what fetch() gives, kept there."""
    if os.path.exists(path):
        return json.loads(Path(path).read_text())
    value = fetch()
    Path(path).write_text(json.dumps(value))
    return value


def tarball(paths: list[str], folder: str) -> str:
    """The files in a .tar.gz that is named after the words all their names share."""
    words = [re.split(r"[_\-.]", Path(p).name) for p in paths]
    shared = [w for w in words[0] if all(w in x for x in words[1:])] or ["files"]
    target = str(Path(folder, "_".join(w for w in shared if w not in ("jsonl", "json", "gz", "tsv")) + ".tar.gz"))
    with tarfile.open(target, "w:gz") as t:
        for p in paths:
            t.add(p, arcname=Path(p).name)
    return target
