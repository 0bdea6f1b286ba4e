"""Reuse of finished output.

A job that may be repeated notes next to its output (``<out>.manifest``) what
it is made of: a fingerprint of its input files and parameters, the state
(``started`` before the first byte is written, ``committed`` after the last)
and the number of rows.  A repeated job takes the output as it is only if the
manifest is committed, the fingerprint is the same and the output still holds
that many rows; an output that was left half-written or that stems from other
inputs is built again.  An output without a manifest is not ours: it is never
replaced.

The fingerprint is taken from the file listing (names, lengths, modification
times), so no input is read for it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession

STARTED, COMMITTED = "started", "committed"


def _path(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _path(spark, path)
    return fs.exists(hpath)


def manifest_path(out: str) -> str:
    return out.rstrip("/") + ".manifest"


def fingerprint(spark: SparkSession, inputs: Sequence[str], parameters: dict) -> str:
    """Digest of the files under ``inputs`` and of the parameters."""
    digest = hashlib.sha256(json.dumps(parameters, sort_keys=True, default=str).encode())
    for path in inputs:
        fs, hpath = _path(spark, path)
        listed, files = fs.listFiles(hpath, True), []
        while listed.hasNext():
            f = listed.next()
            files.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        digest.update(json.dumps([path, sorted(files)]).encode())
    return digest.hexdigest()


def read_manifest(spark: SparkSession, out: str) -> dict | None:
    """The manifest of ``out``; ``{}`` if it cannot be read (its writer was
    killed), None if there is none."""
    fs, hpath = _path(spark, manifest_path(out))
    if not fs.exists(hpath):
        return None
    stream = fs.open(hpath)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        found = json.loads(text)
    except json.JSONDecodeError:
        return {}
    return found if isinstance(found, dict) else {}


def write_manifest(spark: SparkSession, out: str, **entries) -> None:
    fs, hpath = _path(spark, manifest_path(out))
    stream = fs.create(hpath, True)
    try:
        stream.write(bytearray(json.dumps(entries, sort_keys=True).encode()))
    finally:
        stream.close()


def build_or_reuse(spark: SparkSession, out: str, print_: str, build: Callable[[], int],
                   rows: Callable[[], int]) -> bool:
    """Run ``build`` (writes ``out``, replacing it, and returns its rows)
    unless ``out`` is a finished output of the same fingerprint with as many
    ``rows`` as noted.  True if it was built."""
    known, there = read_manifest(spark, out), exists(spark, out)
    if there and known is None:
        raise FileExistsError(f"{out} exists and has no manifest: not replaced")
    if there and known.get("state") == COMMITTED and known.get("fingerprint") == print_ and known.get("rows") == rows():
        return False
    write_manifest(spark, out, state=STARTED, fingerprint=print_)
    write_manifest(spark, out, state=COMMITTED, fingerprint=print_, rows=build())
    return True
