"""Versions of a folder of tables: each build has a folder of its own, one small note says which builds are current.

Publishing writes a note with the next number under another name and renames
it. A reader takes the whole note with the highest number, so it sees the builds of
one version and never a half-written one; a writer that dies leaves the former
version as it was. Numbers are claimed first, so two writers never write one note:
of two that publish at a time the higher number counts, and each is complete.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.sources.tables import read_note, store_of, write_note

VERSIONS = "_versions"


def _numbers(spark: SparkSession, root: str, suffix: str) -> list[int]:
    at, store = store_of(spark, f"{root}/{VERSIONS}")
    if not store.exists(at):
        return []
    names = [status.getPath().getName() for status in store.listStatus(at)]
    return sorted(int(name.removesuffix(suffix)) for name in names if name.endswith(suffix) and name[0].isdigit())


def _place(root: str, number: int, suffix: str = ".json") -> str:
    return f"{root}/{VERSIONS}/{number:012d}{suffix}"


def current_version(spark: SparkSession, root: str) -> dict | None:
    """The content of the version that readers see, or None when nothing was published."""
    numbers = _numbers(spark, root, ".json")
    return read_note(spark, _place(root, numbers[-1])) if numbers else None


def publish_version(spark: SparkSession, root: str, content: dict) -> int:
    """Make ``content`` the current version; its number."""
    number = max([0, *_numbers(spark, root, ".json"), *_numbers(spark, root, ".claim")])
    claimed = False
    while not claimed:
        number += 1
        at, store = store_of(spark, _place(root, number, ".claim"))
        claimed = store.createNewFile(at)
    draft = f"{root}/{VERSIONS}/_{uuid.uuid4().hex}"
    write_note(spark, draft, content)
    source, store = store_of(spark, draft)
    if not store.rename(source, store_of(spark, _place(root, number))[0]):
        raise RuntimeError(f"version {number} of {root} could not be published")
    return number


def expire_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Forget all but the newest ``keep`` versions and delete the builds that only they name; the deleted folders.

    Builds that no version names, such as one under way, are left alone. A reader of a forgotten version fails.
    """
    if keep < 1:
        raise ValueError("the current version is always kept")
    numbers = _numbers(spark, root, ".json")
    folders = {n: {t["path"] for t in read_note(spark, _place(root, n))["tables"].values()} for n in numbers}
    stay = set().union(*[folders[n] for n in numbers[-keep:]])
    gone = sorted(set().union(*[folders[n] for n in numbers[:-keep]]) - stay)
    for path in [*[_place(root, n) for n in numbers[:-keep]], *gone]:  # notes first: they never name what is gone
        at, store = store_of(spark, path)
        store.delete(at, True)
    return gone


def files_digest(spark: SparkSession, paths: str | list[str]) -> str:
    """Digest of path, length and modification time of every file under ``paths`` (files, folders or globs).

    Files are listed and their statuses added up by Spark; no content is read.
    """
    listed = spark.read.format("binaryFile").load(paths).select("path", "length", "modificationTime")
    status = F.xxhash64("path", "length", "modificationTime")
    whole = listed.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0)),
        F.coalesce(F.bit_xor(status), F.lit(0)), F.coalesce(F.sum(status.cast("decimal(38,0)")), F.lit(0)),
    )
    return ":".join(str(value) for value in whole.first())


def input_digest(df: DataFrame) -> str | None:
    """``files_digest`` of the files a frame reads, or None when it reads none."""
    from urllib.parse import unquote

    files = sorted({_literal(unquote(name)) for name in df.inputFiles()})
    return files_digest(df.sparkSession, files) if files else None


def _literal(path: str) -> str:
    """A path in which no character stands for others."""
    return "".join("\\" + c if c in "\\*?[]{}" else c for c in path)


def version_paths(content: Mapping | None) -> dict[str, str]:
    """Folder of each table of a version."""
    return {name: table["path"] for name, table in (content or {}).get("tables", {}).items()}
