"""Versioned tables of Parquet files: every change is one new small file, so it shows whole or not.

    data/write=<id>/jour_cle=<part>/*.parquet     what one write added to a part (a day, say)
    lists/<id>.json                               the writes of the parts that one commit touched
    versions/<number>.json                        for each part the list that counts, notes, schema

A reader takes the newest version file, then the lists of the parts it wants, and scans just those
folders; no other file is listed. A writer adds files under a new id, lists the parts it touched anew
in one file, and commits by renaming the version file into place. What a failed writer left is named
nowhere. Of two writers that started from one version the second one's commit fails.

The lists keep version files small: they grow with the parts, not with the writes or files.
The rename has to be atomic, as it is on HDFS and local file systems.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from veracast.sources import store

PART = "jour_cle"
# The part of tables and rows that have no day.
WHOLE = "all"
_WRITE = "write"
KEPT_VERSIONS = 10
# Parts that a writing task keeps open side by side; past that, what is left is sorted by part.
_WRITERS, _OPEN_PARTS = "spark.sql.maxConcurrentOutputFileWriters", "32"


@dataclass(frozen=True)
class Version:
    number: int = 0
    # Part to the id of the list of its writes.
    parts: dict[str, str] = field(default_factory=dict)
    # Whatever a writer wants to find again with exactly this state of the table.
    notes: dict = field(default_factory=dict)
    schema: str | None = None


@contextmanager
def writing_side_by_side(spark: SparkSession) -> Iterator[None]:
    """Tasks keep some parts' files open at a time, so that rows need no sort by part before a write.

    A session's own setting stays.
    """
    own = spark.conf.get(_WRITERS, None)
    if own not in (None, "0"):
        yield
        return
    spark.conf.set(_WRITERS, _OPEN_PARTS)
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(_WRITERS)
        else:
            spark.conf.set(_WRITERS, own)


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _version_path(self, number: int) -> str:
        return f"{self.path}/versions/{number:010d}.json"

    def numbers(self) -> list[int]:
        found = store.names(self.spark, f"{self.path}/versions")
        return [int(n[:-5]) for n in found if n.endswith(".json") and not n.startswith(".")]

    def version(self, number: int | None = None) -> Version:
        """A version by number, the newest by default; version 0 is the empty table."""
        if number is None:
            number = max(self.numbers(), default=0)
        if not number:
            return Version()
        return Version(**json.loads(store.read_text(self.spark, self._version_path(number))))

    def writes(self, version: Version, parts: Iterable[str] | None = None) -> dict[str, list[str]]:
        """The ids of the writes that some parts (all by default) consist of."""
        wanted = set(version.parts) if parts is None else set(parts) & set(version.parts)
        lists = {i: self._list(i) for i in sorted({version.parts[p] for p in wanted})}
        return {p: lists[version.parts[p]][p] for p in sorted(wanted)}

    def _list(self, listed: str) -> dict[str, list[str]]:
        return json.loads(store.read_text(self.spark, f"{self.path}/lists/{listed}.json"))

    def folders(self, version: Version, parts: Iterable[str] | None = None) -> list[str]:
        """The data folders of some parts, all by default."""
        return [
            f"{self.path}/data/{_WRITE}={write}/{PART}={part}"
            for part, writes in self.writes(version, parts).items()
            for write in writes
        ]

    def read(
        self,
        schema: T.StructType | None = None,
        parts: Iterable[str] | None = None,
        version: Version | None = None,
    ) -> DataFrame:
        """Rows of some parts (all by default). Files older than a column give null for it."""
        version = version or self.version()
        if schema is None:
            if version.schema is None:
                raise ValueError(f"{self.path} has no version yet")
            schema = T.StructType.fromJson(json.loads(version.schema))
        folders = self.folders(version, parts)
        if not folders:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType(
            [*schema, T.StructField(_WRITE, T.StringType()), T.StructField(PART, T.StringType())]
        )
        reader = self.spark.read.schema(stored).option("basePath", f"{self.path}/data")
        return reader.parquet(*folders).select(*schema.names)

    def add(
        self, rows: DataFrame, part: Column | None, checks: dict[str, Column] | None = None
    ) -> tuple[dict[str, str], dict[str, int]]:
        """Write rows as one new write, not yet part of any version.

        With a part for each row the rows are dealt out by it, heavy parts over several tasks.
        Returns the parts written, each with the write's id, and the number of rows (``rows``) and of
        those meeting each check, counted by the write itself. They are counted behind the last
        shuffle, where a lost executor repeats no task whose rows are already written.
        """
        write, seen = uuid.uuid4().hex, Observation()
        folder = f"{self.path}/data/{_WRITE}={write}"
        if part is None:
            dealt = rows.withColumn(PART, F.lit(WHOLE))
        else:
            dealt = rows.withColumn(PART, part).hint("rebalance", PART)
        counts = [F.count(F.lit(1)).alias("rows")]
        counts += [F.count_if(c).alias(n) for n, c in (checks or {}).items()]
        with writing_side_by_side(rows.sparkSession):
            dealt.observe(seen, *counts).write.partitionBy(PART).parquet(folder)
        found = seen.get
        if not found["rows"]:
            store.remove(self.spark, folder)
            return {}, found
        written = [n.split("=", 1)[1] for n in store.names(self.spark, folder) if "=" in n]
        return {part: write for part in written}, found

    def commit(
        self,
        base: Version,
        added: dict[str, str],
        notes: dict | None = None,
        schema: T.StructType | None = None,
        instead: Iterable[str] | None = (),
    ) -> Version:
        """The version after ``base`` with the writes added.

        ``instead`` names parts whose earlier writes no longer count; None: all parts.
        """
        parts = dict(base.parts) if instead is not None else {}
        for part in instead or ():
            parts.pop(part, None)
        if added:
            earlier = self.writes(base, parts.keys() & added.keys())
            lists = {part: [*earlier.get(part, ()), write] for part, write in added.items()}
            listed = uuid.uuid4().hex
            store.write_text(self.spark, f"{self.path}/lists/{listed}.json", json.dumps(lists))
            parts |= dict.fromkeys(added, listed)
        new = Version(
            base.number + 1,
            parts,
            base.notes if notes is None else notes,
            base.schema if schema is None else schema.json(),
        )
        store.write_once(self.spark, self._version_path(new.number), json.dumps(vars(new)))
        return new

    def replace(
        self, rows: DataFrame, part: Column | None = None, checks: dict[str, Column] | None = None
    ) -> dict[str, int]:
        """Make ``rows`` the whole table; readers see the old one until the commit. Returns counts."""
        base = self.version()
        added, counts = self.add(rows, part, checks)
        self.commit(base, added, schema=rows.schema, instead=None)
        self.expire()
        return counts

    def compact(self, schema: T.StructType, least: int = 8) -> list[str]:
        """Write parts that consist of ``least`` writes or more as one each; returns those parts."""
        base = self.version()
        small = [p for p, writes in self.writes(base).items() if len(writes) >= least]
        if not small:
            return []
        folders = self.folders(base, small)
        stored = T.StructType(
            [*schema, T.StructField(_WRITE, T.StringType()), T.StructField(PART, T.StringType())]
        )
        rows = self.spark.read.schema(stored).option("basePath", f"{self.path}/data").parquet(*folders)
        added, _ = self.add(rows.drop(_WRITE), F.col(PART))
        self.commit(base, added, instead=small)
        return sorted(small)

    def expire(self, keep: int = KEPT_VERSIONS) -> None:
        """Forget all but the newest versions, and delete the writes and lists only those named.

        Readers of a forgotten version lose its files. Files under no version are left alone: they
        may belong to a writer that has not committed yet.
        """
        numbers = sorted(self.numbers())
        old, new = numbers[:-keep], numbers[-keep:]
        if not old:
            return
        kept_lists: set[str] = set()
        kept: set[tuple[str, str]] = set()
        gone: set[tuple[str, str]] = set()
        lists: dict[str, dict] = {}
        for numbered, pairs in ((new, kept), (old, gone)):
            for n in numbered:
                for part, listed in self.version(n).parts.items():
                    if listed not in lists:
                        lists[listed] = self._list(listed)
                    pairs.update((part, write) for write in lists[listed][part])
            if numbered is new:
                kept_lists = set(lists)
        for part, write in gone - kept:
            store.remove(self.spark, f"{self.path}/data/{_WRITE}={write}/{PART}={part}")
        for n in old:
            store.remove(self.spark, self._version_path(n))
        for listed in lists.keys() - kept_lists:
            store.remove(self.spark, f"{self.path}/lists/{listed}.json")
