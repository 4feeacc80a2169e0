"""A store of tables whose loads are atomic and repeatable.

A load writes every table into a folder of its own and then one commit: a
small file that lists, for every table of the store, the folders that make it
up. Readers take the latest commit and nothing else, so until it is there they
see the store as it was, whatever a load that failed or was killed has left
behind. An appended load adds its folders to those of the commit before, a
replacing one names its own in their place.

The commits are the ledger too: each one names the load it belongs to. A load
whose id is in the ledger is not run again, so a load can be repeated after any
failure without adding a row twice.

Layout: ``<root>/<table>/<stamp>/*.parquet`` and
``<root>/_commits/<version>-<md5 of the load id>.json``.
"""

from __future__ import annotations

import hashlib
import json
import logging
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starload.operators.conform import conform
from starload.session import _context
from starload.sinks.files import write_parquet

log = logging.getLogger("starload")

COMMITS = "_commits"


class CommitConflict(RuntimeError):
    """Another load has committed since this one began."""


@dataclass(frozen=True)
class Part:
    """One load's rows of a table: their folder below the root, and their schema as JSON text."""

    folder: str
    schema: str


@dataclass(frozen=True)
class Snapshot:
    """The store after one load."""

    version: int
    load_id: str
    tables: Mapping[str, Sequence[Part]] = field(default_factory=dict)

    def to_json(self) -> str:
        tables = {t: [[p.folder, p.schema] for p in parts] for t, parts in self.tables.items()}
        return json.dumps({"version": self.version, "load_id": self.load_id, "tables": tables})

    @classmethod
    def from_json(cls, text: str) -> "Snapshot":
        d = json.loads(text)
        return cls(d["version"], d["load_id"], {t: [Part(*p) for p in parts] for t, parts in d["tables"].items()})


class _Files:
    """The store's few small files and folder names, through the root's Hadoop
    file system. Table rows never pass here."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        sc = _context(spark)
        if sc is None:
            raise RuntimeError("commits are files of the driver's Hadoop file system, which is out of reach here")
        self._jvm = sc._jvm
        self._root = root
        self._fs = self._path("").getFileSystem(sc._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self._root}/{name}")

    def names(self, folder: str) -> list[str]:
        at = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
        finally:
            stream.close()

    def claim(self, name: str) -> bool:
        """Makes an empty file; False if there is one. One of several claimants gets it."""
        at = self._path(name)
        self._fs.mkdirs(at.getParent())
        return bool(self._fs.createNewFile(at))

    def write_whole(self, name: str, text: str) -> None:
        """Under its final name the file is there whole or not at all."""
        draft = self._path(f"{COMMITS}/.draft-{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        if not self._fs.rename(draft, self._path(name)):
            raise CommitConflict(f"could not put {name} in place")

    def drop(self, name: str) -> bool:
        return bool(self._fs.delete(self._path(name), True))


class TableStore:
    """Tables under ``root``; see the module's text."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._files = _Files(spark, self.root)

    def _commits(self) -> list[str]:
        return sorted(n for n in self._files.names(COMMITS) if n.endswith(".json") and not n.startswith("."))

    def snapshot(self, version: int | None = None) -> Snapshot | None:
        """The store as of a version (default: the latest); None if nothing was committed."""
        names = self._commits()
        if version is not None:
            names = [n for n in names if int(n.split("-")[0]) == version]
            if not names:
                raise KeyError(f"no version {version} in {self.root}")
        return Snapshot.from_json(self._files.read(f"{COMMITS}/{names[-1]}")) if names else None

    def committed(self, load_id: str) -> Snapshot | None:
        """The load's commit, if the ledger has it. Only names are listed."""
        mark = _mark(load_id)
        names = [n for n in self._commits() if n.endswith(f"-{mark}.json")]
        return Snapshot.from_json(self._files.read(f"{COMMITS}/{names[-1]}")) if names else None

    def read(self, table: str, version: int | None = None, snapshot: Snapshot | None = None) -> DataFrame:
        """A table's rows as of a version, in the columns and types of its latest load."""
        snapshot = snapshot or self.snapshot(version)
        parts = list(snapshot.tables.get(table, ())) if snapshot else []
        if not parts:
            raise KeyError(f"no table {table!r} in {self.root}")
        by_schema: dict[str, list[str]] = {}
        for p in parts:
            by_schema.setdefault(p.schema, []).append(f"{self.root}/{p.folder}")
        last = T.StructType.fromJson(json.loads(parts[-1].schema))
        frames = [conform(self.spark.read.schema(T.StructType.fromJson(json.loads(s))).parquet(*folders), last, strict=True)
                  for s, folders in by_schema.items()]
        return reduce(DataFrame.unionByName, frames)

    def load(self, load_id: str, write: Callable[["StoreSink"], object], mode: str = "overwrite",
             schemas: Mapping[str, T.StructType] | None = None, strict: bool = False) -> Snapshot:
        """Runs ``write(sink)`` and commits all that the sink was given, or nothing.

        ``mode``: ``overwrite`` replaces the tables that are written, ``append``
        adds to them; others stay. A load that the ledger has is not run. If
        ``write`` fails, its folders are dropped and the store is as before;
        what a killed load leaves is no part of any commit (``vacuum`` drops
        it). Of loads that run side by side the first to commit wins and the
        others fail with CommitConflict.
        """
        if mode not in ("overwrite", "append"):
            raise ValueError(f"mode must be overwrite or append, not {mode!r}")
        done = self.committed(load_id)
        if done is not None:
            log.info("load %s is version %d already", load_id, done.version)
            return done
        before = self.snapshot()
        sink = StoreSink(self, before, uuid.uuid4().hex, mode, dict(schemas or {}), strict)
        try:
            write(sink)
            tables = dict(before.tables) if before else {}
            for table, part in sink.parts.items():
                tables[table] = [*(tables.get(table, ()) if mode == "append" else ()), part]
            after = Snapshot(before.version + 1 if before else 1, load_id, tables)
            self._commit(after)
        except BaseException:
            for table in sink.begun:
                self._files.drop(f"{table}/{sink.stamp}")
            raise
        return after

    def _commit(self, after: Snapshot) -> None:
        """Takes the version, then puts the commit in place; the claim of a load
        that died between the two is given up by ``vacuum``."""
        if not self._files.claim(f"{COMMITS}/{after.version:012d}.claim"):
            raise CommitConflict(f"version {after.version} of {self.root} is taken")
        self._files.write_whole(f"{COMMITS}/{after.version:012d}-{_mark(after.load_id)}.json", after.to_json())

    def vacuum(self, keep: int = 1) -> list[str]:
        """Drops the folders that none of the last ``keep`` versions names, and
        returns them. The ledger stays. Not to be run beside a load."""
        names = self._commits()
        kept = [Snapshot.from_json(self._files.read(f"{COMMITS}/{n}")) for n in names[-max(1, keep):]]
        used = {p.folder for s in kept for parts in s.tables.values() for p in parts}
        gone = [f"{t}/{stamp}" for t in self._files.names("") if t != COMMITS for stamp in self._files.names(t)
                if f"{t}/{stamp}" not in used]
        for folder in gone:
            self._files.drop(folder)
        versions = {n.split("-")[0] for n in names}
        for n in self._files.names(COMMITS):
            if n.startswith(".draft-") or (n.endswith(".claim") and n.split(".")[0] not in versions):
                self._files.drop(f"{COMMITS}/{n}")
        return gone


def _mark(load_id: str) -> str:
    return hashlib.md5(load_id.encode("utf-8")).hexdigest()


class StoreSink:
    """The ``sink(frame, table)`` of one load of a ``TableStore``."""

    def __init__(self, store: TableStore, before: Snapshot | None, stamp: str, mode: str,
                 schemas: Mapping[str, T.StructType], strict: bool) -> None:
        self.store, self.before, self.stamp, self.mode = store, before, stamp, mode
        self.schemas, self.strict = schemas, strict
        self.begun: set[str] = set()
        self.parts: dict[str, Part] = {}

    def path(self, table: str) -> str:
        return f"{self.store.root}/{table}/{self.stamp}"

    def __call__(self, df: DataFrame, table: str, schema: T.StructType | None = None) -> str:
        if not table or "/" in table or table.startswith(("_", ".")):
            raise ValueError(f"{table!r} cannot name a folder of tables")
        if table in self.begun:
            raise ValueError(f"table {table!r} is written twice in one load")
        self.begun.add(table)
        schema = schema or self.schemas.get(table)
        df = conform(df, schema, strict=self.strict) if schema is not None else df
        write_parquet(df, self.path(table), mode="error")
        self.parts[table] = Part(f"{table}/{self.stamp}", df.schema.json())
        return self.path(table)

    def shaped(self, df: DataFrame, table: str) -> DataFrame:
        """A frame of distinct rows as the table will hold them."""
        schema = self.schemas.get(table)
        return df if schema is None or schema == df.schema else conform(df, schema, strict=self.strict).distinct()

    def existing(self, df: DataFrame, table: str) -> DataFrame | None:
        """The table as committed before this load, in the types of ``df``; None if there is none."""
        if self.before is None or table not in self.before.tables:
            return None
        return conform(self.store.read(table, snapshot=self.before), df.schema, strict=True)

    def rereads(self, df: DataFrame, table: str) -> bool:
        return (self.schemas.get(table) or df.schema) == df.schema

    def reread(self, df: DataFrame, table: str) -> DataFrame:
        """The rows that this load has written, and no older ones."""
        return self.store.spark.read.schema(df.schema).parquet(self.path(table))
