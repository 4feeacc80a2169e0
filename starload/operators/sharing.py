"""Sharing one base between several output tables.

Several outputs derived from one base can either recompute it or read a
shared copy, pruned to the columns they use:

* ``"none"``: each output re-reads the base. Right for columnar files,
  where every output reads only its own columns.
* ``"persist"``: the pruned base is cached (memory, spilling to disk) by the
  first output that reads it; lost blocks are recomputed from lineage.
* ``"checkpoint"``: the pruned base is checkpointed once to the shared
  checkpoint folder and the lineage cut.
* ``"stage"``: the pruned base is written once as a Parquet table in the
  shared checkpoint folder and read back; outputs then read only their own
  columns of it. For costly bases (joins, remote or row-format sources).

* ``"auto"``: ``"none"`` when the base's physical plan is only a Parquet or
  ORC scan with projections and filters (cheap to re-read column by
  column), else ``"stage"``.

Checkpointed and staged data survive the loss of executors without
recomputation. ``write_outputs`` deletes a staged copy when all outputs are
written; checkpoints are cleaned by Spark or the cluster's retention policy.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from starload.functions.columns import quoted
from starload.operators.lattice import Member
from starload.session import drop_path, scratch_path, shared_dir
from starload.sinks.tables import Existing, Sink, write_lattice

log = logging.getLogger("starload")

SHARE_MODES = ("auto", "none", "persist", "checkpoint", "stage")

# physical operators that only read, prune or filter a columnar file scan
_CHEAP_NODES = {"Project", "Filter", "ColumnarToRow", "FileScan", "Union"}
_COLUMNAR = {"parquet", "orc"}


def _physical_plan(df: DataFrame) -> str:
    """The physical plan's tree, from the plan object; empty where the driver's
    JVM is out of reach (Spark Connect)."""
    jdf = getattr(df, "_jdf", None)
    return jdf.queryExecution().sparkPlan().treeString() if jdf is not None else ""


def is_plain_columnar_scan(df: DataFrame) -> bool:
    """True when ``df`` is only a Parquet/ORC scan with projections and
    filters, or a union of such (unknown shapes say False)."""
    lines = [ln for ln in _physical_plan(df).splitlines() if ln.strip()]
    if not lines:
        return False
    for ln in lines:
        node = re.sub(r"^[\s:+\-*()\d]*", "", ln)
        name = node.split(" ", 1)[0].split("(", 1)[0]
        if name == "InMemoryTableScan":
            return True  # already cached by the caller: reading it again is cheap
        if name not in _CHEAP_NODES:
            return False
        if name == "FileScan" and (node.split(" ") + [""])[1].lower() not in _COLUMNAR:
            return False
    return True


def resolve_share(base: DataFrame, share: str) -> str:
    if share not in SHARE_MODES:
        raise ValueError(f"share must be one of {SHARE_MODES}, not {share!r}")
    if share == "auto":
        share = "none" if is_plain_columnar_scan(base) else "stage"
        log.info("share=auto resolved to %s", share)
    return share


def share_base(base: DataFrame, columns: Sequence[str], share: str) -> tuple[DataFrame, str | None]:
    """``base`` pruned to ``columns`` and shared as ``share`` says (already
    resolved: not ``"auto"``), with the staged table's path for ``"stage"``."""
    if share not in SHARE_MODES or share == "auto":
        raise ValueError(f"share must be one of {SHARE_MODES[1:]}, not {share!r}")
    pruned = base.selectExpr(*[quoted(c) for c in columns])
    if share == "persist":
        return pruned.persist(StorageLevel.MEMORY_AND_DISK), None
    if share == "checkpoint":
        shared_dir(pruned.sparkSession)
        return pruned.checkpoint(eager=True), None
    if share == "stage":
        spark = pruned.sparkSession
        path = scratch_path(spark, "shared-base")
        pruned.write.parquet(path)
        log.info("staged shared base (%d columns) at %s", len(columns), path)
        return spark.read.schema(pruned.schema).parquet(path), path
    return pruned, None


@dataclass
class Outputs:
    """Lazy output frames plus the handle on the base they share. ``members``
    names the frames that hold each row once, so that those of fewer columns
    can be derived from the others when they are written."""

    frames: dict[str, DataFrame]
    base: DataFrame
    share: str
    staged_path: str | None = None  # the staged table, for the caller's clean-up
    members: Mapping[str, Member] = field(default_factory=dict)
    _released: bool = field(default=False, repr=False)

    def __getitem__(self, name: str) -> DataFrame:
        return self.frames[name]

    def release(self) -> None:
        """Uncaches the base, or deletes its staged copy: its frames end here."""
        if not self._released and self.share == "persist":
            self.base.unpersist()
        if not self._released and self.staged_path:
            drop_path(self.base.sparkSession, self.staged_path)
        self._released = True


def write_outputs(outputs: Outputs, sink: Sink, parallel: int | None = None,
                  existing: Existing | None = None) -> dict[str, object]:
    """Write every output with ``sink(frame, table_name)``, then release the
    shared base. Writes are submitted ``parallel`` at a time (default: all at
    once), so small jobs fill the slots a long one leaves idle. Members are
    written as ``write_lattice`` says: from the smallest member that holds
    their columns, and with an appending sink only what is new."""
    try:
        return write_lattice(outputs.frames, outputs.members, sink, parallel, existing)
    finally:
        outputs.release()
