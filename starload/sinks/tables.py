"""Write several output tables of one plan with one sink."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import Future, ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from starload.functions.columns import quoted
from starload.operators.lattice import Member, containment, depth
from starload.session import drop_path, scratch_path

Sink = Callable[[DataFrame, str], object]
#: The table of that name as it is so far, or None; given the new frame too.
Existing = Callable[[DataFrame, str], "DataFrame | None"]


def new_members(df: DataFrame, name: str, sink: Sink, existing: Existing | None = None) -> DataFrame:
    """What an appending sink should get of ``df``, a frame that holds each row
    once: the rows that their table does not have yet (NULL equals NULL). The
    frame is brought to the form in which the sink writes it first. File sinks
    know their tables; for another appending sink ``existing`` must read them.
    Other modes change nothing."""
    if getattr(sink, "mode", "overwrite") != "append" and existing is None:
        return df
    existing = existing or getattr(sink, "existing", None)
    if existing is None:
        raise ValueError("an appending sink needs existing= to read the members its tables hold")
    shaped = getattr(sink, "shaped", None)
    df = shaped(df, name) if shaped else df
    old = existing(df, name)
    if old is None:
        return df
    same = reduce(lambda a, b: a & b, (df[quoted(c)].eqNullSafe(old[quoted(c)]) for c in df.columns))
    return df.join(old, same, "left_anti")


def write_and_reread(sink: Sink, df: DataFrame, name: str, counted: DataFrame | None = None) -> tuple[object, DataFrame] | None:
    """Writes ``df`` (or ``counted``, the same rows) and gives what the sink
    returns and the rows as they lie in the table; None, with nothing written,
    if the sink cannot tell them from older ones."""
    frame = df if counted is None else counted
    if hasattr(sink, "rereads") and sink.rereads(df, name):
        return sink(frame, name), sink.reread(df, name)
    if hasattr(sink, "appends_apart") and sink.appends_apart(df, name):
        return sink.appended(frame, name)
    return None


def _described(spark: SparkSession, name: str) -> None:
    try:  # name the jobs in the event log; thread-local, absent under Spark Connect
        spark.sparkContext.setJobDescription(f"starload: write {name}")
    except Exception:
        pass


def run_jobs(spark: SparkSession, jobs: Mapping[str, Callable[[], object]], parallel: int | None = None) -> dict[str, object]:
    """Every job, ``parallel`` at a time (default: all at once), started in the
    given order. Concurrent jobs share the cluster, so small ones run in the
    slots that a long one leaves idle."""
    parallel = len(jobs) if parallel is None else parallel

    def one(name: str) -> object:
        _described(spark, name)
        return jobs[name]()

    if parallel <= 1:
        return {name: one(name) for name in jobs}
    # wrapped here, in the caller's thread, so every write inherits its job
    # group, scheduler pool and other local properties (cancellation works)
    target = inheritable_thread_target(spark)(one)
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        futures = {name: pool.submit(target, name) for name in jobs}
        return {name: f.result() for name, f in futures.items()}


def write_tables(frames: Mapping[str, DataFrame], sink: Sink, parallel: int | None = None) -> dict[str, object]:
    """``sink(frame, name)`` for every table."""
    if not frames:
        return {}
    spark = next(iter(frames.values())).sparkSession
    return run_jobs(spark, {name: lambda n=name, d=df: sink(d, n) for name, df in frames.items()}, parallel)


def write_lattice(frames: Mapping[str, DataFrame], members: Mapping[str, Member], sink: Sink,
                  parallel: int | None = None, existing: Existing | None = None) -> dict[str, object]:
    """Writes ``frames``; those in ``members`` from one another where they can be.

    A member whose columns another one holds waits for the smallest such
    member and is derived from that one's rows in this load, so the base is
    read only by the members that no other holds. The rows are read back from
    the table just written where it holds them all and the sink can tell them
    from older ones (``write_and_reread``), else from a scratch copy that is dropped at
    the end. With an appending sink, members get only rows that their tables do
    not hold yet.
    """
    if not frames:
        return {}
    spark = next(iter(frames.values())).sparkSession
    parents = containment({name: members[name] for name in frames if name in members})
    held: dict[str, Future] = {p: Future() for p in parents.values() if p is not None}
    appends = getattr(sink, "mode", "overwrite") == "append" or existing is not None
    copies: list[str] = []

    def staged(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, f"member-{name}")
        copies.append(path)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def member(name: str) -> object:
        try:
            parent = parents[name]
            rows = frames[name] if parent is None else members[name].table(held[parent].result())
            if name not in held:
                return sink(new_members(rows, name, sink, existing), name)
            # into a table that is not there yet go all rows, also when appending
            whole = not appends or (existing is None and hasattr(sink, "existing") and sink.existing(rows, name) is None)
            written = write_and_reread(sink, rows, name) if whole else None
            if written is not None:
                held[name].set_result(written[1])
                return written[0]
            rows = staged(rows, name)
            held[name].set_result(rows)
            return sink(new_members(rows, name, sink, existing), name)
        except BaseException as e:  # the members that wait for this one must not wait for ever
            if name in held and not held[name].done():
                held[name].set_exception(e)
            raise

    # a job never starts before the one it waits for; those that others wait for come first
    order = sorted(frames, key=lambda n: (depth(parents, n), n not in held))
    jobs = {name: (lambda n=name: member(n) if n in parents else sink(frames[n], n)) for name in order}
    try:
        done = run_jobs(spark, jobs, parallel)
        return {name: done[name] for name in frames}
    finally:
        for path in copies:
            drop_path(spark, path)
