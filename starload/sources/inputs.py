"""What a frame reads, from the leaves of its plan: for the overwrite guards.

File roots and JDBC tables are taken from the relations themselves, so the
cost follows the number of tables read and not that of their files.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame

#: Leaves that read nothing that a sink could overwrite.
_NO_SOURCE = {"LogicalRDD", "LocalRelation", "Range", "OneRowRelation", "InMemoryRelation"}


def _leaves(df: DataFrame) -> Iterator[object]:
    """Leaves of the analyzed plan (cached frames included) and of the
    optimized one (subqueries included)."""
    execution = df._jdf.queryExecution()
    for plan in (execution.analyzed(), execution.optimizedPlan()):
        leaves = plan.collectLeaves()
        yield from (leaves.apply(i) for i in range(leaves.size()))


def _kind(obj: object) -> str:
    return obj.getClass().getSimpleName()


def file_roots(df: DataFrame) -> set[str]:
    """Root paths of the file tables that ``df`` reads; the single files of a
    source that does not tell its roots."""
    out = set()
    for leaf in _leaves(df):
        relation = leaf.relation() if _kind(leaf) == "LogicalRelation" else None
        if relation is not None and _kind(relation) == "HadoopFsRelation":
            roots = relation.location().rootPaths()
            out |= {roots.apply(i).toString() for i in range(roots.size())}
        elif relation is None and _kind(leaf) not in _NO_SOURCE:
            out |= set(df.inputFiles())
    return out


def jdbc_tables(df: DataFrame) -> set[tuple[str, str]]:
    """(url, table or query) of the JDBC tables that ``df`` reads."""
    relations = [leaf.relation() for leaf in _leaves(df) if _kind(leaf) == "LogicalRelation"]
    options = [r.jdbcOptions() for r in relations if _kind(r) == "JDBCRelation"]
    return {(o.url(), o.tableOrQuery()) for o in options}
