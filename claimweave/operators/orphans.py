"""Orphan references along a foreign-key graph, direct and inherited.

A reference is orphaned *directly* when its target does not exist, or exists
but not at the time of the referring row.  A row that refers to an orphaned
record is orphaned by *inheritance*; the cascade goes down the graph until a
round adds nothing.

Defined results: a null reference is none; a null time of the row is only held
against existence; a target without a start has held for ever, without an end
it still holds; repeated rows of one id count once per distinct reference;
placeholder keys such as 0 or -1 are references like any other; empty tables
have no orphans, and against an empty target table every reference is one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.operators.skew import lookup_join
from claimweave.operators.staging import Staged, stage, tidy

_COLUMNS = ("ref_table", "row_id", "field", "ref_value", "at", "kind", "depth")


@dataclass(frozen=True)
class ForeignKey:
    """``child.field`` refers to ``parent.parent_key``; ``start`` and ``end`` bound when a target holds."""

    child: str
    child_id: str
    field: str
    parent: str
    parent_key: str
    at: str | None = None
    start: str | None = None
    end: str | None = None


def _references(tables: dict[str, DataFrame], fk: ForeignKey) -> DataFrame:
    t = tables[fk.child]
    at = F.col(fk.at).cast("timestamp") if fk.at else F.lit(None).cast("timestamp")
    return t.where(F.col(fk.field).isNotNull()).select(F.col(fk.child_id).cast("bigint").alias("row_id"), F.col(fk.field).cast("string").alias("ref_value"), at.alias("at"))


def _targets(tables: dict[str, DataFrame], fk: ForeignKey) -> DataFrame:
    """One row per target with the interval it holds; repeats of a record keep the earliest start."""
    t = tables[fk.parent].where(F.col(fk.parent_key).isNotNull())
    start = F.min(F.coalesce(F.col(fk.start).cast("timestamp"), F.timestamp_micros(F.lit(-(2**60))))) if fk.start else F.min(F.timestamp_micros(F.lit(-(2**60))))
    end = F.max(F.col(fk.end).cast("timestamp")) if fk.end else F.max(F.lit(None).cast("timestamp"))
    return t.groupBy(F.col(fk.parent_key).cast("string").alias("ref_value")).agg(start.alias("held_from"), end.alias("held_to"))


def direct_orphans(tables: dict[str, DataFrame], fk: ForeignKey) -> DataFrame:
    """Distinct orphaned references of one foreign key, hot placeholder keys kept apart."""
    joined = lookup_join(_references(tables, fk), _targets(tables, fk), "ref_value")
    missing = F.col("held_from").isNull()
    early = F.col("at") < F.col("held_from")
    late = F.col("at") >= F.col("held_to")
    return (
        joined.where(missing | F.coalesce(early, F.lit(False)) | F.coalesce(late, F.lit(False)))
        .select(F.lit(fk.child).alias("ref_table"), "row_id", F.lit(fk.field).alias("field"), "ref_value", "at", F.lit("direct").alias("kind"), F.lit(0).alias("depth"))
        .distinct()
    )


@tidy
def orphan_cascade(tables: dict[str, DataFrame], keys: list[ForeignKey]) -> DataFrame:
    """Direct and inherited orphans: ref_table, row_id, field, ref_value, at, kind, depth.

    Round n finds the rows whose target is a record orphaned in round n-1 and
    that are not orphaned through the same field already; the loop ends with
    the first round that finds none, so cycles in the graph end as well.
    """
    direct = None
    for fk in keys:
        part = direct_orphans(tables, fk)
        direct = part if direct is None else direct.unionByName(part)
    found: list[Staged] = [stage(direct, "orphans")]
    # only tables whose own id is what others refer to can pass orphanhood on
    passing = [fk for fk in keys if any(up.child == fk.parent and up.child_id == fk.parent_key for up in keys)]
    depth = 0
    while passing:
        depth += 1
        known = found[0].df
        for f in found[1:]:
            known = known.unionByName(f.df)
        frontier = found[-1].df.select("ref_table", F.col("row_id").cast("string").alias("ref_value")).distinct()
        inherited = None
        for fk in passing:
            heads = frontier.where(F.col("ref_table") == fk.parent).select("ref_value")
            rows = (
                lookup_join(_references(tables, fk), heads.withColumn("__lost", F.lit(True)), "ref_value")
                .where("__lost")
                .select(F.lit(fk.child).alias("ref_table"), "row_id", F.lit(fk.field).alias("field"), "ref_value", "at", F.lit("inherited").alias("kind"), F.lit(depth).alias("depth"))
                .distinct()
            )
            inherited = rows if inherited is None else inherited.unionByName(rows)
        fresh = stage(inherited.join(known.select("ref_table", "row_id", "field"), ["ref_table", "row_id", "field"], "left_anti"), "orphans")
        if fresh.empty():
            fresh.drop()
            break
        found.append(fresh)
    out = found[0].df
    for f in found[1:]:
        out = out.unionByName(f.df)
    return out.select(*_COLUMNS)


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphans per table, field, month and kind."""
    return orphans.groupBy("ref_table", "field", F.date_format("at", "yyyy-MM").alias("month"), "kind").agg(
        F.count(F.lit(1)).alias("n_references"), F.countDistinct("row_id").alias("n_rows"), F.countDistinct("ref_value").alias("n_targets")
    )
