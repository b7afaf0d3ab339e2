"""Train, validation and test splits that keep related records together.

Components of related records live in persisted tables that grow batch by
batch.  A component is named by a record id: the smallest of those that formed
it.  In a batch, records and the components that they or their entities already
belong to are the nodes of a graph, a shared entity is an edge; the graph is
solved by hooking and pointer jumping, and what hangs together becomes one
component.  Records that share nothing skip the graph.

Existing components keep their split, components without one fill the deficits
of the splits, and a merge of components that already sit in different splits
is quarantined: the old components and their records stay where they are, and
the new records of the merge go to the split ``quarantine``, to be looked at.

The state is only added to: a merged component keeps its row and points at the
one that took it over, so entities and records need not be written again.  Only
the table of components is rewritten, with its pointers resolved.

Deficits are filled without a global sort.  Components above a thousandth of
the batch (at most a thousand) are placed one by one, largest first; all others
fall into hash buckets of known size, and the buckets are placed likewise.
Only these bounded counts reach the driver.

Defined results: a record without entities (nulls and empty texts are none) is
a component of its own; repeated rows count once; a record that comes back keeps
its component and split and is not counted again, and what it links now is
merged or quarantined like any other link; a record id of null is ignored; an
empty batch changes nothing; ratios are scaled to sum 1.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.operators.graph import connected_components
from claimweave.operators.skew import lookup_join
from claimweave.operators.staging import stage, tidy

QUARANTINE = "quarantine"
#: A component above this share of the batch is placed by itself.
LARGE_SHARE = 1000
#: Hash buckets that small components are placed by.
BUCKETS = 4096


@dataclass
class SplitState:
    """Persisted tables: entities (entity, component), records (record_id, component) and components (component, root, split, n_records).

    A component is alive if it is its own root.
    """

    entities: DataFrame
    records: DataFrame
    components: DataFrame

    def save(self, path: str) -> None:
        """Write the three tables below ``path``, for the next run to load; a path holds one state."""
        for name in ("entities", "records", "components"):
            getattr(self, name).write.parquet(f"{path}/{name}")

    @staticmethod
    def load(spark: SparkSession, path: str) -> SplitState:
        return SplitState(*[spark.read.parquet(f"{path}/{name}") for name in ("entities", "records", "components")])

    def roots(self) -> DataFrame:
        return self.components.select("component", "root")


def link_rows(records: DataFrame, record_id: str, *entities: str) -> DataFrame:
    """Distinct (record_id, entity), one row per entity column that is set; a record without any has one row with a null."""
    ids = F.col(record_id)
    named = [F.when(F.col(c).cast("string") != "", F.concat(F.lit(f"{c}:"), F.col(c).cast("string"))) for c in entities]
    filled = F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")
    return records.where(ids.isNotNull()).select(ids.alias("record_id"), F.explode_outer(filled).alias("entity")).distinct()


def _hang_together(links: DataFrame, state: SplitState | None) -> tuple[DataFrame, DataFrame]:
    """((record_id, node, known), (node, component)) of a batch.

    The node of a record is the component it is known to belong to, else itself;
    ``component`` is the smallest node of a connected part of the graph, for
    nodes that have an edge.
    """
    records = links.select("record_id").distinct()
    shared = links.where("entity is not null").groupBy("entity").agg(F.min("record_id").alias("label"), F.max("record_id").alias("last"))
    if state is None:
        nodes = records.select("record_id", F.col("record_id").alias("node"), F.lit(False).alias("known"))
        # an entity of one record links nothing
        ends = lookup_join(links.where("entity is not null").withColumnRenamed("record_id", "node"), shared.where("label <> last").select("entity", "label"), "entity")
    else:
        of_entity = state.entities.join(state.roots(), "component").select("entity", "root")
        of_record = state.records.join(state.roots(), "component").select("record_id", F.col("root").alias("old"))
        nodes = stage(records.join(of_record, "record_id", "left").select("record_id", F.coalesce("old", "record_id").alias("node"), F.col("old").isNotNull().alias("known")), "nodes").df
        labels = shared.join(of_entity, "entity", "left").where("label <> last or root is not null").select("entity", "label", "root")
        # an entity whose first record is known goes by that record's component
        first = labels.join(nodes.select(F.col("record_id").alias("label"), F.col("node").alias("first")), "label").select("entity", F.coalesce("root", "first").alias("label"))
        ends = lookup_join(links.where("entity is not null").join(nodes.select("record_id", "node"), "record_id").select("entity", "node"), first, "entity")
    edges = ends.where("label is not null and label <> node").select("node", "label").distinct()
    return nodes, connected_components(edges, "node", "label")


@tidy
def group_batch(links: DataFrame) -> DataFrame:
    """(record_id, component) of the records of a first batch that hang together with another, without placing them."""
    links = stage(links, "links").df
    _, parts = _hang_together(links, None)
    return parts.select(F.col("node").alias("record_id"), "component")


def _place(sizes: list[tuple[str, int]], room: dict[str, float]) -> list[tuple[str, str]]:
    """Each item, largest first, to the split with most room left; ties go by name."""
    left, out = dict(room), []
    for item, n in sorted(sizes, key=lambda x: (-x[1], x[0])):
        split = max(sorted(left), key=lambda s: left[s])
        left[split] -= n
        out.append((item, split))
    return out


def _fill(fresh: DataFrame, ratios: dict[str, float], have: dict[str, int]) -> DataFrame:
    """(component, split) of new components (component, n_records), placed where most is missing of the shares asked for."""
    spark = fresh.sparkSession
    n_new = fresh.agg(F.coalesce(F.sum("n_records"), F.lit(0))).first()[0]
    total = sum(have.values()) + n_new
    room = {s: ratio / sum(ratios.values()) * total - have.get(s, 0) for s, ratio in ratios.items()}
    is_large = F.col("n_records") * LARGE_SHARE > n_new
    large = [(str(r["component"]), r["n_records"]) for r in fresh.where(is_large).collect()]
    bucket = F.pmod(F.xxhash64("component"), F.lit(BUCKETS)).cast("string")
    small = [(r["bucket"], r["n"]) for r in fresh.where(~is_large).groupBy(bucket.alias("bucket")).agg(F.sum("n_records").alias("n")).collect()]
    chosen = _place(large, room)
    sizes = dict(large)
    for item, split in chosen:
        room[split] -= sizes[item]
    by_name = spark.createDataFrame(chosen, "name string, split_large string")
    by_bucket = spark.createDataFrame(_place(small, room), "bucket string, split_small string")
    named = fresh.select("component", F.col("component").cast("string").alias("name"), bucket.alias("bucket"))
    return named.join(F.broadcast(by_name), "name", "left").join(F.broadcast(by_bucket), "bucket", "left").select("component", F.coalesce("split_large", "split_small").alias("split"))


@tidy
def assign_batch(links: DataFrame, state: SplitState | None, ratios: dict[str, float]) -> tuple[DataFrame, SplitState]:
    """Assign one batch of (record_id, entity) rows; returns (record_id, component, split) and the new state.  ``state`` is None for a first batch."""
    links = stage(links, "links").df
    nodes, parts = _hang_together(links, state)
    known = nodes.select("node").distinct().join(parts.select("node", F.col("component").alias("part")), "node", "full_outer")
    placed = known.select("node", F.coalesce("part", "node").alias("part"))
    if state is None:
        verdict = stage(placed.select("node", F.col("part").alias("component"), F.lit(None).cast("string").alias("split"), F.lit(False).alias("old")), "verdict").df
    else:
        # what the old members of a part say about its split
        alive = state.components.where("component = root").select(F.col("component").alias("node"), "split")
        member = stage(placed.join(alive, "node", "left").select("node", "part", "split", F.col("split").isNotNull().alias("old")), "members").df
        said = member.groupBy("part").agg(F.min("split").alias("least"), F.max("split").alias("most"), F.min(F.when(F.col("old"), F.col("node"))).alias("keeper"), F.min(F.when(~F.col("old"), F.col("node"))).alias("newest"))
        conflict = F.coalesce(F.col("least") != F.col("most"), F.lit(False))
        verdict = stage(
            lookup_join(member, said, "part").select(
                "node",
                F.when(conflict, F.when(F.col("old"), F.col("node")).otherwise(F.col("newest"))).otherwise(F.coalesce("keeper", "part")).alias("component"),
                F.when(conflict, F.when(F.col("old"), F.col("split")).otherwise(F.lit(QUARANTINE))).otherwise(F.col("least")).alias("split"),
                "old",
            ),
            "verdict",
        ).df
    of_record = stage(nodes.join(verdict.select("node", "component"), "node").select("record_id", "component", "known"), "records").df
    gained = of_record.groupBy("component").agg(F.count_if(~F.col("known")).alias("n_records"))
    sizes = stage(verdict.groupBy("component").agg(F.min("split").alias("split")).join(gained, "component", "left").select("component", "split", F.coalesce("n_records", F.lit(0)).alias("n_records")), "sizes").df
    counted = sizes.where(F.col("split").isin(*ratios)).select("split", "n_records")
    if state is not None:
        counted = counted.unionByName(state.components.where(F.col("split").isin(*ratios)).select("split", "n_records"))
    have = {r["split"]: r["n"] for r in counted.groupBy("split").agg(F.sum("n_records").alias("n")).collect()}
    filled = _fill(sizes.where("split is null"), ratios, have)
    split_of = stage(sizes.join(filled.withColumnRenamed("split", "filled"), "component", "left").select("component", F.coalesce("split", "filled").alias("split"), "n_records"), "splits").df
    assigned = stage(lookup_join(of_record.select("record_id", "component"), split_of.select("component", "split"), "component").select("record_id", "component", "split"), "assigned").df
    return assigned, _next_state(links, state, nodes, verdict, of_record, split_of)


def _next_state(links: DataFrame, state: SplitState | None, nodes: DataFrame, verdict: DataFrame, of_record: DataFrame, split_of: DataFrame) -> SplitState:
    """The state with what a batch adds; tables of the old state are read, never rewritten, but for the components."""
    named = links.where("entity is not null").groupBy("entity").agg(F.min("record_id").alias("record_id"))
    entities = named.join(of_record.select("record_id", "component"), "record_id").select("entity", "component")
    records = of_record.where("not known").select("record_id", "component")
    components = split_of.select("component", F.col("component").alias("root"), "split", "n_records")
    if state is not None:
        entities = entities.join(state.entities.select("entity"), "entity", "left_anti")
        moved = verdict.where("old and node <> component").select(F.col("node").alias("root"), F.col("component").alias("__to"))
        old = lookup_join(state.components, moved, "root").select("component", F.coalesce("__to", "root").alias("root"), "split", "n_records")
        components = old.unionByName(components).groupBy("component").agg(F.min("root").alias("root"), F.min("split").alias("split"), F.sum("n_records").alias("n_records"))
        entities = state.entities.unionByName(stage(entities, "entities").df)
        records = state.records.unionByName(stage(records, "known").df)
        return SplitState(entities, records, stage(components, "components").df)
    return SplitState(stage(entities, "entities").df, stage(records, "known").df, stage(components, "components").df)


def split_report(assigned: DataFrame, ratios: dict[str, float]) -> DataFrame:
    """Records, components and share of each split beside the share asked for."""
    spark = assigned.sparkSession
    total_ratio = sum(ratios.values())
    asked = spark.createDataFrame([(s, r / total_ratio) for s, r in sorted(ratios.items())] + [(QUARANTINE, 0.0)], "split string, share_asked double")
    counts = assigned.groupBy("split").agg(F.count(F.lit(1)).alias("n_records"), F.countDistinct("component").alias("n_components"))
    total = assigned.agg(F.count(F.lit(1))).scalar()
    return (
        F.broadcast(asked).join(counts, "split", "left")
        .select("split", "share_asked", F.coalesce("n_records", F.lit(0)).alias("n_records"), F.coalesce("n_components", F.lit(0)).alias("n_components"), F.try_divide(F.coalesce("n_records", F.lit(0)), total).alias("share"))
    )
