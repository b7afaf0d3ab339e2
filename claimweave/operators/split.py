"""Stratified and grouped dataset splits with a reproducible draw.

Rows are drawn in the order of md5("seed:id"), which every engine computes
alike.  Groups are placed whole, per dominant class.

Defined results: an image without annotations is in no stratum of the plain
split and in a stratum of its own (null class) of the grouped one; ties of the
draw go by id; an empty input gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweave.operators.annotations import dominant_class
from claimweave.operators.graph import connected_components


def draw(seed: int, identity: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), identity.cast("string")))


def group_key(file_name: Column, pattern: str | None) -> Column:
    """First group of the pattern at the start of the file's stem; the whole stem where it matches nothing."""
    stem = F.regexp_extract(file_name, r"([^/]+?)(\.[^./]*)?$", 1)
    if pattern is None:
        return stem
    return F.coalesce(F.nullif(F.regexp_extract(stem, f"^(?:{pattern})", 1), F.lit("")), stem)


def image_groups(images: DataFrame, key: str, near_pairs: DataFrame | None = None) -> DataFrame:
    """(id, group_id): images of one key, and those linked by (id_a, id_b) pairs, share the smallest id."""
    firsts = images.groupBy(key).agg(F.min("id").alias("__first"))
    named = images.select("id", key).join(firsts, key).select("id", F.col("__first").alias("group_id"))
    if near_pairs is None:
        return named
    edges = named.where("id <> group_id").select(F.col("id").alias("src"), F.col("group_id").alias("dst")).unionByName(near_pairs.select(F.col("id_a").alias("src"), F.col("id_b").alias("dst")))
    found = connected_components(edges).select(F.col("node").alias("id"), F.col("component"))
    return named.select("id").join(found, "id", "left").select("id", F.coalesce("component", "id").alias("group_id"))


def _ranked(rows: DataFrame, stratum: str, identity: str, seed: int) -> DataFrame:
    """Position within the stratum and its size.  A stratum is a class: counted by a two-step rank over hash prefixes.

    The draw's first byte cuts each stratum into 256 slices of known sizes, so a
    task ranks one slice and not a whole class.
    """
    drawn = rows.withColumn("__draw", draw(seed, F.col(identity))).withColumn("__slice", F.substring("__draw", 1, 2))
    sizes = drawn.groupBy(stratum, "__slice").agg(F.count(F.lit(1)).alias("__m"))
    w = Window.partitionBy(stratum).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sizes.withColumns({"__before": F.coalesce(F.sum("__m").over(w), F.lit(0)), "__n": F.sum("__m").over(Window.partitionBy(stratum))}).select(F.col(stratum).alias("__s"), F.col("__slice").alias("__sl"), "__before", "__n")
    local = F.row_number().over(Window.partitionBy(stratum, "__slice").orderBy("__draw", identity))
    return drawn.withColumn("__local", local).join(F.broadcast(ahead), F.col(stratum).eqNullSafe(F.col("__s")) & (F.col("__slice") == F.col("__sl"))).withColumn("__pos", F.col("__before") + F.col("__local") - 1)


def _split(train: Column, val: Column) -> Column:
    return F.when(F.col("__pos") < train, "train").when(F.col("__pos") < train + val, "val").otherwise("test")


def stratified_split(annotations: DataFrame, image: str, label: str, pos: str, seed: int = 42, train: float = 0.7, val: float = 0.2) -> DataFrame:
    """(image, label, split) of annotated images by their dominant class; at least one of a class goes to train and val."""
    strata = dominant_class(annotations, image, label, pos)
    n = F.col("__n")
    return _ranked(strata, label, image, seed).select(image, label, _split(F.greatest(F.lit(1), F.floor(n * train)), F.greatest(F.lit(1), F.floor(n * val))).alias("split"))


def grouped_split(groups: DataFrame, annotations: DataFrame, label: str, pos: str, seed: int = 42, train: float = 0.7, val: float = 0.2) -> DataFrame:
    """(id, group_id, split): whole groups placed per dominant class of the group; halves round to even."""
    labelled = annotations.join(groups, annotations["image_id"] == groups["id"]).select("group_id", label, pos)
    strata = groups.select("group_id").distinct().join(dominant_class(labelled, "group_id", label, pos), "group_id", "left")
    n = F.col("__n")
    n_train = F.least(F.bround(n * train), n)
    n_val = F.least(F.bround(n * val), n - n_train)
    placed = _ranked(strata, label, "group_id", seed).select("group_id", _split(n_train, n_val).alias("split"))
    return groups.join(placed, "group_id").select("id", "group_id", "split")


def crossing_groups(assigned: DataFrame) -> DataFrame:
    """Groups with images in more than one split; there should be none."""
    return assigned.groupBy("group_id").agg(F.countDistinct("split").alias("n_splits")).where("n_splits > 1")


def seeded_sample(rows: DataFrame, identity: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows in the order of the draw: a sample is what is asked for."""
    return rows.withColumn("__draw", draw(seed, F.col(identity))).orderBy("__draw", identity).limit(n).drop("__draw")
