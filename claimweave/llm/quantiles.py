"""Percentiles with bounded error that combine across partitions and days.

A value is quantised to an ordered universe of 2**``BITS`` leaves: the sign-free
IEEE bits of a double grow with the value, so their leading bits are an ordered
code with a relative width of 2**-``MANTISSA``.  Counts live on the nodes of
the dyadic tree over the universe.  Compressing a digest moves the counts of a
node and its sibling to the parent where node, sibling and parent together hold
at most n // k; digests merge by adding the counts of equal nodes.

Rank error: every count sits at most BITS levels above its leaf, and on each
level at most n / k of it can belong elsewhere, so a rank is off by at most
BITS * n / k, for any order of merging (``rank_error`` below asks for a share
and derives k).  Compression is deterministic, so results are as well.

Defined results: null, not-a-number, infinite and negative values are not
measured; zero has the first leaf; a group without measured values has no row;
an empty table gives an empty result; ties share a leaf.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Leading bits kept of the fraction of a double: relative width 2**-9.
MANTISSA = 9
#: 11 bits of exponent, and no sign.
BITS = 11 + MANTISSA
#: Bits kept for a node's number when digests are handled side by side.
_ROOM = BITS + 1
_SHIFT = 52 - MANTISSA
#: Nodes that a task holds of its local digests before it hands them over.
_ROOMY = 4_000_000


def measured(value: Column) -> Column:
    """The value as a double if it is finite and not negative, else null."""
    v = value.cast("double")
    return F.when(~F.isnan(v) & (v >= 0) & (v < F.lit(float("inf"))), v)


def leaf_of(values: np.ndarray) -> np.ndarray:
    """Leaf numbers of finite, non-negative doubles."""
    return (np.abs(values).astype("float64").view("int64")) >> _SHIFT


def leaf_bounds(leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest double of each leaf."""
    low = (leaf.astype("int64") << _SHIFT).view("float64")
    high = (((leaf.astype("int64") + 1) << _SHIFT) - 1).view("float64")
    return low, high


def compress_groups(group: np.ndarray, level: np.ndarray, index: np.ndarray, count: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, ...]:
    """One pass from the leaves up over many digests at once; level 0 is the leaves, level BITS the root.

    ``group`` numbers the digest of each node, ``limit`` holds n // k of each
    digest.  Returns (group, level, index, count).
    """
    kept: list[tuple[np.ndarray, ...]] = []
    order = np.argsort(level, kind="stable")
    code, level, count = (group.astype("int64") << _ROOM) | index.astype("int64"), level[order], count[order]
    code = code[order]
    starts = np.searchsorted(level, np.arange(BITS + 2))
    low = (1 << _ROOM) - 1

    def part(lv: int) -> tuple[np.ndarray, np.ndarray]:
        codes, inverse = np.unique(code[starts[lv] : starts[lv + 1]], return_inverse=True)
        return codes, np.bincount(inverse, weights=count[starts[lv] : starts[lv + 1]], minlength=len(codes)).astype("int64")

    now, now_n = part(0)
    for lv in range(BITS):
        up, up_n = part(lv + 1)
        parents, slot = np.unique((now >> _ROOM << _ROOM) | ((now & low) >> 1), return_inverse=True)
        below = np.bincount(slot, weights=now_n, minlength=len(parents)).astype("int64")
        own = np.zeros(len(parents), "int64")
        if len(up):
            at = np.minimum(np.searchsorted(up, parents), len(up) - 1)
            hit = up[at] == parents
            own[hit] = up_n[at[hit]]
        merge = below + own <= limit[parents >> _ROOM]
        stay = ~merge[slot]
        kept.append((now[stay], np.full(int(stay.sum()), lv, "int64"), now_n[stay]))
        both, inverse = np.unique(np.concatenate([up, parents[merge]]), return_inverse=True)
        now, now_n = both, np.bincount(inverse, weights=np.concatenate([up_n, below[merge]]), minlength=len(both)).astype("int64")
    kept.append((now, np.full(len(now), BITS, "int64"), now_n))
    codes, levels, counts = (np.concatenate([p[j] for p in kept]) for j in range(3))
    return codes >> _ROOM, levels, codes & low, counts


def compress(level: np.ndarray, index: np.ndarray, count: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """A single digest compressed: (level, index, count)."""
    return compress_groups(np.zeros(len(level), "int64"), level, index, count, np.array([int(count.sum()) // k]))[1:]


def k_for(rank_error: float) -> int:
    """Compression factor whose rank error is at most this share of n."""
    return int(np.ceil(BITS / rank_error))


def local_digests(rows: DataFrame, group: str, values: list[str], k: int) -> DataFrame:
    """(grp, field, level, node, n): a compressed digest of every group and value column within each task, before anything is shuffled.

    ``group`` is a bigint that numbers the groups, from 0 and below 2**40;
    ``values`` are measured doubles, null where there is none.  A task keeps
    counts of distinct leaves, not rows, and hands over what it has when that
    grows past ``_ROOMY`` nodes; digests merge, so handing over twice changes no
    bound.
    """
    fields = len(values)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def frame() -> pd.DataFrame:
            codes, inverse = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
            n = np.bincount(inverse, weights=np.concatenate([m for _, m in held]), minlength=len(codes)).astype("int64")
            where, leaf = codes >> BITS, codes & ((1 << BITS) - 1)
            firsts = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
            numbered = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, len(where))))
            g, level, node, counts = compress_groups(numbered, np.zeros(len(leaf), "int64"), leaf, n, np.add.reduceat(n, firsts) // k)
            of = where[firsts][g]
            return pd.DataFrame({"grp": of // fields, "field": (of % fields).astype("int8"), "level": level.astype("int32"), "node": node, "n": counts})

        for batch in batches:
            for f, name in enumerate(values):
                v = batch[name].to_numpy("float64")
                has = ~np.isnan(v)
                if has.any():
                    codes, n = np.unique(((batch[group].to_numpy("int64")[has] * fields + f) << BITS) | leaf_of(v[has]), return_counts=True)
                    held.append((codes, n))
                    size += len(codes)
            if size > _ROOMY:
                yield frame()
                held, size = [], 0
        if held:
            yield frame()

    return rows.select(group, *values).mapInPandas(run, "grp bigint, field tinyint, level int, node bigint, n bigint")


def digests(df: DataFrame, keys: list[str], value: str, k: int) -> DataFrame:
    """One compressed digest per key: (*keys, level, node, n).

    Leaf counts are aggregated with map-side combine, so the rows of a hot key
    are never gathered; what a key gathers is bounded by the universe.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, _leaf_column(F.col(value)).alias("node")).agg(F.count(F.lit(1)).alias("n"))
    return compact(counts.withColumn("level", F.lit(0)), keys, k)


def compact(parts: DataFrame, keys: list[str], k: int) -> DataFrame:
    """(*keys, level, node, n) compressed to the bound: of each key's nodes those that together hold at most n // k go to their parent."""

    def run(pdf: pd.DataFrame, group: np.ndarray, firsts: np.ndarray) -> pd.DataFrame:
        n = pdf["n"].to_numpy("int64")
        limit = np.add.reduceat(n, firsts) // k
        g, level, node, counts = compress_groups(group, pdf["level"].to_numpy("int64"), pdf["node"].to_numpy("int64"), n, limit)
        out = pdf[keys].iloc[firsts[g]].reset_index(drop=True)
        return out.assign(level=level.astype("int32"), node=node, n=counts)

    return _by_groups(parts.select(*keys, "level", "node", "n"), keys, ["level", "node"], run, "level int, node bigint, n bigint")


def _by_groups(df: DataFrame, keys: list[str], order: list[str], run, columns: str) -> DataFrame:
    """``run(rows, group number of each row, first row of each group)`` over whole groups, many at a time.

    Rows are hash-partitioned and sorted by key; a batch that ends inside a
    group hands that group on to the next one, so a task holds a batch and the
    one group at its end, whose rows are bounded by the universe.
    """
    kinds = dict(df.dtypes)

    def whole_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[pd.DataFrame] = []

        def numbered(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
            # keys side by side with the row before; nulls equal nulls
            same = np.ones(len(pdf), bool)
            for key in keys:
                v, before = pdf[key], pdf[key].shift()
                same &= ((v == before) | (v.isna() & before.isna())).to_numpy()
            same[0] = False
            return np.cumsum(~same) - 1, np.flatnonzero(~same)

        for batch in batches:
            if not len(batch):
                continue
            pdf = pd.concat([*rest, batch], ignore_index=True)
            group, firsts = numbered(pdf)
            last = firsts[-1]
            rest = [pdf.iloc[last:]]
            if last:
                yield run(pdf.iloc[:last], group[:last], firsts[:-1])
        if rest:
            pdf = pd.concat(rest, ignore_index=True)
            yield run(pdf, *numbered(pdf))

    placed = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    return placed.mapInPandas(whole_groups, ", ".join(f"`{c}` {kinds[c]}" for c in keys) + ", " + columns)


def _leaf_column(value: Column) -> Column:
    """The leaf in built-in arithmetic: exponent by log2 corrected, fraction by division.

    Equal to the leading bits of the IEEE form for normal numbers; subnormal
    ones share the first leaf with zero.
    """
    guess = F.floor(F.log2(value))
    exact = F.when(F.pow(F.lit(2.0), guess) > value, guess - 1).when(F.pow(F.lit(2.0), guess + 1) <= value, guess + 1).otherwise(guess)
    fraction = F.floor((value / F.pow(F.lit(2.0), exact) - 1) * (1 << MANTISSA))
    return F.when(value < F.lit(2.2250738585072014e-308), F.lit(0)).otherwise(((exact + 1023) * (1 << MANTISSA) + fraction)).cast("bigint")


def merge_digests(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Digests of separate partitions or days as one per key: counts of equal nodes are added."""
    return parts.groupBy(*keys, "level", "node").agg(F.sum("n").cast("bigint").alias("n"))


def digest_percentiles(merged: DataFrame, keys: list[str], percentiles: tuple[float, ...], k: int) -> DataFrame:
    """(*keys, percentile, value, value_low, value_high, n, rank_error) of each digest.

    The nodes are read in the order of their largest leaf, smaller nodes first;
    the first node at which the running count reaches the rank gives the value.
    ``rank_error`` is how many ranks the value may be off, from BITS * n / k.
    """
    asked = np.array(percentiles)

    def run(pdf: pd.DataFrame, group: np.ndarray, firsts: np.ndarray) -> pd.DataFrame:
        n = pdf["n"].to_numpy("int64")
        totals = np.add.reduceat(n, firsts)
        g, level, node, counts = compress_groups(group, pdf["level"].to_numpy("int64"), pdf["node"].to_numpy("int64"), n, totals // k)
        last = ((node + 1) << level) - 1
        order = np.lexsort((level, last, g))
        running = np.cumsum(counts[order])
        ranks = np.maximum(np.ceil(asked[None, :] * totals[:, None]), 1) + (np.cumsum(totals) - totals)[:, None]
        at = order[np.searchsorted(running, ranks.ravel())]
        low, high = leaf_bounds(last[at])
        out = pdf[keys].iloc[np.repeat(firsts, len(asked))].reset_index(drop=True)
        return out.assign(percentile=np.tile(asked, len(firsts)), value=(low + high) / 2, value_low=low, value_high=high, n=np.repeat(totals, len(asked)), rank_error=np.repeat(BITS * (totals // k), len(asked)))

    return _by_groups(merged, keys, ["level", "node"], run, "percentile double, value double, value_low double, value_high double, n bigint, rank_error bigint")
