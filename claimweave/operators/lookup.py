"""Lookups in small reference tables, upserts, ranges and top-1 choices.

Reference tables are given by the caller.  They are broadcast by size: Spark
does so below its threshold, and a table that outgrew it is shuffled instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def normal_key(value: Column) -> Column:
    """Trimmed, lower case; null for null and empty."""
    return F.nullif(F.lower(F.trim(value)), F.lit(""))


def lookup_default(df: DataFrame, key: str, table: DataFrame, table_key: str, default: str) -> DataFrame:
    """``df`` with the columns of ``table`` for its key, case and blanks aside; the row named ``default`` where there is none.

    ``matched_key`` tells the row that was used.
    """
    values = [c for c in table.columns if c != table_key]
    right = table.select(normal_key(F.col(table_key)).alias("__k"), F.col(table_key).alias("__name"), *values)
    fallback = table.where(F.col(table_key) == default).select(F.struct(F.col(table_key).alias("__name"), *values).alias("d")).limit(1)
    hit = df.join(right, normal_key(F.col(key)) == F.col("__k"), "left")
    picked = [F.coalesce(F.col(c), fallback.select(F.col(f"d.{c}")).scalar()).alias(c) for c in ("__name", *values)]
    return hit.select(*[F.col(c) for c in df.columns], *picked).withColumnRenamed("__name", "matched_key")


def cascade_lookup(df: DataFrame, table: DataFrame, levels: list[tuple[str, str]], values: list[str]) -> DataFrame:
    """Look up several keys at once, each falling back to a wildcard row.

    ``levels`` gives (key column, wildcard) from the most to the least
    important; ``table`` has the same key columns, with the wildcard where a row
    holds for any value.  The most specific row wins, earlier keys first.
    ``exact`` is true where no wildcard was needed or the row's own value is the
    wildcard; rows without any match keep nulls and exact = false.
    """
    keys = [k for k, _ in levels]
    wild = dict(levels)
    out = df
    n = len(keys)
    tried: list[tuple[str, bool]] = []
    for mask in range(2**n):
        free = {keys[n - 1 - b] for b in range(n) if mask >> b & 1}
        name = f"__m{mask}"
        right = table.select(*[F.col(k).alias(f"__{k}") for k in keys], F.struct(*values).alias(name))
        on = [F.col(f"__{k}") == (F.lit(wild[k]) if k in free else F.coalesce(F.col(k), F.lit(wild[k]))) for k in keys]
        cond = on[0]
        for c in on[1:]:
            cond = cond & c
        out = out.join(right, cond, "left").drop(*[f"__{k}" for k in keys])
        tried.append((name, not free))
    hit = F.coalesce(*[F.col(name) for name, _ in tried])
    own = [F.coalesce(F.col(k), F.lit(wild[k])) == F.lit(wild[k]) for k in keys]
    exact = F.col("__m0").isNotNull()
    for mask in range(1, 2**n):
        needed = F.lit(True)
        for b in range(n):
            if mask >> b & 1:
                needed = needed & own[n - 1 - b]
        exact = exact | (F.col(f"__m{mask}").isNotNull() & needed)
    return out.withColumn("__hit", hit).select(*df.columns, *[F.col("__hit")[v].alias(v) for v in values], exact.alias("exact"))


def bucket_ranges(df: DataFrame, value: str, uppers: list[tuple[str, float | None]]) -> Column:
    """Name of the half-open range [lower, upper) of a value; a bound of None is open, below 0 there is none."""
    out = None
    for name, upper in uppers:
        cond = (F.col(value) < upper) if upper is not None else F.col(value).isNotNull()
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return F.when(F.col(value) >= 0, out)


def keyword_parts(df: DataFrame, key: str, text: str, keywords: DataFrame) -> DataFrame:
    """(key, declared) sets of parts whose keyword stands in the text, case and accents aside.

    ``keywords`` (keyword, part) is a small vocabulary that every text is held against.
    """
    plain = lambda c: F.collate(F.col(c), "UNICODE_CI_AI")
    words = F.broadcast(keywords)
    hit = df.where(F.col(text) != "").select(F.col(key), F.col(text).alias("__t")).join(words, F.contains(plain("__t"), plain("keyword")))
    return hit.groupBy(key).agg(F.array_sort(F.collect_set("part")).alias("declared"))


def top_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of each key in a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def last_source_wins(files: DataFrame, name: str, source_order: str) -> DataFrame:
    """One row per file name, from the source that comes last."""
    return top_one(files, [name], [F.desc(source_order)])


def upsert(current: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """``incoming`` replaces rows of its keys, the rest stays."""
    return current.join(incoming.select(key).distinct(), key, "left_anti").unionByName(incoming)


def append_new(current: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Only rows of ``incoming`` whose key is new are added."""
    return current.unionByName(incoming.join(current.select(key).distinct(), key, "left_anti"))


def map_default(value: Column, mapping: dict[str, str], default: str) -> Column:
    pairs = F.create_map(*[F.lit(x) for k, v in mapping.items() for x in (k, v)])
    return F.coalesce(F.try_element_at(pairs, value), F.lit(default))


def lookup_value(df: DataFrame, key: str, table: DataFrame, table_key: str, value: str, default: Column) -> DataFrame:
    """``df`` with one more column from ``table``, a default where the key has no row."""
    right = table.select(F.col(table_key).alias("__k"), F.col(value).alias("__v"))
    return df.join(right, F.col(key) == F.col("__k"), "left").withColumn(value, F.coalesce("__v", default)).drop("__k", "__v")


def coverage_gaps(table: DataFrame, keys: dict[str, tuple[str, ...]]) -> DataFrame:
    """Combinations of the vocabularies that a reference table has no row for, and values it has outside of them.

    (*keys, gap) with gap ``missing`` or ``unknown``; the combinations are those of small vocabularies.
    """
    from itertools import product

    names = list(keys)
    every = table.sparkSession.createDataFrame([tuple(c) for c in product(*keys.values())], ", ".join(f"`{n}` string" for n in names))
    missing = every.join(table.select(*names).distinct(), names, "left_anti").withColumn("gap", F.lit("missing"))
    unknown = table.select(*names).distinct().join(every, names, "left_anti").withColumn("gap", F.lit("unknown"))
    return missing.unionByName(unknown)
