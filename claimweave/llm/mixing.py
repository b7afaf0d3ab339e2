"""Mix sources to target token shares by Sainte-Laguë apportionment of equal-token blocks.

Tokens are counted with a public tokenizer.  The seats are equal numbers of
tokens, ``BLOCK_TOKENS`` each: sources get them by the highest quotients
share / (2 * seats + 1), no source more than its tokens times its cap of repeats
hold.  Documents fall into shards by a hash, and a source's seats are spread
over its shards by the same rule, which gives each shard a whole number of them.

Within a shard a source's documents, in seeded order, form blocks of about as
many tokens as a seat.  A document longer than a block is not cut: its block is
as large as it is, and all that follows counts the tokens that blocks really
have.  Whole passes over a shard's blocks come first, then blocks in the order of
a seeded draw until the tokens wanted are reached, to within half a block; so
shares are off by half a block or half the longest document a shard, and no
block is used more often than the cap.

Only per (source, shard) totals reach the driver; their number is bounded by
``MAX_SHARDS`` times the sources listed.

Defined results: documents with a null id, a null or unlisted source, and
null or empty texts, are not mixed; a listed source without documents gets nothing and is
reported so; its share goes to the others by their quotients; ties go to the
source listed first by name; a cap of null or below 1 counts as 1, a null share
as 0; repeated document rows count once each.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimweave.operators.staging import stage, tidy

BLOCK_TOKENS = 1024
#: Blocks a shard holds about, and the most shards there can be.
BLOCKS_PER_SHARD = 1024
MAX_SHARDS = 4096
#: Vocabulary file that is used if neither the argument nor the session's setting names another.
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
TOKENIZER_SETTING = "spark.claimweave.tokenizer"
#: How the byte-level vocabulary splits text before merging (part of its public definition).
SPLIT_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a byte-level vocabulary file: a line is a token in base64 and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, Path(path).read_bytes().splitlines()) if token}


def count_tokens(df: DataFrame, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """``df`` without ``text`` and with ``n_tokens``; the vocabulary travels with the plan (about 1 MB)."""
    df, ranks = df.drop("n_tokens"), load_ranks(tokenizer)
    keep = [c for c in df.columns if c != text]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != text) + ", n_tokens bigint"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        encoding = tiktoken.Encoding("claimweave", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            out = batch[keep].copy()
            out["n_tokens"] = pd.array([len(encoding.encode_ordinary(t)) if t else 0 for t in batch[text]], dtype="int64")
            yield out

    return df.mapInPandas(run, schema)


def sainte_lague(weights: dict[str, float], caps: dict[str, int], seats: int) -> dict[str, int]:
    """Seats per party by highest quotients weight / (2 * seats + 1), none above its cap.

    Whole seats are given by bisecting the divisor, so the work does not grow
    with the number of seats; what rounding leaves goes by the quotients.
    """
    names = sorted(n for n in weights if weights[n] > 0 and caps.get(n, 0) > 0)
    seats = min(seats, sum(caps[n] for n in names))

    def at(divisor: float) -> dict[str, int]:
        return {n: min(caps[n], int(weights[n] / divisor + 0.5)) for n in names}

    got = dict.fromkeys(weights, 0)
    if not names or seats <= 0:
        return got
    low, high = min(weights[n] for n in names) / (4 * max(caps[n] for n in names) + 4), 4 * max(weights[n] for n in names)
    for _ in range(200):
        middle = (low * high) ** 0.5
        if sum(at(middle).values()) > seats:
            low = middle
        else:
            high = middle
    got.update(at(high))
    heap = [(-weights[n] / (2 * got[n] + 1), n) for n in names if got[n] < caps[n]]
    heapq.heapify(heap)
    for _ in range(seats - sum(got.values())):
        _, n = heapq.heappop(heap)
        got[n] += 1
        if got[n] < caps[n]:
            heapq.heappush(heap, (-weights[n] / (2 * got[n] + 1), n))
    return got


def plan_quotas(available: list[tuple[str, int, int]], weights: dict[str, float], repeats: dict[str, int], unit: int, total_tokens: int | None = None) -> list[tuple[str, int, int]]:
    """(source, shard, seats) from (source, shard, tokens) of what there is; a seat is ``unit`` tokens.

    ``total_tokens`` is the size of the mix; without it, the largest size at which
    every source that has documents can still supply its share within its cap.
    """
    tokens: dict[str, dict[int, int]] = {}
    for source, shard, n in available:
        tokens.setdefault(source, {})[shard] = n
    caps = {s: sum(t.values()) * repeats[s] for s, t in tokens.items()}
    asked = sum(weights[s] for s in caps)
    if total_tokens is None:
        total_tokens = min((caps[s] * asked / weights[s] for s in caps if weights[s] > 0), default=0)
    out = []
    for source, quota in sainte_lague({s: weights[s] for s in tokens}, {s: -(-c // unit) for s, c in caps.items()}, round(total_tokens / unit)).items():
        cells = {f"{k:08d}": n for k, n in tokens[source].items()}
        by_shard = sainte_lague({k: float(n) for k, n in cells.items()}, {k: -(-n * repeats[source] // unit) for k, n in cells.items()}, quota)
        out.extend((source, k, by_shard[f"{k:08d}"]) for k in sorted(tokens[source]))
    return out


class Mixture:
    """Chosen documents with their repeats, and the report per source."""

    def __init__(self, documents: DataFrame, report: DataFrame) -> None:
        self.documents, self.report = documents, report


def _listed(weights: DataFrame) -> dict[str, tuple[float, int]]:
    """Share and cap of each listed source (a list is short: sources of a mix, not records); of a source listed twice the larger row."""
    rows = weights.where("source is not null").groupBy("source").agg(F.max(F.struct("target_share", "max_repeats")).alias("w")).select("source", "w.*").collect()
    return {r["source"]: (max(0.0, r["target_share"] or 0.0), max(1, r["max_repeats"] or 1)) for r in rows}


@tidy
def mix(documents: DataFrame, weights: DataFrame, seed: int = 42, total_tokens: int | None = None, block_tokens: int = BLOCK_TOKENS, tokenizer: str | None = None) -> Mixture:
    """Mix ``documents`` (doc_id, source, text) to ``weights`` (source, target_share, max_repeats)."""
    spark = documents.sparkSession
    listed = _listed(weights)
    names = spark.createDataFrame([(s,) for s in sorted(listed)], "source string")
    chosen = documents.select("doc_id", "source", "text").join(F.broadcast(names), "source", "left_semi").where("text <> '' and doc_id is not null").select("doc_id", "source", "text")
    counted = stage(count_tokens(chosen, "text", tokenizer or spark.conf.get(TOKENIZER_SETTING, TOKENIZER)), "tokens")
    total, longest = counted.df.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.max("n_tokens"), F.lit(0))).first()
    shards = int(min(MAX_SHARDS, max(1, total // (max(block_tokens, longest) * BLOCKS_PER_SHARD))))
    sharded = counted.df.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(shards)).cast("int")).withColumn("draw", F.xxhash64(F.lit(seed), "doc_id"))
    cell = Window.partitionBy("source", "shard").orderBy("draw", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    # documents fall into the block their first token lies in; one longer than a block is a block by itself or ends one, and the numbers it passes over stay unused
    blocked = stage(sharded.withColumn("block", F.floor(F.coalesce(F.sum("n_tokens").over(cell), F.lit(0)) / block_tokens).cast("bigint")).select("doc_id", "source", "shard", "block", "n_tokens"), "blocks")
    blocks = stage(blocked.df.groupBy("source", "shard", "block").agg(F.sum("n_tokens").alias("tokens")), "block-sizes")
    cells = [(r["source"], r["shard"], r["tokens"]) for r in blocks.df.groupBy("source", "shard").agg(F.sum("tokens").alias("tokens")).collect()]
    quotas = plan_quotas(cells, {s: w for s, (w, _) in listed.items()}, {s: r for s, (_, r) in listed.items()}, block_tokens, total_tokens)
    quota = spark.createDataFrame([(s, k, q * block_tokens) for s, k, q in quotas], "source string, shard int, wanted bigint")
    # whole passes over a cell's blocks, then those that a seeded draw puts first, up to the tokens wanted; a block counts if more than half of it is wanted
    drawn = Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed + 2), "source", "shard", "block"), "block")
    sized = blocks.df.join(F.broadcast(quota), ["source", "shard"]).withColumns({"held": F.sum("tokens").over(Window.partitionBy("source", "shard")), "before": F.sum("tokens").over(drawn) - F.col("tokens"), "cap": _cap(listed)})
    passes = F.least(F.floor(F.try_divide("wanted", "held")), F.col("cap"))
    extra = ((F.col("before") + F.col("tokens") / 2 < F.col("wanted") - passes * F.col("held")) & (passes < F.col("cap"))).cast("int")
    repeats = stage(sized.select("source", "shard", "block", (F.coalesce(passes, F.lit(0)) + F.coalesce(extra, F.lit(0))).cast("int").alias("repeats")).where("repeats > 0"), "repeats")
    picked = blocked.df.join(repeats.df, ["source", "shard", "block"]).select("doc_id", "source", "shard", "block", "n_tokens", "repeats")
    return Mixture(picked, _report(blocks.df, repeats.df, listed, quotas))


def _report(blocks: DataFrame, repeats: DataFrame, listed: dict[str, tuple[float, int]], quotas: list[tuple[str, int, int]]) -> DataFrame:
    """Per listed source what was asked for, granted, there and mixed.

    ``share_asked`` is the target among the sources that have documents,
    ``share_error`` what the mix differs from it.
    """
    have = blocks.groupBy("source").agg(F.sum("tokens").alias("tokens_available"))
    got = blocks.join(repeats, ["source", "shard", "block"]).groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("tokens_mixed"), F.max("repeats").alias("most_repeats"))
    granted = {s: sum(q for x, _, q in quotas if x == s) for s in listed}
    rows = [(s, w, r, granted[s]) for s, (w, r) in sorted(listed.items())]
    asked = blocks.sparkSession.createDataFrame(rows, "source string, target_share double, max_repeats int, blocks_granted bigint")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    joined = F.broadcast(asked).join(have, "source", "left").join(got, "source", "left").select("source", "target_share", "max_repeats", "blocks_granted", zero("tokens_available"), zero("tokens_mixed"), zero("most_repeats"))
    # the rows are those of the list of sources, so one window holds them all
    every = Window.partitionBy()
    stocked = F.when(F.col("tokens_available") > 0, F.col("target_share")).otherwise(0.0)
    share = F.coalesce(F.try_divide(F.col("tokens_mixed"), F.sum("tokens_mixed").over(every)), F.lit(0.0))
    wanted = F.coalesce(F.try_divide(stocked, F.sum(stocked).over(every)), F.lit(0.0))
    return joined.withColumns({"actual_share": share, "share_asked": wanted}).withColumn("share_error", F.col("actual_share") - F.col("share_asked"))


def _cap(listed: dict[str, tuple[float, int]]):
    if not listed:
        return F.lit(1)
    return F.element_at(F.create_map(*[F.lit(x) for s, (_, r) in sorted(listed.items()) for x in (s, r)]), F.col("source"))
