"""Map freely typed brand and model to a canonical list.

A symmetric-delete dictionary holds every text that is left of a canonical term
after removing up to two letters.  A typed word finds its neighbours by looking
up its own deletions, so no term is compared that is not close.  Candidates are
ranked by a weighted Damerau-Levenshtein distance (confusable signs, doubled and
swapped letters cost less) and, at equal distance, by how often the entry is
typed exactly.

The two fields are read together: each may hold brand and model, or the other's
value, or both with trimmings around them.  Words are compared without case,
accents, punctuation or stray spaces, and digits inside words as the letters
they resemble.

The dictionary is broadcast only below ``MAX_TERMS`` terms; a longer list is
joined on the deletions instead (:func:`resolve_by_join`), with equal results.

Defined results: 0 for a missing or unlisted model, an unlisted brand, words
that name no vehicle, or a model of several brands without its brand; fields
that are both null are not resolved; empty or very long texts are words like
any other (only the first ``MAX_WORDS`` words next to each other can be joined
to one term, all words are looked up); equal distance and frequency goes to the
smallest id; an empty list maps everything to 0.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.operators.skew import lookup_join, spread_join
from claimweave.operators.staging import stage

#: Above this many distinct terms the dictionary is not broadcast.
MAX_TERMS = 50_000
#: Words that one canonical term may be broken into.
MAX_WORDS = 4
MAX_EDITS = 2

#: Signs that are typed for letters.
LOOKALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "8": "b", "|": "l", "$": "s", "@": "a"})
#: Pairs that are often confused.
CONFUSED = {frozenset(p) for p in ("il", "oq", "uv", "mn", "bv", "cs", "sz", "gj", "ck", "yi", "ao", "ei")}
#: Words that stand for a value nobody knows.
PLACEHOLDERS = {"", "x", "xx", "xxx", "nd", "na", "sn", "sd", "desconocido", "desconocida", "noconsta", "pendiente", "otro", "otra", "ninguno", "ninguna", "null", "none", "nan", "unknown", "other"}


def plain(text: str | None) -> str:
    """Lower case without accents."""
    if text is None:
        return ""
    return "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))


def words(text: str | None) -> list[str]:
    return [w.translate(LOOKALIKE) for w in re.findall(r"[a-z0-9|$@]+", plain(text))]


def squeezed(text: str | None) -> str:
    return "".join(words(text))


def allowed_edits(length: int) -> int:
    return 0 if length < 5 else 1 if length < 7 else MAX_EDITS


def deletions(text: str, edits: int) -> set[str]:
    """Every text left after removing up to ``edits`` letters."""
    out, edge = {text}, {text}
    for _ in range(edits):
        edge = {t[:i] + t[i + 1 :] for t in edge for i in range(len(t))}
        out |= edge
    return out


def weighted_distance(a: str, b: str) -> float:
    """Damerau-Levenshtein (adjacent swaps) with cheaper likely slips."""
    rows: list[list[float]] = [[0.9 * j for j in range(len(b) + 1)]]
    for i in range(1, len(a) + 1):
        row = [0.9 * i]
        for j in range(1, len(b) + 1):
            x, y = a[i - 1], b[j - 1]
            sub = 0.0 if x == y else 0.6 if frozenset((x, y)) in CONFUSED else 1.0
            drop = 0.5 if i > 1 and a[i - 2] == x else 0.9
            add = 0.5 if j > 1 and b[j - 2] == y else 0.9
            best = min(rows[i - 1][j - 1] + sub, rows[i - 1][j] + drop, row[j - 1] + add)
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y and x != y:
                best = min(best, rows[i - 2][j - 2] + 0.7)
            row.append(best)
        rows.append(row)
    return rows[-1][-1]


def edit_count(a: str, b: str, most: int) -> int:
    """Plain Damerau-Levenshtein (adjacent swaps), or most + 1."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = [], list(range(len(b) + 1))
    for i in range(1, len(a) + 1):
        row = [i]
        for j in range(1, len(b) + 1):
            best = min(last[j - 1] + (a[i - 1] != b[j - 1]), last[j] + 1, row[j - 1] + 1)
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                best = min(best, before[j - 2] + 1)
            row.append(best)
        before, last = last, row
    return min(last[-1], most + 1)


class Lexicon:
    """Terms of the canonical list, what entries they name, and the delete dictionary."""

    def __init__(self, entries: Iterable[tuple], frequency: dict[int, int] | None = None, dictionary: bool = True) -> None:
        self.entries: dict[tuple[str, str], list[int]] = {}
        self.brands: dict[str, str] = {}
        self.models: dict[str, set[str]] = {}
        self.frequency = frequency or {}
        # an alias of several brands goes to the one with the smallest id, in whatever order the entries come
        for entry_id, brand, alias, model in sorted(entries, key=lambda e: (e[0], *(x or "" for x in e[1:]))):
            b, m = squeezed(brand), squeezed(model)
            if not b or not m:
                continue
            self.brands[b] = b
            if alias and squeezed(alias):
                self.brands.setdefault(squeezed(alias), b)
            self.models.setdefault(m, set()).add(b)
            self.entries.setdefault((b, m), []).append(entry_id)
        self.longest = max([len(t) for t in (*self.brands, *self.models)], default=0)
        self.by_deletion: dict[str, list[str]] = {}
        if dictionary:
            for term in {*self.brands, *self.models}:
                for d in deletions(term, allowed_edits(len(term))):
                    self.by_deletion.setdefault(d, []).append(term)
        self.near = lru_cache(maxsize=200_000)(self._near)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "near"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.near = lru_cache(maxsize=200_000)(self._near)

    def candidates(self, span: str) -> set[str]:
        return {t for d in deletions(span, MAX_EDITS) for t in self.by_deletion.get(d, ())}

    def _near(self, span: str) -> tuple[tuple[str, float], ...]:
        """Terms within their allowed edits of ``span``, with weighted distance."""
        return self.verified(span, self.candidates(span))

    def verified(self, span: str, terms: Iterable[str]) -> tuple[tuple[str, float], ...]:
        out = []
        for term in sorted(terms):
            most = allowed_edits(len(term))
            if span == term:
                out.append((term, 0.0))
            elif most and edit_count(span, term, most) <= most:
                out.append((term, weighted_distance(span, term)))
        return tuple(out)

    def entry(self, brand: str, model: str) -> int | None:
        ids = self.entries.get((brand, model))
        return min(ids, key=lambda i: (-self.frequency.get(i, 0), i)) if ids else None


def spans(tokens: list[str], longest: int) -> Iterator[tuple[int, int, str]]:
    """(start, end, text) of words next to each other that could make one term."""
    for i in range(len(tokens)):
        text = ""
        for j in range(i, min(len(tokens), i + MAX_WORDS)):
            text += tokens[j]
            if len(text) > longest + MAX_EDITS:
                break
            if len(text) > 1:
                yield i, j + 1, text


def resolve(lexicon: Lexicon, brand_text: str | None, model_text: str | None, near=None) -> tuple[int, float | None, str]:
    """(entry id or 0, cost, reason) of one typed pair."""
    near = near or lexicon.near
    fields = [words(brand_text), words(model_text)]
    places: dict[tuple[str, int], list[tuple[float, int, int]]] = {}
    for f, tokens in enumerate(fields):
        for i, j, text in spans(tokens, lexicon.longest):
            for term, cost in near(text):
                places.setdefault((term, f), []).append((cost, i, j))
    # a text may repeat a term without end.  Of a brand's places of one cost and width the first and the last decide:
    # the first lies before the model if any does, else the last beside it.  Of a model's, the first clear of the brand.
    brands: list[tuple[float, int, int, int, str]] = []
    models: list[tuple[float, int, list[tuple[int, int]], str]] = []
    for (term, f), found in places.items():
        if term in lexicon.brands:
            ends: dict[tuple[float, int], list[int]] = {}
            for cost, i, j in found:
                ends.setdefault((cost, j - i), [i, i])[1] = i
            brands.extend((cost, f, i, i + width, lexicon.brands[term]) for (cost, width), both in ends.items() for i in sorted(set(both)))
        if term in lexicon.models:
            at: dict[float, list[tuple[int, int]]] = {}
            for cost, i, j in found:
                at.setdefault(cost, []).append((i, j))
            models.extend((cost, f, where, term) for cost, where in at.items())
    best = None
    for bc, bf, bi, bj, b in brands:
        for mc, mf, where, m in models:
            same = bf == mf
            entry = lexicon.entry(b, m)
            if entry is None:
                continue
            mi = next((i for i, j in where if not same or bi >= j or i >= bj), None)
            if mi is None:
                continue
            # words before the model count against it, but not the brand's; words after it are trim
            ahead = mi - (bj - bi) if same and bi < mi else mi
            beside = 0.3 if same and not means_missing(fields[1 - bf]) else 0.0
            key = (bc + mc + 0.1 * ahead + beside, -lexicon.frequency.get(entry, 0), entry)
            if best is None or key < best:
                best = key
    if best is not None:
        return best[2], round(best[0], 4), "brand and model"
    if brands:
        return 0, None, "model missing or unlisted"
    if not models:
        return 0, None, "no listed word"
    # the brand may be missing, but not an unlisted word
    options: dict[int, float] = {}
    for mc, mf, where, m in models:
        if where[0][0] > 0 or not means_missing(fields[1 - mf]):
            continue
        owners = lexicon.models[m]
        if len(owners) > 1:
            options[0] = min(mc, options.get(0, 9.0))
            continue
        entry = lexicon.entry(next(iter(owners)), m)
        options[entry] = min(mc, options.get(entry, 9.0))
    if not options:
        return 0, None, "brand unlisted"
    entry, cost = min(options.items(), key=lambda x: (x[1], -lexicon.frequency.get(x[0], 0), x[0]))
    return entry, (round(cost, 4) if entry else None), ("model of one brand" if entry else "model of several brands")


def means_missing(tokens: list[str]) -> bool:
    """Whether the words of a field say that its value is missing."""
    text = "".join(tokens)
    return text in PLACEHOLDERS or text in ("o", "oo") or not any(c.isalpha() for c in text)


def load_lexicon(catalogue: DataFrame, typed: DataFrame, entry_id: str, brand: str, alias: str, model: str) -> Lexicon | None:
    """The dictionary, with how often ``typed`` (same brand and model columns) has each entry exactly; None above MAX_TERMS."""
    c = catalogue.where(F.col(entry_id).isNotNull()).select(F.col(entry_id).alias("entry_id"), F.col(brand).alias("b"), F.col(alias).alias("a"), F.col(model).alias("m"))
    if c.limit(MAX_TERMS + 1).count() > MAX_TERMS:
        return None
    exact = typed.select(F.col(brand).alias("b"), F.col(model).alias("m")).join(F.broadcast(c.select("entry_id", "b", "m")), ["b", "m"]).groupBy("entry_id").count()
    rows = c.join(exact, "entry_id", "left").collect()
    return Lexicon([(r["entry_id"], r["b"], r["a"], r["m"]) for r in rows], {r["entry_id"]: r["count"] or 0 for r in rows})


_OUT = "entry_id bigint, cost double, reason string"


def resolve_pairs(df: DataFrame, lexicon: Lexicon, brand: str, model: str) -> DataFrame:
    """``df`` with entry_id, cost and reason of its typed pair (in place of columns so named); each task resolves a repeated pair once."""
    df = df.drop("entry_id", "cost", "reason")
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple, tuple] = {}
        for batch in batches:
            got = []
            for pair in zip(batch[brand], batch[model], strict=True):
                pair = tuple(None if p is None or p != p else p for p in pair)
                if pair not in seen:
                    if len(seen) > 500_000:
                        seen.clear()
                    seen[pair] = resolve(lexicon, *pair)
                got.append(seen[pair])
            batch["entry_id"] = pd.array([g[0] for g in got], dtype="int64")
            batch["cost"] = [g[1] for g in got]
            batch["cost"] = batch["cost"].astype("float64")
            batch["reason"] = [g[2] for g in got]
            yield batch

    return df.mapInPandas(run, f"{out}, {_OUT}")


def resolve_by_join(df: DataFrame, catalogue: DataFrame, key: str, brand: str, model: str, columns: tuple[str, str, str, str], typed_by: DataFrame | None = None) -> DataFrame:
    """(key, entry_id, cost, reason) for a list of any length: dictionary and spans meet in a join on deletions.

    ``columns`` names id, brand, alias and model in ``catalogue``.  Entries are
    counted in ``typed_by`` (same brand and model columns) as
    :func:`load_lexicon` counts them, without it in ``df``.  Only the entries
    near a row's spans reach the task that ranks them.
    """
    e, b, a, m = columns
    entries = catalogue.select(F.col(e).cast("bigint").alias("entry_id"), F.col(b).alias("b"), F.col(a).alias("a"), F.col(m).alias("m")).where("entry_id is not null")
    # a pair that is typed many times is looked up once; it goes by the digest of its texts, nulls told from empty ones
    digest = F.unhex(F.md5(F.to_json(F.struct(F.col(brand).cast("string").alias("b"), F.col(model).cast("string").alias("m")))))
    claims = df.select(F.col(key).alias("__key"), digest.alias("k"), F.col(brand).cast("string").alias("tb"), F.col(model).cast("string").alias("tm"))
    counted = stage(claims.groupBy("k", "tb", "tm").agg(F.count(F.lit(1)).alias("n")), "typed-pairs").df
    typed = counted.select("k", "tb", "tm")
    # how often each entry is typed exactly, as load_lexicon counts it
    if typed_by is None:
        pairs = counted.select(F.col("tb").alias("b"), F.col("tm").alias("m"), "n")
    else:
        pairs = typed_by.groupBy(F.col(brand).cast("string").alias("b"), F.col(model).cast("string").alias("m")).agg(F.count(F.lit(1)).alias("n"))
    pairs = pairs.where("b is not null and m is not null")
    exact = entries.join(pairs, ["b", "m"]).groupBy("entry_id").agg(F.sum("n").alias("n"))
    entries = entries.join(exact, "entry_id", "left").select("entry_id", "b", "a", "m", F.coalesce("n", F.lit(0)).alias("n"))

    def lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"longest": [max((len(squeezed(t)) for c in ("b", "a", "m") for t in batch[c] if t), default=0)]})

    longest = entries.select("b", "a", "m").mapInPandas(lengths, "longest int").agg(F.max("longest")).first()[0] or 0

    def term_deletions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                for text in (r.b, r.a, r.m):
                    term = squeezed(text)
                    if term:
                        rows.extend((d, r.entry_id, r.b, r.a, r.m, r.n) for d in deletions(term, allowed_edits(len(term))))
            yield pd.DataFrame(rows, columns=["deletion", "entry_id", "b", "a", "m", "n"]).drop_duplicates()

    def span_deletions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, *texts in zip(batch["k"], batch["tb"], batch["tm"], strict=True):
                found = {d for text in texts for _, _, s in spans(words(text), longest) for d in deletions(s, MAX_EDITS)}
                rows.extend((d, k) for d in found)
            yield pd.DataFrame(rows, columns=["deletion", "k"])

    lists = entries.mapInPandas(term_deletions, "deletion string, entry_id bigint, b string, a string, m string, n bigint")
    asked = typed.mapInPandas(span_deletions, "deletion string, k binary")
    near = spread_join(asked, lists, "deletion").select("k", "entry_id", "b", "a", "m", "n").distinct()
    # a model of several brands needs its other owners as well
    owners = near.select("k", "m").distinct().join(entries, "m").select("k", "entry_id", "b", "a", "m", "n")
    every = near.unionByName(owners).distinct().groupBy("k").agg(F.collect_list(F.struct("entry_id", "b", "a", "m", "n")).alias("near"))

    def rank(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = []
            for tb, tm, few in zip(batch["tb"], batch["tm"], batch["near"], strict=True):
                rows = [(x["entry_id"], x["b"], x["a"], x["m"]) for x in few] if few is not None else []
                lexicon = Lexicon(rows, {x["entry_id"]: x["n"] for x in few} if few is not None else {}, dictionary=False)
                terms = {*lexicon.brands, *lexicon.models}
                got.append(resolve(lexicon, tb, tm, near=lambda span, x=lexicon, t=terms: x.verified(span, t)))
            yield pd.DataFrame({"k": batch["k"], "entry_id": [g[0] for g in got], "cost": pd.Series([g[1] for g in got], dtype="float64"), "reason": [g[2] for g in got]})

    ranked = typed.join(every, "k", "left").mapInPandas(rank, f"k binary, {_OUT}")
    return lookup_join(claims.select("__key", "k"), ranked, "k").select(F.col("__key").alias(key), "entry_id", "cost", "reason")
