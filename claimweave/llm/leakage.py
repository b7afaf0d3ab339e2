"""Passages of held-out items inside a corpus, by an edit-distance LSH and exact verification.

Every window of ``WINDOW`` words, of the items and of each document, is
embedded by the CGK random walk: in step j the walk writes the word it stands
on and moves on if a random bit of (j, word) says so.  Windows a few edits
apart fall back into step, so their edit distance shows as a small Hamming
distance.  Each table of the LSH samples some positions of the embedding; a
window of a document that agrees with a window of an item in all of them makes
the pair (document, item) a candidate.  An item is longer than a window, so it
has dozens of windows, and a leaked one needs a single agreement in any table.

Candidates are verified on words: a run of ``RUN`` words in common, or the whole
item aligned to its best place in the document with at most ``MAX_EDITS`` of its
words edited and ``MIN_KEYS`` of its figures and names kept.

Only the items are broadcast, below ``MAX_ITEM_WINDOWS`` windows; more are
worked off in blocks of items, one after the other, each block one pass over the
corpus.  Documents are read in a map-only pass of whole texts; nothing is
shuffled but the leaks found.

Defined results: null or empty texts hold and leak nothing; an item shorter
than a window is compared as one padded window; repeated items or documents
each count by their id; a null id is ignored; equal places resolve to the
first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.functions.text import spoken, text_words
from claimweave.operators.staging import stage

WINDOW = 16
RUN = 16
MAX_EDITS = 0.4
MIN_KEYS = 0.4
#: Random walks, tables of each walk, and positions each table samples.
WALKS, TABLES, SAMPLED = 3, 6, 10
#: Steps of a walk that are sampled; a walk needs about 2 * WINDOW steps for a window and writes blanks after it.
STEPS = 28
SEED = 20240607
#: Windows of items that one pass holds in memory.
MAX_ITEM_WINDOWS = 2_000_000
#: Windows that are embedded side by side: their arrays stay in a core's cache.
_CHUNK = 16_384
_STRETCH = 4096
#: Leading bits of a signature under which a table notes that it has one.
_NOTED = 20


def _positions() -> list[list[np.ndarray]]:
    """Sampled steps of every table, sorted."""
    rng = np.random.default_rng(SEED)
    return [[np.sort(rng.choice(STEPS, SAMPLED, replace=False)) for _ in range(TABLES)] for _ in range(WALKS)]


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    """64-bit finaliser, so that every walk has its own bits of the same words."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    """Hash of each word, taken once; emptied when it grows large."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _Hashes()


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), "uint64", len(words))


def run_hashes(words: np.ndarray) -> np.ndarray:
    """A hash of every RUN words in a row."""
    out = np.zeros(max(0, len(words) - RUN + 1), "uint64")
    with np.errstate(over="ignore"):
        for i in range(RUN if len(out) else 0):
            out = out * np.uint64(0x100000001B3) + words[i : i + len(out)]
    return out


def window_starts(lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(start, owner) of the windows over texts laid end to end with WINDOW blanks after each."""
    starts, owners, at = [], [], 0
    for owner, n in enumerate(lengths):
        if n:
            k = max(1, n - WINDOW + 1)
            starts.append(np.arange(at, at + k))
            owners.append(np.full(k, owner))
        at += n + WINDOW
    if not starts:
        return np.zeros(0, "int64"), np.zeros(0, "int64")
    return np.concatenate(starts), np.concatenate(owners)


def walk_bits(tape: np.ndarray) -> list[np.ndarray]:
    """For each walk and place the bits that say in which steps the walk moves on from there."""
    return [(_mix(tape, walk) >> np.uint64(32)).astype("uint32") for walk in range(WALKS)]


def signatures(tape: np.ndarray, starts: np.ndarray, bits: list[np.ndarray] | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(table number, signature of each window) of every table; 0 on the tape is a blank."""
    bits = bits or walk_bits(tape)
    factor, one = np.uint64(0xD6E8FEB86659FD93), np.uint32(1)
    for walk, tables in enumerate(_positions()):
        sampled = [[t for t in range(TABLES) if step in tables[t]] for step in range(STEPS)]
        at = starts.astype("int64")
        end = at + WINDOW
        acc = [np.full(len(starts), np.uint64(walk * TABLES + t + 1)) for t in range(TABLES)]
        with np.errstate(over="ignore"):
            for step in range(max(s for s in range(STEPS) if sampled[s]) + 1):
                # past its window a walk writes blanks; the place after the last text is a blank as well
                inside = at < end
                if sampled[step]:
                    word = tape.take(at)
                    word *= inside
                    for t in sampled[step]:
                        acc[t] *= factor
                        acc[t] += word
                move = bits[walk].take(at)
                move >>= np.uint32(step)
                move &= one
                move *= inside
                at += move
            for t in range(TABLES):
                acc[t] ^= acc[t] >> np.uint64(32)
                acc[t] *= factor
        for t in range(TABLES):
            yield walk * TABLES + t, acc[t]


def _tape(texts: list[np.ndarray]) -> np.ndarray:
    blank = np.zeros(WINDOW, "uint64")
    return np.concatenate([x for h in texts for x in (h, blank)]) if texts else np.zeros(0, "uint64")


def key_flags(text: str) -> list[bool]:
    """For each word of the text whether it is a figure or a name (a capital inside a sentence)."""
    plain = spoken(text)
    out = []
    for m in re.finditer(r"[^\W_]+", plain):
        before = plain[: m.start()].rstrip(" ¿¡\"'«“(")
        opens = not before or before[-1] in ".?!:\n"
        word = m.group(0)
        out.append(any(c.isdigit() for c in word) or (word[0].isupper() and not opens))
    return out


def longest_run(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest run of words that both have."""
    best, last = 0, np.zeros(len(b) + 1, "int32")
    for x in a:
        row = np.zeros(len(b) + 1, "int32")
        row[1:] = np.where(b == x, last[:-1] + 1, 0)
        best = max(best, int(row.max()))
        last = row
    return best


def align_inside(a: np.ndarray, b: np.ndarray) -> tuple[int, np.ndarray]:
    """(edits, which words of a are kept) of a aligned to its best place in b."""
    n, m = len(a), len(b)
    cost = np.zeros((n + 1, m + 1), "int32")
    cost[:, 0] = np.arange(n + 1)
    steps = np.arange(m + 1)
    for i in range(1, n + 1):
        best = np.minimum(cost[i - 1, :-1] + (b != a[i - 1]), cost[i - 1, 1:] + 1)
        cost[i] = np.minimum.accumulate(np.concatenate([[i], best]) - steps) + steps
    j = int(cost[n].argmin())
    edits, kept, i = int(cost[n, j]), np.zeros(n, bool), n
    while i:
        if j and cost[i, j] == cost[i - 1, j - 1] + (a[i - 1] != b[j - 1]):
            kept[i - 1] = a[i - 1] == b[j - 1]
            i, j = i - 1, j - 1
        elif cost[i, j] == cost[i - 1, j] + 1:
            i -= 1
        else:
            j -= 1
    return edits, kept


class ItemIndex:
    """LSH tables over the windows of a block of items, and what verification needs."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.ids = [i for i, t in items]
        self.words = [word_hashes(text_words(t)) for _, t in items]
        self.keys = [np.array(key_flags(t), bool) if t else np.zeros(0, bool) for _, t in items]
        self.run_sets = [frozenset(run_hashes(w).tolist()) for w in self.words]
        self.key_words = [w[k].tolist() for w, k in zip(self.words, self.keys, strict=True)]
        tape = _tape(self.words)
        starts, owners = window_starts([len(w) for w in self.words])
        tables: list[tuple[np.ndarray, np.ndarray]] = []
        for _, sig in signatures(tape, starts):
            pairs = np.unique(np.stack([sig, owners.astype("uint64")]), axis=1)
            tables.append((pairs[0], pairs[1].astype("int64")))
        self.tables = tables
        self._notes: list[np.ndarray] | None = None

    @property
    def notes(self) -> list[np.ndarray]:
        """Of each table whether it may have a signature with these leading bits; made where it is used, so it does not travel."""
        if self._notes is None:
            self._notes = []
            for have, _ in self.tables:
                note = np.zeros(1 << _NOTED, bool)
                note[(have >> np.uint64(64 - _NOTED)).astype("int64")] = True
                self._notes.append(note)
        return self._notes

    def possible(self, item: int, vocabulary: set[int], runs: set[int]) -> bool:
        """Whether verification can succeed: a whole run in common, or enough keys somewhere in the document."""
        if len(self.words[item]) < RUN or not self.run_sets[item].isdisjoint(runs):
            return True
        keys = self.key_words[item]
        return not keys or sum(k in vocabulary for k in keys) >= MIN_KEYS * len(keys)

    def verify(self, item: int, doc: np.ndarray) -> tuple[int, float, float] | None:
        """(longest run, share edited, share of keys kept) if the document leaks the item."""
        words, keys = self.words[item], self.keys[item]
        run = longest_run(words, doc)
        # a place of the item fits any stretch of twice its length, so long texts are aligned in overlapping stretches
        stretch, best = max(_STRETCH, 4 * len(words)), None
        for at in range(0, max(1, len(doc) - 2 * len(words)), stretch - 2 * len(words)):
            edits, kept = align_inside(words, doc[at : at + stretch])
            if best is None or edits < best[0]:
                best = edits, kept
        share = best[0] / len(words)
        kept_keys = float(best[1][keys].mean()) if keys.any() else 1.0
        if run >= min(RUN, len(words)) or (share <= MAX_EDITS and kept_keys >= MIN_KEYS):
            return run, share, kept_keys
        return None

    def candidates(self, docs: list[np.ndarray]) -> list[tuple[int, int]]:
        """(document, item) numbers whose windows agree in some table, in order."""
        tape = _tape(docs)
        bits, n = walk_bits(tape), len(self.ids)
        all_starts, all_owners = window_starts([len(d) for d in docs])
        met = [np.zeros(0, "int64")]
        for lo in range(0, len(all_starts) if n else 0, _CHUNK):
            starts, owners = all_starts[lo : lo + _CHUNK], all_owners[lo : lo + _CHUNK]
            for table, sig in signatures(tape, starts, bits):
                have, whose = self.tables[table]
                maybe = np.flatnonzero(self.notes[table].take((sig >> np.uint64(64 - _NOTED)).astype("int64")))
                if not len(maybe):
                    continue
                first = np.searchsorted(have, sig[maybe], "left")
                held = np.searchsorted(have, sig[maybe], "right") - first
                # every item of an agreeing signature
                of = np.repeat(np.arange(len(maybe)), held)
                item = whose[np.repeat(first, held) + np.arange(len(of)) - np.repeat(np.cumsum(held) - held, held)]
                met.append(np.unique(owners[maybe][of] * n + item))
        return [(int(x // n), int(x % n)) for x in np.unique(np.concatenate(met))]


_FOUND = "item_id bigint, doc_id bigint, run int, edited double, keys_kept double"


def find_leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, doc_id, run, edited, keys_kept) for every document that leaks an item."""
    source = documents.where(F.col(doc_id).isNotNull() & F.col(text).isNotNull()).select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    listed = items.where(F.col(item_id).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item_id).cast("bigint").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    words = listed.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] // 2
    blocks = max(1, -(-words // MAX_ITEM_WINDOWS))
    out = None
    for block in range(blocks):
        # one block at a time is held and sent along; what it finds is written before the next is read
        rows = listed.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()
        part = source.mapInPandas(_scan(ItemIndex([(r["item_id"], r["text"]) for r in rows])), _FOUND)
        part = stage(part, "leaks").df if blocks > 1 else part
        out = part if out is None else out.unionByName(part)
    return out.groupBy("item_id", "doc_id").agg(F.max("run").alias("run"), F.min("edited").alias("edited"), F.max("keys_kept").alias("keys_kept"))


def _scan(index: ItemIndex):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # equal texts of a batch are scanned once
            slots, texts = pd.factorize(batch["text"])
            docs = [word_hashes(text_words(t)) for t in texts]
            leaks: dict[int, list[tuple]] = {}
            at = -1
            for d, i in index.candidates(docs):
                if d != at:
                    at, vocabulary, runs = d, set(docs[d].tolist()), set(run_hashes(docs[d]).tolist())
                if not index.possible(i, vocabulary, runs):
                    continue
                got = index.verify(i, docs[d])
                if got:
                    leaks.setdefault(d, []).append((index.ids[i], got))
            rows = [(item, doc, *got) for doc, slot in zip(batch["doc_id"].tolist(), slots.tolist(), strict=True) for item, got in leaks.get(slot, ())]
            yield pd.DataFrame(rows, columns=["item_id", "doc_id", "run", "edited", "keys_kept"]).astype({"item_id": "int64", "doc_id": "int64", "run": "int32", "edited": "float64", "keys_kept": "float64"})

    return run
