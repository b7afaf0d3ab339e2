"""Deeply nested JSON as related flat tables with Merkle subtree identities.

Every object and array gets the hash of its canonical form, built bottom-up
from the hashes of its parts, so equal subtrees have equal identities wherever
they occur.  Three tables come out:

``occurrences`` (doc_key, status, root_hash)
    one row per record; status is ``ok``, ``null``, ``empty`` or ``broken``, and
    root_hash is null unless ``ok``.  Documents may be nested to any depth.
``objects`` (hash, kind, scalars)
    one row per distinct object or array; ``scalars`` holds its own scalar
    fields as canonical JSON text.
``bridge`` (parent_hash, field, ordinal, child_hash, child_value, child_type)
    one row per part of a distinct object or array; nested parts have
    child_hash, scalar parts child_value as text.  Array items carry their
    position in ``ordinal`` and an empty field name.

Text that is itself a complete JSON object or array (a payload or a field that
was encoded twice) is opened and treated as the nested value it holds.  A byte
order mark before the document is not part of it.

Defined results: a null or blank payload and one that is not complete JSON
yields an occurrence without objects; repeated keys of an object keep the last
value; numbers keep the spelling of Python's shortest form; repeated records
add occurrences and no objects; an empty table gives three empty tables.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.operators.skew import spread_join
from claimweave.operators.staging import Staged, stage, tidy

_EMIT = "doc_key string, status string, hash string, kind string, scalars string, field string, ordinal int, child_hash string, child_value string, child_type string"


def open_json(text: str | None):
    """(status, value) of a document; doubly encoded text is opened."""
    if text is None:
        return "null", None
    text = text.lstrip("\ufeff")
    if not text.strip():
        return "empty", None
    try:
        value = _loads(text)
        if isinstance(value, str):
            value = _opened(value)
    except ValueError:
        return "broken", None
    return "ok", value


_JSON_SPACE = " \t\n\r"


def _loads(text: str):
    """The value of a JSON text of any depth: the library's parser where its recursion reaches, else a stack."""
    try:
        return json.loads(text)
    except RecursionError:
        return _loads_deep(text)


def _loads_deep(text: str):
    """Objects and arrays on a stack of their own; scalars, keys and their errors are the library's."""
    at, n, scan = 0, len(text), json.JSONDecoder().scan_once
    top: list = []
    stack: list[tuple[object, str | None]] = [(top, None)]

    def skip(i: int) -> int:
        while i < n and text[i] in _JSON_SPACE:
            i += 1
        return i

    def scalar(i: int):
        try:
            return scan(text, i)
        except StopIteration as stop:
            raise ValueError("no value") from stop

    def key(i: int) -> tuple[str, int]:
        if i >= n or text[i] != '"':
            raise ValueError("no key")
        name, i = scalar(i)
        i = skip(i)
        if i >= n or text[i] != ":":
            raise ValueError("no colon")
        return name, skip(i + 1)

    name = None
    at = skip(at)
    while True:
        # a value begins here
        if at >= n:
            raise ValueError("ends early")
        if text[at] in "{[":
            value: object = {} if text[at] == "{" else []
            is_object = text[at] == "{"
            at = skip(at + 1)
            if at >= n:
                raise ValueError("ends early")
            if text[at] != ("}" if is_object else "]"):
                stack.append((value, name))
                name = None
                if is_object:
                    name, at = key(at)
                continue
            at += 1
        else:
            value, at = scalar(at)
        # and is handed to what holds it, which may end with it
        while True:
            holder = stack[-1][0]
            if isinstance(holder, dict):
                holder[name] = value
            else:
                holder.append(value)
            at = skip(at)
            if len(stack) == 1:
                if at < n:
                    raise ValueError("more than one value")
                return top[0]
            if at >= n:
                raise ValueError("ends early")
            if text[at] == ",":
                at = skip(at + 1)
                if isinstance(holder, dict):
                    name, at = key(at)
                break
            if text[at] != ("}" if isinstance(holder, dict) else "]"):
                raise ValueError("not closed")
            at += 1
            value, name = stack.pop()


def _opened(value):
    """A string that holds a complete JSON object or array, as that value; anything else as it is."""
    if isinstance(value, str) and value[:1] in "{[" and value[-1:] in "}]":
        try:
            return _loads(value)
        except ValueError:
            return value
    return value


def _digest(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def _scalar(value) -> tuple[str | None, str]:
    if value is None:
        return None, "null"
    if value is True or value is False:
        return ("true" if value else "false"), "boolean"
    if isinstance(value, str):
        return value, "string"
    if type(value) is int:
        return str(value), "number"
    return (repr(value) if math.isfinite(value) else json.dumps(value)), "number"


def merkle_rows(root, with_scalars: bool = True) -> tuple[str, dict[str, tuple[str, str, list]]]:
    """Identity of ``root`` and, by identity, (kind, scalars, parts) of each distinct object or array.

    An explicit stack walks children before parents, so depth costs no recursion.
    The canonical form is the written form of the parts in order of their fields.
    """
    found: dict[str, tuple[str, str, list]] = {}
    done: dict[int, str] = {}
    kept: list = []  # keeps opened values alive while their id() is in use
    if not isinstance(root, (dict, list)):
        root = [root]
    stack: list[tuple[object, bool]] = [(root, False)]
    while stack:
        node, ready = stack.pop()
        if not ready:
            items = sorted(node.items()) if isinstance(node, dict) else list(enumerate(node))
            items = [(k, _opened(v)) for k, v in items]
            kept.append((node, items))
            done[id(node)] = len(kept) - 1
            stack.append((node, True))
            stack.extend((v, False) for _, v in items if isinstance(v, (dict, list)))
            continue
        slot = done[id(node)]
        if isinstance(slot, str):
            continue
        items = kept[slot][1]
        is_object = isinstance(node, dict)
        parts, canon, own = [], [], {}
        for n, (key, value) in enumerate(items):
            field = key if is_object else ""
            if isinstance(value, (dict, list)):
                child = done[id(value)]
                parts.append((field, n, child, None, "object" if isinstance(value, dict) else "array"))
                canon.append((field, child))
            else:
                text, kind = _scalar(value)
                parts.append((field, n, None, text, kind))
                canon.append((field, kind, text))
                if is_object:
                    own[key] = value
        identity = _digest(repr((is_object, canon)))
        done[id(node)] = identity
        if identity not in found:
            scalars = json.dumps(own, ensure_ascii=False, sort_keys=True, separators=(",", ":")) if with_scalars else ""
            found[identity] = ("object" if is_object else "array", scalars, parts)
    return done[id(root)], found


def _emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [c.split()[0] for c in _EMIT.split(", ")]
    for batch in batches:
        rows, seen = [], set()
        for key, text in zip(batch["doc_key"], batch["payload"], strict=True):
            status, value = open_json(text)
            if status != "ok":
                rows.append((key, status, None, "root", *[None] * 6))
                continue
            root, found = merkle_rows(value)
            rows.append((key, status, root, "root", *[None] * 6))
            for identity, (kind, scalars, parts) in found.items():
                if identity in seen:
                    continue
                seen.add(identity)
                rows.append((None, None, identity, kind, scalars, *[None] * 5))
                rows.extend((None, None, identity, "part", None, *part) for part in parts)
        frame = pd.DataFrame(rows, columns=columns, dtype=object)
        frame["ordinal"] = frame["ordinal"].astype("Int32")
        yield frame


class Shredded:
    """The three tables of a shredded column, staged once."""

    def __init__(self, staged: Staged) -> None:
        self.staged = staged

    @property
    def occurrences(self) -> DataFrame:
        return self.staged.df.where("kind = 'root'").select("doc_key", "status", F.col("hash").alias("root_hash"))

    @property
    def objects(self) -> DataFrame:
        """Identical objects of different records fall together here."""
        return self.staged.df.where("kind in ('object', 'array')").select("hash", "kind", "scalars").distinct()

    @property
    def bridge(self) -> DataFrame:
        return (
            self.staged.df.where("kind = 'part'")
            .select(F.col("hash").alias("parent_hash"), "field", "ordinal", "child_hash", "child_value", "child_type")
            .distinct()
        )


def shred(df: DataFrame, key: str, payload: str) -> Shredded:
    """Parse and shred ``payload``; ``key`` names the record (kept as text)."""
    source = df.select(F.col(key).cast("string").alias("doc_key"), F.col(payload).cast("string").alias("payload"))
    return Shredded(stage(source.mapInPandas(_emit, _EMIT), "shred"))


#: How to walk from one role to the next: (role, field) -> role of the part.
#: "*" as field stands for array items; a rule of None ends the walk there.
EVALUATION_RULES = {
    ("evaluation", "damages"): "damages",
    ("evaluation", "estimacion"): "estimate",
    ("evaluation", "audit"): "audit",
    ("damages", "*"): "damage",
    ("damage", "supporting_images"): "supporting_images",
    ("estimate", "*"): "estimate",
    ("estimate", "parts_lookup_missing"): "parts_lookup_missing",
    ("audit", "*"): "audit",
    ("audit", "input_hashes"): "input_hashes",
}
#: Fields that name an evaluation and a damage.
EVALUATION_TAGS = ("id_evaluacion", "damage_id")
_LEAVES = ("supporting_images", "parts_lookup_missing", "input_hashes")
_REACHED = {field for _, field in EVALUATION_RULES if field != "*"}
_STEP = "kind string, parent_hash binary, step string, child_hash binary, child_value string, child_type string, is_evaluation boolean, id_evaluacion string, damage_id string"


def reachable_parts(found: dict[str, tuple[str, str, list]]) -> Iterator[tuple[str, bool, list]]:
    """(identity, whether a list of keys or damages, parts) of a document's objects, with just the parts that a walk by the rules can use.

    Scalars count in lists of keys, nested parts where a rule's field lies in or
    below them, or where damages may be listed under names of their own.
    """
    useful: dict[str, bool] = {}
    keys, damages = set(), set()
    for identity, (_, _, parts) in found.items():  # parts come before what holds them
        useful[identity] = any(field in _REACHED or (child is not None and useful[child]) for field, _, child, _, _ in parts)
    for _, (_, _, parts) in found.items():
        keys.update(child for field, _, child, _, _ in parts if child is not None and field in _LEAVES)
        damages.update(child for field, _, child, _, _ in parts if child is not None and field == "damages")
    for marked in (keys, damages):
        todo = list(marked)
        while todo:
            for _, _, child, _, kind in found[todo.pop()][2]:
                if kind == "array" and child not in marked:
                    marked.add(child)
                    todo.append(child)
    for identity, (_, _, parts) in found.items():
        kept = [p for p in parts if (p[0] in _LEAVES or identity in keys if p[2] is None else p[0] in _REACHED or identity in damages or identity in keys or useful[p[2]])]
        yield identity, identity in keys or identity in damages, kept


def _steps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [c.split()[0] for c in _STEP.split(", ")]

    def own(found, identity: str) -> tuple[str | None, str | None]:
        kind, _, parts = found[identity]
        said = {f: text for f, _, _, text, t in parts if f in EVALUATION_TAGS and t in ("string", "number") and text} if kind == "object" else {}
        return said.get(EVALUATION_TAGS[0]), said.get(EVALUATION_TAGS[1])

    for batch in batches:
        rows, seen, texts = [], set(), set()
        for text in batch["payload"]:
            if text in texts:
                continue
            texts.add(text)
            status, value = open_json(text)
            if status != "ok":
                continue
            _, found = merkle_rows(value, with_scalars=False)
            names = {identity: own(found, identity) for identity in found}
            for identity, is_list, parts in reachable_parts(found):
                if (identity, is_list) in seen:
                    continue
                seen.add((identity, is_list))
                parent = bytes.fromhex(identity)
                if names[identity][0] is not None:
                    rows.append(("evaluation", parent, None, None, None, None, None, names[identity][0], None))
                for field, _, child, value_text, child_type in parts:
                    evaluation, damage = names[child] if child is not None else (None, None)
                    rows.append(("part", parent, field or "*", bytes.fromhex(child) if child is not None else None, value_text, child_type, evaluation is not None, None, damage))
        yield pd.DataFrame(rows, columns=columns, dtype=object).astype({"is_evaluation": "boolean"})


@tidy
def evaluation_children(df: DataFrame, payload: str) -> DataFrame:
    """(id_evaluacion, child, parent_key, child_key) of every evaluation in a column of JSON texts.

    An evaluation is any object with a text ``id_evaluacion``.  The walk goes
    down the bridge of identical objects level by level, one join per level of
    nesting, until no part is left; wrappers such as ``meta`` keep the role of
    what holds them, and another evaluation inside is walked on its own.
    ``damages`` may be a list, one damage, an object keyed by damage id, or any
    of these as text; the other lists may also be a single value.  Nulls and
    empty strings are no children.

    Of the bridge only the parts that a rule can use are kept, each once; an
    object that very many evaluations share is met in many places.
    """
    source = df.select(F.col(payload).cast("string").alias("payload"))
    bridge = stage(source.mapInPandas(_steps, _STEP).distinct(), "bridge")
    rows = bridge.df
    evaluations = rows.where("kind = 'evaluation'").select("id_evaluacion", "parent_hash", F.lit("evaluation").alias("role"), F.lit(None).cast("string").alias("damage"))
    steps = rows.where("kind = 'part'").select("parent_hash", "step", "child_hash", "child_value", "child_type", "is_evaluation", "damage_id")
    rule = F.create_map(*[F.lit(x) for (role, field), to in EVALUATION_RULES.items() for x in (f"{role}/{field}", to)])
    frontier = evaluations.distinct()
    found: list[Staged] = []
    while True:
        down = spread_join(frontier, steps, "parent_hash")
        said = F.try_element_at(rule, F.concat_ws("/", "role", "step"))
        nested = F.col("child_hash").isNotNull()
        in_damages = F.col("role") == "damages"
        role = (
            F.when(said.isNotNull() & ~(in_damages & ~nested), said)
            .when(in_damages & nested & F.col("damage_id").isNull() & (F.col("child_type") == "object"), F.lit("damage"))
            .when(F.col("role").isin(*_LEAVES) & (F.col("step") == "*"), F.col("role"))
            .when((F.col("role") == "evaluation") & nested, F.lit("evaluation"))
            .when(F.col("role").isin("estimate", "audit", "damages") & nested, F.col("role"))
        )
        # one damage in place of a list: the object under ``damages`` has its own id
        role = F.when((role == "damages") & F.col("damage_id").isNotNull(), F.lit("damage")).otherwise(role)
        walked = down.where(~(nested & F.col("is_evaluation"))).withColumn("next", role).where("next is not null")
        walked = walked.withColumn("damage_key", F.when(F.col("next") == "damage", F.coalesce("damage_id", F.when(F.col("step") != "*", F.col("step")))).otherwise(F.col("damage")))
        # a damage is known by its key from here on, a list of keys by its values
        level = stage(walked.select("id_evaluacion", "child_hash", "child_value", "child_type", F.col("next").alias("role"), F.col("damage_key").alias("damage")).distinct(), "walk")
        found.append(level)
        frontier = level.df.where("child_hash is not null").select("id_evaluacion", F.col("child_hash").alias("parent_hash"), "role", "damage").distinct()
        if frontier.isEmpty():
            break
    out = None
    for level in found:
        t = level.df
        leaf = F.col("role").isin(*_LEAVES) & F.col("child_hash").isNull() & (F.col("child_type") != "null")
        damage = (F.col("role") == "damage") & F.col("child_hash").isNotNull()
        rows = t.where(leaf | damage).select(
            "id_evaluacion",
            F.when(F.col("role") == "damage", "damages").otherwise(F.col("role")).alias("child"),
            F.when(F.col("role") == "supporting_images", F.col("damage")).otherwise(F.col("id_evaluacion")).alias("parent_key"),
            F.when(F.col("role") == "damage", F.col("damage")).otherwise(F.col("child_value")).alias("child_key"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out.where("child_key <> '' and parent_key <> ''").distinct()
