"""Fine labels from vectors: prototypes, cosine scores and what needs review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, v: acc + v)


def unit(vector: Column) -> Column:
    """The vector scaled to length 1; a zero vector stays."""
    norm = F.array(F.sqrt(dot(vector, vector)))
    # bound as a lambda's variable, the norm is computed once a vector and not once a position
    return F.get(F.transform(norm, lambda n: F.transform(vector, lambda v: F.coalesce(F.try_divide(v.cast("double"), n), F.lit(0.0)))), F.lit(0))


def prototypes(rows: DataFrame, label: str, vector: str) -> DataFrame:
    """(label, prototype): mean of the unit vectors of a label, scaled to length 1 again.

    Positions are averaged with map-side combine, so a large label is never gathered.
    """
    cells = rows.where(F.col(vector).isNotNull()).select(label, F.posexplode(unit(F.col(vector))).alias("i", "v"))
    means = cells.groupBy(label, "i").agg(F.avg("v").alias("m"))
    listed = means.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda x: x["m"]).alias("p"))
    return listed.select(label, unit(F.col("p")).alias("prototype"))


def score_candidates(rows: DataFrame, identity: str, vector: str, candidates: str, protos: DataFrame, label: str = "label", scale: float = 100.0) -> DataFrame:
    """(identity, label, probability) of the best candidate by softmax over scaled cosine scores; the label first in order wins ties.

    ``protos`` is a vocabulary of labels: it travels as one value, and a row
    scores its own candidates where it lies, without a shuffle.
    """
    vocabulary = protos.agg(F.collect_list(F.struct(F.col(label).alias("label"), "prototype"))).scalar()
    mine = F.filter("__known", lambda p: F.array_contains(F.col(candidates), p["label"]))
    fed = rows.select(identity, candidates, unit(F.col(vector)).alias("__u"), vocabulary.alias("__known"))
    scored = fed.select(identity, F.transform(mine, lambda p: F.struct((-F.round(dot(F.col("__u"), p["prototype"]) * scale, 9)).alias("s"), p["label"].alias("label"))).alias("__all")).where("size(__all) > 0")
    best = scored.select(identity, "__all", F.array_min("__all").alias("__best"))
    total = F.aggregate("__all", F.lit(0.0), lambda acc, x: acc + F.exp(F.col("__best.s") - x["s"]))
    return best.select(identity, F.col("__best.label").alias(label), F.round(1 / total, 4).alias("probability"))


def assign_fine(rows: DataFrame, identity: str, coarse: str, vector: str, mapping: dict[str, tuple[str, ...]], protos: DataFrame, min_confidence: float = 0.55, classifier=None) -> DataFrame:
    """(identity, fine, confidence, method, needs_review) of coarse labels.

    ``classifier`` may be given in place of the cosine scores: a function of
    (rows with identity, __v and the candidates __c) that returns (identity,
    label, probability), the label named as in ``protos``.

    No candidate: unmapped.  One: direct.  Several: the classifier decides where
    there is a vector, and a low confidence asks for review; without a vector
    the first candidate stands, for review.
    """
    pairs = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.array(*[F.lit(f) for f in v]))])
    cand = rows.select(identity, F.col(vector).alias("__v"), F.coalesce(F.try_element_at(pairs, F.col(coarse)), F.array().cast("array<string>")).alias("__c"))
    open_rows = cand.where((F.size("__c") > 1) & F.col("__v").isNotNull())
    decided = classifier(open_rows) if classifier else score_candidates(open_rows, identity, "__v", "__c", protos, protos.columns[0])
    joined = cand.join(decided.select(identity, F.col(protos.columns[0]).alias("__fine"), "probability"), identity, "left")
    n = F.size("__c")
    return joined.select(
        identity,
        F.when(n == 1, F.get("__c", F.lit(0))).when(n > 1, F.coalesce("__fine", F.get("__c", F.lit(0)))).alias("fine"),
        F.when(n == 0, 0.0).when(n == 1, 1.0).otherwise(F.coalesce("probability", F.lit(0.0))).alias("confidence"),
        F.when(n == 0, "unmapped").when(n == 1, "direct").when(F.col("__fine").isNotNull(), "classifier").otherwise("first_candidate").alias("method"),
        F.when(n == 1, F.lit(False)).when(n == 0, F.lit(True)).otherwise(F.coalesce(F.col("probability") < min_confidence, F.lit(True))).alias("needs_review"),
    )


def spot_check(rows: DataFrame, label: str, score: str, identity: str, per_class: int) -> DataFrame:
    """The least and the most certain rows of each label, ``per_class`` in all, each row once."""
    low = per_class // 2
    up = F.row_number().over(Window.partitionBy(label).orderBy(F.asc(score), identity))
    down = F.row_number().over(Window.partitionBy(label).orderBy(F.desc(score), identity))
    # one limit each, so that every task keeps only its best rows before the exchange
    least = rows.withColumn("__n", up).where(F.col("__n") <= low).drop("__n")
    most = rows.withColumn("__n", down).where(F.col("__n") <= per_class - low).drop("__n")
    return least.unionByName(most).dropDuplicates([label, identity])


def small_crop(crop: Column, min_side: int = 16) -> Column:
    """Whether a crop [x1, y1, x2, y2] is too small to be told by a classifier."""
    x1, y1, x2, y2 = (F.get(crop, F.lit(i)) for i in range(4))
    return F.least(x2 - x1, y2 - y1) < min_side


def prompts_to_classes(prompts: dict[str, str]) -> dict[str, str]:
    """Phrase -> class from class -> phrases separated by `` . ``; the class listed first keeps a phrase."""
    out: dict[str, str] = {}
    for name, text in prompts.items():
        for phrase in text.split(" . "):
            if phrase.strip():
                out.setdefault(phrase.strip(), name)
    return out


def near_files(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` placed and sorted by path, so that batch work opens the files of a folder one after the other."""
    return rows.repartitionByRange(path).sortWithinPartitions(path)


def certainty_mark(score: Column, high: float = 0.7, medium: float = 0.4) -> Column:
    """Word for a score as pages show it."""
    return F.when(score >= high, "high").when(score >= medium, "medium").when(score.isNotNull(), "low")
