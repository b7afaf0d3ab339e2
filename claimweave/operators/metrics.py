"""Metrics of estimates against truth, calibration and bootstrap intervals.

Records have lane, estimated, real, structural_suspected, structural_truth,
severity_pred, severity_truth, processing_time_ms.  A record counts for amount
metrics if its lane is verde or ambar and both amounts are measured.

Defined results: metrics of no records are null (shares of nothing as well);
values that are not finite count as missing; repeated records count each.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweave.functions.numeric import bin_of, half_up, rank_in
from claimweave.functions.vocabulary import SEVERITIES

PAID_LANES = ("verde", "ambar")


def finite(value: Column) -> Column:
    v = value.cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), v)


def cents(value: Column) -> Column:
    """An amount in whole hundredths, so that sums of errors are exact; null where it has none."""
    return F.round(value * 100).try_cast("bigint")


def pair_with_truth(outputs: DataFrame, truth: DataFrame, key: str, amount: str) -> DataFrame:
    """Outputs joined to the truth of their key; the truth's amount is renamed to ``real``."""
    return outputs.join(truth.withColumnRenamed(amount, "real"), key)


def counted(records: DataFrame) -> DataFrame:
    return records.where(F.col("lane").isin(*PAID_LANES) & F.col("estimated").isNotNull() & F.col("real").isNotNull())


def headline(records: DataFrame, within: float = 0.15) -> DataFrame:
    """One row: mae, shares of green, structural misses, share within tolerance, mean time."""
    paid = F.col("lane").isin(*PAID_LANES) & F.col("estimated").isNotNull() & F.col("real").isNotNull()
    error = F.abs(cents(F.col("estimated")) - cents(F.col("real")))
    close = paid & (F.col("real") > 0) & (F.abs(F.col("estimated") - F.col("real")) <= F.col("real") * within)
    truth = F.coalesce("structural_truth", F.lit(False))
    missed = truth & ~F.coalesce("structural_suspected", F.lit(False)) & (F.coalesce("lane", F.lit("")) != "rojo")
    share = lambda a, b: F.try_divide(F.count_if(a).cast("double"), F.count_if(b))
    return records.agg(
        half_up(F.try_divide(F.sum(F.when(paid, error)).cast("double"), F.count_if(paid)) / 100, 2).alias("mae"),
        half_up(share(F.col("lane") == "verde", F.lit(True)), 4).alias("green_of_all"),
        half_up(share(F.col("lane") == "verde", F.col("lane").isin(*PAID_LANES)), 4).alias("green_of_paid"),
        half_up(share(missed, truth), 4).alias("structural_miss_rate"),
        half_up(share(close, paid), 4).alias("share_within"),
        half_up(F.avg("processing_time_ms"), 1).alias("mean_ms"),
        F.count(F.lit(1)).alias("n_records"),
        F.count_if(paid).alias("n_paid"),
    )


def mae_by_bracket(records: DataFrame, brackets: list[tuple[str, float | None]]) -> DataFrame:
    """(bracket, mae, n) for every bracket of the real amount; those without records with mae null and n 0.

    A bracket starts at the bound of the one before; the first at 0.
    """
    spark = records.sparkSession
    lowers = [0.0] + [b for _, b in brackets[:-1]]
    table = spark.createDataFrame([(i, name, low, high) for i, ((name, high), low) in enumerate(zip(brackets, lowers, strict=True))], "ord int, bracket string, low double, high double")
    name = None
    for (label, high), low in zip(brackets, lowers, strict=True):
        cond = (F.col("real") >= low) & ((F.col("real") < high) if high is not None else F.lit(True))
        name = F.when(cond, label) if name is None else name.when(cond, label)
    error = F.abs(cents(F.col("estimated")) - cents(F.col("real")))
    found = counted(records).groupBy(name.alias("bracket")).agg(half_up(F.try_divide(F.sum(error).cast("double"), F.count(F.lit(1))) / 100, 2).alias("mae"), F.count(F.lit(1)).alias("n"))
    return table.join(found, "bracket", "left").select("bracket", "mae", F.coalesce("n", F.lit(0)).alias("n"))


def weighted_kappa(records: DataFrame, predicted: str, truth: str, labels: tuple[str, ...] = SEVERITIES) -> DataFrame:
    """One row: Cohen's kappa with quadratic weights, and the number of pairs.

    Null below two pairs or two distinct true labels; pairs with an unknown label do not count.
    """
    i, j = rank_in(F.col(predicted), labels), rank_in(F.col(truth), labels)
    pairs = records.select(i.cast("bigint").alias("i"), j.cast("bigint").alias("j")).where("i is not null and j is not null")
    got = pairs.agg(
        F.sum(F.expr("(i - j) * (i - j)")).alias("seen"), F.sum(F.expr("i * i")).alias("ii"), F.sum(F.expr("j * j")).alias("jj"), F.sum("i").alias("si"), F.sum("j").alias("sj"), F.count(F.lit(1)).alias("n"), F.countDistinct("j").alias("k")
    )
    # sum of (i - j)^2 over all pairs of a predicted and a true label, from the moments of both
    chance = (F.col("n") * (F.col("ii") + F.col("jj")) - 2 * F.col("si") * F.col("sj")).cast("double")
    kappa = 1 - F.try_divide(F.col("seen").cast("double") * F.col("n"), chance)
    return got.select(F.when((F.col("n") >= 2) & (F.col("k") >= 2), half_up(kappa, 4)).alias("kappa"), F.col("n").alias("n_pairs"))


def target_check(values: DataFrame, targets: dict[str, tuple[str, float]]) -> DataFrame:
    """(metric, value, target, passed) of the metrics of a one-row table; no row for a metric without value or target."""
    rows = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"), F.lit(float(t)).alias("target"), ((F.col(m) <= t) if op == "<=" else (F.col(m) >= t)).alias("passed")) for m, (op, t) in targets.items()]
    return values.select(F.explode(F.array(*rows)).alias("r")).select("r.*").where("value is not null")


def bootstrap_exact(values: DataFrame, value: str, keys: list[str], statistic: Callable[[np.ndarray], float] = np.mean, resamples: int = 2000, seed: int = 42, alpha: float = 0.05) -> DataFrame:
    """(*keys, low, high) by resampling each group's values in one task: for groups known to be small."""
    kinds = dict(values.dtypes)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.sort(pdf[value].dropna().to_numpy("float64"))
        low = high = None
        if len(x) >= 2:
            rng = np.random.default_rng(seed)
            got = [statistic(x[rng.integers(0, len(x), len(x))]) for _ in range(resamples)]
            low, high = (round(float(v), 3) for v in np.percentile(got, [100 * alpha / 2, 100 * (1 - alpha / 2)]))
        out = {k: [pdf[k].iloc[0]] for k in keys}
        return pd.DataFrame(out | {"low": [low], "high": [high]})

    return values.groupBy(*keys).applyInPandas(run, ", ".join([*[f"`{k}` {kinds[k]}" for k in keys], "low double", "high double"]))


def _poisson_steps(mean: int) -> tuple[int, np.ndarray]:
    """(first count, cumulated probabilities from there on) of a Poisson draw; what lies outside is below 1e-16."""
    low, high = max(0, int(mean - 10 * mean**0.5 - 10)), int(mean + 10 * mean**0.5 + 20)
    k = np.arange(low, high + 1)
    return low, np.cumsum(np.exp(k * math.log(mean) - mean - np.array([math.lgamma(x + 1) for x in k.tolist()])))


def _uniform(row: int, resamples: int) -> np.ndarray:
    """A number in [0, 1) for each resample, from a hash of row and resample."""
    with np.errstate(over="ignore"):
        h = np.uint64(row & (2**64 - 1)) + np.arange(1, resamples + 1, dtype="uint64") * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
    return (h >> np.uint64(11)).astype("float64") / 2**53


def bootstrap_mean(values: DataFrame, value: str, keys: list[str], resamples: int = 2000, seed: int = 42, alpha: float = 0.05) -> DataFrame:
    """(*keys, low, high) of the mean for groups of any size.

    Every row is drawn a Poisson(1) number of times in each resample, so n equal
    rows together a Poisson(n) number, from a hash of their keys, value and the
    resample: the bounds do not depend on the partitions.  Partial sums combine
    on the map side: one aggregation of resamples x keys cells.
    """
    kinds = dict(values.dtypes)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}
        steps: dict[int, tuple[int, np.ndarray]] = {}

        def frame() -> pd.DataFrame:
            rows = [(*k, r, s[r, 0], s[r, 1]) for k, s in sums.items() for r in range(resamples)]
            return pd.DataFrame(rows, columns=[*keys, "resample", "s", "n"])

        for batch in batches:
            for key, part in batch.groupby(keys, dropna=False, sort=False) if keys else [((), batch)]:
                key = key if isinstance(key, tuple) else (key,)
                total = sums.setdefault(key, np.zeros((resamples, 2)))
                for row, x, n in zip(part["__row"].tolist(), part["__x"].tolist(), part["__n"].tolist(), strict=True):
                    if n not in steps:
                        if len(steps) >= 1000:
                            steps.clear()
                        steps[n] = _poisson_steps(n)
                    first, chances = steps[n]
                    draws = first + np.searchsorted(chances, _uniform(row, resamples), side="right")
                    total[:, 0] += draws * x
                    total[:, 1] += draws
                if len(sums) >= 500:
                    yield frame()
                    sums.clear()
        if sums:
            yield frame()

    schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in keys], "resample int", "s double", "n double"])
    equal = values.select(*keys, F.col(value).cast("double").alias("__x")).where(F.col("__x").isNotNull() & ~F.isnan("__x")).groupBy(*keys, "__x").agg(F.count(F.lit(1)).alias("__n"))
    rows = equal.select(*keys, "__x", "__n", F.xxhash64(F.lit(seed), *keys, "__x").alias("__row"))
    means = rows.mapInPandas(partial, schema).groupBy(*keys, "resample").agg((F.sum("s") / F.nullif(F.sum("n"), F.lit(0))).alias("m"))
    return means.groupBy(*keys).agg(F.round(F.percentile("m", alpha / 2), 3).alias("low"), F.round(F.percentile("m", 1 - alpha / 2), 3).alias("high"))


def brier(pairs: DataFrame, confidence: str = "confidence", label: str = "label") -> DataFrame:
    """Mean squared difference of confidence and label."""
    d = F.col(confidence).cast("decimal(12,6)") - F.col(label).cast("decimal(12,6)")
    return pairs.agg(half_up(F.try_divide(F.sum(d * d).cast("double"), F.count(d)), 6).alias("brier"), F.count(d).alias("n"))


def reliability_curve(pairs: DataFrame, n_bins: int = 10, confidence: str = "confidence", label: str = "label") -> DataFrame:
    """(bin, centre, mean_confidence, accuracy, n) of equal-width bins, empty ones with nulls and 0."""
    spark = pairs.sparkSession
    bins = spark.range(n_bins).select(F.col("id").cast("int").alias("bin"), F.round((F.col("id") + 0.5) / n_bins, 4).alias("centre"))
    kept = pairs.where(F.col(confidence).isNotNull() & F.col(label).isNotNull())
    got = kept.groupBy(bin_of(F.col(confidence), n_bins).alias("bin")).agg(
        half_up(F.try_divide(F.sum(F.col(confidence).cast("decimal(12,6)")).cast("double"), F.count(F.lit(1))), 4).alias("mean_confidence"),
        half_up(F.try_divide(F.sum(F.col(label).cast("decimal(12,6)")).cast("double"), F.count(F.lit(1))), 4).alias("accuracy"),
        F.count(F.lit(1)).alias("n"),
    )
    return bins.join(got, "bin", "left").select("bin", "centre", "mean_confidence", "accuracy", F.coalesce("n", F.lit(0)).alias("n"))


def calibration_error(curve: DataFrame) -> DataFrame:
    """Expected calibration error of a reliability curve, over its rounded values."""
    gap = F.abs(F.col("accuracy").cast("decimal(12,4)") - F.col("mean_confidence").cast("decimal(12,4)")) * F.col("n")
    return curve.agg(half_up(F.try_divide(F.sum(gap).cast("double"), F.sum("n")), 4).alias("ece"), F.sum("n").alias("n"))


class Calibrator:
    """Isotonic or logistic map from a raw confidence to a probability, fitted with the ML library."""

    def __init__(self, method: str = "isotonic") -> None:
        if method not in ("isotonic", "platt"):
            raise ValueError("method is isotonic or platt")
        self.method, self.model = method, None

    def fit(self, pairs: DataFrame, confidence: str = "confidence", label: str = "label") -> Calibrator:
        from pyspark.ml.classification import LogisticRegression
        from pyspark.ml.functions import array_to_vector
        from pyspark.ml.regression import IsotonicRegression

        clean = pairs.where(F.col(confidence).isNotNull() & F.col(label).isNotNull()).select(F.col(confidence).cast("double").alias("c"), F.col(label).cast("double").alias("label"))
        n = clean.count()
        if n < 2:
            raise ValueError("calibration needs at least two pairs")
        rows = clean.select(array_to_vector(F.array("c")).alias("features"), "label")
        if self.method == "isotonic":
            self.model = IsotonicRegression(featuresCol="features", labelCol="label", predictionCol="calibrated").fit(rows)
        else:
            self.model = LogisticRegression(regParam=1.0 / n, elasticNetParam=0.0, standardization=False).fit(rows)
        return self

    def transform(self, rows: DataFrame, confidence: str = "confidence") -> DataFrame:
        """``rows`` with the raw value kept in confidence_raw and the calibrated one, rounded, in its place."""
        from pyspark.ml.functions import array_to_vector, vector_to_array

        if self.model is None:
            raise ValueError("the calibrator is not fitted")
        fed = rows.withColumn("features", array_to_vector(F.array(F.coalesce(F.col(confidence).cast("double"), F.lit(0.0)))))
        out = self.model.transform(fed)
        value = F.col("calibrated") if self.method == "isotonic" else vector_to_array("probability")[1]
        calibrated = F.when(F.col(confidence).isNotNull(), F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)), 4))
        return out.withColumns({"confidence_raw": F.col(confidence), confidence: calibrated}).select(*rows.columns, "confidence_raw")

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)

    @staticmethod
    def load(path: str, method: str = "isotonic") -> Calibrator:
        from pyspark.ml.classification import LogisticRegressionModel
        from pyspark.ml.regression import IsotonicRegressionModel

        out = Calibrator(method)
        out.model = (IsotonicRegressionModel if method == "isotonic" else LogisticRegressionModel).load(path)
        return out


def precision_recall(matches: DataFrame, label: str = "label", outcome: str = "outcome") -> DataFrame:
    """(label, precision, recall, f1, n_true) from rows with outcome tp, fp or fn; f1 is 0 where both are."""
    tp, fp, fn = (F.count_if(F.col(outcome) == o) for o in ("tp", "fp", "fn"))
    counts = matches.groupBy(label).agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
    return counts.select(label, half_up(p, 4).alias("precision"), half_up(r, 4).alias("recall"), half_up(f1, 4).alias("f1"), (F.col("tp") + F.col("fn")).alias("n_true"))


def average_precision(detections: DataFrame, truths: DataFrame, label: str = "label", score: str = "score", hit: str = "hit") -> DataFrame:
    """(label, ap, n_true): area under the precision-recall curve of each class with true cases.

    ``detections`` (label, score, hit) are matched already, at most one hit a
    true case; ``truths`` is (label, n_true).  Detections of equal scores come
    on together.  Precision at a recall is the best at that recall or beyond.
    """
    levels = detections.where(F.col(score).isNotNull()).groupBy(label, score).agg(F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("tp"))
    along = Window.partitionBy(label).orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, 0)
    beyond = Window.partitionBy(label).orderBy(F.desc(score)).rowsBetween(0, Window.unboundedFollowing)
    curve = levels.withColumn("precision", F.sum("tp").over(along).cast("double") / F.sum("n").over(along)).withColumn("best", F.max("precision").over(beyond))
    area = curve.groupBy(label).agg(F.sum(F.col("best") * F.col("tp")).alias("area"))
    kept = truths.where("n_true > 0")
    return kept.join(area, label, "left").select(label, half_up(F.coalesce(F.col("area") / F.col("n_true"), F.lit(0.0)), 4).alias("ap"), "n_true")


def estimate(damages: DataFrame, estimator: Callable[[DataFrame], DataFrame], columns: tuple[str, ...]) -> DataFrame:
    """What an injected estimator makes of consolidated damages, held to the columns it must give."""
    out = estimator(damages)
    missing = set(columns) - set(out.columns)
    if missing:
        raise ValueError(f"the estimator gives no {sorted(missing)}")
    return out.select(*columns)
