"""Consolidation, lookups, metrics and calibration on hand-made rows."""

from __future__ import annotations

import random

import pytest
from conftest import listed, rows
from pyspark.sql import functions as F

from claimweave.functions.numeric import bin_of, half_even, half_up
from claimweave.operators import consolidate as con
from claimweave.operators import lookup, metrics

DETECTION = "claim_id string, image_hash string, pos int, type string, part string, part_category string, zone string, confidence double, extension string, severity string, structural_suspicion boolean, area_pct double"


def det(pos, image="h1", type="scratch", part="front_bumper", zone="front", category="plastic_panel", conf=0.9, ext="medium", sev=None, struct=None, area=None, claim="A"):
    return (claim, image, pos, type, part, category, zone, conf, ext, sev, struct, area)


def merged(spark, *found):
    return [r.asDict() for r in con.consolidate(spark.createDataFrame(list(found), DETECTION)).orderBy("first_pos").collect()]


def test_three_views_of_one_damage(spark):
    (d,) = merged(spark, det(1, "h1"), det(2, "h2"), det(3, "h3"))
    assert d["damage_id"] == "C1" and d["supporting_images"] == ["h1", "h2", "h3"] and d["n_detections"] == 3


def test_distinct_damages_are_numbered_by_appearance(spark):
    out = merged(spark, det(2, type="dent", part="hood"), det(1))
    assert [(d["damage_id"], d["type"]) for d in out] == [("C1", "scratch"), ("C2", "dent")]


def test_weighted_mean_votes_and_maxima(spark):
    (d,) = merged(
        spark,
        det(1, "a", zone="front", conf=0.9, ext="small", sev="leve", struct=False, area=1.234),
        det(2, "b", zone="front", conf=0.8, ext="large", sev="severo", struct=True, area=9.876),
        det(3, None, zone="front_left", conf=0.5, ext=None, sev="odd", area=None),
    )
    assert d["zone"] == "front" and d["extension"] == "large" and d["severity"] == "severo" and d["structural_suspicion"]
    assert d["confidence"] == round((0.81 + 0.64 + 0.25) / 2.2, 4) and d["area_pct"] == 9.88 and d["supporting_images"] == ["a", "b"]
    (two,) = merged(spark, det(1, conf=0.9), det(2, conf=0.5))
    assert two["confidence"] == pytest.approx(0.7571)


def test_equal_votes_go_to_the_first_seen(spark):
    (d,) = merged(spark, det(2, zone="rear", conf=0.5), det(1, zone="front", conf=0.5))
    assert d["zone"] == "front"


def test_unknowns_and_nulls(spark):
    out = merged(spark, det(1, part="unknown", zone="rear"), det(2, part="", zone="rear"), det(3, part=None, zone=None), det(4, part="unknown", zone="unknown", conf=None))
    assert len(out) == 2
    none = out[1]
    assert none["part"] == none["zone"] == "unknown" and none["n_detections"] == 2
    (zero,) = merged(spark, det(1, conf=None, ext=None))
    assert zero["confidence"] == 0.0 and zero["extension"] == "medium" or zero["extension"] == "small"
    assert zero["severity"] is None
    assert con.consolidate(spark.createDataFrame([], DETECTION)).count() == 0


def test_consolidation_against_a_loop(spark):
    rng = random.Random(3)
    found = [det(i, f"h{rng.randrange(4)}", rng.choice(["scratch", "dent"]), rng.choice(["hood", "trunk", "unknown"]), rng.choice(["front", "rear", "unknown"]), rng.choice(["body_panel", "unknown"]), rng.choice([0.5, 0.6, 0.7, 0.9]), rng.choice(["small", "large", None]), claim=f"c{rng.randrange(6)}") for i in range(200)]
    want = {}
    for f in found:
        claim, image, pos, kind, part, cat, zone, conf, ext, *_ = f
        region = ("part", part) if part != "unknown" else ("zone", zone) if zone != "unknown" else ("none", "")
        want.setdefault((claim, kind, *region), []).append(f)
    got = con.consolidate(spark.createDataFrame(found, DETECTION)).collect()
    assert len(got) == len(want)
    for g in got:
        group = next(v for v in want.values() if v[0][2] == g["first_pos"])
        votes: dict = {}
        for f in group:
            if f[6] != "unknown":
                votes[f[6]] = votes.get(f[6], 0) + round(f[7] * 1e6)
        best = max(votes, key=lambda z: votes[z]) if votes else "unknown"
        assert g["zone"] == best and g["n_detections"] == len(group)
        c = [f[7] for f in group]
        assert g["confidence"] == pytest.approx(sum(x * x for x in c) / sum(c), abs=1e-4)


# --- lookups


def test_lookup_with_default(spark):
    table = spark.createDataFrame([("Other", 0), ("Madrid", 1), ("Málaga", 2)], "name string, v int")
    df = spark.createDataFrame([(1, " madrid "), (2, "malaga"), (3, ""), (4, None), (5, "MÁLAGA")], "id int, place string")
    got = {r["id"]: (r["matched_key"], r["v"]) for r in lookup.lookup_default(df, "place", table, "name", "Other").collect()}
    assert got == {1: ("Madrid", 1), 2: ("Other", 0), 3: ("Other", 0), 4: ("Other", 0), 5: ("Málaga", 2)}


def test_cascade_against_enumeration(spark):
    table = [("p", "s", "x", 1), ("p", "s", "any", 2), ("p", "any", "any", 3), ("b", "any", "x", 4), ("unknown", "s", "any", 5), ("unknown", "any", "any", 6)]
    t = spark.createDataFrame(table, "a string, b string, c string, v int")
    cases = [(a, b, c) for a in ("p", "b", "zzz", None, "unknown") for b in ("s", "d", None, "any") for c in ("x", "y", None, "any")]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "id int, a string, b string, c string")
    got = {r["id"]: (r["v"], r["exact"]) for r in lookup.cascade_lookup(df, t, [("a", "unknown"), ("b", "any"), ("c", "any")], ["v"]).collect()}
    for i, (a, b, c) in enumerate(cases):
        a, b, c = a or "unknown", b or "any", c or "any"
        best = min(((x != a, y != b, z != c), v) for x, y, z, v in table if x in (a, "unknown") and y in (b, "any") and z in (c, "any"))
        assert got[i] == (best[1], not any(best[0])), cases[i]


def test_keywords_need_no_accents(spark):
    words = spark.createDataFrame([("capo", "hood"), ("puerta", "door")], "keyword string, part string")
    df = spark.createDataFrame([(1, "Daño en el CAPÓ y la puerta"), (2, "nada"), (3, None), (4, "")], "id int, t string")
    assert {(r["id"], tuple(r["declared"])) for r in lookup.keyword_parts(df, "id", "t", words).collect()} == {(1, ("door", "hood"))}


def test_upsert_and_append(spark):
    now = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "id int, v string")
    assert rows(lookup.upsert(now, new, "id")) == {(1, "a"), (2, "B"), (3, "C")}
    assert rows(lookup.append_new(now, new, "id")) == {(1, "a"), (2, "b"), (3, "C")}


def test_bracket_edges(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (499.99,), (500.0,), (1500.0,), (None,)], "v double")
    b = lookup.bucket_ranges(df, "v", [("<500", 500.0), ("500-1500", 1500.0), (">1500", None)])
    assert [r[0] for r in df.select(b).collect()] == [None, "<500", "<500", "500-1500", ">1500", None]


# --- numbers


def test_rounding(spark):
    df = spark.createDataFrame([(352.5 * 1.21,), (1.005,), (None,)], "v double")
    assert [r[0] for r in df.select(half_up(F.col("v"))).collect()] == [426.53, 1.01, None]
    assert [r[0] for r in df.where("v is not null").select(half_even(F.col("v"))).collect()] == [426.52, 1.0]


def test_bins_follow_the_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.3,), (0.7,), (0.99,), (1.0,)], "v double")
    assert [r[0] for r in df.select(bin_of(F.col("v"), 10)).collect()] == [0, 3, 7, 9, 9]


# --- metrics

RECORD = "lane string, estimated double, real double, structural_suspected boolean, structural_truth boolean, severity_pred string, severity_truth string, processing_time_ms bigint"


def test_headline(spark):
    df = spark.createDataFrame(
        [("verde", 100.0, 110.0, False, False, "leve", "leve", 10), ("ambar", 500.0, 300.0, False, True, "moderado", "moderado", 20), ("rojo", 900.0, 100.0, False, True, "severo", "severo", None), ("verde", None, 5.0, True, True, None, "leve", 30)], RECORD
    )
    r = metrics.headline(df).first()
    assert r["mae"] == 105.0 and r["green_of_all"] == 0.5 and r["n_paid"] == 2 and r["share_within"] == 0.5 and r["mean_ms"] == 20.0
    assert r["structural_miss_rate"] == pytest.approx(0.3333)
    assert metrics.weighted_kappa(df, "severity_pred", "severity_truth").first()["kappa"] == 1.0
    empty = metrics.headline(df.limit(0)).first()
    assert empty["mae"] is None and empty["n_records"] == 0
    assert metrics.weighted_kappa(df.limit(1), "severity_pred", "severity_truth").first()["kappa"] is None
    checks = rows(metrics.target_check(metrics.headline(df), {"mae": ("<=", 120.0), "share_within": (">=", 0.8)}))
    assert checks == {("mae", 105.0, 120.0, True), ("share_within", 0.5, 0.8, False)}


def test_kappa_against_the_definition(spark):
    rng = random.Random(4)
    labels = ("leve", "moderado", "severo")
    pairs = [(rng.choice(labels), rng.choice(labels)) for _ in range(300)] + [("x", "leve"), (None, "leve")]
    df = spark.createDataFrame(pairs, "p string, t string")
    known = [(labels.index(a), labels.index(b)) for a, b in pairs if a in labels]
    n = len(known)
    seen = sum((a - b) ** 2 for a, b in known)
    chance = sum((a - b) ** 2 for a, _ in known for _, b in known) / n
    assert metrics.weighted_kappa(df, "p", "t").first()["kappa"] == pytest.approx(1 - seen / chance, abs=1e-4)


def test_brackets_without_records_are_listed(spark):
    df = spark.createDataFrame([("verde", 100.0, 110.0, False, False, "leve", "leve", 10), ("rojo", 1.0, 2000.0, None, None, None, None, None)], RECORD)
    assert rows(metrics.mae_by_bracket(df, [("<500", 500.0), (">500", None)])) == {("<500", 10.0, 1), (">500", None, 0)}


def test_bootstrap_intervals_hold_the_mean(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([("a", rng.gauss(10, 2)) for _ in range(800)] + [("b", 1.0)], "g string, v double")
    for out in (metrics.bootstrap_mean(df, "v", ["g"]), metrics.bootstrap_exact(df, "v", ["g"], resamples=300)):
        r = {x["g"]: x for x in out.collect()}["a"]
        assert r["low"] < 10 < r["high"] and r["high"] - r["low"] < 0.6
    assert metrics.bootstrap_exact(df.where("g = 'b'"), "v", ["g"]).first()["low"] is None


def test_bootstrap_bounds_do_not_depend_on_partitions(spark):
    rng = random.Random(8)
    values = [round(rng.gauss(10, 2), 1) for _ in range(600)]
    df = spark.createDataFrame([("a", v) for v in values], "g string, v double")
    one, many = (metrics.bootstrap_mean(df.repartition(n), "v", ["g"]).first() for n in (1, 7))
    assert one == many
    # equal rows are drawn apart: the width is that of the exact bootstrap
    exact = metrics.bootstrap_exact(df, "v", ["g"]).first()
    assert abs(one["low"] - exact["low"]) < 0.03 and abs(one["high"] - exact["high"]) < 0.03


def test_calibration_helps(spark, tmp_path):
    rng = random.Random(6)
    truth = {0.5: 0.45, 0.7: 0.5, 0.9: 0.55, 0.95: 0.6}
    pairs = [(c, float(rng.random() < p)) for c, p in truth.items() for _ in range(250)]
    df = spark.createDataFrame(pairs, "confidence double, label double")
    before = metrics.brier(df).first()["brier"]
    for method in ("isotonic", "platt"):
        c = metrics.Calibrator(method).fit(df)
        out = c.transform(df)
        assert metrics.brier(out).first()["brier"] < before
        c.save(str(tmp_path / method))
        again = metrics.Calibrator.load(str(tmp_path / method), method).transform(df)
        assert listed(again.select("confidence")) == listed(out.select("confidence"))
    with pytest.raises(ValueError):
        metrics.Calibrator().fit(df.limit(1))
    curve = metrics.reliability_curve(df)
    assert curve.count() == 10 and curve.agg(F.sum("n")).first()[0] == 1000
    assert metrics.calibration_error(curve).first()["ece"] > 0.2
    perfect = spark.createDataFrame([(1.0, 1.0)] * 5 + [(0.0, 0.0)] * 5, "confidence double, label double")
    assert metrics.calibration_error(metrics.reliability_curve(perfect)).first()["ece"] == 0.0


def test_the_stream_of_damages_has_every_line(spark, sf_dir):
    from claimweave.plans import claims

    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_orderkey is not null")
    want = lines.groupBy(F.col("l_orderkey").cast("string")).agg(F.count(F.lit(1)), F.max("l_discount").cast("double"))
    assert rows(claims.streaming_consolidate(spark, sf_dir).select("claim_id", "n_detections", "best")) == rows(want)


def test_running_damages_go_on_over_batches_without_python(spark, tmp_path):
    from claimweave.plans.claims import _run_stream
    from claimweave.streaming.monitor import running_damages

    kind = "claim_id int, type string, part string, confidence double"
    for batch in ([(1, "dent", "hood", 0.5), (1, "dent", "hood", 0.75), (1, "dent", "unknown", None)], [(1, "dent", "", float("nan")), (1, "dent", None, 0.25), (1, None, "hood", 0.5), (2, "dent", "hood", -1.0), (None, "dent", "hood", 0.5)]):
        spark.createDataFrame(batch, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    running = running_damages(spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")))
    assert "FlatMapGroupsInPandasWithState" not in running._jdf.queryExecution().analyzed().toString()
    out = _run_stream(running, "test-damages", "update")
    last = out.groupBy("claim_id").agg(F.max_by(F.struct("n_detections", "n_damages", "best"), "batch").alias("r")).select("claim_id", "r.*")
    assert rows(last) == {("1", 6, 3, 0.75), ("2", 1, 1, 0.0), (None, 1, 1, 0.5)}
    assert out.select("batch").distinct().count() == 2
