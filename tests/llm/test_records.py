"""Problems 1, 2, 4, 6 and 7 against brute force and edge cases."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from claimweave.llm import canonical, groups, overlap, quantiles, splits
from claimweave.llm import plans as llm_plans
from claimweave.operators.neardup import hamming_pairs

# --- 1: canonical list

CATALOGUE = [(1, "Véduolamo", "VEO", "Rarilneven"), (2, "Véduolamo", "VEO", "Dunéjas"), (3, "Selmihi", None, "Bracatorsel"), (4, "Gocámdorlan", None, "Bracatorsel"), (5, "Gocámdorlan", None, "Xipimife"), (6, "Selmihi", None, "Nortresone")]

TYPED = [
    ("Véduolamo", "Dunejas", 2), ("VEDUOLAMO", "dunéjas 1.6 TDI", 2), ("veo", "Dunéjas", 2), ("V.E.O.", "Dunéjas II", 2), ("Vèduolmo", "Dunéjxs", 2), ("Dunéjas", "Véduolamo", 2), ("Dunéjas (Véduolamo)", None, 2), (None, "Véduolamo-Dunéjas", 2),
    ("", "Dunéjas", 2), ("-", "Dunéjas", 2), ("desconocido", "Dunéjas", 2), (None, "Bracatorsel", 0), ("Selmihi", "Bracatorsel", 3), ("Gocámdorlan", "Bracatorsel aut.", 4), ("Selm1hi", "N0rtresone", 6), ("Sel mihi", "Nor-tresone", 6), ("Selmihi", "Xipimife", 0),
    ("Selmihi", None, 0), ("Selmihi", "", 0), ("Jastortor", "Duminemi", 0), ("Jastortor", "Nortresone", 0), ("moto", "x", 0), ("?", "??", 0), ("", "", 0), ("Selmihi", "Chomicamdor", 0), ("  Selmihi ", "nORTRESONE -", 6), ("x" * 5000, "Nortresone " + "y" * 5000, 0), ("Selmihi " * 3000, "Nortresone " * 3000, 6),
]


def test_typed_pairs_resolve(spark):
    lexicon = canonical.Lexicon(CATALOGUE)
    for brand, model, want in TYPED:
        assert canonical.resolve(lexicon, brand, model)[0] == want, (brand, model)


def test_dictionary_and_join_agree(spark):
    cat = spark.createDataFrame(CATALOGUE, "catalog_id bigint, marca string, marca_alias string, modelo string")
    typed = spark.createDataFrame([(f"c{i}", b, m, 1.0) for i, (b, m, _) in enumerate(TYPED)], "claim_id string, marca string, modelo string, cost double")
    lexicon = canonical.load_lexicon(cat, typed, "catalog_id", "marca", "marca_alias", "modelo")
    by_broadcast = rows(canonical.resolve_pairs(typed, lexicon, "marca", "modelo").select("claim_id", "entry_id"))
    by_join = rows(canonical.resolve_by_join(typed, cat, "claim_id", "marca", "modelo", ("catalog_id", "marca", "marca_alias", "modelo")).select("claim_id", "entry_id"))
    assert by_broadcast == by_join == {(f"c{i}", want) for i, (_, _, want) in enumerate(TYPED)}


def test_ties_and_long_terms_agree_both_ways(spark):
    long = "".join(random.Random(2).choices("abcdefghklmnp", k=80))
    names = ("catalog_id", "marca", "marca_alias", "modelo")
    cat = spark.createDataFrame([(1, "Bravixo", None, "Tarsola"), (2, "Bravixo", None, "Tarsole"), (3, "Bravixo", None, long)], "catalog_id bigint, marca string, marca_alias string, modelo string")
    data = [("c0", "Bravixo", "Tarsolt"), *((f"c{i}", "Bravixo", "Tarsole") for i in (1, 2, 3)), ("c4", "Bravixo", "Tarsola"), ("c5", "Bravixo", long)]
    typed = spark.createDataFrame(data, "claim_id string, marca string, modelo string")
    lexicon = canonical.load_lexicon(cat, typed, *names)
    by_broadcast = rows(canonical.resolve_pairs(typed, lexicon, "marca", "modelo").select("claim_id", "entry_id", "cost"))
    by_join = rows(canonical.resolve_by_join(typed, cat, "claim_id", "marca", "modelo", names).select("claim_id", "entry_id", "cost"))
    assert by_join == by_broadcast
    assert {(c, e) for c, e, _ in by_join} == {("c0", 2), ("c1", 2), ("c2", 2), ("c3", 2), ("c4", 1), ("c5", 3)}


def test_claims_resolve_alike_below_and_above_the_switch(spark, tmp_path, monkeypatch):
    # the entry typed exactly more often wins the tie of c0; an alias of two brands goes to the smaller id
    catalogue = [(4, "Wexola", "WX", "Zumparto"), (3, "Tiromax", "WX", "Zumpartel"), (2, "Bravixo", None, "Tarsole"), (1, "Bravixo", None, "Tarsola")]
    spark.createDataFrame(catalogue, "catalog_id bigint, marca string, marca_alias string, modelo string").coalesce(1).write.parquet(str(tmp_path / "vehicle_catalog.parquet"))
    typed = [("c0", "Bravixo", "Tarsolt"), *((f"c{i}", "Bravixo", "Tarsole") for i in (1, 2, 3)), ("c4", "Bravixo", "Tarsola"), ("c5", "WX", "Zumpartel"), ("c6", None, "Tarsolt")]
    spark.createDataFrame(typed, "claim_id string, marca string, modelo string").selectExpr("*", "timestamp '2024-01-01' as received_at").write.parquet(str(tmp_path / "vehicle_metadata.parquet"))
    both = []
    for most in (canonical.MAX_TERMS, 0):
        monkeypatch.setattr(canonical, "MAX_TERMS", most)
        both.append(rows(llm_plans._resolved_claims(spark, str(tmp_path)).select("claim_id", "entry_id", "cost", "reason")))
    assert both[0] == both[1]
    assert {(c, e) for c, e, _, _ in both[0]} == {("c0", 2), ("c5", 3), ("c6", 2)}


def test_a_near_place_counts_among_many_exact_ones_behind():
    lexicon = canonical.Lexicon([(1, "Bravixo", None, "Tarsola"), (2, "Bravixo", None, "Quimberto")])
    # one wrong letter at the start costs less than the words before the exact places
    model = " ".join(["Tarsolt", *["gris"] * 30, *["Tarsola"] * 5])
    near = canonical.resolve(lexicon, "Bravixo", "Tarsolt")
    assert near[0] == 1 and canonical.resolve(lexicon, "Bravixo", model) == near


def test_empty_list_and_empty_table(spark):
    empty = canonical.Lexicon([])
    assert canonical.resolve(empty, "Selmihi", "Nortresone")[0] == 0
    none = spark.createDataFrame([], "claim_id string, marca string, modelo string")
    assert canonical.resolve_pairs(none, canonical.Lexicon(CATALOGUE), "marca", "modelo").count() == 0


def test_symmetric_deletes_find_all_close_terms():
    rng = random.Random(5)
    terms = ["".join(rng.choice("abcdef") for _ in range(rng.randint(5, 9))) for _ in range(60)]
    lexicon = canonical.Lexicon([(i, t, None, t + "zz") for i, t in enumerate(terms)])
    for _ in range(200):
        t = list(rng.choice(terms))
        for _ in range(rng.randint(0, 2)):
            k = rng.randrange(len(t))
            t[k : k + rng.randint(0, 1)] = rng.choice(["", "a", "x"])
        word = "".join(t)
        want = {x for x in lexicon.brands if canonical.edit_count(word, x, canonical.allowed_edits(len(x))) <= canonical.allowed_edits(len(x))}
        assert {x for x, _ in lexicon.near(word) if x in lexicon.brands} == want


def test_ties_go_to_the_frequent_entry():
    lexicon = canonical.Lexicon([(1, "Abcdefg", None, "Model one"), (2, "Abcdefh", None, "Model one")], {2: 9, 1: 3})
    assert canonical.resolve(lexicon, "Abcdefx", "Model one")[0] == 2


# --- 2: quantiles


def ranks_of(values, at):
    v = np.sort(values)
    return np.searchsorted(v, at, "left"), np.searchsorted(v, at, "right")


def test_rank_error_over_days_and_merges(spark):
    rng = np.random.default_rng(1)
    data = [(d, float(x)) for d in range(5) for x in rng.lognormal(5, 2, 2000)]
    df = spark.createDataFrame(data, "day int, value double")
    k = quantiles.k_for(0.02)
    daily = quantiles.digests(df, ["day"], "value", k)
    assert daily.agg(F.sum("n")).first()[0] == 10000
    merged = quantiles.merge_digests(daily.withColumn("g", F.lit(1)), ["g"])
    got = quantiles.digest_percentiles(merged, ["g"], (0.01, 0.25, 0.5, 0.75, 0.99), k).collect()
    values = np.array([v for _, v in data])
    for r in got:
        low, _ = ranks_of(values, r["value_low"])
        _, high = ranks_of(values, r["value_high"])
        want = math.ceil(r["percentile"] * 10000)
        assert low - 0.02 * 10000 <= want <= high + 0.02 * 10000
    # the order of merging does not matter
    again = quantiles.digest_percentiles(quantiles.merge_digests(daily.orderBy(F.desc("day")).withColumn("g", F.lit(1)), ["g"]), ["g"], (0.5,), k).first()
    assert again["value"] == next(r["value"] for r in got if r["percentile"] == 0.5)


def test_local_digests_merge_to_those_of_all_rows(spark, monkeypatch):
    rng = np.random.default_rng(4)
    data = [(int(g), float(x) if x < 400 else None, float(y)) for g, x, y in zip(rng.integers(0, 3, 6000), rng.lognormal(3, 2, 6000), rng.lognormal(1, 3, 6000), strict=True)]
    df = spark.createDataFrame(data, "g int, x double, y double").repartition(5)
    fed = df.withColumn("g", F.col("g").cast("bigint"))
    for roomy in (quantiles._ROOMY, 100):
        monkeypatch.setattr(quantiles, "_ROOMY", roomy)
        merged = quantiles.compact(quantiles.merge_digests(quantiles.local_digests(fed, "g", ["x", "y"], 50), ["grp", "field"]), ["grp", "field"], 50)
        assert merged.agg(F.sum("n")).first()[0] == sum((x is not None) + 1 for _, x, _ in data)
        for r in quantiles.digest_percentiles(merged, ["grp", "field"], (0.1, 0.5, 0.9), 50).collect():
            values = np.array([row[1 + r["field"]] for row in data if row[0] == r["grp"] and row[1 + r["field"]] is not None])
            low, _ = ranks_of(values, r["value_low"])
            _, high = ranks_of(values, r["value_high"])
            assert r["n"] == len(values) and low - r["rank_error"] <= math.ceil(r["percentile"] * len(values)) <= high + r["rank_error"]
    # compression works where a group has more values than the factor
    assert merged.count() < 2 * 3 * 50 * 3


def test_digest_size_is_bounded():
    rng = np.random.default_rng(2)
    leaves, counts = np.unique(quantiles.leaf_of(rng.lognormal(3, 3, 200_000)), return_counts=True)
    level, node, n = quantiles.compress(np.zeros(len(leaves), "int64"), leaves, counts.astype("int64"), 200)
    assert n.sum() == 200_000 and len(n) <= 3 * 200
    same = quantiles.compress(level, node, n, 200)
    assert sum(map(len, same)) == 3 * len(n)
    shuffled = rng.permutation(len(n))
    for a, b in zip(same, quantiles.compress(level[shuffled], node[shuffled], n[shuffled], 200), strict=True):
        assert np.array_equal(a, b)


def test_many_digests_at_once_are_those_of_each():
    rng = np.random.default_rng(7)
    parts = [np.unique(quantiles.leaf_of(rng.lognormal(2, 2, size)), return_counts=True) for size in (1, 50, 3000, 20_000)]
    group = np.concatenate([np.full(len(leaf), g) for g, (leaf, _) in enumerate(parts)])
    leaf, n = (np.concatenate([p[j] for p in parts]).astype("int64") for j in (0, 1))
    limit = np.array([c.sum() // 40 for _, c in parts])
    got = quantiles.compress_groups(group, np.zeros(len(leaf), "int64"), leaf, n, limit)
    for g, (one_leaf, one_n) in enumerate(parts):
        own = set(zip(*(x[got[0] == g].tolist() for x in got[1:]), strict=True))
        assert own == set(zip(*(x.tolist() for x in quantiles.compress(np.zeros(len(one_leaf), "int64"), one_leaf, one_n.astype("int64"), 40)), strict=True))


def test_unmeasured_values_and_leaves(spark):
    values = [None, float("nan"), float("inf"), -1.0, 0.0, 5e-324, 1.0, 1.5, 3.0, 1e300, 0.1, 123456.789]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(quantiles.measured(F.col("v")).alias("v")).where("v is not null")
    got = sorted((r["v"], r["leaf"]) for r in df.select("v", quantiles._leaf_column(F.col("v")).alias("leaf")).collect())
    assert [v for v, _ in got] == [0.0, 5e-324, 0.1, 1.0, 1.5, 3.0, 123456.789, 1e300]
    assert [leaf for _, leaf in got] == quantiles.leaf_of(np.array([v for v, _ in got])).tolist()
    rng = np.random.default_rng(3)
    many = np.concatenate([rng.lognormal(0, 20, 3000), 2.0 ** np.arange(-40, 40), np.nextafter(2.0 ** np.arange(-40, 40), 0)])
    leaves = [r["leaf"] for r in spark.createDataFrame([(i, float(v)) for i, v in enumerate(many)], "i int, v double").select("i", quantiles._leaf_column(F.col("v")).alias("leaf")).orderBy("i").collect()]
    assert leaves == quantiles.leaf_of(many).tolist()
    assert quantiles.digests(df.limit(0).withColumn("g", F.lit(1)), ["g"], "v", 10).count() == 0


def test_equal_values_share_a_leaf(spark):
    df = spark.createDataFrame([(1, 7.0)] * 50, "g int, v double")
    (r,) = quantiles.digest_percentiles(quantiles.digests(df, ["g"], "v", 100), ["g"], (0.5,), 100).collect()
    assert r["value_low"] <= 7.0 <= r["value_high"] and r["n"] == 50


# --- 4: splits

RATIOS = {"train": 0.7, "val": 0.2, "test": 0.1}


def linked(spark, data):
    return splits.link_rows(spark.createDataFrame(data, "id bigint, author string, source string, component string"), "id", "author", "source")


def test_related_records_share_a_split(spark):
    data = [(i, f"a{i % 150}", None, "x") for i in range(600)] + [(600 + i, f"a{i}", f"s{i // 2}", "x") for i in range(0, 20)] + [(700, None, "", "x"), (None, "a1", None, "x"), (5, "a5", None, "x")]
    assigned, state = splits.assign_batch(linked(spark, data), None, RATIOS)
    got = {r["record_id"]: (r["component"], r["split"]) for r in assigned.collect()}
    assert len(got) == 621
    by_author: dict = {}
    for i, a, *_ in data:
        if i is not None and a:
            by_author.setdefault(a, set()).add(got[i])
    assert all(len(v) == 1 for v in by_author.values())
    assert got[0] == got[1] and got[2] == got[3]  # linked through a source
    share = sum(s == "train" for _, s in got.values()) / len(got)
    assert abs(share - 0.7) < 0.02
    assert state.components.agg(F.sum("n_records")).first()[0] == 621


def test_batches_keep_splits_and_quarantine_conflicts(spark):
    first, state = splits.assign_batch(linked(spark, [(i, f"a{i}", None, "") for i in range(200)]), None, RATIOS)
    got = {r["record_id"]: r["split"] for r in first.collect()}
    by_split = {s: sorted(i for i in got if got[i] == s) for s in RATIOS}
    t, t2, v = by_split["train"][0], by_split["train"][1], by_split["val"][0]
    batch = [(1000, f"a{t}", "n1", ""), (1001, f"a{t}", f"m{t2}", ""), (1002, f"a{t2}", f"m{t2}", ""), (1003, f"a{t}", "w", ""), (1004, f"a{v}", "w", ""), (1005, None, "w", ""), (1006, "new", None, "")]
    second, later = splits.assign_batch(linked(spark, batch), state, RATIOS)
    out = {r["record_id"]: r["split"] for r in second.collect()}
    assert out[1006] in RATIOS
    # v and t cannot merge: what joins them is set apart, and so is all that is new in that merge
    assert out[1003] == out[1004] == out[1005] == splits.QUARANTINE
    third, _ = splits.assign_batch(linked(spark, [(2000, f"a{t}", None, ""), (2001, f"a{v}", None, ""), (2002, None, "w", "")]), later, RATIOS)
    last = {r["record_id"]: r["split"] for r in third.collect()}
    assert last == {2000: "train", 2001: "val", 2002: splits.QUARANTINE}


def test_one_entity_with_a_third_of_all(spark):
    data = [(i, "hot" if i % 3 == 0 else f"a{i}", None, "") for i in range(900)]
    assigned, _ = splits.assign_batch(linked(spark, data), None, RATIOS)
    assert assigned.where("record_id % 3 = 0").select("split").distinct().count() == 1
    report = {r["split"]: r["share"] for r in splits.split_report(assigned, RATIOS).collect()}
    assert abs(report["train"] - 0.7) < 0.02 and abs(report["val"] - 0.2) < 0.02


def test_records_that_come_back(spark, tmp_path):
    first, state = splits.assign_batch(linked(spark, [(i, f"a{i}", None, "") for i in range(200)]), None, RATIOS)
    state.save(str(tmp_path / "state"))
    state = splits.SplitState.load(spark, str(tmp_path / "state"))
    got = {r["record_id"]: r["split"] for r in first.collect()}
    by_split = {s: sorted(i for i in got if got[i] == s) for s in RATIOS}
    t, t2, v = by_split["train"][0], by_split["train"][1], by_split["val"][0]
    # one comes back as it was, one with an entity of another split, one links two components of its own split
    second, later = splits.assign_batch(linked(spark, [(t, f"a{v}", None, ""), (v, f"a{v}", None, ""), (by_split["test"][0], None, None, ""), (900, f"a{t}", None, ""), (by_split["train"][3], f"a{t2}", "new", ""), (901, None, "new", "")]), state, RATIOS)
    out = {r["record_id"]: (r["component"], r["split"]) for r in second.collect()}
    assert all(out[i][1] == got[i] for i in out if i < 200)
    assert out[900][1] == splits.QUARANTINE
    assert out[901] == out[by_split["train"][3]] and out[901][1] == "train"
    assert later.components.agg(F.sum("n_records")).first()[0] == 202 and later.records.count() == 202
    third, last = splits.assign_batch(linked(spark, [(902, f"a{t2}", None, ""), (903, "", "new", ""), (904, f"a{v}", None, "")]), later, RATIOS)
    out = {r["record_id"]: r for r in third.collect()}
    # the merged component is found by either of its entities
    assert out[902]["component"] == out[903]["component"] and out[904]["split"] == "val"
    alive = last.components.where("component = root")
    assert last.components.count() == alive.count() + 1


def test_entities_in_chains_are_one_component(spark):
    data = [(i, f"p{i // 2}", f"q{(i + 1) // 2}", "") for i in range(300)]
    assigned, _ = splits.assign_batch(linked(spark, data), None, RATIOS)
    assert assigned.select("component", "split").distinct().count() == 1
    assert rows(splits.group_batch(linked(spark, data))) == {(i, 0) for i in range(300)}


def test_empty_batch(spark):
    assigned, state = splits.assign_batch(linked(spark, []), None, RATIOS)
    assert assigned.count() == 0 and state.entities.count() == 0


# --- 6: overlap


def near_codes(rng, n):
    base = [rng.getrandbits(64) for _ in range(n)]
    out = []
    for b in base:
        out.append(b)
        for bits in (3, 7, 8):
            x = b
            for p in rng.sample(range(64), bits):
                x ^= 1 << p
            out.append(x)
    return [x - 2**64 if x >= 2**63 else x for x in out]


@pytest.mark.parametrize("hot", [4096, 1])
def test_hamming_pairs_against_brute_force(spark, hot):
    codes = near_codes(random.Random(9), 40) + [0, 1, -1, -2, 0, None]
    left, right = codes[::2] + [0], codes[1::2] + [0, 3]
    got = rows(hamming_pairs(spark.createDataFrame([(c,) for c in left], "code bigint"), spark.createDataFrame([(c,) for c in right], "code bigint"), 7, hot))
    want = {(a, b) for a, b in itertools.product(left, right) if a is not None and b is not None and bin((a ^ b) & (2**64 - 1)).count("1") <= 7}
    assert got == want


def test_ways_a_pair_is_found(spark):
    schema = "id bigint, content_hash string, code bigint, vehicle string, shot string"
    train = spark.createDataFrame([(1, "h", 0, None, None), (2, None, None, "7", "1"), (3, "x", 1 << 40, None, "2"), (9, None, None, None, None)], schema)
    held = spark.createDataFrame([(10, "h", None, None, None), (11, None, None, "7", "1"), (12, None, 127, "7", "2"), (13, None, 255, None, None), (9, None, None, None, None), (14, None, None, None, "2")], schema)
    assert rows(overlap.cross_pairs(train, held, 7)) == {(1, 10, "hash"), (2, 11, "shot"), (1, 12, "code"), (9, 9, "itself")}
    assert overlap.cross_pairs(train.limit(0), held, 7).count() == 0


# --- 7: groups


def brute_groups(edges):
    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {(x, find(x)) for x in parent}


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_against_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(130)] + [(5000, 5001 + i) for i in range(150)] + [(7, 7), (None, 3), (3, None), (1, 2), (2, 1), (1, 2)]
    df = spark.createDataFrame([(a, b, "node") for a, b in edges], "a bigint, b bigint, node string")
    assert rows(groups.group_pairs(df, "a", "b")) == brute_groups(edges)


def test_no_pairs(spark):
    assert groups.group_pairs(spark.createDataFrame([(1, 1), (None, 2)], "a bigint, b bigint"), "a", "b").count() == 0


def test_claims_and_records_without_a_time_are_kept(spark, tmp_path):
    from claimweave.llm import plans

    typed = spark.createDataFrame([("a", "Selm1hi", "Nortresone", None), ("b", "Selmihi", "Nortresone", None), ("c", None, None, None), (None, "x", "y", None), ("d", "", "", "2024-01-01"), ("e", "moto", "x", "2024-01-02"), ("e", "Selmihi", "Xx", "2024-01-01"), ("e", "Selmihi", "Aa", "2024-01-01")], "claim_id string, marca string, modelo string, at string")
    typed.selectExpr("*", "cast(at as timestamp) as received_at", "1 as entry_id").write.parquet(str(tmp_path / "vehicle_metadata.parquet"))
    spark.createDataFrame(CATALOGUE, "catalog_id bigint, marca string, marca_alias string, modelo string").write.parquet(str(tmp_path / "vehicle_catalog.parquet"))
    assert rows(plans.p1_found(spark, str(tmp_path))) == {("a", 6), ("d", 0), ("e", 0)}
    misses = {(r["marca"], r["modelo"]) for r in plans.p1_misses(spark, str(tmp_path)).collect()}
    assert misses == {("", ""), ("Selmihi", "Aa")}
    records = spark.createDataFrame([(1, "Verde ", 10.0, 5, None), (1, "verde", 99.0, 5, "2025-01-01"), (2, "ámbar", float("nan"), None, None), (3, None, 1.0, 1, None), (None, "rojo", 1.0, 1, None), (4, "verde", 5.0, -3, "1960-01-01"), (4, "verde", 7.0, 3, "1961-01-01")], "record_id bigint, lane string, estimated_eur double, processing_time_ms bigint, at string")
    records.selectExpr("*", "cast(at as timestamp) as received_at", "timestamp'2024-05-05 10:00:00' as evaluated_at").write.parquet(str(tmp_path / "claim_metrics.parquet"))
    got = plans.p2_lane_percentiles(spark, str(tmp_path)).where("percentile = 0.5 and period = 'all'").collect()
    assert {(r["lane"], r["measure"], r["n"]) for r in got} == {("verde", "estimated_eur", 2), ("verde", "processing_time_ms", 1)}
    most = plans.p2_lane_percentiles(spark, str(tmp_path)).where("percentile = 0.99 and measure = 'estimated_eur'").collect()
    assert all(r["value_low"] <= 99.0 <= r["value_high"] for r in most) and {(r["period"], r["month"] is None) for r in most} == {("all", True), ("month", False)}
