"""The driver's contract: names, schemas and rows of every query on the smallest tables."""

from __future__ import annotations

import re

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings vehicle_metadata vehicle_catalog claim_metrics coco_images coco_annotations coco_categories split_map leakage_audit match_pairs inference_raw eval_items source_weights".split()


def plain(value):
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, float):
        return None if value != value else repr(value)
    if hasattr(value, "isoformat"):
        return value.isoformat()[:19]
    return None if value is None else str(value)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, sf_dir, name):
    got = entry.queries()[name](spark, sf_dir)
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    found = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(got.columns)
    order = sorted(names)
    want = sorted(str([plain(r[names.index(c)]) for c in order]) for r in found.fetchall())
    have = sorted(str([plain(v) for v in r]) for r in got.select(*order).collect())
    assert have == want


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_sql_runs(spark, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    assert df.columns and df.count() > 0


def test_names_of_the_problems():
    numbers = {int(m[1]) for m in (re.match(r"p(\d+)_", n) for n in entry.queries()) if m}
    assert {3, 5} <= numbers
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark, sf_dir):
    assert entry.entry(spark).columns == ["ref_table", "row_id", "field"]
