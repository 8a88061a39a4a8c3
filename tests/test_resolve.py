"""Multi-key blocking finds exactly the links of all pairs in a block; streaming; driver contract."""

import random

import pytest

from rolodar import config as cfg
from rolodar.functions.names import split_name
from rolodar.functions.text import py_text_key
from rolodar.operators import resolve
from rolodar.operators.normalize import normalize
from rolodar.plans.pipeline import unify
from rolodar.streaming import incremental
from tests.test_pipeline import records


def test_blocking_loses_no_link(spark):
    from pyspark.sql import functions as F

    rng = random.Random(5)
    rows = [
        {
            "source": rng.choice(["linkedin", "gmail", "mac_vcf"]),
            "first_name": rng.choice(["Bill", "William", "Bob", "Ann", ""]),
            "last_name": rng.choice(["Doe", "Ray"]),
            "nickname": rng.choice(["", "", "Billy"]),
            "emails": [(f"m{rng.randrange(6)}@x.example", "")] if rng.random() < 0.6 else [],
            "phones": [(f"415555010{rng.randrange(6)}", "", "")] if rng.random() < 0.5 else [],
        }
        for _ in range(40)
    ]
    keyed = resolve.with_keys(normalize(records(spark, rows))).cache()
    for d in (cfg.Dedupe(), cfg.Dedupe(merge_score_threshold=0.5, relaxed_merge_threshold=0.3), cfg.Dedupe(enable_nickname_equivalence=False)):
        got = {(r["a"], r["b"]) for r in resolve.match_edges(keyed, d).collect()}
        side = F.struct(*resolve.EVIDENCE)
        left, right = keyed.select("block_key", side.alias("left")), keyed.select("block_key", side.alias("right"))
        every = resolve.pair_signals(left.join(right, "block_key").where("left.rec_idx < right.rec_idx").drop("block_key"), d)
        want = {(r["a"], r["b"]) for r in every.where(resolve.gate(every, d)).select(F.col("left.rec_idx").alias("a"), F.col("right.rec_idx").alias("b")).collect()}
        assert got == want and want
        parent = {r["rec_idx"]: r["rec_idx"] for r in keyed.select("rec_idx").collect()}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in want:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
        assert {r["rec_idx"]: r["cluster_id"] for r in resolve.clusters(keyed, d).collect()} == {x: find(x) for x in parent}


def test_text_forms():
    assert py_text_key("  Jürgen\tÉmile ") == "jurgen emile" and py_text_key(None) == ""
    assert split_name("Ludwig van Beethoven") == ("Ludwig", "", "van Beethoven") and split_name("Cher") == ("Cher", "", "")


def test_incremental_resolution(spark, tmp_path):
    old = records(spark, [{"source": "gmail", "first_name": "Bill", "last_name": "Doe"}, {"source": "gmail", "first_name": "Ann", "last_name": "Ray"}])
    new = records(spark, [{"source": "gmail", "first_name": "William", "last_name": "Doe"}]).selectExpr("rec_idx + 10 as rec_idx", "* except (rec_idx)")
    src = str(tmp_path / "in")
    old.coalesce(1).write.parquet(src)
    seen = []
    q = incremental.start(
        spark.readStream.schema(old.schema).parquet(src), str(tmp_path / "store"), str(tmp_path / "ck"), lambda r, i: seen.append((i, r.contacts.count()))
    )
    q.processAllAvailable()
    new.coalesce(1).write.mode("append").parquet(src)
    q.processAllAvailable()
    q.stop()
    # The second batch touches one block, whose two records are now one contact.
    assert seen == [(0, 2), (1, 1)]
    # Only the files of the touched block are opened.
    store = spark.read.parquet(str(tmp_path / "store"))
    blocks = store.where("last_name = 'Doe'").select("block_key", "bucket").distinct()
    opened = incremental.touched(store, blocks)
    assert opened.count() == 2 and len(opened.inputFiles()) == 3
    plan = opened._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan.replace("isnotnull(bucket", "bucket")
    q = incremental.start(spark.readStream.schema(old.schema).parquet(src), str(tmp_path / "store2"), str(tmp_path / "ck2"), lambda r, i: None)
    q.processAllAvailable()
    old.coalesce(1).write.mode("append").parquet(src)
    with pytest.raises(Exception, match="more than one batch"):
        q.processAllAvailable()


def test_entry_lists_queries_and_sql():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert unify is not None
