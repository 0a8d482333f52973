"""Tables of a job's steps go when they have been read; the mix leaves texts where they are."""

import os
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

pytest.importorskip("scanloom.llm")

from scanloom.llm import lines, mixing, omh
from scanloom.llm.common import materialise, scratch, shared_dir
from scanloom.llm.components import components
from scanloom.shared import FREE_SHUFFLES

NEAR = [" ".join(f"w{(i * 7 + k) % 90}" for k in range(60)) for i in range(3)]


@pytest.fixture
def left(spark):
    """Names of the tables that are new in the shared folder."""
    listed = lambda: set(os.listdir(shared_dir(spark)))
    before = listed()
    return lambda: {x.rsplit("-", 1)[0] for x in listed() - before}


def test_a_scratch_keeps_results_only(spark, left):
    with pytest.raises(ZeroDivisionError), scratch(spark):
        materialise(spark.range(3), "failed")
        raise ZeroDivisionError
    with scratch(spark) as outer:
        with scratch(spark) as inner:
            own = materialise(spark.range(3), "own")
            passed = inner.result(own, "passed")
        assert left() == {"passed"} and passed.count() == 3
        kept = outer.result(passed, "kept")
    assert left() == {"kept"} and kept.count() == 3


@pytest.mark.parametrize("f, stay", [(lines.drop_repeated_lines, {"line-removed"}), (omh.keep_one_of_each, {"omh-gone"}), (mixing.mixed_documents, {"mix-lengths"})])
def test_steps_leave_what_results_read(spark, left, f, stay):
    rows = [(i, f"{NEAR[i % 3]} x{i}\n{NEAR[0]}", "a") for i in range(12)]
    out = f(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert left() == stay and out.count() > 0


def test_near_duplicates_drop_few_without_moving_texts(spark):
    docs = spark.createDataFrame([(i, NEAR[0] + f" x{i}") for i in range(5)], "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = omh.keep_one_of_each(docs)
        assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
        assert [r["doc_id"] for r in out.collect()] == [0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("ids", [lambda i: i, lambda i: None, lambda i: i % 4])
def test_the_mix_takes_what_was_decided(spark, ids):
    rows = [(ids(i), " ".join(f"v{i % 11 if i % 2 else i}" for _ in range(1 + i % 5)) if i % 9 else None, "abc"[i % 3] if i % 7 else None, i) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, at long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = mixing.mixed_documents(docs, salts=3)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert ids(5) != 5 or "Exchange hashpartitioning" not in plan
        got = out.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    source = {r[3]: r for r in rows}
    size = lambda t: len((t or "").split())
    assert out.columns == [*docs.columns, "copies"] and len({r["at"] for r in got}) == len(got)
    assert all(tuple(r)[:4] == source[r["at"]] for r in got)
    want = Counter((r["doc_id"], r["source"], r["size"], r["copies"]) for r in mixing.mix_to_weights(docs, salts=3).collect() if r["copies"])
    assert Counter((r["doc_id"], r["source"], size(r["text"]), r["copies"]) for r in got) == want


def test_tables_leave_no_shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    shuffled = lambda: {f for top in folders for _, _, files in os.walk(top) for f in files if f.startswith("shuffle_")}
    was, before = spark.conf.get(FREE_SHUFFLES), shuffled()
    many = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    with scratch(spark):
        assert materialise(many, "counted").count() == 7
        until = time.time() + 20  # executors remove files on their own time
        while {f for f in shuffled() - before if f.endswith(".data")} and time.time() < until:
            time.sleep(0.1)
        # the count of the table has one file of its own
        assert len([f for f in shuffled() - before if f.endswith(".data")]) <= 1
    assert spark.conf.get(FREE_SHUFFLES) == was


@pytest.mark.parametrize("chunk, broadcast_nodes", [(1 << 18, 500_000), (1, 500_000), (3, 0)])
def test_components_of_paths_and_hubs(spark, left, chunk, broadcast_nodes):
    links = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(30)] + [(130 + i, 200 - i) for i in range(20)] + [(7, 7), (300, 299), (299, 300)]
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 131)} | {299: 299, 300: 299}
    want |= {i: 100 if i in (130, 200) else min(i, 330 - i) for i in [*range(130, 150), *range(181, 201)]}
    frame = spark.createDataFrame(links * 2, "a long, b long").repartition(3)
    with scratch(spark):
        got = components(frame, chunk, broadcast_nodes).collect()
        assert dict(got) == want and len(got) == len(want)


def test_links_of_one_task_take_no_round(spark):
    before = set(os.listdir(shared_dir(spark)))
    with scratch(spark):
        got = components(spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long").coalesce(1)).collect()
        made = sorted(x.rsplit("-", 1)[0] for x in set(os.listdir(shared_dir(spark))) - before)
    assert {r["root"] for r in got} == {0} and made == ["component-lows", "components"]
