"""Rows, not ids, decide what goes: several texts under one id, and rows without id."""

import numpy as np
import pytest

pytest.importorskip("scanloom.llm")

from scanloom.llm import decontaminate, lines, omh

LONG = " ".join(f"word{i}" for i in range(60))
OTHER = " ".join(f"item{i}" for i in range(60))


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def texts(df):
    return sorted((r["doc_id"] is None, r["doc_id"], r["text"]) for r in df.collect())


@pytest.mark.parametrize("none", [3, None])
def test_lines(spark, none):
    mine, yours = "only this row says so, at some length", "and only that row says this, at some length"
    rows = [(1, f"{LONG}\n{OTHER}"), (none, f"{LONG}\n{mine}"), (none, f"{yours}\n{OTHER}"), (none, f"{LONG}\n{mine}")]
    got = texts(lines.drop_repeated_lines(docs(spark, rows), max_copies=1))
    assert [x[2] for x in got] == [f"{LONG}\n{OTHER}", *sorted([mine, mine, yours])]
    report = sorted((r["doc_id"] or 0, r["n_removed"]) for r in lines.line_report(docs(spark, rows), max_copies=1).collect())
    assert report == sorted([(1, 0), (none or 0, 1), (none or 0, 1), (none or 0, 1)])


def test_near_duplicates(spark):
    near = LONG.replace("word7 ", "changed ")
    rows = [(1, LONG), (5, near), (5, OTHER), (None, LONG), (None, "quite another text without id " * 3), (None, near)]
    got = texts(omh.keep_one_of_each(docs(spark, rows)))
    assert [x[1:] for x in got] == [(1, LONG), (5, OTHER), (None, "quite another text without id " * 3)]


def test_contaminated(spark):
    item = "what is the name of the long river that runs past the old mill? it is the quiet brook"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(5, f"{OTHER} {item} {OTHER}"), (5, OTHER), (None, f"{item} {LONG}"), (None, LONG)]
    assert [x[1:] for x in texts(decontaminate.drop_contaminated(docs(spark, rows), bench))] == [(5, OTHER), (None, LONG)]


def test_arrays_and_pivot_score_alike(spark, monkeypatch):
    rng = np.random.default_rng(3)
    word = lambda n: " ".join(f"w{int(x)}" for x in rng.zipf(1.3, n) % 400)
    items = [(i, word(int(rng.integers(8, 90)))) for i in range(60)]
    rows = [(i, f"{word(150)} {items[i % 60][1]} {word(80)}") for i in range(80)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    _, (index,) = decontaminate.build_indexes(bench, "item_id", "text", 4, 5000)
    import pyarrow as pa

    held = pa.array([t for _, t in rows])
    arrays = sorted(decontaminate.search(held, index))
    monkeypatch.setattr(decontaminate, "ARRAY_WORK", -1)
    pivot = sorted(decontaminate.search(held, index))
    assert [x[:2] for x in arrays] == [x[:2] for x in pivot] and len(pivot) >= 80
    assert np.allclose([x[2:] for x in arrays], [x[2:] for x in pivot])


def test_links_reach_hosts_with_ports(spark):
    from scanloom.llm import urls

    link = '<a href="http://u@Spam.example:81/x">'
    pages = spark.createDataFrame(
        [(1, "http://spam.example:8080/a", None), (2, "http://bad.net/", link), (3, "http://[::1]:80/", '<a href="http://[::1]/y">')],
        "page_id long, url string, html string"
    )
    assert [tuple(r) for r in urls.host_edges(pages).collect()] == [("bad.net", "spam.example", 1)]
    got = {r["page_id"]: r["host"] for r in urls.judge_urls(pages).collect()}
    assert got == {1: "spam.example:8080", 2: "bad.net", 3: "[::1]:80"}
