"""Repeated lines: long passages go from the second copy on, and every repeated line is reported."""

import random

from scanloom.llm import lines


def test_long_passages_go_from_the_second_copy_on(spark):
    rng = random.Random(2)
    passage = " ".join(f"word{rng.randrange(1000)}" for _ in range(60))
    line = "".join(rng.choice("abcdefghij klmno") for _ in range(300))
    off = line[:50] + "X" + line[51:200] + "Y" + line[201:]
    short = "a line that stands in two documents"
    rows = [(1, f"one\n{passage}"), (2, f"{passage}\ntwo"), (3, short), (4, short), (5, line), (6, off)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in lines.line_report(docs).collect()}
    assert [got[i]["removed"] for i in range(1, 5)] == [[], [0], [], []]
    assert [(x["pos"], x["copies"]) for i in range(1, 5) for x in got[i]["repeated"]] == [(1, 2), (0, 2), (0, 2), (0, 2)]
    assert got[1]["repeated"][0]["class"] == got[2]["repeated"][0]["class"] != got[3]["repeated"][0]["class"]
    # two changed characters in 300
    assert got[5]["n_linked"] == got[6]["n_linked"] == 1 and got[5]["repeated"][0]["copies"] == 2
    kept = {r["doc_id"]: r["text"] for r in lines.drop_repeated_lines(docs).collect()}
    assert kept[1] == rows[0][1] and kept[2] == "two" and kept[3] == kept[4] == short


def test_words_are_counted_where_they_matter(spark):
    words = [f"word{i}" for i in range(60)]
    near = " ".join(["wurd0", *words[1:]])
    alone, short = " ".join(reversed(words)), "two of these lines with few words are no passage"
    rows = [(1, f"{' '.join(words)}\n{short}"), (2, f"{near}\n{short}"), (3, alone), (4, " ".join(["x"] * 70)), (5, " ".join(["x"] * 70))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    distinct = lines.distinct_lines(lines.occurrences(docs, "doc_id", "text"))
    assert {(r["line"][:5], r["copies"]): r["words"] for r in distinct.collect()} == {("word0", 1): 0, ("wurd0", 1): 0, ("two o", 2): 0, ("word5", 1): 0, ("x x x", 2): 70}
    assert "SortAggregate" not in distinct._jdf.queryExecution().executedPlan().toString()
    # passages that are linked, but have no copy, are long all the same
    kept = {r["doc_id"]: r["text"] for r in lines.drop_repeated_lines(docs).collect()}
    assert kept == {1: rows[0][1], 2: short, 3: alone, 4: rows[3][1], 5: ""}
