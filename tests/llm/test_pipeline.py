"""Every stage against a plain version on its own input."""

import re
import unicodedata
from collections import Counter

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from scanloom.llm.editdistance import distance_within
from tests.oracle import SF


def plain_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())


def plain_quality(t):
    """Whether all rules let a text pass."""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = {g for g, n in Counter(grams).items() if n > 1}
    covered = {i + k for i, g in enumerate(grams) if g in often for k in range(3)}
    chars, lines = sum(map(len, w)), t.split("\n")
    worded = [x for x in lines if re.search(r"[^\x20\x09-\x0D]", x)]
    letters = sum(unicodedata.category(c)[0] == "L" for c in t)
    return not (
        len(w) < 50 or 100 * len(covered) > 50 * len(w) or 2 * sum(c in "#*$%&|<>" for c in t) > len(w)
        or not 2 * len(w) <= chars <= 25 * len(w) or 2 * (len(worded) - len(set(worded))) > len(lines) or 2 * letters < chars
    )


def plain_lines(docs):
    """Texts without repeated lines: classes of lines within one edit (two from 200 characters on), brute force within lengths."""
    lines = {x for t in docs.values() for x in t.split("\n") if x.strip(" \t\n\r\f\v") and len(x) >= 16}
    root = {x: x for x in lines}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    half = {}
    for x in lines:  # two lines one edit apart share their first or last third
        for key in {x[: len(x) // 3 - 1], x[-(len(x) // 3 - 1) :]} if len(x) < 200 else {x[:40], x[-40:], x[80:100]}:
            half.setdefault(key, []).append(x)
    for group in half.values():
        for i, x in enumerate(group):
            for y in group[:i]:
                if abs(len(x) - len(y)) <= 2 and find(x) != find(y) and distance_within(x, y, 2 if min(len(x), len(y)) >= 200 else 1) >= 0:
                    root[find(x)] = find(y)
    total, long, first = Counter(), Counter(), {}
    for i in sorted(docs):
        for pos, x in enumerate(docs[i].split("\n")):
            if x in root:
                c = find(x)
                total[c] += 1
                long[c] = max(long[c], len(re.findall(r"[^\x20\x09-\x0D]+", x)))
                first.setdefault(c, (i, pos))
    gone = lambda i, pos, x: x in root and total[c := find(x)] > (1 if long[c] > 50 else 6) and first[c] != (i, pos)
    return {i: "\n".join(x for pos, x in enumerate(t.split("\n")) if not gone(i, pos, x)) for i, t in docs.items()}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        out = stage(spark, docs, SF)
        rows = out.collect()
        after = {r["doc_id"]: r for r in rows}
        assert len(after) == len(rows)
        seen.append(name)
        if name != "mixing":
            assert out.columns == columns
        if name == "quality rules":
            assert after == {i: r for i, r in before.items() if plain_quality(r["text"] or "")} != before
        elif name == "line dedup":
            assert {i: r["text"] for i, r in after.items()} == plain_lines({i: r["text"] for i, r in before.items()})
            assert any(after[i]["text"] != before[i]["text"] for i in before)
        elif name == "near duplicates":
            words = {i: plain_words(r["text"]) for i, r in before.items()}
            alike = lambda i, j: distance_within(words[i], words[j], int(0.2 * max(len(words[i]), len(words[j])) + 1e-9)) >= 0
            links = [(i, j) for i in before for j in before if i < j and alike(i, j)]
            missed = sum(i in after and j in after for i, j in links)
            assert links and missed <= 0.1 * len(links)
            assert all(any(i in p and min(p) < i for p in links) or any(i in p for p in links) for i in before.keys() - after.keys())
        elif name == "decontamination":
            items = [" ".join(plain_words(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            gone = {i for i, r in before.items() if any(x in " ".join(plain_words(r["text"])) for x in items)}
            assert gone and after.keys() == before.keys() - gone
        else:
            size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for i, r in before.items()}
            assert out.columns == [*columns, "copies"] and all(tuple(r)[:-1] == tuple(before[r["doc_id"]]) and 1 <= r["copies"] <= 2 for r in rows)
            assert abs(sum(r["copies"] * size[r["doc_id"]] for r in rows) - 1.5 * sum(size.values())) < 0.02 * sum(size.values())
        docs = out
    assert seen == ["quality rules", "line dedup", "near duplicates", "decontamination", "mixing"]


def test_odd_rows_run_through(spark, tmp_path):
    rows = [(i, t, "en", s, n) for i, t, s, n in [(1, None, None, None), (2, "", "a", 0), (None, "w " * 60, None, 1), (3, "word%d " * 9 % tuple(range(9)) * 9, "a", 2), (3, "x" * 50_000, "a", 3)]]
    rows += [(10 + i, " ".join("qrstuv"[i] + "abcdefghij"[k % 10] + "klmnopqr"[k // 10] for k in range(80)), "en", None if i % 2 else "b", 4) for i in range(6)] * 2
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in out.collect()} <= {r[0] for r in rows} and out.count() > 0
    empty = tmp_path / "none"
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{tmp_path}/{name}.parquet").limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(empty)).collect() == []
