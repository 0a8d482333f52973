import random
import re

import pytest

pytest.importorskip("scanloom.llm")

from scanloom.llm import jaccard


def sets_of(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(ws[i : i + 3]) for i in range(max(1, len(ws) - 2))} if ws else set()


def plain(rows, percent):
    sets = [sets_of(t) for _, t in rows]
    of = list(range(len(rows)))

    def find(x):
        while of[x] != x:
            x = of[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                of[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)] = min(low.get(find(i), doc), doc)
    return sorted(((doc, len(sets[i]), low.get(find(i))) for i, (doc, _) in enumerate(rows)), key=repr)


def made(seed, n):
    """Texts at all distances of each other: copies with a few edits, chains of edits, texts around one passage, short ones."""
    r = random.Random(seed)
    word = lambda: r.choice("abcdefghijklmnopqrstuvwxyz") + str(int(r.paretovariate(0.6)) % 500)
    passage = [word() for _ in range(60)]
    texts = [[word() for _ in range(r.choice([1, 2, 3, 9, 12, 40, 150]))] for _ in range(n // 10)] + [[], ["A"], ["a"], ["a", "B"]]
    while len(texts) < n:
        t = list(r.choice(texts))
        kind = r.random()
        if kind < 0.6 and t:
            for _ in range(r.randint(0, 1 + len(t) // 60)):
                t[r.randrange(len(t))] = word()
        elif kind < 0.7:
            t = t + [word() for _ in range(r.randint(1, 3))]
        elif kind < 0.9:
            t = [word() for _ in range(r.randint(0, 3))] + passage + [word() for _ in range(r.randint(0, 3))]
        texts.append(t)
    r.shuffle(texts)
    return [(i if i % 17 else None, " ".join(t).upper() if i % 5 == 0 else "\n ".join(t)) for i, t in enumerate(texts)] + [(3, None)]


@pytest.mark.parametrize("seed,percent,small", [(1, 90, False), (2, 90, True), (3, 60, True)])
def test_equals_all_pairs(spark, monkeypatch, seed, percent, small):
    if small:  # many groups, parts and cells
        for name, v in (("GROUP", 4), ("PART", 3), ("CELL_ROWS", 5), ("CELL_BYTES", 20_000), ("OPENED", 500)):
            monkeypatch.setattr(jaccard, name, v)
    rows = made(seed, 400)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "id long, body string, token int, digest string").repartition(3)
    got = jaccard.similar_documents(docs, "id", "body", percent).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain(rows, percent)


def test_groups_that_cannot_qualify_stay_closed(monkeypatch):
    import numpy as np
    import pyarrow as pa

    token = lambda *x: np.array(x, np.uint64).tobytes()
    rows = [(1, False, 0, 10, token(*range(100))), (1, False, 0, 11, token(*range(1, 101))), (1, True, 0, 12, token(*range(5, 100)))]
    table = pa.table([pa.array(c) for c in zip(*rows)], names=["group", "query", "low", "root", "tokens"])
    assert len(jaccard.opened(table, 90)[0]) == 2
    calls = []
    product = jaccard.in_common
    monkeypatch.setattr(jaccard, "in_common", lambda *a: (calls.append(1), product(*a))[1])
    assert len(jaccard.opened(table, 90)[0]) == 2 and calls
    calls.clear()
    far = [*rows[:2], (1, True, 0, 12, token(*range(50, 160)))]
    table = pa.table([pa.array(c) for c in zip(*far)], names=["group", "query", "low", "root", "tokens"])
    assert jaccard.opened(table, 90) == ([], []) and not calls


def test_empty(spark):
    assert jaccard.similar_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
