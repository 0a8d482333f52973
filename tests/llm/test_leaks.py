"""Benchmark items in documents against brute-force BM25 over all passages, for items of all lengths and any sharding."""

import math
import random
from collections import Counter

import numpy as np

from scanloom.llm import decontaminate as leaks
from tests.llm.test_pipeline import plain_words
from tests.oracle import SF


def brute(docs, items, width=128, threshold=0.6, overlap=0.6):
    """{(doc, item)}: every passage scored with every part, no index and no bounds."""
    parts = []
    for key, text in items.items():
        w = plain_words(text)
        n = -(-len(w) // leaks.PART)
        parts += [(key, w[i * len(w) // n : (i + 1) * len(w) // n]) for i in range(n)] if len(w) >= 4 else []
    mean = sum(len(p) for _, p in parts) / len(parts)
    df = Counter(t for _, p in parts for t in set(p))
    idf = lambda t: math.log(1 + (len(parts) - df[t] + 0.5) / (df[t] + 0.5))

    def impacts(p):
        raw = {t: idf(t) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(p) / mean)) for t, f in Counter(p).items()}
        return {t: x / sum(raw.values()) for t, x in raw.items()}

    scored = [(key, impacts(p)) for key, p in parts]
    runs = lambda w, k: {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    out = set()
    for d, text in docs.items():
        w = plain_words(text)
        for at in range(0, max(len(w), 1), width // 2):
            seen = set(w[at : at + width])
            for key, impact in scored:
                if (d, key) in out or sum(x for t, x in impact.items() if t in seen) < threshold:
                    continue
                whole = plain_words(items[key])
                q, a = (plain_words(x) for x in leaks.split_item(items[key].lower()))
                reach = max(len(whole), width // 2)
                near = w[max(0, at - reach) : at + width + reach]
                if len(whole) < 8:
                    q, a = whole, []
                ok = True
                for x in (q, a):
                    k = len(x) if len(whole) < 8 else min(3, len(x))
                    ok &= not x or len(runs(x, k) & runs(near, k)) >= overlap * len(runs(x, k))
                if ok:
                    out.add((d, key))
    return out


def found(spark, docs, items, **options):
    d = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    i = spark.createDataFrame(list(items.items()), "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): r["score"] for r in leaks.find_leaks(d, i, **options).collect()}


def test_items_of_all_lengths_equal_brute_force(spark):
    rng = random.Random(2)
    vocab = [f"t{i}" for i in range(500)]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    sizes = [4, 5, 7, 8, 12, 30, 60, 120, 256, 306, 406, 1000]
    items = {i: f"{say(n - n // 4)}? {say(n // 4)}" for i, n in enumerate(sizes)}
    items |= {100 + i: f"{say(30)}? {say(5)}" for i in range(60)} | {200: items[5], 201: "", 202: "yes"}
    docs = {i: f"{say(rng.randrange(1, 300))} {text.upper()} {say(rng.randrange(1, 300))}" for i, text in items.items()}
    for i in range(40):  # part of an item, an item with changed words, an item in other order
        w = items[i % 12].split()
        docs[1000 + i] = f"{say(50)} {' '.join(w[: rng.randrange(1, len(w) + 1)])} {say(50)}"
        docs[2000 + i] = f"{say(70)} {' '.join(x if rng.random() < 0.85 else 'other' for x in w)} {say(10)}"
        docs[3000 + i] = f"{say(40)} {' '.join(rng.sample(w, len(w)))} yes"
    docs |= {5000: "", 5001: "what is two plus two? four", 5002: None}
    items |= {300: "what is two plus two? four"}
    want = brute(docs, items)
    got = found(spark, docs, items)
    assert got.keys() == want
    assert all((i, i) in want for i in range(12)) and (5001, 300) in want and (5, 200) in want and (202, 202) not in want
    sharded = found(spark, docs, items, shard_items=10)
    assert sharded.keys() == want and all(abs(sharded[k] - got[k]) < 1e-9 for k in want)
    assert found(spark, {}, items) == {} == found(spark, docs, {})


def test_given_tables_equal_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    docs = {k: v for k, v in docs.items() if len(v or "") < 5000}
    assert found(spark, docs, items).keys() == brute(docs, items)


def test_skipping_loses_nothing():
    rng = np.random.default_rng(5)
    n, terms = 90, 60
    item, number = np.repeat(np.arange(n), 6), np.zeros(n * 6, np.int64)
    term = np.concatenate([rng.choice(terms, 6, replace=False) for _ in range(n)]).astype(np.uint64)
    impact = rng.dirichlet(np.ones(6), n).ravel()
    index = leaks.make_index(np.arange(n), [np.zeros(8, np.uint64)] * n, np.zeros(n, np.int64), item, number, term, impact)
    for _ in range(200):
        mine = np.sort(rng.choice(len(index.terms), rng.integers(1, 30), replace=False))
        score = np.bincount(item, impact * np.isin(term, index.terms[mine]), n)
        got = {int(index.item_of_part[p]): s for p, s in leaks.wand(index, mine, 0.5)}
        assert got.keys() == set(np.flatnonzero(score >= 0.5 - 1e-9).tolist())
        assert all(abs(s - score[i]) < 1e-9 for i, s in got.items())


def test_question_and_answer():
    assert leaks.split_item("a? b") == ("a?", " b") and leaks.split_item("abc") == ("abc", "")
    assert not len(leaks._runs(np.zeros(2, np.uint64), 3))
