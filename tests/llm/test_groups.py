"""Near duplicates in large groups, against brute force: the pairs that agree in a sample and are similar."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from scanloom.llm import blocks, omh
from scanloom.llm.editdistance import distance_within
from scanloom.llm.tokens import words
from tests.oracle import SF


def changed(rng, text, share):
    at = set(rng.sample(range(len(text)), round(share * len(text))))
    return [f"n{rng.randrange(10**6)}" if i in at else x for i, x in enumerate(text)]


def brute(texts, among=None):
    """Class (smallest place) of each text by pairs that agree in a sample and are similar."""
    s, c = omh.sketches(words(pa.array(texts))), word_codes(texts)
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x] = root[root[x]]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        if (s[i] == s[j]).any() and find(i) != find(j) and blocks.alike(c[i], c[j], int(0.2 * max(len(c[i]), len(c[j])) + 1e-9)):
            root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))]


def classes(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in omh.near_duplicates(df).collect()}
    return [got[i] for i in range(len(texts))]


@pytest.mark.parametrize("n", [20, 100, 1000])
def test_copies_that_are_like_their_original_only(spark, n):
    rng = random.Random(n)
    base = [f"w{rng.randrange(10**6)}" for _ in range(250)]
    texts = [" ".join(base)] + [" ".join(changed(rng, base, rng.uniform(0.12, 0.15))) for _ in range(n)]
    assert classes(spark, texts) == brute(texts)


def word_codes(texts):
    w = words(pa.array(texts))
    return [w.hashes[i:j].astype(np.uint32) for i, j in zip(w.bounds, w.bounds[1:])]


def similar_pairs(texts, least, most=1.01):
    """Pairs of texts by brute force whose edit similarity is in [least, most)."""
    c, out = word_codes(texts), []
    for i, j in itertools.combinations(range(len(texts)), 2):
        longer = max(len(c[i]), len(c[j]))
        if blocks.alike(c[i], c[j], int((1 - least) * longer + 1e-9)):
            d = distance_within(c[i].tolist(), c[j].tolist(), longer)
            if least <= 1 - d / longer < most:
                out.append((i, j))
    return out


@pytest.mark.parametrize("lo, hi", [(0.80, 0.85), (0.85, 0.90), (0.90, 1.0)])
def test_recall_among_texts_that_share_a_passage(spark, lo, hi):
    rng = random.Random(5)
    passage, texts = [f"p{i}" for i in range(175)], []
    for k in range(150):
        x = passage + [f"u{rng.randrange(10**6)}" for _ in range(75)]
        texts += [" ".join(x), " ".join(changed(rng, x, rng.uniform(1 - hi, 1 - lo)))]
    got = classes(spark, texts)
    pairs = similar_pairs(texts, lo)
    found = sum(got[i] == got[j] for i, j in pairs)
    print(f"similarity {lo} to {hi}: {found} of {len(pairs)} pairs in one class")
    assert found >= 0.9 * len(pairs) >= 90
    assert len({got[i] for i in range(0, 300, 2)}) == 150  # what shares the passage only stays apart


def test_classes_equal_brute_force_on_the_given_documents(spark):
    texts = [t for t in {r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect() if r["text"]} if len(t) < 4000]
    texts = sorted(texts)[:400]
    got = classes(spark, texts)
    pairs = similar_pairs(texts, 0.8)
    found = sum(got[i] == got[j] for i, j in pairs)
    print(f"{found} of {len(pairs)} links found")
    assert found >= 0.95 * len(pairs)
    root = {}
    for i, j in pairs:
        root.setdefault(i, set()).add(j)
        root.setdefault(j, set()).add(i)
    for i, c in enumerate(got):  # nothing is in a class without a link
        assert c == i or i in root


@pytest.mark.parametrize("sizes", [{"cell_rows": 4}, {"cell_rows": 8, "split_rows": 8}, {"cell_bytes": 5000}])
def test_sizes_of_cells_change_nothing(spark, sizes):
    rng = random.Random(11)
    base, passage, texts = [f"w{rng.randrange(10**6)}" for _ in range(80)], [f"p{i}" for i in range(60)], []
    for k in range(40):
        texts.append(" ".join(changed(rng, base, rng.uniform(0.05, 0.18))))
        x = passage + [f"u{rng.randrange(10**6)}" for _ in range(30)]
        texts += [" ".join(x), " ".join(changed(rng, x, 0.1))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    small = {r["doc_id"]: r["class_id"] for r in omh.near_duplicates(df, **sizes).collect()}
    assert [small[i] for i in range(len(texts))] == classes(spark, texts) == brute(texts)
