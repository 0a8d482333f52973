import random
import re
from collections import Counter

import pytest

pytest.importorskip("scanloom.llm")

from scanloom.llm.collocations import collocations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def plain(rows, least, longest, top):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        text = (text or "").translate(str.maketrans(UPPER, UPPER.lower()))
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, longest + 1):
                for i in range(len(ws) - k + 1):
                    f[lang, tuple(ws[i : i + k])] += 1
    cands = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    out = []
    for lang in n:
        kept = []
        mine = [(p, a) for (t, p), a in cands.items() if t == lang]
        for p, a in mine:
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            if any(len(q) > len(p) and b >= a and inside(q) for q, b in mine):
                continue
            cut = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            phrase, k = " ".join(p), cut[1]
            kept.append((-cut[0], -a, phrase.encode(), f[lang, p[:k]], f[lang, p[k:]], phrase))
        for rank, x in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, x[5], -x[1], x[3], x[4], n[lang], -x[0]))
    return sorted(out)


def made(seed, n, letters="abcdefghijkl"):
    """Skewed words, some sentences again and again, odd separators."""
    r = random.Random(seed)
    weights = [1 / (i + 1) for i in range(len(letters))]
    saying = ["once upon a time", "Never say É never", "a b"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(r.randint(0, 6)):
            parts.append(r.choice(saying) if r.random() < 0.3 else " ".join(r.choices(letters, weights, k=r.randint(1, 9))))
            parts.append(r.choice([" ", "  ", "\t", ". ", ",", "\n", "!?", " "]))
        rows.append((r.choice(["en", "de", None, "und"]), "".join(parts) if r.random() < 0.98 else None))
    return rows


@pytest.mark.parametrize("seed,least,top", [(1, 3, 5), (4, 20, 3)])
def test_equals_all_phrases_counted(spark, seed, least, top):
    rows = made(seed, 300)
    docs = spark.createDataFrame([(lang, text, 7, "x") for lang, text in rows], "lang string, text string, f int, key string").repartition(3)
    got = sorted(tuple(r) for r in collocations(docs, least=least, top=top).collect())
    assert got == plain(rows, least, 5, top)


def test_only_the_frontier_is_expanded(spark, monkeypatch):
    """Bounds settle a language before its frequent first words are reached, with the same result."""
    from scanloom.llm import collocations as c

    bands = []
    grown = c.grown
    monkeypatch.setattr(c, "grown", lambda *a: (bands.append(1), grown(*a))[1])
    monkeypatch.setattr(c, "WIDER", 2)
    rows = [("en", f"rare{i % 40} pair{i % 40}") for i in range(400)] + [("en", "the of the of and the") for _ in range(3000)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = sorted(tuple(r) for r in c.collocations(docs, least=10, top=20).collect())
    assert got == plain(rows, 10, 5, 20)
    assert len(bands) == 1


def test_empty(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations(docs).count() == 0
    assert collocations(spark.createDataFrame([(None, None), ("en", " \n")], "lang string, text string")).count() == 0
