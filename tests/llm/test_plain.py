"""Helpers against brute force, without Spark."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scanloom.llm import blocks, licenses, mixing, omh, toxicity
from scanloom.llm.editdistance import distance_within
from scanloom.llm.tokens import steps, words


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[:], i
        for j, y in enumerate(b, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
    return row[-1]


@settings(max_examples=400, deadline=None)
@given(st.text("abc", max_size=16), st.text("abc", max_size=16), st.integers(0, 18))
def test_banded_distance(a, b, most):
    d = edit_distance(a, b)
    assert distance_within(a, b, most) == (d if d <= most else -1)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aAbZ09é漢 .,\n-_"), max_size=40)), max_size=6))
def test_words_on_bytes(texts):
    w = words(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        want = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        lo, hi = w.bounds[i], w.bounds[i + 1]
        assert [bytes(w.data[a:b]).decode() for a, b in zip(w.first[lo:hi], w.end[lo:hi])] == want
    assert sum(len(x) for _, x in steps(pa.array(texts, pa.string()), 8)) == len(texts)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 5), min_size=1, max_size=6), st.integers(0, 120))
def test_budget_is_fitted_as_well_as_can_be(lengths, budget):
    ls, cs = np.array(list(lengths)), np.array(list(lengths.values()))
    take = mixing.fit_budget(ls, cs, budget, window=1000)
    assert (take >= 0).all() and (take <= cs).all()
    got = int((take * ls).sum())
    floor = np.floor(cs * min(1.0, budget / (ls * cs).sum())).astype(int) if budget < (ls * cs).sum() else cs
    reach = {0}
    for n, left in zip(ls.tolist(), (cs - floor).tolist()):
        reach = {r + k * n for r in reach for k in range(left + 1)}
    base = int((floor * ls).sum())
    assert got == max(base + r for r in reach if base + r <= max(budget, base))


def test_targets_stop_at_the_cap():
    t = mixing.water_fill([100, 100, 1000, 0], [5, 2, 1, 5], 1800, 2.0)
    assert t == [200.0, 200.0, 1400.0, 0.0]
    assert mixing.water_fill([], [], 0, 2.0) == []


def test_sketches_agree_for_equal_and_nearly_equal_texts():
    rng = random.Random(4)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    near = base[:]
    near[50] = near[200] = "changed"
    moved = base[150:] + base[:150]
    s = omh.sketches(words(pa.array([" ".join(base), " ".join(base).upper(), " ".join(near), " ".join(f"x{i}" for i in range(300)), "", "one two"])), 20)
    assert (s[0] == s[1]).all() and (s[0] == s[2]).sum() >= 8 and (s[0] == s[3]).sum() == 0 and not s[4].any() and s[5].any()
    codes = lambda t: words(pa.array([" ".join(t)])).hashes.astype(np.uint32)
    assert blocks.alike(codes(base), codes(near), 60) and not blocks.alike(codes(base), codes(moved), 60)


def test_kmers_carry_occurrence_numbers():
    h, bounds = omh.kmers(words(pa.array(["a b c d e a b c d e a b c d e", "a b c d e"])))
    assert bounds.tolist() == [0, 11, 12] and len(set(h[:11].tolist())) == 11 and h[11] == h[0]


def test_templates():
    one = lambda markup: licenses.compile_templates([("t", markup)])
    a = one("grant <<var;max=2>> use<<beginOptional>> and copy<<endOptional>> freely")
    ok = ["grant use freely", "grant x use freely", "grant x y use and copy freely"]
    bad = ["grant x y z use freely", "grant use and freely", "grant use copy freely", "grant use"]
    assert all(a.match(t.split(), 0) == {"t": len(t.split())} for t in ok) and not any(a.match(t.split(), 0) for t in bad)
    y = one("since <<var;match=[0-9]{4};max=2;min=1>> by")
    assert y.match("since 1999 by".split(), 0) and y.match("since 1999 2001 by".split(), 0)
    assert not y.match("since by".split(), 0) and not y.match("since then by".split(), 0)
    for markup in ("a <<endOptional>>", "<<beginOptional>> a", "<<var;max=3>> a", ""):
        with pytest.raises(ValueError):
            one(markup)


def test_whole_licenses_and_changed_wording():
    a = licenses.compile_templates(licenses.TEMPLATES)
    held = dict(licenses.TEMPLATES)
    for label in ("mit-text", "bsd-3-clause", "bsd-2-clause", "zlib", "unlicense"):
        text = re.sub("<<beginOptional>>|<<endOptional>>", "", re.sub("<<var.*?>>", "authors", held[label]))
        found = licenses.scan_text(f"before {text} after", a)
        assert label in found[4].split(",") and found[5] == 1.0
        words = licenses.words_of(text)
        changed = " ".join([*words[:-2], "unlike", words[-1]])
        assert label not in licenses.scan_text(changed, a)[4].split(",")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcd"), min_size=1, max_size=4), min_size=1, max_size=4), st.lists(st.sampled_from("abcde"), max_size=10))
def test_one_automaton_equals_each_alone(templates, words):
    markup = [(str(i), t[0] + "".join(f"<<beginOptional>> {x}<<endOptional>>" if k % 2 else f" <<var;max=1>> {x}" for k, x in enumerate(t[1:]))) for i, t in enumerate(templates)]
    pattern = [re.compile(t[0] + " " + "".join(f"(?:{x} )?" if k % 2 else f"(?:. )?{x} " for k, x in enumerate(t[1:]))) for t in templates]
    for i in range(len(words)):
        got = licenses.compile_templates(markup).match(words, i)
        rest = "".join(w + " " for w in words[i:])
        want = {}
        for k, p in enumerate(pattern):
            ends = [n for n in range(len(words) - i + 1) if p.fullmatch(rest[: 2 * n])]
            if ends:
                want[str(k)] = i + max(ends)
        assert got == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["MIT", "License", "apache", "general", "public", "x", "license."]), max_size=14))
def test_license_places(tokens):
    got = licenses.scan_text(" ".join(tokens), licenses.compile_templates(licenses.TEMPLATES))
    w = [t.lower().strip(".") for t in tokens]
    places = sorted(i for i in range(len(w)) for p, _ in licenses.BASE_PHRASES if w[i : i + len(p.split())] == p.split())
    assert got[0] == len(places) and got[1] == (places[0] if places else None) and got[2] == (places[-1] if places else None)


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    e, chain = np.exp(rng.normal(size=9)), rng.normal(size=(2, 2))
    bounds = np.array([0, 4, 4, 9])
    lanes = toxicity.Lanes(bounds)
    lane = np.empty(9)
    lane[lanes.slot] = e
    fore, back = toxicity.odds(lane, lanes.at, np.exp(chain))
    got = (fore * back)[lanes.slot]
    for lo, hi in ((0, 4), (4, 9)):
        total = np.zeros((hi - lo, 2))
        for y in itertools.product((0, 1), repeat=hi - lo):
            p = np.prod([e[lo + i] if b else 1.0 for i, b in enumerate(y)]) * np.exp(sum(chain[a, b] for a, b in zip(y, y[1:])))
            for i, b in enumerate(y):
                total[i, b] += p
        assert np.allclose(got[lo:hi], total[:, 1] / total[:, 0])


def test_model_learns_spans():
    rng = random.Random(1)
    plain = [f"word{i}" for i in range(200)]
    make = lambda bad: " ".join(rng.choice(["idiot", "morons", "moronic"]) if bad and rng.random() < 0.1 else rng.choice(plain) for _ in range(60))
    texts = [make(i % 3 == 0) for i in range(240)]
    model = toxicity.train(texts, np.array([i % 3 == 0 for i in range(240)]), 0.3)
    w = words(pa.array(["word1 idiot word2 é moronesque word3", "word1 word2", ""]))
    m = model.marginals(w)
    s = model.scores(w, m)
    assert s[0] > 0.5 > s[1] and s[2] < 0.5
    assert toxicity.spans_of(w, m).to_pylist()[0][0] == {"start": 6, "end": 11}
