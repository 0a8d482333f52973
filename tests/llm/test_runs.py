import hashlib
import re
import zlib

import pytest

pytest.importorskip("scanloom.llm")

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from scanloom.llm.queries import QUERIES, with_repeats
from scanloom.llm.runs import BLANKS, collapse, find_runs, runs_of, starts
from scanloom.llm.tokens import not_of, words
from tests.oracle import SF


def plain_runs(ws):
    """Every lag compared with every word."""
    out = []
    n = len(ws)
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            j = i
            while j < n and ws[j] == ws[j - q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q):
                part = ws[i - q : j]
                if not any(part[r:] == part[:-r] for r in range(1, q)):
                    out.append((i - q, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def mine(*texts):
    w = words(pa.array([b" ".join(t) for t in texts], pa.large_binary()), not_of(BLANKS), lower=False)
    spots, lags = starts(w)
    out = []
    for k, t in enumerate(texts):
        proposed = {}
        for i, lag in zip(spots.tolist(), lags.tolist()):
            if w.bounds[k] <= i < w.bounds[k + 1]:
                proposed.setdefault(i - int(w.bounds[k]), []).append(lag)
        out.append(runs_of(list(t), proposed))
    return out


few = st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60)
tiled = st.tuples(few, st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=1, max_size=12), st.integers(2, 9), few).map(
    lambda x: x[0] + x[1] * x[2] + x[3]
)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(few, tiled), min_size=1, max_size=4))
def test_runs_equal_every_lag_compared(texts):
    assert mine(*texts) == [plain_runs(t) for t in texts]


def test_long_and_uniform_texts():
    assert mine([b"x"] * 200_000) == [[(0, 200_000, 1)]]
    period = [str(i).encode() for i in range(5000)]
    assert mine([b"head"] + period * 4 + period[:7] + [b"tail"]) == [[(1, 20_007, 5000)]]
    # frequent words, with ever other words between them
    assert mine([x for i in range(50_000) for x in (b"the", str(i).encode())]) == [[]]


def digest(x):
    return hashlib.sha256(x).hexdigest()


def expected(doc_id, text):
    ws = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(ws), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(ws)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    s, length, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    kept = b" ".join(x for i, x in enumerate(ws) if i not in gone)
    return doc_id, len(runs), s, length, q, 1000 * length // q if runs else None, digest(lines.encode()), digest(kept)


def test_query_equals_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = {d.doc_id for d in docs if len(d.text or "") < 12_000}
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_runs"](spark, SF).collect()}
    assert len(got) == len(docs) and len(short) > 150
    wanted = {d.doc_id: expected(d.doc_id, d.text) for d in docs if d.doc_id in short}
    assert {i: got[i] for i in short} == wanted
    assert sum(r[1] for r in wanted.values()) > 10
    for d in docs:
        if d.doc_id not in short:
            ws = with_repeats(d.doc_id, d.text.encode().split())
            assert got[d.doc_id][6] == digest("".join(f"{a},{b},{c}\n" for a, b, c in mine(ws)[0]).encode())


def test_odd_rows(spark):
    rows = [(None, None, 1), (3, "", 1), (3, "a " * 7, 2), (4, "é é\té\né é é", 3), (5, "a b " * 3, 4)]
    docs = spark.createDataFrame(rows, "id long, body string, runs int")
    got = {(r.id, r.n_words): ([tuple(x) for x in r.runs], r.collapsed) for r in find_runs(docs, "id", "body").collect()}
    assert got == {
        (None, 0): ([], ""), (3, 0): ([], ""), (3, 7): ([(0, 7, 1)], "a"), (4, 6): ([(0, 6, 1)], "é"), (5, 6): ([], "a b a b a b")
    }
    assert find_runs(docs.limit(0), "id", "body").count() == 0
    assert collapse(list("abcabcabcabcx"), [(0, 12, 3)]) == list("abcx")
