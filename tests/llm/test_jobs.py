"""Each operator as a Spark job on small tables: brute force, and nulls, empty texts, ties, repeated rows, empty tables and
columns with clashing names."""

import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from scanloom.llm import decontaminate, licenses, lines, mixing, omh, quality, secrets, toxicity, urls, warc
from scanloom.llm.common import fresh_path, materialise
from scanloom.llm.components import components
from scanloom.llm.editdistance import distance_within

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n long, key string, _id long, digest string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing column names."""
    texts = [None, "", " \n\t\n", "one", "same words here in this text " * 4, "same words here in this text " * 4, "ümlaut Wörter\nund Zeilen\nund Zeilen", "x" * 30_000, "line of some length to count\n" * 40]
    rows = [(i, t, None if i % 2 else "en", None if i == 3 else f"s{i % 3}", i, 7, "k", i, "d") for i, t in enumerate(texts)]
    rows += [rows[4], (None, "no id", "en", "s1", 1, 7, "k", 1, "d"), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_odd_tables(spark, odd, none):
    n = odd.count()
    bench = spark.createDataFrame([(1, "same words here in this text same words here"), (2, None), (3, "")], "item_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(6)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    each = {
        "quality": quality.quality_report,
        "mixing": mixing.mix_to_weights,
        "licenses": licenses.scan_licenses,
        "omh": omh.near_duplicates,
        "lines": lines.line_report,
        "toxicity": lambda d: toxicity.score_toxicity(d, labels),
        "keep_lines": lines.drop_repeated_lines,
    }
    for name, f in each.items():
        assert len(f(odd).collect()) == n, name
        assert f(none).collect() == [], name
    for f in (quality.keep_quality, omh.keep_one_of_each, lambda d: decontaminate.drop_contaminated(d, bench), secrets.scan_corpus):
        assert len(f(odd).collect()) <= n and f(none).collect() == []
    assert decontaminate.find_leaks(odd, bench.limit(0)).collect() == []
    assert {r["doc_id"] for r in decontaminate.find_leaks(odd, bench).collect()} == {4, 5}


def test_kept_rows_keep_their_columns(odd):
    for f in (quality.keep_quality, lines.drop_repeated_lines, omh.keep_one_of_each):
        assert f(odd).columns == odd.columns


def test_near_duplicates_in_a_large_group(spark):
    rng = random.Random(7)
    base = [f"w{rng.randrange(900)}" for _ in range(120)]
    passage = [f"p{i}" for i in range(40)]
    docs = [" ".join(base)] * 5
    for _ in range(60):  # near copies of one text
        t = base[:]
        for _ in range(3):
            t[rng.randrange(120)] = f"n{rng.randrange(900)}"
        docs.append(" ".join(t))
    docs += [" ".join(passage + [f"u{k}x{i}" for i in range(60)]) for k in range(40)]  # unlike texts that share a passage
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in omh.near_duplicates(df).collect()}
    assert all(got[i] == 0 for i in range(65)) and all(got[i] == i for i in range(65, 105))
    assert omh.keep_one_of_each(df).count() == 41


@pytest.mark.parametrize("edits, split_rows", [(1, 10**6), (1, 4), (2, 10**6)])
def test_line_links_equal_brute_force(spark, edits, split_rows):
    rng = random.Random(3)
    base = "".join(rng.choice("abcdefghij klmno") for _ in range(40))
    pool = {base} | {base[:i] + "X" + base[i + 1 :] for i in range(0, 40, 2)} | {base[:i] + base[i + 1 :] for i in range(0, 40, 3)} | {base[:i] + "é" + base[i:] for i in range(0, 40, 3)}
    for _ in range(40):
        r = "".join(rng.choice("ab ") for _ in range(rng.randrange(14, 20)))
        pool |= {r, r[:5] + "c" + r[6:], r[:-2]}
    pool = sorted(x for x in pool if len(x) >= 16)
    docs = spark.createDataFrame([(i, x + "\nshort") for i, x in enumerate(pool)], "doc_id long, text string")
    distinct = materialise(lines.distinct_lines(lines.occurrences(docs, "doc_id", "text")).filter("n >= 16"), "t")
    got = {tuple(sorted((bytes(r["a"]), bytes(r["b"])))) for r in lines.line_links(distinct, edits, split_rows).collect()}
    digest = {x: hashlib.md5(x.encode()).digest() for x in pool}
    want = {tuple(sorted((digest[a], digest[b]))) for a, b in itertools.combinations(pool, 2) if distance_within(a, b, edits) >= 0}

    def classes(links):
        root = {d: d for d in digest.values()}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in links:
            root[max(find(a), find(b))] = min(find(a), find(b))
        return {x: find(x) for x in root}

    assert classes(got) == classes(want)
    found = {bytes(r["node"]): bytes(r["root"]) for r in components(spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in got], "a binary, b binary")).collect()}
    assert found == {x: r for x, r in classes(want).items() if x in found}


def test_only_the_first_of_many_lines_stays(spark):
    often, twice = "a line that stands everywhere", "a line that stands in two documents"
    own = [f"{c * 9} is what this document says" for c in "abcdefghij"]
    rows = [(i, f"{often if i % 2 else often + '.'}\n{own[i]}\nhi") for i in range(10)] + [(10, twice), (11, twice), (12, "hi\nhi\nhi")]
    got = {r["doc_id"]: r["text"] for r in lines.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == rows[0][1] and all(got[i] == f"{own[i]}\nhi" for i in range(1, 10))
    assert got[10] == got[11] == twice and got[12] == "hi\nhi\nhi"


def test_warc_round_trip_and_pushdown(spark):
    same = "ü" * 600
    pages = spark.createDataFrame([(1, "http://a/", same), (2, "http://b/", same), (3, None, None), (4, "x", "small"), (5, "y\nz", "small"), (9, "http://c/", same), (None, "q", same), (7, "r", "")], "page_id long, url string, html string")
    got = {(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in warc.archived_pages(pages).collect()}
    sha = lambda t: hashlib.sha1(t.encode()).hexdigest()
    want = {(1, "revisit", 9, 1200, sha(same)), (2, "revisit", 9, 1200, sha(same)), (9, "response", None, 1200, sha(same)), (None, "response", None, 1200, sha(same))}
    want |= {(3, "response", None, 0, sha("")), (7, "response", None, 0, sha("")), (4, "response", None, 5, sha("small")), (5, "response", None, 5, sha("small"))}
    assert got == want
    path = fresh_path(spark, "w")
    warc.archive_pages(pages, path)
    back = warc.read_warc(spark, path)
    assert {bytes(r["payload"]).decode() for r in back.filter("record_type = 'response'").collect()} == {same, "small", ""}
    assert back.filter("record_type = 'revisit'").count() == 2 and warc.read_warc(spark, path, recordTypes="revisit", payload="false").count() == 2
    both = back.filter("record_type = 'revisit'").union(back.filter("target_uri = 'q'"))
    assert both.count() == 3 and back.count() == 8  # one frame, several queries
    one = lambda **o: [r["record_id"] for r in warc.read_warc(spark, path, **o).collect()]
    assert one(headers='{"x-payload-bytes": ["5"]}', uriPrefix="y") == ["<urn:page:5>"]
    pushed = warc.read_warc(spark, path, pushdown="true").filter("target_uri = 'http://a/' AND record_type = 'revisit'")
    assert [r["record_id"] for r in pushed.collect()] == ["<urn:page:1>"]
    assert [r["record_id"] for r in back.filter("target_uri = 'http://a/'").collect()] == ["<urn:page:1>"]
    assert warc.archived_pages(pages.limit(0)).collect() == []


def test_plain_archives_and_cut_off_records(spark, tmp_path):
    record = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 4\r\nX-Long: a\r\n b\r\n\r\nbody\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(record * 3)
    df = warc.read_warc(spark, str(tmp_path))
    assert [bytes(r["payload"]) for r in df.collect()] == [b"body"] * 3 and df.first()["headers"]["x-long"] == "a b"
    assert warc.read_warc(spark, str(tmp_path), payload="false").count() == 3
    (tmp_path / "b.warc").write_bytes(record + record[:-6])
    assert warc.read_warc(spark, str(tmp_path), mode="PERMISSIVE").count() == 4
    with pytest.raises(Exception, match="payload"):
        warc.read_warc(spark, str(tmp_path)).collect()


def test_distrust_runs_against_links_and_trust_along(spark):
    page = lambda *to: "".join(f'<a href="http://{h}/x">' for h in to)
    rows = [(1, "http://bad.net/a", page()), (2, "http://friend.example.com/a", page("bad.net", "bad.net")), (3, "http://ok.org/fr/a", page("fine.com")), (4, "http://fine.com/", page("bad.net")), (5, "HTTP://FRIEND.example.com", None), (6, None, None), (7, "nothing", "x"), (8, "http://x.example.net/en/1?q", ""), (9, "http://x.example.net/de/1#f", "")]
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string"), threshold=0.2).collect()}
    assert got[1] == ("bad.net", "/a", "net/", "block") and got[8][2:] == ("example.net/en/", "allow") and got[9][2:] == ("net/", "block")
    assert got[2][2:] == (None, "block") and got[5] == ("friend.example.com", "", None, "block")
    assert got[4][2:] == (None, "allow") and got[3][2:] == ("org/fr/", "allow")
    assert got[6] == got[7] == ("", "", None, "allow")
    assert urls.judge_urls(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_mix_comes_near_its_targets_and_reruns_agree(spark):
    rng = random.Random(5)
    rows = [(i, " ".join("w" * rng.randrange(1, 30)), rng.choice(["a", "b", "c", "d", None])) for i in range(600)] + [(600 + i, "same length here", "a") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_to_weights(df).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_to_weights(df.repartition(9)).collect()))
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    total = {}
    for r in got:
        total.setdefault(r["source"], [r["target"], 0])[1] += r["taken"]
    assert all(abs(t - n) <= 1 for t, n in total.values()) and len(total) == 5


def test_held_out_rows_do_not_teach(spark):
    docs = spark.createDataFrame([(i, f"text {i} idiot" if i % 2 else f"text {i} kind") for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(400)], "doc_id long, quality int, toxic int")
    turned = spark.createDataFrame([(i, 0, i % 2 if zlib.crc32(str(i).encode()) % 5 else 1 - i % 2) for i in range(400)], "doc_id long, quality int, toxic int")
    a, b = (sorted(map(tuple, toxicity.score_toxicity(docs, x).select("doc_id", "held_out", "score", "predicted").collect())) for x in (labels, turned))
    assert a == b and all(r[1] == (zlib.crc32(str(r[0]).encode()) % 5 == 0) for r in a)
    assert sum(r[3] == r[0] % 2 for r in a) > 395
