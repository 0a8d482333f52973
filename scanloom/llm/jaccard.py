"""Documents that share nearly all their n-grams, by a token-group matrix (after Li et al. 2021, LES3).

A document's set is that of its distinct 3-word shingles; two documents link if their sets' Jaccard similarity is at least
0.9. Similar sets are partitioned into groups, and the matrix holds each group's tokens: the union of its sets. What a query
has in common with a group's union bounds what it has in common with any set of the group, so that only groups whose bound
reaches the threshold are opened and compared set by set. Components of the links are the result; no link between different
sets is lost, and none is drawn between two sets that a chain of links joins already.

Equal sets are one node from the start. The matrix is kept as rows (token, group), first for the tokens that decide whether a
group can qualify at all: with tokens in one order for all, two sets of sizes a and b that link share SHARED tokens of their
first a - ceil(0.9 a) + SHARED and first b - ceil(0.9 b) + SHARED. The order puts rare tokens first: by a count of tokens that
stand out in a task, then by how rare their words are; it changes the cost only, any order gives the same links.

Steps: each node meets, for each of its first tokens, the node that has most company there, as an original has among its
copies; nodes of similar size that share SHARED tokens with it are compared. Classes of linked nodes are cut by their MinHash into
groups of about GROUP sets, nodes without a link are grouped by their MinHash alone: similar ones together. A join on the token gives queries and groups of other classes, of each pair of classes
the smaller one as query, so that the members of one large class never query each other. Qualifying groups are opened in cells
of bounded size: a cell holds unions of MinHash-ordered parts of a group, bounds each query against them with whole sets,
and opens those parts that still qualify.

Data flow: three passes over the texts with arrays in Arrow batches. The first gives digests and counts, the second the first
tokens, about a tenth of a set, the last whole sets, of nodes that are to be compared only (found by a bitmap of digests of fixed
size, 8 MB, then exactly). Counts are broadcast as tables of fixed size (5 MB). Everything else is a join or an aggregation;
tables in the shared folder cut the lineage.

Cases: a null text is empty; a text without words has an empty set and links with nothing, not even its like; one or two words
are one shingle; very long texts are whole sets; equal rows are one node; rows with equal ids are rows of their own, a
component is named by its smallest id (null if it has none); an empty table gives an empty result; other columns aren't
read, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.llm.collocations import bitmap, hit, long
from scanloom.llm.common import materialise, text_of
from scanloom.llm.components import components
from scanloom.llm.runs import BLANKS
from scanloom.llm.tokens import Words, mix, not_of, steps, words

K = 3
PERCENT = 90
#: First tokens that two sets which link have in common at least.
SHARED = 4
#: Sets of a class that a group holds, if no MinHash is shared by more. (Cells bound what a task holds.)
GROUP = 64
#: Sets that a union of a cell is made of.
PART = 32
#: Numbers of an incidence matrix of queries.
OPENED = 1 << 22
#: A cell holds at most about so many sets, and bytes, on either side.
CELL_ROWS = 512
CELL_BYTES = 4 << 20
#: Buckets of the counts of tokens and of words.
TOKEN_BITS = 22
WORD_BITS = 20
_ODD = np.random.default_rng(13).integers(0, 1 << 63, 8, dtype=np.uint64) | np.uint64(1)


def shingles(w: Words, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first word, bounds): the k-word shingles of each text, in text order, repeats included."""
    n = np.diff(w.bounds)
    place = w.place
    left = np.repeat(n, n) - place
    h = np.zeros(len(place), np.uint64)
    for j in range(k):
        at = w.hashes[j:]
        h[: len(at)] += np.where(left[: len(at)] > j, at, np.uint64(0)) * _ODD[j]
    count = np.where(n > 0, np.maximum(n - k + 1, 1), 0)
    h = mix(h + np.minimum(np.repeat(n, n), k).astype(np.uint64))  # fewer words are no shingle of as many
    is_first = place < np.repeat(count, n)
    return h[is_first], np.flatnonzero(is_first), np.concatenate(([0], np.cumsum(count)))


def digest_of(tokens: np.ndarray) -> bytes:
    return hashlib.md5(tokens.tobytes()).digest()


def tokenised(texts: pa.Array) -> Words:
    return words(texts, not_of(BLANKS))


def overlap_needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Least number of common tokens of sets of sizes a and b that link: t / (a + b - t) >= percent / 100."""
    return -(-percent * (a + b) // (100 + percent))


def bucket(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def digested(docs: DataFrame) -> DataFrame:
    """docs: (id, text). Rows (id, n, digest), and rows (kind, bucket, count): of words (kind 1) and of tokens (kind 2) in buckets that
    stand out in their task."""
    kind = docs.schema["id"].dataType.simpleString()
    arrow = ["id", "n", "digest", "kind", "bucket", "count"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_count, token_count = np.zeros(1 << WORD_BITS, np.int64), np.zeros(1 << TOKEN_BITS, np.int64)
        id_type = None
        for batch in batches:
            id_type = batch.column("id").type
            for at, texts in steps(batch.column("text")):
                w = tokenised(texts)
                h, _, bounds = shingles(w)
                sets = [np.unique(h[i:j]) for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                np.add.at(word_count, bucket(w.hashes, WORD_BITS), 1)
                if len(h):
                    np.add.at(token_count, bucket(np.concatenate(sets), TOKEN_BITS), 1)
                n = len(texts)
                columns = [batch.column("id").slice(at, n), pa.array([len(s) for s in sets], pa.int64()), pa.array([digest_of(s) for s in sets], pa.binary())]
                yield pa.record_batch([*columns, pa.array(np.zeros(n, np.int32)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names=arrow)
        usual = token_count.mean()
        for k, count, least in ((1, word_count, 3), (2, token_count, usual + 4 * math.sqrt(usual) + 1)):
            at = np.flatnonzero(count >= least)
            if len(at):
                empty = [pa.nulls(len(at), t) for t in (id_type, pa.int64(), pa.binary())]
                yield pa.record_batch([*empty, pa.array(np.full(len(at), k, np.int32)), pa.array(at), pa.array(count[at])], names=arrow)

    return docs.mapInArrow(run, f"id {kind}, n long, digest binary, kind int, bucket long, count long")


def heats(counted: DataFrame, kind: int, bits: int) -> np.ndarray:
    """Of each bucket, four times the binary logarithm of its count; 0 where none was told. As many rows as buckets at most."""
    level = F.round(4 * F.log2(F.sum("count") + 1)).cast("long").alias("level")
    found = counted.filter(F.col("kind") == kind).groupBy("bucket").agg(level).toArrow()
    out = np.zeros(1 << bits, np.uint8)
    out[found["bucket"].to_numpy()] = np.minimum(found["level"].to_numpy(), 255)
    return out


def least_shared(percent: int) -> int:
    """First tokens in common of any two different sets that link: SHARED, or all of the smallest set that has a different partner."""
    return min(SHARED, -(-percent // (100 - percent)))


def first_tokens(docs: DataFrame, heat, percent: int) -> DataFrame:
    """(digest, n, low, first): low is a MinHash of two hashes, first the set's first tokens in the order of `heat` (a broadcast of
    the heats of words and of tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_heat, token_heat = heat.value
        for batch in batches:
            for _, texts in steps(batch.column("text")):
                w = tokenised(texts)
                h, at, bounds = shingles(w)
                warm = np.append(word_heat[bucket(w.hashes, WORD_BITS)].astype(np.uint64), np.zeros(K, np.uint64))
                rare = warm[at] + warm[at + 1] + warm[at + 2]
                order = (token_heat[bucket(h, TOKEN_BITS)].astype(np.uint64) << np.uint64(56)) | (rare << np.uint64(44)) | (h >> np.uint64(20))
                other = mix(h, 9)
                rows: dict[bytes, tuple] = {}
                for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    tokens, which = np.unique(h[i:j], return_index=True)
                    n = len(tokens)
                    if n * 100 < percent * (n + 1):  # all other sets are too different
                        continue
                    size = n - int(overlap_needed(n, math.ceil(percent * n / 100), percent)) + SHARED
                    by = order[i:j][which]
                    first = tokens[np.lexsort((tokens, by))[:size]] if size < n else tokens
                    low = int(mix(tokens[:1] * _ODD[4] + other[i:j].min(), 1)[0])
                    rows.setdefault(digest_of(tokens), (n, low - (1 << 64) if low >> 63 else low, first.view(np.int64)))
                values = list(rows.values())
                offsets = pa.array(np.concatenate(([0], np.cumsum([len(v[2]) for v in values]))), pa.int32())
                flat = pa.array(np.concatenate([v[2] for v in values])) if values else pa.array([], pa.int64())
                columns = [pa.array(list(rows), pa.binary()), *[pa.array([v[k] for v in values], pa.int64()) for k in range(2)]]
                yield pa.record_batch([*columns, pa.ListArray.from_arrays(offsets, flat)], names=["digest", "n", "low", "first"])

    return docs.select("text").mapInArrow(run, "digest binary, n long, low long, first array<long>")


def keys_of(digests: list[bytes]) -> np.ndarray:
    return np.array([int.from_bytes(d[:8], "little") for d in digests], np.uint64)


def digest_bits(digests: DataFrame) -> np.ndarray:
    """A bitmap of (digest), by their first eight bytes."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([long(keys_of(batch.column("digest").to_pylist()))], names=["key"])

    return bitmap(digests.mapInArrow(keyed, "key long"))


def whole_sets(docs: DataFrame, bits) -> DataFrame:
    """(digest, tokens) of the sets whose digests are in a broadcast bitmap, each once and dealt by digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in steps(batch.column("text")):
                h, _, bounds = shingles(tokenised(texts))
                sets = {}
                for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    tokens = np.unique(h[i:j])
                    sets.setdefault(digest_of(tokens), tokens)
                keep = hit(bits.value, keys_of(list(sets)))
                found = [(d, t.tobytes()) for (d, t), k in zip(sets.items(), keep) if k]
                yield pa.record_batch([pa.array([x[k] for x in found], pa.binary()) for k in range(2)], names=["digest", "tokens"])

    out = docs.select("text").mapInArrow(run, "digest binary, tokens binary")
    return out.groupBy("digest").agg(F.any_value("tokens").alias("tokens"))


def found_in(tokens: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the sorted array `of`, whether it is there) of each token."""
    at = np.searchsorted(of, tokens)
    at[at == len(of)] = 0
    return at, of[at] == tokens


def in_common(place: np.ndarray, there: np.ndarray, row: np.ndarray, rows: int, part: list[np.ndarray], union: np.ndarray) -> np.ndarray:
    """(rows, len(part)): tokens that each query (its rows of place, there) has in common with each set of a part, as a product of two
    incidence matrices over the union."""
    asked, held = np.zeros((rows, len(union)), np.float32), np.zeros((len(part), len(union)), np.float32)
    asked[row[there], place[there]] = 1
    for j, tokens in enumerate(part):
        held[j, np.searchsorted(union, tokens)] = 1
    return (asked @ held.T).astype(np.int64)


def opened(table: pa.Table, percent: int) -> tuple[list[int], list[int]]:
    """Rows i and j of a cell's table whose links merge classes. table: (group, query, low, root, tokens); each group's queries
    against its other rows."""
    group, query, low = (table[c].to_numpy() for c in ("group", "query", "low"))
    root = np.unique(table["root"].to_numpy(), return_inverse=True)[1]
    sets = [np.frombuffer(x, np.uint64) for x in table["tokens"].to_pylist()]
    n = np.array([len(s) for s in sets], np.int64)
    of = list(range(int(root.max()) + 1)) if len(root) else []

    def find(x: int) -> int:
        while of[x] != x:
            of[x] = of[of[x]]
            x = of[x]
        return x

    out: tuple[list[int], list[int]] = ([], [])
    order = np.lexsort((low, query, group))
    starts = np.flatnonzero(np.append(True, group[order][1:] != group[order][:-1])) if len(order) else []
    for lo, hi in zip(starts, [*starts[1:], len(order)]):
        rows = order[lo:hi]
        targets, asking = rows[~query[rows]], rows[query[rows]]
        if not len(targets) or not len(asking):
            continue
        tokens, bounds = np.concatenate([sets[q] for q in asking]), np.concatenate(([0], np.cumsum(n[asking])))
        for at in range(0, len(targets), PART):
            part = targets[at : at + PART]
            union = np.unique(np.concatenate([sets[t] for t in part])) if len(part) > 1 else sets[part[0]]
            place, there = found_in(tokens, union)
            least = np.maximum(n[part].min(), -(-percent * n[asking] // 100))
            bound = np.add.reduceat(there.astype(np.int64), bounds[:-1])
            ok = np.flatnonzero((bound >= overlap_needed(n[asking], least, percent)) & (n[part].max() >= least))
            for lo in range(0, len(ok), max(1, OPENED // len(union))):
                some = ok[lo : lo + max(1, OPENED // len(union))]
                own = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in some])
                row = np.repeat(np.arange(len(some)), n[asking[some]])
                common = in_common(place[own], there[own], row, len(some), [sets[t] for t in part], union)
                both = n[asking[some]][:, None] + n[part] - common
                for i, j in zip(*np.nonzero(100 * common >= percent * both)):
                    q, t = int(asking[some[i]]), int(part[j])
                    x, y = find(root[q]), find(root[t])
                    if x != y:
                        of[max(x, y)] = min(x, y)
                        out[0].append(q)
                        out[1].append(t)
    return out


def open_groups(asked: DataFrame, members: DataFrame, nodes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """(a, b): roots whose classes links merge. asked: (group, node), queries; members: (group, node), the sets of groups; nodes:
    (node, digest, n, low, root)."""
    told = asked.select("group").distinct()
    rows = asked.withColumn("query", F.lit(True)).unionByName(members.join(told, "group", "left_semi").withColumn("query", F.lit(False)))
    rows = materialise(rows.join(nodes, "node"), "jaccard-asked")
    bits = docs.sparkSession.sparkContext.broadcast(digest_bits(rows.select("digest").distinct()))
    wholes = whole_sets(docs, bits)
    size = F.col("n") * 8 + 200
    parts = lambda query: F.greatest(
        F.ceil(F.count_if(F.col("query") == query) / CELL_ROWS),
        F.ceil(F.coalesce(F.sum(F.when(F.col("query") == query, size)), F.lit(0)) / CELL_BYTES),
    ).cast("int")
    sizes = rows.groupBy("group").agg(parts(False).alias("nt"), parts(True).alias("nq"))
    held = rows.join(sizes, "group")
    mine = F.pmod(F.xxhash64("node"), F.when(F.col("query"), F.col("nq")).otherwise(F.col("nt")))
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("query"), F.col("nt")).otherwise(F.col("nq")) - 1))
    held = held.withColumn("mine", mine).withColumn("other", other)
    x, y = F.when(F.col("query"), F.col("other")).otherwise(F.col("mine")), F.when(F.col("query"), F.col("mine")).otherwise(F.col("other"))
    # groups of one cell share it with others, about as many as fill it
    shared = F.pmod(F.xxhash64("group"), F.lit(max(1, rows.count() // CELL_ROWS)))
    cell = F.when((F.col("nt") == 1) & (F.col("nq") == 1), shared).otherwise(F.xxhash64("group", x, y))
    cells = held.select(cell.alias("cell"), F.col("group"), "query", "low", "root", "digest").join(wholes, "digest").drop("digest")

    def meet(table: pa.Table) -> pa.Table:
        i, j = opened(table, percent)
        return pa.table({c: table["root"].take(pa.array(at, pa.int64())) for c, at in (("a", i), ("b", j))})

    out = materialise(cells.groupBy("cell").applyInArrow(meet, "a long, b long").distinct(), "jaccard-merges")
    bits.destroy()
    return out


def held_tokens(nodes: DataFrame) -> DataFrame:
    """(token, node, n, holders) of first tokens that several nodes hold. nodes: (node, n, first). Tokens of one node, most of them,
    are taken off by a bitmap before their rows are dealt."""
    sizes = nodes.select(F.explode("first").alias("token")).groupBy("token").agg(F.count("*").alias("holders")).filter("holders > 1")
    sizes = materialise(sizes, "jaccard-tokens")
    bits = nodes.sparkSession.sparkContext.broadcast(bitmap(sizes.select(F.col("token").alias("key"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = batch.column("first")
            tokens = first.flatten().to_numpy()
            of = np.repeat(np.arange(batch.num_rows), np.diff(first.offsets.to_numpy()))
            keep = hit(bits.value, tokens.view(np.uint64))
            at = pa.array(of[keep])
            yield pa.record_batch([pa.array(tokens[keep]), batch.column("node").take(at), batch.column("n").take(at)], names=["token", "node", "n"])

    rows = nodes.select("node", "n", "first").mapInArrow(run, "token long, node long, n long")
    out = materialise(rows.join(sizes, "token"), "jaccard-held")
    bits.destroy()
    return out


def share_enough(rows: DataFrame, percent: int, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("shared")).filter(F.col("shared") >= least_shared(percent)).drop("shared")


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """Per row: id, n_shingles, component_id (smallest id of its component)."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    told = materialise(digested(docs), "jaccard-digests")
    rows = told.filter("kind = 0").select("id", "n", "digest")
    heat = spark.sparkContext.broadcast((heats(told, 1, WORD_BITS), heats(told, 2, TOKEN_BITS)))
    nodes = first_tokens(docs, heat, percent).groupBy("digest").agg(*[F.any_value(c).alias(c) for c in ("n", "low", "first")])
    nodes = materialise(nodes.withColumn("node", F.monotonically_increasing_id()), "jaccard-nodes")
    heat.destroy()

    held = held_tokens(nodes)
    company = held.groupBy("node").agg(F.sum("holders").alias("company"))
    known = held.join(company, "node")
    middles = known.groupBy("token").agg(F.max(F.struct("company", "node", "n")).alias("m")).select("token", F.col("m.node").alias("middle"), F.col("m.n").alias("size"))
    pairs = held.join(middles, "token").filter("node <> middle").filter(f"100 * least(n, size) >= {percent} * greatest(n, size)")
    asked = materialise(share_enough(pairs, percent, "middle", "node").withColumnRenamed("middle", "group"), "jaccard-stars")
    members = asked.select("group", F.col("group").alias("node")).distinct()
    bare = nodes.select("node", "digest", "n", "low").withColumn("root", F.col("node"))
    roots = materialise(components(open_groups(asked, members, bare, docs, percent)), "jaccard-roots")

    rooted = held.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = materialise(roots.groupBy("root").agg(F.count("*").alias("of")), "jaccard-sizes")
    rooted = rooted.join(sizes, "root", "left").withColumn("class", F.struct(F.coalesce("of", F.lit(1)).alias("of"), "root"))
    ends = rooted.groupBy("token").agg(F.min("class").alias("least"), F.max("class").alias("most")).filter("least <> most")
    left = materialise(rooted.join(ends, "token").join(nodes.select("node", "low"), "node"), "jaccard-left")
    # the smaller class asks, so those of a token's largest class never do, and those of its smallest are never asked; classes of one
    # node are in groups by their MinHash
    cut: Column = F.pmod("low", F.ceil(F.col("class.of") / GROUP))
    group = F.when(F.col("class.of") > 1, F.xxhash64("root", cut)).otherwise(F.xxhash64("low"))
    grouped = left.withColumn("group", group)
    ends = [F.max("class").alias("class"), F.min("n").alias("least_n"), F.max("n").alias("most_n")]
    targets = grouped.filter("class <> least").groupBy("token", "group").agg(*ends)
    queries = left.filter("class <> most").select("token", "node", "n", F.col("class").alias("own"))
    found = queries.join(targets, "token").filter(f"own < class AND 100 * n >= {percent} * least_n AND 100 * most_n >= {percent} * n")
    asked = materialise(share_enough(found, percent, "group", "node"), "jaccard-groups")
    members = grouped.select("group", "node").distinct()
    now = nodes.select("node", "digest", "n", "low").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    merges = components(open_groups(asked, members, now, docs, percent)).select(F.col("node").alias("root"), F.col("root").alias("above"))

    of = now.join(merges, "root", "left").select("digest", F.coalesce("above", "root").alias("root"))
    lows = rows.filter("n > 0").groupBy("digest").agg(F.min("id").alias("low")).join(of, "digest", "left")
    key = F.when(F.col("root").isNull(), F.hex("digest")).otherwise(F.col("root").cast("string"))
    lows = lows.select("digest", "low", key.alias("key"))
    named = materialise(lows.groupBy("key").agg(F.min("low").alias("component_id")), "jaccard-named")
    of = materialise(lows.join(named, "key").select("digest", "component_id"), "jaccard-components")
    alone = rows.filter("n = 0").select("id", "n", F.col("id").alias("component_id"))
    linked = rows.filter("n > 0").join(of, "digest").select("id", "n", "component_id")
    return linked.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


#: All pairs of documents that share a shingle, then the smallest id that links reach.
ORACLE = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM w WHERE len(ws) > 0)
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), link AS MATERIALIZED (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)
), both_ways AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (
  SELECT a AS doc_id, a AS seen FROM both_ways UNION SELECT both_ways.b, seen FROM reach JOIN both_ways ON both_ways.a = reach.doc_id
), low AS (SELECT doc_id, min(seen) AS low FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(low, w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id)
"""
