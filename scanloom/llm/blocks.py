"""From blocks of sequences that share a key to links, without a row for each pair of a block.

Sequences are texts as word codes or lines as characters; two are alike if their edit distance is at most what `most`
gives for their lengths. First all of a block are compared with one of them, its middle. Only links between different
classes matter for the classes, so what follows looks at pairs of a block that no chain of links joins yet, and at all
of these: they meet in cells of bounded size, where an exact bound (items in common) rules pairs out and the rest is
aligned at once, likeliest first. A cell returns links that merge classes, at most one for each of its sequences.

A block that is too large for a cell becomes several, so that each two parts meet once. One of very many cells is first
split by rare items: two sequences that are alike have an item in common among the rarest of each (a prefix that is as
long as what they may differ in, and one more), whatever the order of rarity, while those that share a frequent passage
only don't. Both ways find the same links; the choice is one of cost."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.llm.common import materialise
from scanloom.llm.components import components
from scanloom.llm.editdistance import distance_within

#: A cell holds at most about twice as many sequences and bytes.
CELL_ROWS = 2048
CELL_BYTES = 4 << 20
#: Larger blocks are split by rare items first; below, cells are cheaper.
SPLIT_ROWS = 1 << 16
#: Block sizes, or digests, (16 bytes each) up to which they are broadcast.
BROADCAST_KEYS = 500_000
#: Buckets of the item counts that rule pairs out, and counts up to which they are compared by bucket.
BUCKETS = 1024
LEVELS = 24

#: Lengths of two sequences (longer, shorter) to the largest distance at which they are alike.
Most = Callable[[np.ndarray, np.ndarray], np.ndarray]


def sized(rows: DataFrame) -> DataFrame:
    """rows: (key, node, owns, ..). With `n`: nodes of the block, for blocks of two and more with an owner.

    Most keys are of one node. The sizes of the others are a table, and as long as these are few they are broadcast, so that
    the rows of the rest needn't be shuffled to be dropped."""
    sizes = rows.groupBy("key").agg(F.count("*").alias("n"), F.max("owns").alias("owned"))
    sizes = materialise(sizes.filter("n > 1 AND owned").select("key", "n"), "block-sizes")
    few = sizes.count() <= BROADCAST_KEYS
    return rows.join(F.broadcast(sizes) if few else sizes, "key")


def with_middle(held: DataFrame) -> DataFrame:
    """held: (key, node, owns, n, ..). With `middle`: of the block's owners the one with the most company in all its
    blocks, as an original has among its copies."""
    company = held.groupBy("node").agg(F.sum("n").alias("company"))
    middles = held.join(company, "node").groupBy("key").agg(
        F.max(F.struct("owns", "company", "node"))["node"].alias("middle")
    )
    return held.join(middles, "key")


def star_pairs(held: DataFrame) -> DataFrame:
    """(a, b): each node with its block's middle. held: (key, node, middle, ..)."""
    pairs = held.filter(F.col("node") != F.col("middle"))
    return pairs.select(F.least("node", "middle").alias("a"), F.greatest("node", "middle").alias("b")).distinct()


def items_of(codes: bytes) -> np.ndarray:
    return np.frombuffer(codes, np.uint32)


def bag_of(codes: np.ndarray) -> np.ndarray:
    """Counts of a sequence's items by bucket, up to 255."""
    spread = (codes * np.uint32(0x9E3779B1)) >> np.uint32(22)
    return np.minimum(np.bincount(spread, minlength=BUCKETS), 255).astype(np.uint8)


def alike(x: np.ndarray, y: np.ndarray, most: int) -> bool:
    """Whether the edit distance of two sequences is at most `most`; a cheap bound comes first."""
    longer = max(len(x), len(y))
    if longer - min(len(x), len(y)) > most:
        return False
    if most > 2 and longer <= 255 and longer - int(np.minimum(bag_of(x), bag_of(y)).sum()) > most:
        return False
    a, b = x.tolist(), y.tolist()
    narrow = min(most, 48)
    return distance_within(a, b, narrow) >= 0 or (most > narrow and distance_within(a, b, most) >= 0)


def aligned(pairs: DataFrame, items: DataFrame, most: Most) -> DataFrame:
    """Of pairs (a, b), those that are alike. items: (node, codes), nodes unique."""
    side = lambda c, out: items.select(F.col("node").alias(c), F.col("codes").alias(out))
    joined = pairs.join(side("a", "ca"), "a").join(side("b", "cb"), "b").select("a", "b", "ca", "cb")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("ca"), batch.column("cb"))):
                x, y = items_of(x.as_py()), items_of(y.as_py())
                keep[i] = alike(x, y, int(most(max(len(x), len(y)), min(len(x), len(y)))))
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return joined.mapInArrow(check, "a binary, b binary")


def mixed(rooted: DataFrame) -> DataFrame:
    """rooted: (key, root, ..). The rows of blocks whose nodes are in several classes."""
    several = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return rooted.join(several.filter("low <> high").select("key"), "key")


def by_rare_items(left: DataFrame, items: DataFrame, share: float) -> DataFrame:
    """left: (key, part, node, root, ..). The same blocks, each split by the rarest items of its sequences: as many as
    `share` of a sequence, and one more. The n-th time that a sequence has an item counts as another item. What then is of
    one class goes."""
    every = items.join(left.select("node").distinct(), "node", "left_semi").select("node", "codes")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, codes in zip(batch.column("node").to_pylist(), batch.column("codes").to_pylist()):
                codes = np.sort(items_of(codes)).astype(np.int64)
                first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
                nth = np.arange(len(codes)) - np.repeat(first, np.diff(np.append(first, len(codes))))
                columns = [pa.array([node] * len(codes), pa.binary()), pa.array(codes + (nth << 32))]
                yield pa.record_batch(columns, names=["node", "item"])

    item = materialise(every.mapInArrow(spread, "node binary, item long"), "block-items")
    uses = item.groupBy("item").agg(F.count("*").alias("uses"))
    ranked = item.join(uses, "item").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("uses", "item"))).alias("r"))
    first = F.slice("r", 1, F.floor(F.size("r") * F.lit(share) + 1e-9).cast("int") + 1)
    rare = ranked.select("node", F.explode(first).alias("x")).select("node", F.col("x.item").alias("item"))
    split = left.join(rare, "node").withColumn("key", F.xxhash64("key", "item")).drop("item")
    return mixed(materialise(split, "block-split"))


def cells(rows: DataFrame, cell_rows: int, cell_bytes: int) -> DataFrame:
    """rows: (key, band, node, codes, ..). With (cell, side, self): parts of a block and a band, each of which meets itself
    and those of its own and of the next bands once. A block that fits a cell isn't split."""
    size = F.length("codes") + 600
    full = lambda n, b: F.greatest(F.ceil(n / cell_rows), F.ceil(b / cell_bytes)).cast("int")
    sizes = rows.groupBy("key", "band").agg(F.count("*").alias("n"), F.sum(size).alias("b"))
    parts = F.map_from_entries(F.collect_list(F.struct("band", full(F.col("n"), F.col("b")).alias("m"))))
    sizes = sizes.groupBy("key").agg((full(F.sum("n"), F.sum("b")) <= 1).alias("whole"), parts.alias("m"))
    held = rows.join(sizes, "key")

    def m(step: int) -> Column:
        here = F.coalesce(F.try_element_at("m", F.col("band") + step), F.lit(0))
        return F.when(F.col("whole"), F.lit(0 if step else 1)).otherwise(here)

    def each(n: Column, f: Callable[[Column], Column]) -> Column:
        kind = "array<struct<b:bigint,x:int,y:int,step:int,side:int>>"
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), f)).otherwise(F.array().cast(kind))

    def cell(b: Column, x: Column, y: Column, step: int, side: Column) -> Column:
        ints = {"x": x, "y": y, "step": F.lit(step), "side": side}
        return F.struct(b.cast("long").alias("b"), *[c.cast("int").alias(name) for name, c in ints.items()])

    band = F.when(F.col("whole"), F.lit(0).cast("long")).otherwise(F.col("band"))
    held = held.withColumn("h", F.pmod(F.xxhash64("node"), m(0).cast("long")).cast("int"))
    h = F.col("h")
    own = each(m(0), lambda i: cell(band, F.least(h, i), F.greatest(h, i), 0, h > i))
    above = each(m(1), lambda i: cell(band, h, i, 1, F.lit(0)))
    below = each(m(-1), lambda i: cell(band - 1, i, h, 1, F.lit(1)))
    out = held.withColumn("c", F.explode(F.concat(own, above, below)))
    return out.withColumns(
        {
            "cell": F.xxhash64("key", "c.b", "c.x", "c.y", "c.step"),
            "side": F.col("c.side"),
            "self": (F.col("c.step") == 0) & (F.col("c.x") == F.col("c.y")),
        }
    ).drop("c", "h", "m", "whole")


def in_common(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """(len(x), len(y)): at least as much as the items that two bags (of nx and ny items) have in common."""
    out = np.zeros((len(x), len(y)), np.float32)
    for t in range(1, LEVELS + 1):
        p, q = x >= t, y >= t
        some = np.flatnonzero(p.any(axis=0) & q.any(axis=0))
        if not len(some):
            break
        out += p[:, some].astype(np.float32) @ q[:, some].astype(np.float32).T
    beyond = lambda bag, n: n - np.minimum(bag, LEVELS).sum(axis=1, dtype=np.int64)
    out += np.minimum.outer(beyond(x, nx), beyond(y, ny))
    return np.minimum(out, np.minimum.outer(nx, ny))


def merges_within(table: pa.Table, most: Most) -> tuple[list[int], list[int]]:
    """Rows i and j of a cell's table whose links merge its classes: of all pairs of different classes with an owner among
    them that agree in no part before this one, likeliest first."""
    side, own = table["side"].to_numpy(), table["owns"].to_numpy()
    root = np.unique(np.array(table["root"].to_pylist(), object), return_inverse=True)[1]
    middle = np.array([a == b for a, b in zip(table["node"].to_pylist(), table["middle"].to_pylist())])
    same = table["self"][0].as_py()
    codes = [items_of(x) for x in table["codes"].to_pylist()]
    n = np.array([len(x) for x in codes])
    at = np.flatnonzero(side == 0)
    to = at if same else np.flatnonzero(side == 1)
    longer, shorter = np.maximum.outer(n[at], n[to]), np.minimum.outer(n[at], n[to])
    room = most(longer, shorter)
    ok = (root[at][:, None] != root[to]) & (own[at][:, None] | own[to]) & (longer - shorter <= room)
    ok &= ~(middle[at][:, None] | middle[to])  # those have been compared
    if same:
        ok = np.triu(ok)
    if not ok.any():
        return [], []
    bags = np.stack([bag_of(x) for x in codes])
    shared = in_common(bags[at], bags[to], n[at], n[to])
    ok &= longer - shared <= room + 0.5
    i, j = np.nonzero(ok)
    order = np.argsort(-shared[i, j] / longer[i, j], kind="stable")
    i, j, room = at[i[order]], to[j[order]], room[i[order], j[order]]
    if table["sketch"][0].is_valid:
        sketch = np.array(table["sketch"].to_pylist(), np.int64)[:, : table["part"][0].as_py()]
        fresh = np.array([not (sketch[a] == sketch[b]).any() for a, b in zip(i, j)], bool)
        i, j, room = i[fresh], j[fresh], room[fresh]
    of = list(range(int(root.max()) + 1))

    def find(x: int) -> int:
        while of[x] != x:
            of[x] = of[of[x]]
            x = of[x]
        return x

    found: tuple[list[int], list[int]] = ([], [])
    for a, b, r in zip(i.tolist(), j.tolist(), room.tolist()):
        x, y = find(root[a]), find(root[b])
        if x != y and alike(codes[a], codes[b], int(r)):
            of[max(x, y)] = min(x, y)
            found[0].append(a)
            found[1].append(b)
    return found


def classes(
    held: DataFrame,
    items: DataFrame,
    links: DataFrame,
    most: Most,
    share: float | None = None,
    cell_rows: int = CELL_ROWS,
    cell_bytes: int = CELL_BYTES,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """(node, root): the classes that `links` and all links within blocks give, for every node that has a link.

    held: (key, part, node, owns, n, middle). items: (node, codes, band, sketch); alike sequences are in the same or the next
    band, and sketch[part] tells blocks apart (null: a pair is looked at in each block). links: (a, b), those of the middles
    among them. share: what alike sequences differ in at most, as a share of either; null where that isn't bounded so."""
    roots = materialise(components(links), "block-roots")
    rooted = held.filter("n > 2").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    left = mixed(rooted).select("key", "part", "node", "owns", "root", "middle", "n")
    left = materialise(left, "block-mixed")
    if left.isEmpty():
        return roots
    huge = left.filter(F.col("n") > split_rows)
    if share is not None and not huge.isEmpty():
        left = left.filter(F.col("n") <= split_rows).unionByName(by_rare_items(huge, items, share))
    rows = left.join(items, "node")

    def meet(table: pa.Table) -> pa.Table:
        i, j = merges_within(table, most)
        return pa.table({c: table["root"].take(pa.array(at, pa.int64())) for c, at in (("a", i), ("b", j))})

    more = cells(rows, cell_rows, cell_bytes).groupBy("cell").applyInArrow(meet, "a binary, b binary")
    more = materialise(more.distinct(), "block-merges")
    if more.isEmpty():
        return roots
    above = materialise(components(more).select(F.col("node").alias("root"), F.col("root").alias("above")), "block-above")
    # a class without a link before is one of a single node
    single = above.join(roots.select("root").distinct(), "root", "left_anti").select(F.col("root").alias("node"), "above")
    merged = roots.join(above, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
    return materialise(merged.unionByName(single.withColumnRenamed("above", "root")), "block-classes")
