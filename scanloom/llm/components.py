"""Connected components of a link table, by alternating large-star and small-star steps (Kiveris et al. 2014).

Each task first joins its own links into stars, as a map-side combine, so that rounds are for what links tasks to each
other. A step looks up each node's smallest neighbour; these are broadcast while they are few, else it is a join whose
hubs the adaptive skew join splits. Nothing is collected, and the state is a table in the shared folder after each round.
Rounds end when every node has one link, to a node that has none itself; their number grows with the logarithm of the
longest path."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanloom.llm.common import materialise

#: Links that a task joins before it passes them on, which bounds its memory.
CHUNK = 1 << 18
#: Nodes (two of 16 bytes a row) up to which smallest neighbours are broadcast.
BROADCAST_NODES = 500_000


def _joined(links: DataFrame, chunk: int) -> DataFrame:
    """(a, b), a > b, with the same components: of each `chunk` links of a task, each node with the smallest node that they lead to."""
    kind = links.schema["a"].dataType.simpleString()

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: dict = {}
        held = 0

        def find(x):
            while of[x] != x:
                of[x] = of[of[x]]
                x = of[x]
            return x

        def told(kind: pa.DataType) -> pa.RecordBatch:
            pairs = [(x, root) for x in of if (root := find(x)) != x]
            return pa.record_batch([pa.array([p[i] for p in pairs], kind) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                x, y = find(of.setdefault(a, a)), find(of.setdefault(b, b))
                of[max(x, y)] = min(x, y)
            held += batch.num_rows
            if held >= chunk:
                yield told(batch.schema.field("a").type)
                of.clear()
                held = 0
        if of:
            yield told(batch.schema.field("a").type)

    return links.mapInArrow(stars, f"a {kind}, b {kind}")


def components(links: DataFrame, chunk: int = CHUNK, broadcast_nodes: int = BROADCAST_NODES) -> DataFrame:
    """links: (a, b). Returns (node, root) for every node with a link, root being the smallest node of its
    component. chunk and broadcast_nodes change the cost only."""
    state = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    state = materialise(_joined(state, chunk), "components")
    while True:
        lows = state.groupBy("a").agg(F.min("b").alias("low"), (F.min("b") != F.max("b")).alias("several"))
        lows = materialise(lows, "component-lows")
        few = F.broadcast if lows.count() <= broadcast_nodes else lambda table: table
        down = lows.select(F.col("a").alias("b"), "low")
        if lows.filter("several").isEmpty() and lows.select(F.col("low").alias("b")).join(few(down), "b", "left_semi").isEmpty():
            return lows.select(F.col("a").alias("node"), F.col("low").alias("root")).unionAll(lows.select("low", "low").distinct())
        # large star: the larger neighbours of b are linked to its smallest
        large = state.join(few(down), "b", "left").select("a", F.coalesce("low", "b").alias("b"))
        # small star: a and its smaller neighbours are linked to the smallest of them
        near = large.join(few(large.groupBy("a").agg(F.min("b").alias("low"))), "a")
        each = F.array(*[F.struct(F.col(c).alias("a"), F.col("low").alias("b")) for c in ("a", "b")])
        state = materialise(near.select(F.explode(each).alias("x")).select("x.a", "x.b").filter("a <> b").distinct(), "components")
