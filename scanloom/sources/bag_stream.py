"""A growing recording as a stream: messages of sqlite bags in the order in which they were written.

Offsets hold, for each file and topic, the last row read and how many messages of the topic came up to it, so that a restarted
query goes on with the next message and its number. New files and topics join as they appear. A batch is read in ranges of rows."""

from __future__ import annotations

import glob
import os
import sqlite3
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSourceStreamReader, InputPartition

#: Messages that one task reads.
ROWS = 10_000


@dataclass
class Range(InputPartition):
    """Rows after `low` up to `high`, the first of which is the topic's message number `seq`."""

    file: str
    topic_id: int
    topic: str
    kind: str
    low: int
    high: int
    seq: int


class BagStreamReader(DataSourceStreamReader):
    def __init__(self, path: str, topics: set[str] | None, rows: int = ROWS) -> None:
        self.path, self.topics, self.rows = path, topics, rows

    def files(self) -> list[str]:
        return [self.path] if os.path.isfile(self.path) else sorted(glob.glob(os.path.join(self.path, "**", "*.db3"), recursive=True))

    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        out: dict = {}
        for file in self.files():
            with sqlite3.connect(f"file:{file}?mode=ro", uri=True) as db:
                if not db.execute("SELECT count(*) FROM sqlite_master WHERE name IN ('topics', 'messages')").fetchone()[0] == 2:
                    continue  # a recorder that has only just made its file
                known = [i for i, name in db.execute("SELECT id, name FROM topics") if self.topics is None or name in self.topics]
                last = {i: (row, n) for i, row, n in db.execute("SELECT topic_id, max(rowid), count(*) FROM messages GROUP BY topic_id")}
                out[file] = {str(i): list(last[i]) for i in known if i in last}
        return out

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        parts: list[InputPartition] = []
        for file, topics in end.items():
            with sqlite3.connect(f"file:{file}?mode=ro", uri=True) as db:
                names = {str(i): (name, kind) for i, name, kind in db.execute("SELECT id, name, type FROM topics")}
                for topic_id, (high, _) in topics.items():
                    low, seq = start.get(file, {}).get(topic_id, (0, 0))
                    while low < high:
                        sql = "SELECT rowid FROM messages WHERE topic_id = ? AND rowid > ? AND rowid <= ? ORDER BY rowid LIMIT 1 OFFSET ?"
                        cut = db.execute(sql, (int(topic_id), low, high, self.rows - 1)).fetchone()
                        to = cut[0] if cut else high
                        parts.append(Range(file, int(topic_id), *names[topic_id], low, to, seq))
                        low, seq = to, seq + self.rows
        return parts

    def read(self, part: Range) -> Iterator[tuple]:
        with sqlite3.connect(f"file:{part.file}?mode=ro", uri=True) as db:
            sql = "SELECT timestamp, data FROM messages WHERE topic_id = ? AND rowid > ? AND rowid <= ? ORDER BY rowid"
            for i, (ns, data) in enumerate(db.execute(sql, (part.topic_id, part.low, part.high))):
                yield part.file, part.topic, part.kind, ns, part.seq + i, bytearray(data)

    def commit(self, end: dict) -> None:
        """Recordings stay as they are."""
