"""Exact deduplication (operator 5): Patricia-trie owners.

Texts are equal when they are identical after white space is deleted. Their
full bytes, led by content hash and length, are inserted into compressed radix
tries; the terminal node of a text stores its owner (the row that stays) and
the number of its rows.

* Each task first inserts its own rows, so a group of copies leaves a task as
  one row however large it is. When a trie holds more than ``TRIE_BYTES``, its
  largest subtrees are sent on and removed; the second step merges the parts.
* The rows are then dealt and sorted by (content hash, length). Only the
  subtree of the current pair is held; it is finished when the next pair comes.

Of equal texts the row with the most code points in its original text stays,
then the smallest identifier. Every row gets its group by the SHA-256 of its
normalised text, the groups themselves come from comparing whole texts.

Defined cases: NULL counts as an empty text, and all empty texts are equal; a
NULL identifier loses against any other; rows that repeat both identifier and
text are kept or dropped alike. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRIE_BYTES = 48 << 20
BATCH_BYTES = 8 << 20
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


def shared_length(a: bytes, b: bytes, start: int) -> int:
    """How many bytes of ``a`` match ``b`` from ``start`` on, by halving."""
    lo, hi = 0, min(len(a), len(b) - start)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[start + lo : start + mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


class Node:
    """An edge's bytes, the children by their first byte, and what a text ending here has."""

    __slots__ = ("label", "children", "owner", "rows")

    def __init__(self, label: bytes):
        self.label, self.children, self.owner, self.rows = label, {}, None, 0


class PatriciaTrie:
    def __init__(self) -> None:
        self.root, self.size = Node(b""), 0

    def insert(self, key: bytes, owner: tuple, rows: int) -> None:
        """Count ``rows`` for ``key`` and keep its smallest owner."""
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = Node(key[at:])
                self.size += len(child.label) + 200
                node, at = child, len(key)
            elif key.startswith(child.label, at):
                node, at = child, at + len(child.label)
            else:
                k = shared_length(child.label, key, at)
                middle = node.children[key[at]] = Node(child.label[:k])
                child.label = child.label[k:]
                middle.children[child.label[0]] = child
                self.size += 200
                node, at = middle, at + k
        node.owner = owner if node.owner is None else min(node.owner, owner)
        node.rows += rows

    def texts(self, node: Node | None = None, before: bytes = b"") -> Iterator[tuple[bytes, tuple, int]]:
        """(key, owner, rows) of every text below ``node``."""
        todo = [(node or self.root, before)]
        while todo:
            node, before = todo.pop()
            key = before + node.label
            if node.owner is not None:
                yield key, node.owner, node.rows
            todo += [(child, key) for child in node.children.values()]

    def spill(self) -> Iterator[tuple[bytes, tuple, int]]:
        """Send on and remove the largest subtrees of the root until half the bytes are left."""
        sizes = {}
        for first, child in self.root.children.items():
            size, todo = 0, [child]
            while todo:
                node = todo.pop()
                size += len(node.label) + 200
                todo += node.children.values()
            sizes[first] = size
        left = self.size // 2
        for first in sorted(sizes, key=lambda f: (-sizes[f], f)):
            if self.size <= left:
                break
            yield from self.texts(self.root.children.pop(first))
            self.size -= sizes[first]


def normalised(column: pa.Array) -> Iterator[tuple[bytes, int]]:
    """(text without white space, code points of the original) of each row."""
    filled = pc.fill_null(column, "")
    points = pc.utf8_length(filled).to_pylist()
    for value, n in zip(filled, points):
        yield value.as_buffer().to_pybytes().translate(None, SPACES), n


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(x) for x in row if isinstance(x, (bytes, str)))
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _owner(points: int, identifier: object) -> tuple:
    return -points, identifier is None, 0 if identifier is None else identifier


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) of every row of ``docs``."""
    kind = docs.schema[id_col].dataType.simpleString()
    probe = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = probe.limit(0).toArrow().schema.field("id").type

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("content", pa.int64()), ("length", pa.int64()), ("body", pa.binary()),
                            ("points", pa.int64()), ("id", id_type), ("copies", pa.int64())])

        def out(found: Iterator[tuple[bytes, tuple, int]]) -> Iterator[tuple]:
            for key, owner, rows in found:
                yield (int.from_bytes(key[:8], "big", signed=True), int.from_bytes(key[8:16], "big"), key[16:],
                       -owner[0], None if owner[1] else owner[2], rows)

        trie = PatriciaTrie()
        for batch in batches:
            for identifier, (body, points) in zip(batch.column(0).to_pylist(), normalised(batch.column(1))):
                lead = xxhash.xxh64(body).digest() + len(body).to_bytes(8, "big")
                trie.insert(lead + body, _owner(points, identifier), 1)
                if trie.size > TRIE_BYTES:
                    yield from _batches(out(trie.spill()), schema)
        yield from _batches(out(trie.texts()), schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("sha", pa.string()), ("keep_points", pa.int64()), ("keep_id", id_type), ("group_size", pa.int64())])

        def out() -> Iterator[tuple]:
            trie, now = PatriciaTrie(), None
            for batch in batches:
                contents, lengths, bodies, points, ids, copies = (batch.column(i) for i in range(6))
                for i in range(batch.num_rows):
                    pair = contents[i].as_py(), lengths[i].as_py()
                    if pair != now:
                        yield from finished(trie)
                        trie, now = PatriciaTrie(), pair
                    trie.insert(bodies[i].as_py(), _owner(points[i].as_py(), ids[i].as_py()), copies[i].as_py())
            yield from finished(trie)

        def finished(trie: PatriciaTrie) -> Iterator[tuple]:
            for body, owner, rows in trie.texts():
                yield hashlib.sha256(body).hexdigest(), -owner[0], None if owner[1] else owner[2], rows

        yield from _batches(out(), schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(hashlib.sha256(body).hexdigest(), points) for body, points in normalised(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([p for _, p in found], pa.int64()), pa.array([s for s, _ in found], pa.string())],
                names=["id", "points", "sha"],
            )

    owners = (
        probe.mapInArrow(local, f"content long, length long, body binary, points long, id {kind}, copies long")
        .repartition("content", "length").sortWithinPartitions("content", "length")
        .mapInArrow(merge, f"sha string, keep_points long, keep_id {kind}, group_size long")
    )
    rows = probe.mapInArrow(digest, f"id {kind}, points long, sha string")
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("keep_points"))
    return rows.join(owners, "sha").select(
        F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), F.col("sha").alias("text_sha256")
    )


ORACLE_SQL = r"""
WITH n AS (SELECT doc_id, length(COALESCE(text, '')) AS points, sha256(regexp_replace(COALESCE(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
g AS (SELECT *, first_value(doc_id) OVER w AS keep_id, first_value(points) OVER w AS keep_points, COUNT(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM n WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT doc_id, keep_id, group_size, (doc_id IS NOT DISTINCT FROM keep_id AND points = keep_points) AS kept, text_sha256 FROM g
"""
