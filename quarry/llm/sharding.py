"""Sharding (operator 6): a hierarchical weighted hash tree.

A document descends from the root over region and rack to a shard. At each
node every child draws ``-ln(u) / weight`` with ``u`` a hash of the document's
key and the child's name, and the smallest draw wins, so a child gets its share
of the weights. A child's draw doesn't depend on its siblings: if one weight
changes, documents move only into or out of the subtrees whose weights change.
A shard that is added as a region of its own therefore takes documents only
into itself, and nothing moves between the old ones (law ``key``).

Positions inside a shard are counted without bringing a shard together: rows
are numbered inside (shard, hash bucket) and the counts of the at most shards x
``SLOT_BUCKETS`` buckets give the offsets.

Defined cases: the key is the identifier; rows without one are placed by the
checksum of their text. A NULL text has size 8 and checksum 0. Repeated rows go
to the same shard and get slots of their own. An empty table gives no rows.
Other columns pass through where they are asked for (``keep``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOT_BUCKETS = 1024
LAW = "key"


@dataclass(frozen=True)
class Node:
    """A node of the tree; leaves carry a shard and its weight."""

    name: str
    children: tuple["Node", ...] = field(default=())
    shard: int = -1
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight

    @property
    def shards(self) -> list[int]:
        return [s for c in self.children for s in c.shards] if self.children else [self.shard]


def even_tree(regions: int = 2, racks: int = 3, shards: int = 4) -> Node:
    """Shards numbered from 0, equal weights."""
    def leaf(r: int, k: int, s: int) -> Node:
        return Node(f"s{s}", shard=(r * racks + k) * shards + s)

    return Node("root", tuple(
        Node(f"r{r}", tuple(Node(f"k{k}", tuple(leaf(r, k, s) for s in range(shards))) for k in range(racks)))
        for r in range(regions)
    ))


def grown(tree: Node, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a region of its own."""
    new = max(tree.shards) + 1
    leaf = Node("s0", shard=new, own_weight=weight)
    return Node(tree.name, (*tree.children, Node(f"r+{new}", (Node("k0", (leaf,)),))))


def _nodes(node: Node, path: str = "") -> list[tuple[str, Node]]:
    return [(path, node), *(x for i, c in enumerate(node.children) for x in _nodes(c, f"{path}/{i}"))]


def _literal_map(pairs: list[tuple[str, object]]) -> Column:
    return F.create_map(*[x for path, value in pairs for x in (F.lit(path), value)])


def _draws(key: Column, path: Column, weights: Column) -> Column:
    """(draw, child) of every child of the node at ``path``; a child's draw only depends on its own path and weight."""
    def draw(weight: Column, i: Column) -> Column:
        u = F.shiftrightunsigned(F.xxhash64(key, F.concat(path, F.lit("/"), i.cast("string"))), 16).cast("double")
        return F.struct((-F.ln((u + 0.5) / float(1 << 48)) / weight).alias("d"), i.alias("i"))

    return F.transform(weights, draw)


def place(df: DataFrame, key: Column, tree: Node, name: str) -> DataFrame:
    """Add ``name``: the shard of each row; one choice among children per level of the tree."""
    before, nodes = df.columns, _nodes(tree)
    weights = _literal_map([(p, F.array(*[F.lit(float(c.weight)) for c in n.children])) for p, n in nodes if n.children])
    shards = _literal_map([(p, F.lit(n.shard)) for p, n in nodes if not n.children])
    df = df.withColumn("__key", key).withColumn("__path", F.lit(""))
    for _ in range(max(p.count("/") for p, _ in nodes)):
        won = F.array_min(_draws(F.col("__key"), F.col("__path"), F.try_element_at(weights, F.col("__path"))))["i"]
        df = df.withColumn("__path", F.concat(F.col("__path"), F.coalesce(F.concat(F.lit("/"), won.cast("string")), F.lit(""))))
    return df.withColumn(name, F.element_at(shards, F.col("__path"))).select(*before, name)


def with_slots(df: DataFrame, shards: int, group: str, order: Sequence[str], spread: Column) -> DataFrame:
    """Add ``slot``: 0, 1, ... inside each value of ``group`` (at most ``shards`` values).

    ``spread`` is a hash in [0, 2**48) that leads the order; ``order`` breaks ties.
    """
    tagged = df.withColumn("__h", spread).withColumn("__b", F.shiftright("__h", 48 - 10).cast("int"))
    counts = tagged.groupBy(group, "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    inside = Window.partitionBy(group, "__b").orderBy("__h", *order)
    numbered = tagged.withColumn("__r", F.row_number().over(inside) - 1)
    # at most shards x SLOT_BUCKETS rows by construction
    return numbered.join(F.broadcast(offsets), [group, "__b"]).withColumn(
        "slot", (F.col("__r") + F.col("__off")).cast("long")
    ).drop("__h", "__b", "__r", "__off")


def shard(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tree: Node | None = None, keep: Sequence[str] = (),
) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every row, before them the columns in
    ``keep`` (but for those that a result column replaces)."""
    tree = tree or even_tree()
    keep = [c for c in keep if c not in ("size", "text_crc32", "law", "shard", "slot", "grown_shard")]
    rows = docs.select(
        *[F.col(c) for c in keep], F.col(id_col).alias("__id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 8).cast("long").alias("__size"),
        F.coalesce(F.crc32(text_col), F.lit(0)).cast("long").alias("__crc"),
    )
    key = F.coalesce(F.col("__id").cast("string"), F.concat(F.lit("text|"), F.col("__crc").cast("string")))
    rows = place(rows, key, tree, "__shard")
    # the grown tree differs by one region: it wins, or the descent is the same as before
    top = grown(tree).children
    draws = _draws(key, F.lit(""), F.array(*[F.lit(float(c.weight)) for c in top]))
    won = F.array_min(draws)["i"] == len(top) - 1
    rows = rows.withColumn("__grown", F.when(won, top[-1].shards[0]).otherwise(F.col("__shard")))
    spread = F.shiftrightunsigned(F.xxhash64(key, "__crc", "__size", F.lit("slot")), 16)
    rows = with_slots(rows, len(tree.shards), "__shard", ["__id", "__crc", "__size"], spread)
    named = {"__size": "size", "__crc": "text_crc32", "__shard": "shard", "slot": "slot", "__grown": "grown_shard"}
    lead = [F.col(c) for c in keep] if id_col in keep else [*map(F.col, keep), F.col("__id").alias(id_col)]
    return rows.select(
        *lead, *[F.col(a).alias(b) for a, b in list(named.items())[:2]], F.lit(LAW).alias("law"),
        *[F.col(a).alias(b) for a, b in list(named.items())[2:]],
    )
