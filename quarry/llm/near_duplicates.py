"""Near duplicates (operator 8): circulant MinHash, banding, exact verification.

1. Texts become sets of word shingles (64-bit hashes). Rows with the same word
   sequence have the same set; the digest of the sequence is what is compared
   from here on, so a group of exact copies, however large, is one item. Each
   task sends on the bands of a sequence once.
2. Two permutations make all coordinates of a signature. The first one (a
   bijection of 64-bit hashes) scatters the shingles over ``WIDTH`` positions;
   the second one is a table of ``WIDTH`` ranks that coordinate ``k`` reads
   shifted by ``k``. The ranks of one shingle in all coordinates are therefore
   one slice of the table, and a signature is the minimum of slices.
3. ``bands`` keys of ``rows`` coordinates each are grouped. With 24 bands of 4
   rows a pair of similarity 0.8 shares a band but for 3 pairs in a million.
4. Bands are gone through in batches of 4 and all others. In every bucket
   that holds several components the members of different components are
   compared with each other if there are at most ``SMALL`` members, else all
   with the one that has most company in all its buckets (the hub, near the
   middle of its group); those linked to the hub count as its component, and
   the same is done again with the members of large buckets, without the hub.
   After each batch the links are contracted to components.
   Near copies are joined by the first bands, so the others find hardly a
   bucket that is not one component already: a pair inside a component, which
   changes nothing, is not made, and no pair that shares a band and could join
   two components is skipped.
5. Links are confirmed on the full sets. When a round of hubs asks for more than
   half as many comparisons as the one before it, what is left of its buckets is
   dealt out in blocks of members, the largest component apart from the others.
   Each two blocks meet in one cell (not two of the largest component), and a
   cell gives the links of a spanning forest only, so a member has no more links
   than cells, however many members it is similar to. Pairs whose components a
   cell has joined already are not compared, others after an exact bound: bit
   ``i`` of a parity sketch is the parity of the number of shingles that hash to
   ``i``. Every bit in which two sketches differ needs a shingle that only one of
   the sets has, so more differing bits than a similar pair may have such
   shingles rule a link out.
6. Rows that repeat an identifier with another text join the components of
   their texts.

Tables between rounds are Parquet in the shared folder, deleted once the next
round's are written.

Defined cases: a text that is NULL or has no words has no shingles and is
linked with nothing; a text with fewer words than a shingle is one shingle; a
row without an identifier is kept, with a NULL component; rows that repeat an
identifier are one document, linked by any of its texts. Only the identifier
and the text are read, other columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.graph import components
from quarry.llm.scratch import Scratch
from quarry.llm.wordhash import mix, plain_words, runs_of_rows, utf8

WORDS, SIMILARITY, BANDS, ROWS = 5, 80, 24, 4
WIDTH = 1 << 18
SEED = 20240607
SKETCH_LONGS = 32
BATCHES = (4,)  # bands of the first batches; the last one has the others
SMALL = 16  # members of a bucket that are compared with each other at once
BLOCK = 1024  # members of a block
BLOCK_SHINGLES = 1 << 19  # their shingles together
SEEN = 1 << 20  # sequences a task remembers
MEMBERS = 1 << 13  # members of buckets whose links are written to one file


def shingle_sets(column: pa.Array, words: int) -> Iterator[tuple[bytes | None, np.ndarray]]:
    """(digest of the word sequence, sorted distinct shingle hashes) of each text."""
    data, offsets = utf8(column)
    hasher = plain_words()
    for lo, hi in runs_of_rows(offsets, 1 << 20):
        base = offsets[lo]
        start, _, h = hasher.words(data[base : offsets[hi]], offsets[lo : hi + 1] - base)
        first = np.searchsorted(start, offsets[lo : hi + 1] - base)
        joined = np.zeros(max(0, len(h) - words + 1), np.uint64)
        for j in range(words):
            joined = mix(joined * np.uint64(0x9E3779B97F4A7C15) + h[j : j + len(joined)])
        for a, b in zip(first[:-1], first[1:]):
            if a == b:
                yield None, joined[:0]
                continue
            sequence = hashlib.blake2b(h[a:b].tobytes(), digest_size=16).digest()
            if b - a < words:
                yield sequence, np.frombuffer(sequence[:8], np.uint64)
            else:
                yield sequence, np.unique(joined[a : b - words + 1])


class Signer:
    """Signatures of shingle sets under one table of ranks, read at shifting places."""

    def __init__(self, coordinates: int):
        ranks = np.random.Generator(np.random.PCG64(SEED)).permutation(WIDTH).astype(np.uint32)
        around = np.concatenate([ranks, ranks[: coordinates - 1]])
        self.slices = np.lib.stride_tricks.sliding_window_view(around, coordinates)
        self.coordinates = coordinates

    def sign(self, shingles: np.ndarray) -> np.ndarray:
        places = (mix(shingles ^ np.uint64(SEED)) & np.uint64(WIDTH - 1)).astype(np.int64)
        out = np.full(self.coordinates, WIDTH, np.uint32)
        for i in range(0, len(places), 1024):
            np.minimum(out, self.slices[places[i : i + 1024]].min(axis=0), out=out)
        return out


def parity_sketch(shingles: np.ndarray, longs: int = SKETCH_LONGS) -> np.ndarray:
    """``longs`` is a power of two."""
    bits = mix(shingles + np.uint64(SEED)) & np.uint64(64 * longs - 1)
    return np.packbits((np.bincount(bits.astype(np.int64), minlength=64 * longs) & 1).astype(np.uint8)).view(np.int64)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    parts = signatures.reshape(len(signatures), bands, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2])
    for j in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return key.astype(np.int64)


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int, bands: int, rows: int) -> DataFrame:
    """(id, sequence, n, bands): NULL sequence where there are no words; a task gives the
    bands of a sequence with its first identifier only."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer, seen = Signer(bands * rows), set()
        for batch in batches:
            sequences, sizes, signed, first = [], [], [], []
            for identifier, (sequence, shingles) in zip(batch.column(0), shingle_sets(batch.column(1), words)):
                sequences.append(sequence)
                sizes.append(len(shingles))
                first.append(sequence is not None and identifier.is_valid and sequence not in seen)
                if first[-1]:
                    signed.append(signer.sign(shingles))
                    seen.add(sequence)
            if len(seen) > SEEN:
                seen.clear()
            keys = band_keys(np.asarray(signed, np.uint32).reshape(-1, bands * rows), bands, rows)
            ends = np.concatenate([[0], np.cumsum(np.asarray(first, np.int64) * bands)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sequences, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel(), pa.int64()))],
                names=["id", "sequence", "n", "bands"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(sign, f"id {kind}, sequence binary, n long, bands array<bigint>")


def full_sets(docs: DataFrame, id_col: str, text_col: str, words: int, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the rows whose identifier is in ``wanted`` (id)."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):  # the sets are larger than the texts
                part = batch.slice(start, 512)
                nodes, found = zip(*shingle_sets(part.column(1), words))
                ends = np.concatenate([[0], np.cumsum([len(s) for s in found])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).astype(np.int64), pa.int64()))],
                    names=["node", "shingles"],
                )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = rows.join(wanted.hint("shuffle_hash"), "id", "left_semi").mapInArrow(sets, "node binary, shingles array<bigint>")
    return found.where("node IS NOT NULL")


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) with 100 * |intersection| >= similarity * |union|."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * common >= similarity * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def sizes_allow(na: str, nb: str, similarity: int) -> Column:
    return 100 * F.least(na, nb) >= similarity * F.greatest(na, nb)


def alike(a: np.ndarray, b: np.ndarray, similarity: int) -> bool:
    """Whether two sorted sets reach the similarity."""
    if len(a) > len(b):
        a, b = b, a
    common = int(np.count_nonzero(b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a))
    return 100 * common >= similarity * (len(a) + len(b) - common)


def forest(parts: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], similarity: int) -> list[tuple[int, int]]:
    """Links that join ``parts`` as all links between the sides do (between any two if there is one side only)."""
    sizes, parts, links = np.array([len(s) for s in sets]), parts.copy(), []
    longs = SKETCH_LONGS
    while 32 * longs < sizes.max() and longs < 1024:
        longs *= 2
    sketches = np.stack([parity_sketch(s, longs) for s in sets]).view(np.uint64)
    first, second = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
    for at, i in enumerate(first):
        others = second if len(second) else first[at + 1 :]
        others = others[parts[others] != parts[i]]
        n = sizes[others]
        others = others[100 * np.minimum(n, sizes[i]) >= similarity * np.maximum(n, sizes[i])]
        apart = np.bitwise_count(sketches[others] ^ sketches[i]).sum(axis=1, dtype=np.int64)
        near = (100 + similarity) * apart <= (100 - similarity) * (sizes[others] + sizes[i])
        others = others[near][np.argsort(apart[near], kind="stable")]
        while len(others):
            j, others = others[0], others[1:]
            if alike(sets[i], sets[j], similarity):
                links.append((i, j))
                parts[parts == parts[j]] = parts[i]
                others = others[parts[others] != parts[i]]
    return links


def dealt(members: DataFrame) -> DataFrame:
    """(key, x, y, side, node, part) of ``members`` (key, node, n, part): any two members of a
    bucket and of different components meet in a cell (key, x, y), on its two sides unless x = y.

    Blocks of the bucket's largest component have negative numbers, they meet those of the others only.
    """

    def blocks(count: str, shingles: str) -> Column:
        return F.ceil(F.greatest(F.expr(f"({count}) / {BLOCK}"), F.expr(f"({shingles}) / {BLOCK_SHINGLES}"))).cast("int")

    by_part = members.groupBy("key", "part").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("w"))
    by_key = by_part.groupBy("key").agg(F.max(F.struct("c", "w", "part")).alias("top"), F.sum("c").alias("c"), F.sum("w").alias("w"))
    by_key = by_key.where("c > top.c").select(
        "key", F.col("top.part").alias("largest"), blocks("top.c", "top.w").alias("in_largest"), blocks("c - top.c", "w - top.w").alias("in_others"))
    apart = F.col("part") == F.col("largest")
    own = F.pmod(F.xxhash64("node"), F.when(apart, F.col("in_largest")).otherwise(F.col("in_others"))).cast("int")
    rows = members.join(by_key, "key").withColumn("own", own)

    def cells(blocks: str, x: str, y: str, side: str) -> Column:
        return F.expr(f"transform(sequence(0, {blocks} - 1), i -> struct(int({x}) AS x, int({y}) AS y, int({side}) AS side))")

    cell = F.when(apart, cells("in_others", "i", "-1 - own", "1")).otherwise(
        F.concat(cells("in_largest", "own", "-1 - i", "0"), cells("in_others", "least(own, i)", "greatest(own, i)", "own > i")))
    return rows.select("key", "node", "part", F.explode(cell).alias("cell")).select("key", "cell.*", "node", "part")


def forests(cells: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Confirmed links (a, b) that join the components of every cell."""

    def links(cell: pa.Table) -> pa.Table:
        nodes, sides = cell.column("node").combine_chunks(), cell.column("side").to_numpy()
        parts = cell.column("part").combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
        shingles = pa.concat_arrays(cell.column("shingles").chunks)
        values, ends = shingles.values.to_numpy().view(np.uint64), shingles.offsets.to_numpy()
        found = forest(parts, sides, [values[a:b] for a, b in zip(ends[:-1], ends[1:])], similarity)
        return pa.table({k: nodes.take(pa.array([pair[at] for pair in found], pa.int64())) for at, k in enumerate("ab")})

    rows = cells.join(sets.join(cells.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"]), "node")
    return rows.groupBy("key", "x", "y").applyInArrow(links, "a binary, b binary").distinct()


def batches_of(bands: int) -> list[tuple[int, int]]:
    """(first band, number of bands) of every batch."""
    out, at = [], 0
    for size in (*BATCHES, bands):
        size = min(size, bands - at)
        if size:
            out.append((at, size))
        at += size
    return out


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
    similarity: int = SIMILARITY, bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row of ``docs``.

    ``similarity`` is in hundredths. Rows of one component are linked directly
    or through others; ``kept`` marks the row that is its component's smallest
    identifier.
    """
    scratch = Scratch(docs.sparkSession, "near")
    signed = scratch.keep(signatures(docs, id_col, text_col, words, bands, rows))
    held = signed.where("sequence IS NOT NULL AND id IS NOT NULL").select("id", "sequence")
    smallest = held.groupBy("sequence").agg(F.min("id").alias("id"))
    items = signed.where("size(bands) > 0").select(F.col("sequence").alias("node"), "n", "bands")
    # only buckets with company matter
    keys = items.select("node", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count(F.lit(1)).alias("m")).where("lo < hi").select("key", "m")
    company = scratch.keep(keys.join(shared, "key").distinct().groupBy("node").agg(F.sum("m").alias("company")))
    items = scratch.keep(items.join(company, "node").dropDuplicates(["node"]))
    wanted = company.join(smallest, company["node"] == smallest["sequence"]).select("id").distinct()
    sets = scratch.keep(full_sets(docs, id_col, text_col, words, wanted))
    parts = None  # (node, component) of every node that is not its component; none until nodes are linked

    def with_parts(rows: DataFrame, node: str = "node", part: str = "part") -> DataFrame:
        if parts is None:
            return rows.withColumn(part, F.col(node))
        known = parts.select(F.col("node").alias(node), F.col("component").alias("__component"))
        return rows.join(known, node, "left").withColumn(part, F.coalesce("__component", node)).drop("__component")

    def contract(links: DataFrame) -> None:
        """Join the components of linked nodes; only the components that change are gone through."""
        nonlocal parts
        between = with_parts(with_parts(links, "a", "pa"), "b", "pb").where("pa <> pb")
        fresh = scratch.keep(between.select(F.greatest("pa", "pb").alias("a"), F.least("pa", "pb").alias("b")).distinct())
        if not fresh.isEmpty():
            moved = scratch.keep(components(fresh))
            if parts is None:
                parts = moved
            else:
                into = moved.select(F.col("node").alias("component"), F.col("component").alias("to"))
                before, parts = parts, scratch.keep(
                    parts.join(into, "component", "left").select("node", F.coalesce("to", "component").alias("component")).union(moved))
                scratch.release(before, moved)
        scratch.release(fresh)

    for first, size in batches_of(bands):
        members = with_parts(items).select(
            F.explode(F.slice("bands", first + 1, size)).alias("key"), "node", "n", "company", "part")
        stored, before, linked = None, None, []
        while True:
            mixed = (
                members.groupBy("key").agg(
                    F.max(F.struct("company", "node", "part", "n")).alias("h"), F.min("part").alias("least"), F.max("part").alias("last"),
                    F.count(F.lit(1)).alias("m"))
                .where("least <> last")
                .select("key", "m", F.col("h.node").alias("b"), F.col("h.part").alias("part_b"), F.col("h.n").alias("nb"))
            )
            near = scratch.keep(members.join(mixed, "key"))
            scratch.release(stored)
            large, other = F.col("m") > SMALL, F.col("part") != F.col("part_b")
            found, asked = near.agg(F.count(F.lit(1)), F.count_if(large & other)).first()
            if not found:
                scratch.release(near)
                break
            few = near.where(~large)
            fewer = few.select("key", F.col("node").alias("b"), F.col("part").alias("part_b"), F.col("n").alias("nb"))
            pairs = few.select("key", F.col("node").alias("a"), "part", "n").join(fewer, "key").where(
                (F.col("a") > F.col("b")) & other & sizes_allow("n", "nb", similarity)).select("a", "b")
            with_hub = near.where(large & other & sizes_allow("n", "nb", similarity)).select(F.col("node").alias("a"), "b")
            # as many tasks as the sets need give few links, and each file costs a writer and, on a local disk, forked processes
            links = confirmed(pairs.union(with_hub).distinct(), sets, similarity).distinct()
            links = scratch.keep(links.repartition(1 + found // MEMBERS))
            linked.append(links)
            if not asked:
                scratch.release(near)
                break
            # those that are left in large buckets, without the hub; what is linked to it is of its component
            hits = links.select(F.col("a").alias("node"), "b", F.lit(True).alias("hit"))
            stored = members = scratch.keep(
                near.where(large & (F.col("node") != F.col("b"))).join(hits, ["node", "b"], "left")
                .select("key", "node", "n", "company", F.when(F.col("hit"), F.col("part_b")).otherwise(F.col("part")).alias("part"))
            )
            scratch.release(near)
            if before is not None and asked > before / 2:
                cells = scratch.keep(dealt(members))
                linked.append(scratch.keep(forests(cells, sets, similarity)))
                scratch.release(cells)
                scratch.release(stored)
                break
            before = asked
        if linked:
            contract(reduce(DataFrame.union, linked))
            scratch.release(*linked)
    # the texts of one identifier belong together
    several = held.groupBy("id").agg(F.min("sequence").alias("b"), F.max("sequence").alias("last")).where("b < last")
    contract(held.join(several, "id").where("sequence <> b").select(F.col("sequence").alias("a"), "b").distinct())
    own = with_parts(smallest.withColumnRenamed("sequence", "node"))
    least = own.groupBy("part").agg(F.min("id").alias("component_id"))
    groups = scratch.keep(own.join(least, "part").select(F.col("node").alias("sequence"), "component_id"))
    scratch.release(items, company, sets, parts)
    out = signed.select("id", "sequence", "n").join(groups, "sequence", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
