"""Line dedup (operator 13): sharded minimal perfect hash over line hashes.

A line's key is the line without white space at both ends, A-Z lower-cased. A
key of at least ``MIN_CHARS`` code points in at least ``MIN_DOCS`` documents
loses all its lines, except in the document with the largest identifier that
holds it (its owner). Keys are told by 128-bit hashes.

1. Each task counts, per distinct key of its own documents, how many of them
   hold it and their largest identifier; these counts are summed by hash. The
   hashes that reach ``MIN_DOCS`` are the set that is indexed.
2. The set is dealt into shards of about ``SHARD_KEYS`` hashes. Each shard gets a
   minimal perfect hash: levels of bit arrays in which a hash claims the place
   it alone falls on, what collides goes to the next level; the rank of its bit
   is its index into compact arrays of fingerprints (the hash's second half),
   counts and owners.
3. Documents probe the arrays, lines are never joined. Hashes that more than
   1/``HEAVY`` of all (document, repeated key) incidences fall on are fewer than
   ``HEAVY`` whatever the input; they form one shard that every task holds, so
   that frequent lines are decided where they stand. A bit table of
   64 * ``MARKS`` bits (fixed size) tells the tasks which other hashes can't be
   in the set. What is left is sent, packed by document, to the task that
   holds its shard, which reads the arrays once and then streams the probes.
4. The hashes that a document loses are joined to its text by a digest of its
   row, and the text is written again without them.

No task holds more than one shard and the lines of one document.

Defined cases: a NULL or empty text is one empty line. Each row is a document,
also where identifiers repeat: rows of the owner's identifier all keep their
lines. Rows with a NULL identifier count as documents and never own a key; a key
held only by such rows stays. Dropping all lines leaves an empty text. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from quarry.llm.wordhash import SPACES, mix

MIN_CHARS, MIN_DOCS = 20, 3
SHARD_KEYS = 1 << 16
HEAVY = 1 << 16
MARKS = 1 << 16  # 64-bit words of the bit table
ENTRIES = 200_000  # keys a task counts before it sends them on
GAMMA = 2  # places per hash left, on each level


def line_keys(text: bytes, min_chars: int) -> list[bytes | None]:
    """The 128-bit hash of every line's key; None for keys that are too short."""
    out = []
    for line in text.split(b"\n"):
        key = line.strip(SPACES)
        long = len(key) >= min_chars and (key.isascii() or len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)
        out.append(xxhash.xxh3_128_digest(key.lower()) if long else None)
    return out


def halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


class LineTable:
    """A minimal perfect hash of (hi, lo) pairs with the arrays that it indexes."""

    def __init__(self, sizes: bytes, words: bytes, fingerprints: bytes, counts: bytes, owners: bytes):
        self.sizes, self.words = np.frombuffer(sizes, np.int64), np.frombuffer(words, np.uint64)
        self.fingerprints, self.owners = np.frombuffer(fingerprints, np.uint64), np.frombuffer(owners, np.int64)
        self.counts = np.frombuffer(counts, np.uint32)
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    @staticmethod
    def places(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(hi ^ mix(lo + np.uint64(level))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, hi: np.ndarray, lo: np.ndarray, counts: np.ndarray, owners: np.ndarray) -> tuple[bytes, ...]:
        """The five arrays of distinct pairs."""
        sizes, parts, index, left, base = [], [], np.zeros(len(hi), np.int64), np.arange(len(hi)), 0
        while len(left):
            size = -(-max(64, GAMMA * len(left)) // 64) * 64
            at = cls.places(hi[left], lo[left], len(sizes), size)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(size, np.uint8)
            bits[at[alone]] = 1
            index[left[alone]] = base + (np.cumsum(bits) - 1)[at[alone]]
            base += int(alone.sum())
            sizes.append(size)
            parts.append(np.packbits(bits, bitorder="little"))
            left = left[~alone]
        out = [np.empty(len(hi), t) for t in (np.uint64, np.uint32, np.int64)]
        for array, values in zip(out, (lo, np.minimum(counts, 2**32 - 1), owners)):
            array[index] = values
        words = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        return np.asarray(sizes, np.int64).tobytes(), words.tobytes(), *(a.tobytes() for a in out)

    def find(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The index of each pair, -1 for pairs that are not in the set."""
        out, left, base = np.full(len(hi), -1, np.int64), np.arange(len(hi)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = base + self.places(hi[left], lo[left], level, size)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            here = (word >> bit) & np.uint64(1) == 1
            below = word[here] & ((np.uint64(1) << bit[here]) - np.uint64(1))
            out[left[here]] = self.ranks[at[here] >> 6] + np.bitwise_count(below)
            left, base = left[~here], base + size
        hits = out >= 0
        hits[hits] = self.fingerprints[out[hits]] == lo[hits]
        return np.where(hits, out, -1)


def counted_keys(rows: DataFrame, kind: str, min_chars: int) -> DataFrame:
    """(hi, lo, docs, id) of the keys of each task: documents that hold it, largest identifier."""
    id_type = rows.select("id").limit(0).toArrow().schema.field("id").type

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, owner = Counter(), {}

        def sent() -> pa.RecordBatch:
            keys = list(docs)
            hi, lo = halves(keys)
            return pa.RecordBatch.from_arrays(
                [pa.array(hi.astype(np.int64)), pa.array(lo.astype(np.int64)),
                 pa.array([docs[k] for k in keys], pa.int64()), pa.array([owner.get(k) for k in keys], id_type)],
                names=["hi", "lo", "docs", "id"],
            )

        for batch in batches:
            for identifier, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held = set(line_keys(text.as_buffer().to_pybytes(), min_chars))
                held.discard(None)
                docs.update(held)
                if identifier is not None:
                    for key in held:
                        if key not in owner or owner[key] < identifier:
                            owner[key] = identifier
                if len(docs) > ENTRIES:
                    yield sent()
                    docs.clear()
                    owner.clear()
        yield sent()

    return rows.select("id", "text").mapInArrow(count, f"hi long, lo long, docs long, id {kind}")


def _owner(column: str, kind: object) -> Column:
    """An identifier as 64 bits: itself if it is an integer, else its hash."""
    whole = isinstance(kind, (ByteType, ShortType, IntegerType, LongType))
    value = F.col(column).cast("long") if whole else F.xxhash64(column)
    return F.when(F.col(column).isNotNull(), value)


def shard_tables(keys: DataFrame) -> DataFrame:
    """(shard, sizes, words, fingerprints, counts, owners) of (shard, hi, lo, docs, owner)."""

    def build(key: tuple, group: pa.Table) -> pa.Table:
        hi, lo = (group.column(c).to_numpy().astype(np.uint64) for c in ("hi", "lo"))
        arrays = LineTable.build(hi, lo, group.column("docs").to_numpy(), group.column("owner").to_numpy())
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()),
                         **{n: pa.array([a], pa.binary()) for n, a in zip(ARRAYS, arrays)}})

    return keys.groupBy("shard").applyInArrow(build, "shard int, " + ", ".join(f"{n} binary" for n in ARRAYS))


ARRAYS = ("sizes", "words", "fingerprints", "counts", "owners")


def lost_keys(rows: DataFrame, keys: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(uid, lost): packed hashes that each row loses; ``keys`` (hi, lo, docs, owner) are the repeated ones."""
    spark = rows.sparkSession
    n, incidences = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum("docs"), F.lit(0))).first()
    shards = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // SHARD_KEYS))
    frequent = F.col("docs") > F.lit(incidences // HEAVY)
    # fewer than HEAVY rows: their documents add up to at most all incidences
    top = keys.where(frequent).toArrow()
    heavy = LineTable.build(
        *(top.column(c).to_numpy().astype(np.uint64) for c in ("hi", "lo")), top.column("docs").to_numpy(), top.column("owner").to_numpy()
    )
    rest = keys.where(~frequent)
    word, bit = F.col("hi").bitwiseAND(F.lit(MARKS - 1)), F.shiftrightunsigned("hi", 58)
    marked = (
        rest.select(word.cast("int").alias("word"), bit.cast("int").alias("bit"))
        .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    )
    marks = np.zeros(MARKS, np.int64)
    marks[marked.column("word").to_numpy()] = marked.column("bits").to_numpy()
    small = spark.sparkContext.broadcast((heavy, marks.tobytes()))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bits = LineTable(*small.value[0]), np.frombuffer(small.value[1], np.uint64)
        for batch in batches:
            uids, mine = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keys, row = [], []
            for i, text in enumerate(batch.column(2)):
                held = set(line_keys(text.as_buffer().to_pybytes(), min_chars))
                held.discard(None)
                keys += held
                row += [i] * len(held)
            hi, lo = halves(keys)
            row = np.asarray(row, np.int64)
            me = np.asarray([0 if m is None else m for m in mine], np.int64)[row]
            owned = np.asarray([m is not None for m in mine], bool)[row]
            at = table.find(hi, lo)
            found = at >= 0
            lost = found.copy()
            lost[found] = (table.owners[at[found]] != me[found]) | ~owned[found]
            asked = ~found & ((bits[(hi & np.uint64(MARKS - 1)).astype(np.int64)] >> (hi >> np.uint64(58))) & np.uint64(1) == 1)
            shard = (hi.astype(np.int64) % shards).astype(np.int64)  # floored, as pmod
            packed: dict[tuple, list[bytes]] = {}
            for j in np.flatnonzero(lost | asked).tolist():
                packed.setdefault((bool(asked[j]), int(row[j]), int(shard[j]) if asked[j] else int(row[j]) % shards), []).append(keys[j])
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[2] for k in packed], pa.int32()), pa.array([1 if k[0] else 2 for k in packed], pa.int32()),
                 pa.array([uids[k[1]] for k in packed], pa.binary()), pa.array([mine[k[1]] for k in packed], pa.int64()),
                 pa.array([b"".join(v) for v in packed.values()], pa.binary())],
                names=["shard", "kind", "uid", "me", "hashes"],
            )

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, table = None, None
        for batch in batches:
            uids, losses = [], []
            shard, kind, uid, me, hashes = (batch.column(c).to_pylist() for c in ("shard", "kind", "uid", "me", "hashes"))
            arrays = [batch.column(c) for c in ARRAYS]
            i = 0
            while i < len(shard):
                if kind[i] == 0:
                    now, table = shard[i], LineTable(*(a[i].as_py() for a in arrays))
                    i += 1
                    continue
                stop = i
                while stop < len(shard) and (shard[stop], kind[stop]) == (shard[i], kind[i]):
                    stop += 1
                if kind[i] == 2:
                    uids += uid[i:stop]
                    losses += hashes[i:stop]
                elif now == shard[i]:
                    hi, lo = halves(hashes[i:stop])
                    at = table.find(hi, lo)
                    ends = np.cumsum([len(h) // 16 for h in hashes[i:stop]])
                    row = np.repeat(np.arange(stop - i), np.diff(ends, prepend=0))
                    gone: dict[int, list[bytes]] = {}
                    for j in np.flatnonzero(at >= 0).tolist():
                        r = int(row[j])
                        if me[i + r] is None or me[i + r] != table.owners[at[j]]:
                            k = j - (int(ends[r - 1]) if r else 0)
                            gone.setdefault(r, []).append(hashes[i + r][16 * k : 16 * k + 16])
                    uids += [uid[i + r] for r in gone]
                    losses += [b"".join(v) for v in gone.values()]
                i = stop
            yield pa.RecordBatch.from_arrays([pa.array(uids, pa.binary()), pa.array(losses, pa.binary())], names=["uid", "lost"])

    probes = rows.select("uid", "me", "text").mapInArrow(probe, "shard int, kind int, uid binary, me long, hashes binary")
    tables = shard_tables(rest.select(F.pmod("hi", F.lit(shards)).cast("int").alias("shard"), "hi", "lo", "docs", "owner"))
    dealt = tables.withColumn("kind", F.lit(0)).unionByName(probes, allowMissingColumns=True)
    return dealt.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(decide, "uid binary, lost binary")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(id, n_lines, n_dropped, text) of every row: its lines before and without the repeated ones."""
    id_type = docs.schema[id_col].dataType
    kind = id_type.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    uid = F.unhex(F.md5(F.concat(F.coalesce(F.concat(F.lit("="), F.col("id").cast("string")), F.lit("")), F.lit("\n"), F.col("text"))))
    rows = rows.withColumn("uid", uid).withColumn("me", _owner("id", id_type))
    keys = (
        counted_keys(rows, kind, min_chars).groupBy("hi", "lo").agg(F.sum("docs").alias("docs"), F.max("id").alias("id"))
        .where((F.col("docs") >= min_docs) & F.col("id").isNotNull())
        .select("hi", "lo", "docs", _owner("id", id_type).alias("owner"))
    ).checkpoint()
    lost = lost_keys(rows, keys, min_chars, min_docs).groupBy("uid").agg(F.collect_list("lost").alias("lost"))
    out_type = rows.select("id").limit(0).toArrow().schema.field("id").type

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, dropped, texts = [], [], []
            for text, gone in zip(batch.column(1), batch.column(2).to_pylist()):
                text = text.as_buffer().to_pybytes()
                if gone is None:
                    lines.append(text.count(b"\n") + 1)
                    dropped.append(0)
                    texts.append(text)
                    continue
                gone = b"".join(gone)
                gone = {gone[i : i + 16] for i in range(0, len(gone), 16)}
                parts = text.split(b"\n")
                stay = [line for line, key in zip(parts, line_keys(text, min_chars)) if key not in gone]
                lines.append(len(parts))
                dropped.append(len(parts) - len(stay))
                texts.append(b"\n".join(stay))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(out_type), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()),
                 pa.array(texts, pa.binary()).cast(pa.string())], names=["id", "n_lines", "n_dropped", "text"])

    # the side with the hashes is the one that is built; texts are not sorted
    joined = rows.select("uid", "id", "text").join(lost.hint("shuffle_hash"), "uid", "left").select("id", "text", "lost")
    return joined.mapInArrow(rewrite, f"id {kind}, n_lines long, n_dropped long, text string").withColumnRenamed("id", id_col)


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, COALESCE(text, '') AS text FROM documents),
l AS (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
h AS (SELECT key, MAX(doc_id) AS owner FROM k WHERE length(key) >= 20 GROUP BY key HAVING COUNT(DISTINCT r) >= 3 AND MAX(doc_id) IS NOT NULL),
m AS (SELECT k.*, (h.key IS NOT NULL AND k.doc_id IS DISTINCT FROM h.owner) AS dropped FROM k LEFT JOIN h ON k.key = h.key)
SELECT ANY_VALUE(doc_id) AS doc_id, COUNT(*) AS n_lines, COUNT(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(COALESCE(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY r
"""
