"""Source divergence audit (operator 11): iceberg prefix refinement, then integer divergences.

Kept terms are found without a table of all terms:

1. One scan counts, in every task, how many documents hold each term and each
   of its byte prefixes of ``FIRST``, 2 * ``FIRST``, 4 * ``FIRST``, ... bytes, and how
   often each source uses each term. A document lies in one task, so the counts
   of tasks add up to the numbers of distinct documents. The counts leave a
   task as packed blocks, one per language and bucket of a term's first
   ``FIRST`` bytes; a frequent term is one entry of one block per task.
2. The blocks of a bucket meet in one place, which holds whole subtrees of
   prefixes. It refines them level by level: prefixes below ``min_docs``
   documents are discarded, longer ones are read only below survivors, and
   complete terms only below the last survivor. What is discarded is never
   held as a term. Terms in ``min_docs`` documents of their language are kept,
   again as packed blocks with their counts by source.
3. Kept blocks are read once more for the sums: all sources of a language side
   by side, a block of terms at a time. Tasks send on sums of pairs and the
   ``top`` terms of each source.

Shares are integers: p = 1 + floor(10^9 * (count + 1) / (N + V)) for a term's
count in a group, N the group's occurrences of kept terms, V the number of kept
terms of the language. f(p, q) = floor((p - q)^2 / q).

* ``pair``: the sum of f over all V terms for each two sources of a language.
* ``term``: f of each term of a source against its language where its share is
  above the language's, the ``top`` largest.

Defined cases: NULL text, lang and source read as ''. Each row is a document,
also where identifiers repeat. A language without kept terms has V = 0: its
pairs are 0 and it has no terms. A language with one source has no pairs. Texts
of any length are read in pieces. An empty table gives no rows. Other columns
are not read.
"""

from __future__ import annotations

import pickle
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MIN_DOCS, TOP = 3, 200
FIRST = 8  # bytes of the first level
BUCKETS = 1024  # per language
ENTRIES = 400_000  # terms a task counts before it sends them on
PIECE = 4 << 20
CELLS = 1 << 19  # shares in one block of terms
SCALE = 10**9

LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)  # A-Z lower-cased; all ASCII bytes that are not letters separate terms


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, by pieces that end between terms."""
    text = text.translate(LETTERS)
    at = 0
    while at < len(text):
        stop = text.find(b" ", at + PIECE)
        stop = len(text) if stop < 0 else stop
        yield text[at:stop].split()
        at = stop


def levels_of(terms: set[bytes]) -> Iterator[tuple[int, set[bytes]]]:
    """(length, prefixes of that length) of the terms that are longer, for every level."""
    length = FIRST
    longer = [t for t in terms if len(t) > length]
    while longer:
        yield length, {t[:length] for t in longer}
        length *= 2
        longer = [t for t in longer if len(t) > length]


def parent_length(n: int) -> int:
    """The longest level below ``n`` bytes, 0 if there is none."""
    length = FIRST
    while 2 * length < n:
        length *= 2
    return length if n > FIRST else 0


def bucket_of(key: bytes) -> int:
    return zlib.crc32(key[:FIRST]) % BUCKETS


class Counts:
    """What one task has counted of one language."""

    def __init__(self) -> None:
        self.docs, self.levels, self.uses = Counter(), {}, {}

    def add(self, source: str, text: bytes) -> int:
        """Count a document; the number of its distinct terms."""
        uses, distinct = self.uses.setdefault(source, Counter()), set()
        for terms in terms_of(text):
            uses.update(terms)
            distinct.update(terms)
        self.docs.update(distinct)
        for length, prefixes in levels_of(distinct):
            self.levels.setdefault(length, Counter()).update(prefixes)
        return len(distinct)

    def blocks(self) -> Iterator[tuple[int, bytes]]:
        """(bucket, packed counts) of all that was counted."""
        terms, sources = list(self.docs), list(self.uses)
        number = {t: i for i, t in enumerate(terms)}
        docs = np.fromiter(self.docs.values(), np.int64, len(terms))
        place = np.fromiter(map(bucket_of, terms), np.int64, len(terms))
        of = [np.fromiter(map(number.__getitem__, uses), np.int64, len(uses)) for uses in self.uses.values()]
        n = [np.fromiter(uses.values(), np.int64, len(uses)) for uses in self.uses.values()]
        term, count = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (of, n))
        source = np.repeat(np.arange(len(sources)), [len(x) for x in of])
        nodes: dict[int, dict[int, tuple[list, list]]] = {}
        for length, counts in self.levels.items():
            for key, k in counts.items():
                keys, ks = nodes.setdefault(bucket_of(key), {}).setdefault(length, ([], []))
                keys.append(key)
                ks.append(k)
        order = np.argsort(place, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        use_order = np.argsort(rank[term], kind="stable")
        term, source, count = rank[term][use_order], source[use_order], count[use_order]
        starts = np.flatnonzero(np.diff(place[order], prepend=-1))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(order)]):
            bucket = int(place[order[a]])
            lo, hi = np.searchsorted(term, (a, b))
            packed = ([terms[i] for i in order[a:b].tolist()], docs[order[a:b]].tobytes(), (term[lo:hi] - a).tobytes(),
                      source[lo:hi].tobytes(), count[lo:hi].tobytes(), sources, nodes.get(bucket, {}))
            yield bucket, zlib.compress(pickle.dumps(packed), 1)


def _sent(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def task_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, block) of (lang, source, text)."""
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("block", pa.binary())])
    held: dict[str, Counts] = {}
    entries = 0

    def sent() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            yield _sent([(lang, bucket, block) for bucket, block in counts.blocks()], schema)
        held.clear()

    for batch in batches:
        langs, sources, texts = (batch.column(i) for i in range(3))
        for lang, source, text in zip(langs.to_pylist(), sources.to_pylist(), texts):
            entries += held.setdefault(lang, Counts()).add(source, text.as_buffer().to_pybytes())
            if entries > ENTRIES:
                entries = sum(len(c.docs) for c in held.values())
                if entries > ENTRIES // 2:
                    yield from sent()
                    entries = 0
    yield from sent()


def refined(blocks: list[tuple], min_docs: int) -> tuple[list[bytes], list[str], np.ndarray]:
    """(kept terms, sources, occurrences by term and source) of one bucket's blocks.

    The levels are gone through from the shortest; a prefix counts only where
    the one before it survived, a term only below its last surviving prefix.
    """
    alive: dict[int, set[bytes]] = {}
    for length in sorted({n for b in blocks for n in b[6]}):
        before, found = alive.get(length // 2), Counter()
        for b in blocks:
            for key, n in zip(*b[6].get(length, ((), ()))):
                if length == FIRST or (before and key[: length // 2] in before):
                    found[key] += n
        alive[length] = {k for k, n in found.items() if n >= min_docs}
    number: dict[bytes, int] = {}
    at = []
    for b in blocks:
        here = np.full(len(b[0]), -1, np.int64)
        for i, term in enumerate(b[0]):
            up = parent_length(len(term))
            if not up or term[:up] in alive[up]:
                here[i] = number.setdefault(term, len(number))
        at.append(here)
    docs = np.zeros(len(number), np.int64)
    for b, here in zip(blocks, at):
        docs[here[here >= 0]] += np.frombuffer(b[1], np.int64)[here >= 0]  # a term stands once in a block
    keep = np.append(docs >= min_docs, False)  # place -1: a term that was passed over
    row = np.cumsum(keep) - 1
    sources = sorted({s for b in blocks for s in b[5]})
    column = {s: i for i, s in enumerate(sources)}
    counts = np.zeros((int(keep.sum()), len(sources)), np.int64)
    for b, here in zip(blocks, at):
        term, source, n = (np.frombuffer(x, np.int64) for x in b[2:5])
        term = here[term]
        use = keep[term]
        names = np.asarray([column[s] for s in b[5]], np.int64)
        np.add.at(counts, (row[term[use]], names[source[use]]), n[use])
    return [t for t, k in zip(number, keep.tolist()) if k], sources, counts


def kept_blocks(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, v, sources, totals, block): the kept terms, packed, with the occurrences per source."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang_col, source_col, text_col)])
    schema = pa.schema([("lang", pa.string()), ("v", pa.int64()), ("sources", pa.list_(pa.string())),
                        ("totals", pa.list_(pa.int64())), ("block", pa.binary())])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blocks = None, []

        def finished() -> Iterator[pa.RecordBatch]:
            terms, sources, counts = refined(blocks, min_docs)
            term, source = np.nonzero(counts)
            used = np.unique(source)
            totals = counts.sum(axis=0)[used].tolist()
            packed = terms, [sources[i] for i in used], term.tobytes(), np.searchsorted(used, source).tobytes(), counts[term, source].tobytes()
            if terms:
                yield _sent([(now[0], len(terms), packed[1], totals, zlib.compress(pickle.dumps(packed), 1))], schema)

        for batch in batches:
            for lang, bucket, block in zip(*(c.to_pylist() for c in batch.columns)):
                if (lang, bucket) != now:
                    yield from finished() if blocks else ()
                    now, blocks = (lang, bucket), []
                blocks.append(pickle.loads(zlib.decompress(block)))
        yield from finished() if blocks else ()

    dealt = rows.mapInArrow(task_blocks, "lang string, bucket int, block binary")
    return dealt.repartition("lang", "bucket").sortWithinPartitions("lang", "bucket").mapInArrow(
        merge, "lang string, v long, sources array<string>, totals array<bigint>, block binary")


def share(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(10^9 * (count + 1) / total) without leaving 64 bits, three digits at a time."""
    rest = count + 1
    out = rest // total
    for _ in range(3):
        rest = rest % total * 1000
        out = out * 1000 + rest // total
    return out + 1


def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // q


def _sums(batches: Iterator[pa.RecordBatch], top: int) -> Iterator[pa.RecordBatch]:
    """Partial sums of pairs, and the candidates for the top terms, of (lang, block, groups)."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.string())])
    pairs: dict[str, tuple[list[str], np.ndarray]] = {}
    best: dict[tuple[str, str], list[tuple[int, bytes]]] = {}
    for batch in batches:
        for lang, block, groups in zip(*(c.to_pylist() for c in batch.columns)):
            names = sorted(g["source"] for g in groups)
            total = np.asarray([g["total"] for g in sorted(groups, key=lambda g: g["source"])], np.int64)
            v, whole = groups[0]["v"], int(total.sum())
            terms, sources, term, source, n = pickle.loads(zlib.decompress(block))
            column = {s: i for i, s in enumerate(names)}
            source = np.asarray([column[s] for s in sources], np.int64)[np.frombuffer(source, np.int64)]
            term, n = np.frombuffer(term, np.int64), np.frombuffer(n, np.int64)
            sums = pairs.setdefault(lang, (names, np.zeros((len(names), len(names)), object)))[1]
            step = max(1, CELLS // len(names))
            for lo in range(0, len(terms), step):
                counts = np.zeros((min(step, len(terms) - lo), len(names)), np.int64)
                inside = slice(*np.searchsorted(term, (lo, lo + step)))
                counts[term[inside] - lo, source[inside]] = n[inside]
                p = share(counts, total + v)
                for t in range(len(names)):
                    sums[:, t] += f(p, p[:, t : t + 1]).sum(axis=0).tolist()
                q = share(counts.sum(axis=1), whole + v)[:, None]
                row, col = np.nonzero((counts > 0) & (p > q))
                values = f(p, q)[row, col]
                for s in np.unique(col).tolist():
                    mine = np.flatnonzero(col == s)
                    if len(mine) > top:  # ties with the last one stay in
                        least = np.partition(values[mine], len(mine) - top)[len(mine) - top]
                        mine = mine[values[mine] >= least]
                    found = best.setdefault((lang, names[s]), [])
                    found += [(-x, terms[lo + r]) for x, r in zip(values[mine].tolist(), row[mine].tolist())]
                    if len(found) > 4 * top:
                        found.sort()
                        del found[top:]
    for lang, (names, sums) in pairs.items():
        yield _sent([(lang, a, "pair", b, str(sums[i, j])) for i, a in enumerate(names) for j, b in enumerate(names) if i != j], schema)
    for (lang, source), found in best.items():
        yield _sent([(lang, source, "term", t.decode(), str(-x)) for x, t in sorted(found)[:top]], schema)


def divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
               min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of every source of every language."""
    kept = kept_blocks(docs, lang_col, source_col, text_col, min_docs).checkpoint()
    names = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                          for c, n in ((lang_col, "lang"), (source_col, "source"))]).distinct()
    kinds = kept.groupBy("lang").agg(F.sum("v").alias("v"))
    totals = kept.select("lang", F.explode(F.arrays_zip("sources", "totals")).alias("o")).groupBy(
        "lang", F.col("o.sources").alias("source")).agg(F.sum("o.totals").alias("total"))
    groups = names.join(totals, ["lang", "source"], "left").join(kinds, "lang").select(
        "lang", "source", F.coalesce("total", F.lit(0)).cast("long").alias("total"), "v")
    lists = groups.groupBy("lang").agg(F.collect_list(F.struct("source", "total", "v")).alias("groups"))  # a language's sources
    partial = kept.select("lang", "block").join(lists, "lang").mapInArrow(
        lambda batches: _sums(batches, top), "lang string, source string, part string, item string, value string")
    found = partial.select("lang", "source", "part", "item", F.col("value").cast("decimal(38,0)").alias("value")).checkpoint()
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    every = names.join(names.select("lang", F.col("source").alias("item")), "lang").where("source <> item")  # all ranks are asked for
    pairs = every.join(pairs, ["lang", "source", "item"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    terms = found.where("part = 'term'").select("lang", "source", "part", "item", F.col("value").cast("long"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = F.row_number().over(order).alias("rank")
    return pairs.select("*", ranked).union(terms.select("*", ranked).where(F.col("rank") <= top))


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source, COALESCE(text, '') AS text FROM documents),
w AS (SELECT r, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS (SELECT lang, term, COUNT(*) AS all_n FROM w GROUP BY ALL HAVING COUNT(DISTINCT r) >= 3),
v AS (SELECT lang, COUNT(*) AS v, SUM(all_n) AS all_total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT w.lang, w.source, w.term, COUNT(*) AS n FROM w JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
t AS (SELECT lang, source, SUM(n) AS total FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, COALESCE(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (COALESCE(c.n, 0) + 1)) // (COALESCE(t.total, 0) + v.v) AS p,
    1 + (1000000000::HUGEINT * (k.all_n + 1)) // (v.all_total + v.v) AS q
  FROM g JOIN k ON g.lang = k.lang JOIN v ON g.lang = v.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN t ON t.lang = g.lang AND t.source = g.source),
x AS (SELECT a.lang, a.source, b.source AS item, SUM(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, COALESCE(x.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (FROM pairs UNION ALL FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
