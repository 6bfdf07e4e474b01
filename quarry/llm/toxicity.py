"""Toxicity (operator 3): a factorization machine over hashed terms.

A text is the set of its lower-cased words and their stems (first ``STEMS``
bytes, so inflected forms share a term), hashed to ``TERMS`` places. The score
is ``sigmoid(bias + sum of weights + sum of factor products over all pairs of
terms)``; the products let two terms together say what neither says
alone (an insult next to a mention of a group). Products of all pairs cost one
pass: ``((sum of factors)**2 - sum of squared factors) / 2``.

The machine is fitted on at most about ``ROWS`` labelled rows, those with the
smallest hash of the identifier. That bound is a parameter; scoring reads whole
texts of all rows. Terms in fewer than ``LEAST_ROWS`` of the fitted rows, and
terms that tell the labels apart neither alone nor in a pair, keep weight 0, so a
long text doesn't pile up chance weights. A term is told apart alone by its share
among the labels (``LEAST_Z`` standard errors), in a pair by the share of rows
that hold both (``PAIR_Z``): terms that say nothing by themselves are learned if
they do together. Pairs are counted among the telling terms and the ``PAIR_TERMS``
most frequent others of the fitted rows, a parameter of the fit.

Defined cases: a NULL or empty text has the score of the bias alone; without
labelled rows every score is 0; labels other than 0 and 1 and rows without an
identifier aren't learned from; an identifier that repeats in the labels counts
with its largest label. Only identifier, text and the label are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.scratch import ship
from quarry.llm.wordhash import WordHasher, ascii_lower, runs_of_rows, utf8

TERMS = 1 << 18
FACTORS = 4
STEMS = (4, 6)
ROWS = 12_000
LEAST_ROWS, LEAST_Z = 4, 5.0
PAIR_TERMS, PAIR_Z = 1024, 20.0
PASSES, LEAST_STEPS = 5, 1500
BATCH = 64
CUT = 0.7


def term_words() -> WordHasher:
    word = np.zeros(256, bool)
    word[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
    return WordHasher(word, ascii_lower(), STEMS)


def terms_of(hasher: WordHasher, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct terms, row ends): the sorted distinct terms of each row, one row after the other."""
    found, counts = [], [np.zeros(0, np.int64)]
    for lo, hi in runs_of_rows(offsets, 1 << 20):
        base = offsets[lo]
        start, _, h = hasher.words(data[base : offsets[hi]], offsets[lo : hi + 1] - base)
        row = np.searchsorted(offsets[lo : hi + 1] - base, start, side="right") - 1
        h = h if len(h) else np.zeros((0, 1), np.uint64)
        pair = np.unique(row.astype(np.uint64)[:, None] * np.uint64(TERMS) + (h & np.uint64(TERMS - 1)))
        found.append((pair & np.uint64(TERMS - 1)).astype(np.int32))
        counts.append(np.bincount((pair // np.uint64(TERMS)).astype(np.int64), minlength=hi - lo))
    terms = np.concatenate(found) if found else np.zeros(0, np.int32)
    return terms, np.cumsum(np.concatenate(counts))


@dataclass
class Machine:
    bias: float
    table: np.ndarray  # per term: its weight, then its factors

    def raw(self, terms: np.ndarray, ends: np.ndarray) -> np.ndarray:
        begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        out = np.full(len(ends), self.bias)
        full = np.flatnonzero(ends > begins)
        if len(full):
            rows = self.table[terms]
            sums = np.add.reduceat(rows, begins[full], axis=0, dtype=np.float64)
            squares = np.add.reduceat(rows[:, 1:] ** 2, begins[full], axis=0, dtype=np.float64)
            out[full] += sums[:, 0] + 0.5 * (sums[:, 1:] ** 2 - squares).sum(axis=1)
        return out

    def score(self, terms: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(terms, ends), -30, 30)))


def telling(terms: np.ndarray, label: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Terms found in enough rows whose share among label 1 and label 0 differs by ``LEAST_Z`` standard errors."""
    ones, zeros = max(1.0, labels.sum()), max(1.0, len(labels) - labels.sum())
    rows, with_one = np.bincount(terms, minlength=TERMS), np.bincount(terms, label, TERMS)
    share = rows / len(labels)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / ones + 1 / zeros))
    return (rows >= LEAST_ROWS) & (np.abs(with_one / ones - (rows - with_one) / zeros) >= LEAST_Z * spread)


def telling_pairs(terms: np.ndarray, ends: np.ndarray, labels: np.ndarray, alone: np.ndarray) -> np.ndarray:
    """Terms in a pair whose joint share differs between the labels by ``PAIR_Z`` standard errors.

    The pairs of ``alone`` and the most frequent other terms, from the two
    co-occurrence matrices; what the shares of both terms alone would make of a
    pair is taken off, so a telling term does not drag in all others.
    """
    n, ones = len(labels), labels.sum()
    out = np.zeros(TERMS, bool)
    if not 0 < ones < n:
        return out
    rows = np.bincount(terms, minlength=TERMS)
    common = np.argsort(-np.where(alone, 0, rows), kind="stable")[:PAIR_TERMS]
    chosen = np.unique(np.concatenate([np.flatnonzero(alone)[:PAIR_TERMS], common[rows[common] >= LEAST_ROWS]]))
    place = np.full(TERMS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    row = np.repeat(np.arange(n), np.diff(ends, prepend=0))
    use = place[terms] >= 0
    row, column = row[use], place[terms[use]]
    held = np.zeros((n, len(chosen)), np.uint8)
    held[row, column] = 1
    sides, sizes = [labels == 0, labels == 1], (n - ones, ones)
    single = [held[side].mean(axis=0, dtype=np.float64).astype(np.float32) for side in sides]
    whole = held.mean(axis=0, dtype=np.float64).astype(np.float32)
    for at in range(0, len(chosen), 256):  # a strip of pairs at a time
        strip = slice(at, min(at + 256, len(chosen)))
        both = [np.zeros((strip.stop - at, len(chosen)), np.float32) for _ in sides]
        for lo in range(0, n, 1024):
            dense = held[lo : lo + 1024].astype(np.float32)
            for total, side in zip(both, sides):
                of = side[lo : lo + 1024]
                total += dense[of, strip].T @ dense[of]
        gap = (both[1] / ones - np.outer(single[1][strip], single[1])) - (both[0] / (n - ones) - np.outer(single[0][strip], single[0]))
        joint = (both[0] + both[1]) / n
        spread = np.sqrt(np.maximum(joint * (1 - joint), 1.0 / n) * (1 / sizes[0] + 1 / sizes[1]))
        # words and their stems always stand together: such a pair says nothing that one of them doesn't
        alike = joint >= 0.9 * np.minimum(whole[strip][:, None], whole[None, :])
        out[chosen[strip][((np.abs(gap) >= PAIR_Z * spread) & ~alike).any(axis=1)]] = True
    return out


def fit(terms: np.ndarray, ends: np.ndarray, labels: np.ndarray, factors: int = FACTORS, passes: int = PASSES,
        rate: float = 0.05, decay: float = 2e-5, seed: int = 7) -> Machine:
    """Adaptive gradient steps on the logistic loss, in mini-batches."""
    n = len(labels)
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    used = telling(terms, np.repeat(labels, ends - begins), labels)
    used |= telling_pairs(terms, ends, labels, used)
    rng = np.random.Generator(np.random.PCG64(seed))
    table = np.zeros((TERMS, 1 + factors), np.float32)
    table[used, 1:] = rng.normal(0, 0.01, (int(used.sum()), factors))
    share = min(max(labels.mean(), 1e-3), 1 - 1e-3)
    bias, steps = float(np.log(share / (1 - share))), np.full(table.shape, 1e-2, np.float32)
    bias_step = 1e-2
    for _ in range(max(passes, -(-LEAST_STEPS * BATCH // n))):
        order = rng.permutation(n)
        for i in range(0, n, BATCH):
            pick = order[i : i + BATCH]
            sizes = ends[pick] - begins[pick]
            row = np.repeat(np.arange(len(pick)), sizes)
            place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begins[pick], sizes)
            term = terms[place]
            keep = used[term]
            row, term = row[keep], term[keep]
            values = table[term]
            sums = np.zeros((len(pick), 1 + factors), np.float64)
            squares = np.zeros(len(pick))
            for k in range(1 + factors):
                sums[:, k] = np.bincount(row, values[:, k], len(pick))
            for k in range(1, 1 + factors):
                squares += np.bincount(row, values[:, k].astype(np.float64) ** 2, len(pick))
            raw = bias + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(axis=1) - squares)
            error = 1.0 / (1.0 + np.exp(-np.clip(raw, -30, 30))) - labels[pick]
            slope = np.ones((len(term), 1 + factors), np.float32)
            slope[:, 1:] = sums[row, 1:] - values[:, 1:]
            slope *= error[row, None]
            grad = float(error.sum())
            bias_step += grad**2
            bias -= rate * grad / bias_step**0.5
            if not len(term):
                continue
            seen, where = np.unique(term, return_inverse=True)
            total = np.stack([np.bincount(where, slope[:, k], len(seen)) for k in range(1 + factors)], axis=1)
            total += decay * len(pick) * table[seen]
            steps[seen] += total**2
            table[seen] -= rate * total / np.sqrt(steps[seen])
    return Machine(bias, table)


def train(
    docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", rows: int = ROWS,
) -> Machine | None:
    """Fit on a bounded sample of the labelled rows where ``learn`` (over the identifier) holds."""
    known = (
        labels.where(learn & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("double").alias("label"))
    )
    n = known.count()
    if not n:
        return None
    draw = F.conv(F.substring(F.md5(F.concat(F.lit("tox|"), F.col("id").cast("string"))), 1, 12), 16, 10).cast("double")
    sample = known.where(draw < min(1.0, rows / n) * float(1 << 48))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(sample.hint("shuffle_hash"), "id")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = term_words()
        for batch in batches:
            terms, ends = terms_of(hasher, *utf8(batch.column(1)))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(terms))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, batch.column(2)], names=["id", "terms", "label"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = texts.select("id", "text", "label").mapInArrow(hashed, f"id {kind}, terms array<int>, label double")
    found = found.toArrow().sort_by("id")  # rows x distinct terms, bounded by the sample
    if not found.num_rows:
        return None
    lists = found.column("terms").combine_chunks()
    ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
    return fit(lists.flatten().to_numpy(zero_copy_only=False), ends, found.column("label").to_numpy())


def score(docs: DataFrame, machine: Machine | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""
    shared = ship(docs.sparkSession, machine)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, machine = term_words(), shared()
        for batch in batches:
            out = []
            data, offsets = utf8(batch.column(1))
            for lo, hi in runs_of_rows(offsets, 1 << 21):
                terms, ends = terms_of(hasher, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                out.append(machine.score(terms, ends) if machine else np.zeros(hi - lo))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(out) if out else np.zeros(0))], names=[id_col, "score"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(scored, f"`{id_col}` {kind}, score double")


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(True))


def toxicity_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for a documents table and its labels."""
    machine = train(docs, labels, ~held_out())
    return score(docs, machine).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )
