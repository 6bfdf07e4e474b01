"""Language identification (operator 1): prediction by partial matching.

For every language a context tree over bytes holds, for each context of up to
``DEPTH`` bytes, how often each byte followed it in the training texts. The
probability of a byte is taken in its longest known context; a byte never seen
there costs an escape (distinct followers / (followers + distinct followers))
and is then looked for in the next shorter context, down to a uniform
distribution over 256 values. The statistics are frozen after training, so the
exact code length of (context, byte) is a constant. They are tabulated for
each pair that occurs in a training text, ``GROUP`` languages to a hash table,
and a text's code length under every language is a sum of table entries and
escapes: the shortest code names the language. The trees are whole, no count is
dropped; every group of languages is collected and broadcast by itself, and its
size follows from its training texts.

Training takes about ``ROWS_PER_LANGUAGE`` labelled rows of each language, the
ones with the smallest hash of the identifier (all rows of a language that has
fewer). That bound is a parameter; scoring always reads whole texts of all rows.

Defined cases: a text that is NULL or has no letter is ``und`` with score 0;
so is every text if there is nothing to learn from. Equal texts get equal
results; equal code lengths go to the language first in code point order; rows
without an identifier are scored, held out and never learned from. Columns
other than identifier, text and label are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.scratch import ship
from quarry.llm.wordhash import runs_of_rows, utf8

DEPTH = 4
ROWS_PER_LANGUAGE = 400
GROUP = 8
UNKNOWN = "und"
PIECE = 1 << 18


class Places:
    """Hash table from distinct keys, none of them 0, to their places."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(len(keys) * 2).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.places = np.zeros(1 << self.bits, np.int32)
        left, at = np.arange(len(keys), dtype=np.int32), self._slot(keys)
        while len(left):
            free = self.keys[at] == 0
            self.keys[at[free]] = keys[left[free]]
            put = self.keys[at] == keys[left]
            self.places[at[put]] = left[put]
            left, at = left[~put], (at[~put] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (((keys ^ (keys >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 for a key that isn't there."""
        at = self._slot(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.places[at], np.int32(-1))
        left = np.flatnonzero((held != keys) & (held != 0))
        at = at[left]
        while len(left):
            at = (at + 1) & ((1 << self.bits) - 1)
            held = self.keys[at]
            same = held == keys[left]
            out[left[same]] = self.places[at[same]]
            on = ~same & (held != 0)
            left, at = left[on], at[on]
        return out


def _low(packed: np.ndarray, size: int) -> np.ndarray:
    """The last ``size`` packed bytes."""
    return packed & np.uint64((1 << 8 * size) - 1)


class Trees:
    """Context trees of a group of languages: ``cost[gram, language]``, ``escape[context, language]``.

    A gram is a context and a byte, packed; a context is packed like the byte before it was one.
    """

    def __init__(self, language: np.ndarray, gram: np.ndarray, n: np.ndarray, languages: int):
        grams, where = np.unique(gram, return_inverse=True)
        count = np.zeros((len(grams), languages))
        np.add.at(count, (where, language), n)
        size, body = (grams >> np.uint64(56)).astype(np.int64), _low(grams, 7)
        contexts, node = np.unique((body >> np.uint64(8)) | (grams & np.uint64(0xFF << 56)), return_inverse=True)
        starts = np.searchsorted(node, np.arange(len(contexts)))
        distinct = np.add.reduceat((count > 0).astype(np.float64), starts, axis=0)
        total = np.add.reduceat(count, starts, axis=0) + distinct
        known = distinct > 0
        escape = np.zeros(total.shape)
        escape[known] = -np.log2(distinct[known] / total[known])
        has = count > 0
        cost = np.zeros(count.shape)
        cost[has] = -np.log2(count[has] / total[node][has])
        for s in range(1, DEPTH + 2):  # a language without the gram escapes to the shorter one
            at = np.flatnonzero(size == s)
            shorter = 8.0
            if s > 1:
                shorter = cost[np.searchsorted(grams, _low(body[at], s - 1) | np.uint64((s - 1) << 56))]
            cost[at] += np.where(has[at], 0.0, escape[node[at]] + shorter)
        self.grams, self.contexts = Places(grams), Places(contexts)
        self.cost, self.escape = cost.astype(np.float32), escape.astype(np.float32)

    def bits(self, packed: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Bits of each byte under each language; ``packed``: the byte after those before it, ``depth``: how many of these count."""
        out = np.zeros((len(packed), self.cost.shape[1]), np.float32)
        left = np.arange(len(packed))
        for k in range(DEPTH, -1, -1):
            deep = depth[left] >= k
            here, mark = left[deep], np.uint64((k + 1) << 56)
            place = self.grams.find(_low(packed[here], k + 1) | mark)
            hit = place >= 0
            out[here[hit]] += self.cost[place[hit]]
            missed = here[~hit]
            place = self.contexts.find(_low(packed[missed] >> np.uint64(8), k) | mark)
            out[missed[place >= 0]] += self.escape[place[place >= 0]]
            left = np.concatenate([missed, left[~deep]])
        out[left] += np.float32(8.0)
        return out


@dataclass
class Model:
    """The languages, in groups of ``GROUP``, and the trees of each group."""

    languages: list[str]
    trees: list[Trees]

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text under each language; a long text is summed piece by piece."""
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        long = np.flatnonzero(np.diff(offsets) > PIECE)
        cuts = np.unique(np.concatenate([offsets, *(np.arange(offsets[r], offsets[r + 1], PIECE) for r in long)]))
        row = np.searchsorted(offsets, cuts[:-1], side="right") - 1
        for lo, hi in runs_of_rows(cuts, PIECE):
            at = cuts[lo : hi + 1] - cuts[lo]
            n = int(at[-1])
            if not n:
                continue
            depth = np.minimum(np.arange(cuts[lo], cuts[hi]) - np.repeat(offsets[row[lo:hi]], np.diff(at)), DEPTH)
            bytes_ = np.zeros(n + DEPTH, np.uint64)
            before = min(DEPTH, int(cuts[lo]))
            bytes_[DEPTH - before :] = data[cuts[lo] - before : cuts[hi]]
            packed = np.zeros(n, np.uint64)
            for j in range(DEPTH + 1):
                packed = packed << np.uint64(8) | bytes_[j : j + n]
            first = 0
            for trees in self.trees:
                bits = trees.bits(packed, depth)
                for k in range(bits.shape[1]):
                    np.add.at(out[:, first + k], row[lo:hi], np.add.reduceat(bits[:, k], at[:-1], dtype=np.float64))
                first += bits.shape[1]
        return out


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter; only texts without an ASCII letter are decoded."""
    ascii_letter = np.zeros(256, bool)
    ascii_letter[[*range(65, 91), *range(97, 123)]] = True
    found, out = ascii_letter[data], np.zeros(len(offsets) - 1, bool)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        out[full] = np.logical_or.reduceat(found, offsets[:-1][full])
    for i in np.flatnonzero(~out):
        out[i] = any(map(str.isalpha, data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")))
    return out


def grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(language, packed bytes, count) of each context with its next byte.

    ``gram`` packs the context and the byte, the length in the top byte.
    """
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        label = np.asarray(batch.column(0).to_pylist(), object)
        for name in sorted(set(label)):
            rows = np.flatnonzero(label == name)
            for k in range(DEPTH + 1):
                found = []
                for i in rows:
                    text = data[offsets[i] : offsets[i + 1]].astype(np.uint64)
                    m = len(text) - k
                    if m > 0:
                        packed = np.zeros(m, np.uint64)
                        for j in range(k + 1):
                            packed = packed << np.uint64(8) | text[j : j + m]
                        found.append(packed)
                if found:
                    gram, n = np.unique(np.concatenate(found), return_counts=True)
                    gram = gram | np.uint64((k + 1) << 56)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(gram)), pa.array(gram.astype(np.int64)), pa.array(n.astype(np.int64))],
                        names=["label", "gram", "n"],
                    )


def build(languages: list[str], rows: list[tuple[str, int, int]]) -> Model:
    """The model of (language, gram, count)."""
    trees = []
    for lo in range(0, len(languages), GROUP):
        index = {name: i for i, name in enumerate(languages[lo : lo + GROUP])}
        own = [r for r in rows if r[0] in index]
        trees.append(Trees(
            np.array([index[r[0]] for r in own]), np.array([r[1] for r in own], np.uint64), np.array([r[2] for r in own], float), len(index)
        ))
    return Model(languages, trees)


def train(
    docs: DataFrame, id_col: str, text_col: str, label_col: str, learn: Column,
    rows_per_language: int = ROWS_PER_LANGUAGE,
) -> Model | None:
    """Fit on a bounded sample of the rows where ``learn`` holds and the label is not NULL.

    The label counts (one row per language) and the gram counts of the sample,
    ``GROUP`` languages at a time, come to the driver; texts stay on the executors.
    """
    rows = docs.where(learn & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(F.col(label_col)).count().collect()}
    if not counts:
        return None
    draw = F.conv(F.substring(F.md5(F.concat(F.lit("sample|"), F.col(id_col).cast("string"))), 1, 12), 16, 10).cast("double")
    keep = F.lit(False)
    for name, n in sorted(counts.items()):
        keep = keep | ((F.col(label_col) == name) & (draw < F.lit(min(1.0, rows_per_language / n) * float(1 << 48))))
    sample = rows.where(keep).select(F.col(label_col).cast("string").alias("label"), F.col(text_col).alias("text"))
    found = (
        sample.mapInArrow(grams_of, "label string, gram long, n long")
        .groupBy("label", "gram").agg(F.sum("n").alias("n")).checkpoint()
    )
    languages = sorted(r[0] for r in found.select("label").distinct().collect())
    if not languages:
        return None
    trees = []
    for lo in range(0, len(languages), GROUP):
        group = languages[lo : lo + GROUP]
        index = F.array_position(F.array(*map(F.lit, group)), F.col("label")).cast("int") - 1
        learned = found.where(F.col("label").isin(group)).select(index.alias("i"), "gram", "n").toArrow()
        i, gram, n = (learned.column(c).to_numpy() for c in range(3))
        trees.append(Trees(i, gram.astype(np.uint64), n.astype(float), len(group)))
    return Model(languages, trees)


def share(docs: DataFrame, model: Model | None) -> Callable[[], Model | None]:
    """Broadcasts a model, each group of languages by itself; the function gives the model inside a task."""
    if model is None:
        return lambda: None
    languages, parts = model.languages, [ship(docs.sparkSession, t) for t in model.trees]
    kind = Model
    return lambda: kind(languages, [part() for part in parts])


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, bits_per_byte) of every row; the last is NULL for empty texts."""
    shared = share(docs, model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared()
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            sizes, letters = np.diff(offsets), has_letter(data, offsets)
            n = batch.num_rows
            names, sure, rate = np.full(n, UNKNOWN, object), np.zeros(n), np.full(n, np.nan)
            if model is not None:
                bits = model.code_lengths(data, offsets)
                best = bits.argmin(axis=1)
                least = bits.min(axis=1)
                share = 1.0 / np.exp2(np.maximum(least[:, None] - bits, -1000.0)).sum(axis=1)
                names[letters] = np.asarray(model.languages, object)[best[letters]]
                sure[letters] = share[letters]
                rate[sizes > 0] = least[sizes > 0] / sizes[sizes > 0]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(sure),
                 pa.array(rate, pa.float64(), from_pandas=True)],
                names=[id_col, "lang_pred", "score", "bits_per_byte"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        score, f"`{id_col}` {kind}, lang_pred string, score double, bits_per_byte double"
    )


def with_language(docs: DataFrame, model: Model | None, text_col: str = "text", most_bits: float = 8.0) -> DataFrame:
    """The rows of ``docs``, unchanged, whose text has a letter and a language that
    codes it in fewer than ``most_bits`` bits a byte. Without a model only the letter counts."""
    shared = share(docs, model)
    place = docs.columns.index(text_col)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared()
        for batch in batches:
            data, offsets = utf8(batch.column(place))
            good = has_letter(data, offsets)
            if model is not None:
                good &= model.code_lengths(data, offsets).min(axis=1) < most_bits * np.diff(offsets)
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(choose, docs.schema)


def held_out(id_col: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """Whether a row is in the part that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % parts == part, F.lit(True))


def language_table(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, bits_per_byte) for a documents table."""
    model = train(docs, "doc_id", "text", "lang", ~held_out())
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "bits_per_byte")
