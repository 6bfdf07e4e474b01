"""Benchmark decontamination (operator 9): template windows with slot checks.

Texts are canonicalised word by word: words are lower-cased; numbers become
``<number>``, a unit right after a number ``<unit>``, a capitalised word inside
a sentence ``<name>``. Windows of ``WINDOW`` canonical words are hashed, and
documents and benchmark items are joined on the hash. What stood in the slots
(the placeholders) is carried along: a match counts only if the slots are
filled consistently, that is equal fillings in the item correspond to equal
fillings in the document and different ones to different ones, inside each
window and over all windows of one passage. A window with the item's own
fillings always counts; a filling that is inconsistent over the passage takes
out the other windows that hold it, and no more. So a question asked again with
other numbers or names is found, two questions that only share a shape are
not.

Every window is looked up in up to three forms, and a match in one is enough:

* all words literal, whatever their case; so each verbatim copy is found;
* the template above, its first word taken literally: whether a capital there
  starts a sentence can depend on text outside the passage;
* the open template, where every capitalised word is a ``<name>``, also at the
  start of a sentence, and the first word may be a slot.

A template window needs ``LITERAL`` words that are not slots. An item shorter
than a window is one window of its own length; its templates need ``FEW`` such
words and ``SHORTEST`` words in all, its literal form needs neither.

Documents are scanned once. A bit table of fixed size with the benchmark's
window hashes is broadcast and drops windows that can't match before anything
is shuffled; matches are decided by the join, so the table may fill up with a
huge benchmark without changing the result.

Defined cases: NULL and empty texts match nothing; repeated rows are reported
as one document; equal benchmark items are reported each; an empty benchmark
gives an empty result; rows without an identifier are left out of the result.
Other columns of either table are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.wordhash import WordHasher, ascii_lower, mix, runs_of_rows, utf8

WINDOW, LITERAL, SHORTEST, FEW = 13, 7, 5, 3
FILTER_BITS = 22
# Units that may follow a number.
UNITS = (
    "mm cm m km inch inches feet foot miles mile g kg mg grams gram pounds pound tons ton l ml liters liter "
    "litres litre gallons gallon s sec seconds second min minutes minute h hours hour days day weeks week "
    "months month years year percent dollars dollar cents cent euros euro degrees degree mph kmh watts watt"
).split()
SLOT = np.uint64(1 << 32)
NUMBER, UNIT, NAME = (np.uint64(x) for x in (0x6E756D, 0x756E6974, 0x6E616D65))


def _two_byte_folds() -> np.ndarray:
    """Two bytes of UTF-8 -> the two bytes of the same letter in lower case."""
    folds = np.arange(1 << 16)
    for point in range(0x80, 0x800):
        lower = chr(point).casefold().encode()
        if len(lower) == 2:
            folds[int.from_bytes(chr(point).encode(), "big")] = int.from_bytes(lower, "big")
    return folds


class Templates:
    """Canonical words of a column and their windows."""

    def __init__(self) -> None:
        word = np.zeros(256, bool)
        word[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
        self.hasher = WordHasher(word, ascii_lower())
        self.digit, self.ender, self.upper = np.zeros(256, np.int32), np.zeros(256, np.int32), np.zeros(256, bool)
        self.digit[48:58] = 1
        self.ender[list(b".!?:;\"\n\r")] = 1
        self.upper[65:91] = True
        self.folds = _two_byte_folds()
        units = pa.array(UNITS)
        data, offsets = utf8(units)
        self.units = np.sort(self.hasher.words(data, offsets)[2])

    def canonical(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row start in words, literal codes, canonical codes, open codes); slots are canonical and open codes below 2**32."""
        low = data.copy()
        wide = np.zeros(len(data), bool)  # capitals of two bytes: U+00C0 to U+00DE
        wide[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        lead = np.flatnonzero((data[:-1] >= 0xC2) & (data[:-1] <= 0xDF))
        folded = self.folds[data[lead].astype(np.int64) << 8 | data[lead + 1]]
        low[lead], low[lead + 1] = folded >> 8, folded & 255
        start, end, literal = self.hasher.words(low, offsets)
        if not len(start):
            return np.zeros(len(offsets), np.int64), literal, literal, literal
        digits = np.concatenate([[0], np.cumsum(self.digit[data], dtype=np.int32)])
        number = digits[end] - digits[start] == end - start
        enders = np.concatenate([[0], np.cumsum(self.ender[data], dtype=np.int32)])
        row = np.searchsorted(offsets, start, side="right") - 1
        follows = np.zeros(len(start), bool)  # in the same row and sentence as the word before
        follows[1:] = (row[1:] == row[:-1]) & (enders[start[1:]] == enders[end[:-1]])
        second = np.minimum(start + 1, len(data) - 1)
        capital = self.upper[data[start]] | (wide[second] & (end - start > 1))
        unit = np.zeros(len(start), bool)
        unit[1:] = number[:-1] & (row[1:] == row[:-1]) & (start[1:] - end[:-1] <= 2)
        at = np.searchsorted(self.units, literal[unit])
        unit[unit] = self.units[np.minimum(at, len(self.units) - 1)] == literal[unit]
        code = literal | np.uint64(1 << 63)
        opened = code.copy()
        code[follows & capital] = NAME
        opened[capital] = NAME
        for codes in (code, opened):
            codes[unit] = UNIT
            codes[number] = NUMBER
        # 3.5 or 1,000 is one number: the later part joins the first
        joined = np.zeros(len(start), bool)
        joined[1:] = number[1:] & number[:-1] & (row[1:] == row[:-1]) & (start[1:] - end[:-1] == 1)
        joined[1:] &= np.isin(data[end[:-1].clip(max=len(data) - 1)], np.frombuffer(b".,", np.uint8))
        if joined.any():
            head = np.flatnonzero(~joined)
            group = np.cumsum(~joined) - 1
            whole = literal[head].copy()
            np.add.at(whole, group[joined], mix(literal[joined] + np.flatnonzero(joined).astype(np.uint64) - head[group[joined]].astype(np.uint64)))
            start, literal, code, opened = start[head], whole, code[head], opened[head]
        return np.searchsorted(start, offsets), literal, code, opened

    def windows(
        self, first: np.ndarray, literal: np.ndarray, code: np.ndarray, opened: np.ndarray, size: int, least: int | None
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(form, is a slot as first word, is a slot inside, row, word index, hash) of the windows of ``size`` words, per form.

        Forms: 0 literal, 1 template, 2 open template. Windows are left out of a form
        that says the same as the one before it. Templates need ``least`` words that are
        not slots; None: no templates.
        """
        m = len(literal) - size + 1
        if m <= 0:
            return
        at = np.arange(m)
        row = np.searchsorted(first, at, side="right") - 1
        fits = at + size <= first[row + 1]
        plain = literal | np.uint64(1 << 63)
        fewer = np.zeros(m, np.int64)  # slots in the form before
        for form, start, inside in ((0, plain, plain), (1, plain, code), (2, np.where(opened == UNIT, plain, opened), opened)):
            if form and least is None:
                return
            before = np.concatenate([[0], np.cumsum(inside < SLOT)])
            slots = before[size:] - before[1 : m + 1] + (start[:m] < SLOT)
            keep = fits & (slots > fewer) & (size - slots >= least) if form else fits
            fewer = slots
            if not keep.any():
                continue
            hashed = start[:m].copy()
            for j in range(1, size):
                hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + inside[j : j + m]
            yield form, start < SLOT, inside < SLOT, row[keep], at[keep], mix(hashed[keep] + np.uint64(size))


def _rows(
    templates: Templates, column: pa.Array, sizes: list[int], size_of_all: int, whole_short: bool, bits: np.ndarray | None
):
    """(row, place, size, window, form, slots, shape) of the windows; ``bits`` drops those that can't match.

    ``whole_short``: a row shorter than ``size_of_all`` gives one window, all of it.
    """
    data, offsets = utf8(column)
    for lo, hi in runs_of_rows(offsets, 1 << 19):
        codes = templates.canonical(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        first, literal = codes[:2]
        lengths = np.diff(first)
        for size in sizes:
            least = min(LITERAL if size == size_of_all else FEW, size - 1) if size >= min(SHORTEST, size_of_all) else None
            for form, head, inside, row, at, window in templates.windows(*codes, size, least):
                if whole_short and size < size_of_all:
                    keep = lengths[row] == size
                    row, at, window = row[keep], at[keep], window[keep]
                if bits is not None:
                    place = window & np.uint64((1 << FILTER_BITS) - 1)
                    keep = (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
                    row, at, window = row[keep], at[keep], window[keep]
                for r, a, w in zip(row.tolist(), at.tolist(), window.astype(np.int64).tolist()):
                    filled = inside[a : a + size].copy()
                    filled[0] = head[a]
                    slots = literal[a : a + size][filled].astype(np.int64).tolist()
                    seen: dict[int, int] = {}
                    shape = [seen.setdefault(s, len(seen)) for s in slots]
                    yield lo + r, a - int(first[r]), size, w, form, slots, ",".join(map(str, shape))


def window_rows(
    table: DataFrame, id_col: str, text_col: str, sizes: list[int], whole_short: bool = False, bits: bytes | None = None,
    window: int = WINDOW,
) -> DataFrame:
    """(id, place, size, window, form, slots, shape) of the windows of a table's texts.

    ``shape`` numbers the slots by their fillings in order of appearance: two
    windows fill their slots consistently when their shapes are equal.
    """
    shared = table.sparkSession.sparkContext.broadcast(bits)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates()
        held = np.frombuffer(shared.value, np.uint8) if shared.value is not None else None
        for batch in batches:
            for found in batched(_rows(templates, batch.column(1), sizes, window, whole_short, held), 1 << 14):
                columns = list(zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.int64()),
                     pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int32()),
                     pa.array(columns[5], pa.list_(pa.int64())), pa.array(columns[6], pa.string())],
                    names=["id", "place", "size", "window", "form", "slots", "shape"],
                )

    kind = table.schema[id_col].dataType.simpleString()
    return table.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(id_col, text_col).mapInArrow(
        find, f"id {kind}, place long, size int, window long, form int, slots array<bigint>, shape string"
    )


def bit_table(windows: DataFrame) -> bytes:
    """Bits of the windows' hashes: at most 2**FILTER_BITS places come to the driver."""
    places = windows.select(F.col("window").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)).cast("int").alias("p")).distinct().toArrow()
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[places.column(0).to_numpy()] = True
    return np.packbits(bits, bitorder="little").tobytes()


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
) -> DataFrame:
    """(id, item, n_windows, n_exact, first_place): each document with each item it holds.

    ``n_windows`` counts matching windows, ``n_exact`` those whose slots hold
    the item's own fillings, ``first_place`` is the first matching word.
    """
    sizes = list(range(1, window + 1))
    items = window_rows(benchmark, item_col, item_text_col, sizes, whole_short=True, window=window).checkpoint()
    used = sorted(r[0] for r in items.select("size").distinct().collect())
    found = window_rows(docs, id_col, text_col, used or [window], bits=bit_table(items), window=window)
    theirs = items.select(
        F.col("id").alias("item"), F.col("place").alias("item_place"), "window", "shape",
        F.col("form").alias("item_form"), F.col("slots").alias("item_slots"),
    )
    both = (
        found.join(theirs, ["window", "shape"])
        .select(
            "id", "item", "place", (F.col("place") - F.col("item_place")).alias("shift"),
            F.greatest("form", "item_form").alias("form"), "slots", "item_slots",
        )
    )
    # over a whole passage each filling of the item should stand for one filling of the document, and the other way
    # round; of a passage that breaks this, the windows with the item's own fillings count and those without the torn ones
    # (templates are judged by templates, open ones by both)
    pairs = both.where("form > 0").select(
        "id", "item", "shift", F.explode(F.sequence("form", F.lit(2))).alias("form"), F.arrays_zip("item_slots", "slots").alias("s")
    ).select("id", "item", "shift", "form", F.explode("s").alias("s"))
    mixed = None
    for one, other in (("item_slots", "slots"), ("slots", "item_slots")):
        part = (
            pairs.groupBy("id", "item", "shift", "form", F.col(f"s.{one}").alias("value"))
            .agg(F.min(f"s.{other}").alias("lo"), F.max(f"s.{other}").alias("hi"))
            .where("lo <> hi").select("id", "item", "shift", "form", F.col("value").alias(f"torn_{one}"))
        )
        mixed = part if mixed is None else mixed.unionByName(part, allowMissingColumns=True)
    # at one shift there are no more values than the item has slots
    torn = mixed.groupBy("id", "item", "shift", "form").agg(
        F.collect_set("torn_item_slots").alias("torn_item"), F.collect_set("torn_slots").alias("torn_doc")
    )
    whole = both.join(torn, ["id", "item", "shift", "form"], "left").where(
        F.col("torn_item").isNull()
        | (F.col("slots") == F.col("item_slots"))
        | ~(F.arrays_overlap("item_slots", "torn_item") | F.arrays_overlap("slots", "torn_doc"))
    )
    return whole.groupBy(F.col("id").alias(id_col), F.col("item").alias(item_col)).agg(
        F.countDistinct("place").alias("n_windows"),
        F.countDistinct(F.when(F.col("slots") == F.col("item_slots"), F.col("place"))).alias("n_exact"),
        F.min("place").alias("first_place"),
    )
