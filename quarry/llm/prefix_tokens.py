"""Token counts (operator 10): exact counts at every prefix by dynamic programming.

A byte-pair encoder cuts a text into pieces with a fixed pattern and merges
bytes inside each piece. For one piece the encodings of all its prefixes are
built left to right: the encoding of ``w[:j]`` is the encoding of a shorter
prefix ``w[:i]`` plus one last token ``w[i:j]``, and it is the right one when
the two tokens at the seam stay apart under the merge rules. Each prefix has
exactly one such encoding, so a table of (last token, count) per prefix gives
the exact count at every cut. Pieces are worked off in sorted order and the
table is kept for the shared beginning of neighbouring pieces.

Counts of a text are sums over its pieces; a cut inside a piece only looks at
the beginning of that piece (:meth:`PrefixCounts.at`), so budget and
truncation questions need no second encoding.

Defined cases: NULL and empty texts have 0 bytes and 0 tokens; a special
string of the vocabulary inside a text is one token, as the library handles it
by default; repeated rows are counted alike; other columns are not read.
"""

from __future__ import annotations

import bisect
import json
from collections.abc import Iterator
from itertools import accumulate, chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quarry.llm.scratch import ship

LIMIT = 1024
CACHED_PIECES = 400_000
NEVER = 1 << 60

# The byte-level piece pattern of the vocabulary file.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"""


def printable_bytes() -> dict[str, int]:
    """The vocabulary file writes bytes that don't print as characters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    out |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    return out


class Vocabulary:
    """Merge rules of a byte-pair vocabulary file (JSON), in rank order."""

    def __init__(self, text: str):
        data, byte = json.loads(text), printable_bytes()
        self.special = [t["content"] for t in data.get("added_tokens", [])]
        self.bytes = [bytes([b]) for b in range(256)]
        self.id = {b: i for i, b in enumerate(self.bytes)}
        self.parts: list[tuple[int, int] | None] = [None] * 256
        self.merge: dict[tuple[int, int], int] = {}
        for rule in data["model"]["merges"]:
            a, b = (self.id[bytes(byte[c] for c in part)] for part in (rule if isinstance(rule, list) else rule.split(" ")))
            joined = self.bytes[a] + self.bytes[b]
            if (a, b) in self.merge:
                continue
            self.merge[a, b] = n = len(self.bytes)
            self.bytes.append(joined)
            self.parts.append((a, b))
            self.id.setdefault(joined, n)
        self._edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self._apart: dict[int, bool] = {}
        self._whole: dict[int, bool] = {}
        self.id = {b: i for b, i in self.id.items() if self.whole(i)}
        self.reach: dict[bytes, int] = {}  # last four bytes -> longest token that ends so
        for b in self.id:
            if len(b) >= 4:
                self.reach[b[-4:]] = max(len(b), self.reach.get(b[-4:], 0))
        self.piece = regex.compile(PIECES)
        self.split = regex.compile("|".join(regex.escape(s) for s in self.special)) if self.special else None

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """(token, rank of the merge that ends it) along one edge, outermost last."""
        if (known := self._edges.get((token, side))) is None:
            parts = self.parts[token]
            inner = self._edge(parts[side], side) if parts else []
            known = [*inner[:-1], (parts[side], token), (token, NEVER)] if parts else [(token, NEVER)]
            self._edges[token, side] = known
        return known

    def apart(self, a: int, b: int) -> bool:
        """Whether ``a`` then ``b`` stay two tokens: no merge across the seam comes
        before the merges that build ``a`` and ``b`` (ranks are the order of time)."""
        if (known := self._apart.get(a << 20 | b)) is None:
            left, right = self._edge(a, 1), self._edge(b, 0)
            i = j = 0
            known = True
            while True:
                (x, x_until), (y, y_until) = left[i], right[j]
                across = self.merge.get((x, y), NEVER)
                if across < NEVER and across < x_until and across <= y_until:
                    known = False
                    break
                if x_until <= y_until and i + 1 < len(left):
                    i += 1
                elif j + 1 < len(right):
                    j += 1
                elif i + 1 < len(left):
                    i += 1
                else:
                    break
            if len(self._apart) > 4 * CACHED_PIECES:
                self._apart.clear()
            self._apart[a << 20 | b] = known
        return known

    def whole(self, token: int) -> bool:
        """Whether the token's own bytes encode to the token."""
        if (known := self._whole.get(token)) is None:
            parts = self.parts[token]
            known = self._whole[token] = parts is None or (
                self.whole(parts[0]) and self.whole(parts[1]) and self._joins(*parts, token)
            )
        return known

    def _joins(self, a: int, b: int, token: int) -> bool:
        left, right = self._edge(a, 1), self._edge(b, 0)
        i = j = 0
        while i + 1 < len(left) or j + 1 < len(right):
            (x, x_until), (y, y_until) = left[i], right[j]
            across = self.merge.get((x, y), NEVER)
            if across < min(x_until, NEVER) and across <= y_until:
                return False
            if (x_until <= y_until and i + 1 < len(left)) or j + 1 == len(right):
                i += 1
            else:
                j += 1
        return self.merge.get((a, b)) == token

    def prefix_table(self, piece: bytes, last: list[int], count: list[int], done: int) -> None:
        """Extend ``last`` and ``count`` (index: prefix length) from ``done`` to the whole piece."""
        get, apart, known, reach = self.id.get, self.apart, self._apart.get, self.reach.get
        del last[done + 1 :], count[done + 1 :]
        for j in range(done + 1, len(piece) + 1):
            for i in range(max(0, j - reach(piece[j - 4 : j], 3)) if j >= 4 else 0, j):
                if (token := get(piece[i:j])) is None:
                    continue
                if i and (fits := known(last[i] << 20 | token)) is not True and (fits is False or not apart(last[i], token)):
                    continue
                last.append(token)
                count.append(count[i] + 1)
                break

    def count_pieces(self, pieces: set[str], known: dict[str, int]) -> None:
        """Counts of pieces; the table of a shared beginning is built once."""
        last, count, before = [-1], [0], b""
        for piece in sorted(pieces):  # code point order is also the order of the bytes
            raw, same = piece.encode("utf-8"), 0
            for x, y in zip(before, raw):
                if x != y:
                    break
                same += 1
            self.prefix_table(raw, last, count, same)
            known[piece] = count[len(raw)]
            before = raw

    def parts_of(self, text: str) -> Iterator[tuple[str, bool]]:
        """Stretches of a text: (stretch, is it a special string)."""
        if not self.split or not any(s in text for s in self.special):
            yield text, False
            return
        at = 0
        for m in self.split.finditer(text):
            if m.start() > at:
                yield text[at : m.start()], False
            yield m[0], True
            at = m.end()
        if at < len(text):
            yield text[at:], False


class PrefixCounts:
    """Token counts of the prefixes of one text: a sum per piece, a table inside a piece."""

    def __init__(self, vocabulary: Vocabulary, text: str):
        self.v, self.pieces, self.special = vocabulary, [], []
        for stretch, special in vocabulary.parts_of(text):
            found = [stretch] if special else vocabulary.piece.findall(stretch)
            self.pieces += found
            self.special += [special] * len(found)
        known: dict[str, int] = {}
        vocabulary.count_pieces({p for p, s in zip(self.pieces, self.special) if not s}, known)
        self.ends = [0, *accumulate(map(len, self.pieces))]
        self.counts = [0, *accumulate(1 if s else known[p] for p, s in zip(self.pieces, self.special))]

    def at(self, n_chars: int) -> int:
        """Tokens of the first ``n_chars`` characters, encoded as a text of their own."""
        k = bisect.bisect_right(self.ends, n_chars) - 1
        if k == len(self.pieces):
            return self.counts[-1]
        # a cut may turn the white space before it into one piece, so look back to the piece before
        while k and self.pieces[k - 1].isspace():
            k -= 1
        rest = "".join(self.pieces[k:])[: n_chars - self.ends[k]] if n_chars > self.ends[k] else ""
        known: dict[str, int] = {}
        found = self.v.piece.findall(rest)
        self.v.count_pieces(set(found), known)
        return self.counts[k] + sum(known[p] for p in found)

    def longest_within(self, budget: int) -> int:
        """Characters of the longest prefix made of whole pieces with at most ``budget`` tokens."""
        return self.ends[bisect.bisect_right(self.counts, budget) - 1]


def count_texts(vocabulary: Vocabulary, texts: list[str], known: dict[str, int]) -> list[int]:
    if len(known) > CACHED_PIECES:
        known.clear()
    split, found, extra = vocabulary.piece.findall, [], []
    for text in texts:
        if any(s in text for s in vocabulary.special):
            stretches = list(vocabulary.parts_of(text))
            extra.append(sum(1 for _, special in stretches if special))
            found.append([p for t, special in stretches if not special for p in split(t)])
        else:
            extra.append(0)
            found.append(split(text))
    vocabulary.count_pieces(set(chain.from_iterable(found)).difference(known), known)
    return [n + sum(map(known.__getitem__, pieces)) for n, pieces in zip(extra, found)]


def groups(texts: list[str | None], chars: int = 1 << 20) -> Iterator[list[str]]:
    """Texts in lists of about ``chars`` characters; one long text is a list of its own."""
    out, size = [], 0
    for text in texts:
        out.append(text or "")
        size += len(out[-1])
        if size >= chars:
            yield out
            out, size = [], 0
    if out:
        yield out


def token_counts(
    docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row of ``docs``.

    ``vocabulary_path`` is read on the driver; the vocabulary (its size doesn't
    depend on the data) is broadcast.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        shared = ship(docs.sparkSession, Vocabulary(f.read()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, known = shared(), {}
        for batch in batches:
            sizes, tokens = [], []
            for start in range(0, batch.num_rows, 256):
                for part in groups(batch.column(1).slice(start, 256).to_pylist()):
                    sizes += [len(t.encode("utf-8")) for t in part]
                    tokens += count_texts(vocabulary, part, known)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_())],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        count, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
