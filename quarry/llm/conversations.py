"""Conversation structure repair (operator 12): Four-Russians block tables.

The rows of a conversation, in turn order, are edited at least cost so that the
initials of their roles read ``(s?(ua)+)?``: Keep (0), Rerole to user or
assistant (3), Delete (4; a must for blank and repeated rows), Insert an empty
user or assistant row (3); a truncated row that stays adds 3. Of equally cheap
edits the one whose initials come first in ASCII is taken.

* A row is one of nine symbols (initial s, u, a or other, truncated or not; must
  go). The cheapest completion from each of the four states (nothing yet, after
  s, after u, after a) is a vector; inserts keep its entries close, so less its
  minimum it is one of a few dozen. ``Tables`` finds them all, and precomputes for
  every block of up to ``BLOCK`` symbols and every vector behind it the vector
  before it, the cost between them, and the state that each state leaves in.
* A conversation is read from its end, one lookup per block. Then it is traced
  from its start: each block is expanded backward from the vector behind it,
  and of all letters that keep the cost the least is taken, so ties are safe.
  Expansions are remembered.
* Rows are sorted over all tasks by range, not dealt by conversation. Each task
  repairs the conversations that lie inside it. Those at its edges, or of more
  than ``CHUNK_ROWS`` rows or ``CHUNK_BYTES`` bytes, are cut into chunks. A chunk is a
  function from vectors to vectors and states to states, as a block is; the
  functions of a conversation are composed from a few hundred bytes per chunk,
  then all chunks are traced in parallel. Only the final digest, which is
  sequential by its nature, streams the chunks of a conversation through one
  task, one chunk at a time.

Defined cases: a NULL role or text reads as one space, NULL turns come first,
rows of one turn are ordered by role and text. A NULL conversation is one
conversation. A row whose role has no initial s, u or a (an empty role too) can't
be kept. A row with zero copies only says that its conversation exists. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)  # where an inserted or reroled row leads
SYMBOLS, GONE, REPEATED = 9, 8, 9  # a blank row is GONE, a repeated one too
BLOCK = 4
CHUNK_ROWS, CHUNK_BYTES = 4096, 4 << 20
SPACES = " \t\n\x0b\x0c\r"
NEVER = 1 << 20


def keeps(state: int, symbol: int) -> int | None:
    """The state after keeping a row, None where that is not allowed."""
    initial = symbol >> 1
    if initial == 0 and state == START:
        return AFTER_S
    if initial == 1 and state != AFTER_U:
        return AFTER_U
    return AFTER_A if initial == 2 and state == AFTER_U else None


def choices(state: int, symbol: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state after) of each way to consume a row."""
    out = [("D", DELETE, state)]
    if symbol != GONE:
        late = TRUNCATED * (symbol & 1)
        kept = keeps(state, symbol)
        if kept is not None:
            out.append(("K", KEEP + late, kept))
        out.append(("R", REROLE + late, NEXT[state]))
    return out


def with_inserts(costs: list[int]) -> list[int]:
    u = min(costs[AFTER_U], INSERT + costs[AFTER_A])
    a = min(costs[AFTER_A], INSERT + costs[AFTER_U])
    return [min(costs[START], INSERT + u), min(costs[AFTER_S], INSERT + u), u, a]


def before(symbol: int, behind: list[int]) -> list[int]:
    """Cheapest completion from each state ahead of a symbol, from those behind it."""
    return with_inserts([min(c + behind[s] for _, c, s in choices(q, symbol)) for q in range(4)])


END = tuple(with_inserts([0, NEVER, NEVER, 0]))
TAIL = ["I" * (cost // INSERT) for cost in END]


class Tables:
    """All normalised vectors, and the transitions of all blocks of up to ``block`` symbols."""

    def __init__(self, block: int = BLOCK):
        self.block, self.vectors, self.expanded = block, [END], {}
        number, first = {END: 0}, []
        for vector in self.vectors:  # grows while it is read
            steps = []
            for symbol in range(SYMBOLS):
                ahead = before(symbol, list(vector))
                least = min(ahead)
                ahead = tuple(x - least for x in ahead)
                if ahead not in number:
                    number[ahead] = len(self.vectors)
                    self.vectors.append(ahead)
                steps.append((number[ahead], least))
            first.append(steps)
        n = len(self.vectors)
        ahead = np.asarray([[first[v][s][0] for v in range(n)] for s in range(SYMBOLS)], np.int64)
        cost = np.asarray([[first[v][s][1] for v in range(n)] for s in range(SYMBOLS)], np.int64)
        self.step = ahead
        leave = np.asarray([[[self.letters(s, v, q)[1] for q in range(4)] for v in range(n)] for s in range(SYMBOLS)], np.int64)
        one = (ahead, cost, leave)
        self.blocks = [self.nothing(), one]
        while len(self.blocks) <= block:
            self.blocks.append(self.compose(one, self.blocks[-1]))

    def nothing(self) -> tuple[np.ndarray, ...]:
        n = len(self.vectors)
        return np.arange(n)[None], np.zeros((1, n), np.int64), np.tile(np.arange(4), (1, n, 1))

    @staticmethod
    def compose(a: tuple, b: tuple) -> tuple[np.ndarray, ...]:
        """Every block of ``a`` followed by every block of ``b``."""
        (va, ca, sa), (vb, cb, sb) = a, b
        n = vb.shape[1]
        v = va[:, vb].reshape(-1, n)
        c = (ca[:, vb] + cb[None]).reshape(-1, n)
        left = sa[:, vb]  # states of the first, for each vector behind the second
        s = np.take_along_axis(np.broadcast_to(sb[None], left.shape), left, axis=3).reshape(-1, n, 4)
        return v, c, s

    def letters(self, symbol: int, behind: int, state: int) -> tuple[str, int]:
        """The edits of one symbol, inserts ahead of it first, and the state after."""
        w, ahead, out = self.vectors[behind], before(symbol, list(self.vectors[behind])), ""
        while True:
            ways = [(x, s) for x, c, s in choices(state, symbol) if c + w[s] == ahead[state]]
            if INSERT + ahead[NEXT[state]] == ahead[state]:
                ways.append(("I", -1))
            letter, after = min(ways)
            out += letter
            if after >= 0:
                return out, after
            state = NEXT[state]

    def expand(self, symbols: bytes, behind: int, state: int) -> tuple[str, int]:
        """The edits of a block, from the vectors inside it (worked out backward), and the state after."""
        found = self.expanded.get((symbols, behind, state))
        if found is None:
            inside = [behind]
            for symbol in reversed(symbols[1:]):
                inside.append(int(self.step[symbol, inside[-1]]))
            out, q = "", state
            for symbol, vector in zip(symbols, reversed(inside)):
                letters, q = self.letters(symbol, vector, q)
                out += letters
            found = self.expanded[symbols, behind, state] = out, q
        return found

    def split(self, symbols: bytes) -> list[tuple[bytes, int]]:
        """(block, its number) of a run; the first block takes the remainder."""
        head = len(symbols) % self.block
        cuts = ([0] if head else []) + list(range(head, len(symbols), self.block))
        parts = [symbols[i:j] for i, j in zip(cuts, [*cuts[1:], len(symbols)])]
        return [(p, sum(s * SYMBOLS ** (len(p) - 1 - i) for i, s in enumerate(p))) for p in parts]

    def trace(self, symbols: bytes, behind: int = 0, state: int = START) -> tuple[str, int, int, int]:
        """(edits, state after, vector ahead, cost between the vectors) of a run of symbols."""
        blocks, vectors, cost = self.split(symbols), [behind], 0
        for part, code in reversed(blocks):
            v, c, _ = self.blocks[len(part)]
            cost += int(c[code, vectors[-1]])
            vectors.append(int(v[code, vectors[-1]]))
        out = []
        for (part, _), vector in zip(blocks, reversed(vectors[:-1])):
            letters, state = self.expand(part, vector, state)
            out.append(letters)
        return "".join(out), state, vectors[-1], cost

    def function(self, symbols: bytes) -> bytes:
        """A run as a whole: vector ahead, cost and states after, for every vector behind."""
        n = len(self.vectors)
        v, c, s = np.arange(n), np.zeros(n, np.int64), np.tile(np.arange(4), (n, 1))
        for part, code in reversed(self.split(symbols)):
            bv, bc, bs = (x[code] for x in self.blocks[len(part)])
            s = np.take_along_axis(s, bs[v], axis=1)
            c, v = c + bc[v], bv[v]
        return np.concatenate([v, c, s.ravel()]).astype(np.int64).tobytes()

    def read(self, function: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, all_ = len(self.vectors), np.frombuffer(function, np.int64)
        return all_[:n], all_[n : 2 * n], all_[2 * n :].reshape(n, 4)


def code_of(role: str, text: str, repeated: bool) -> int:
    body = text.rstrip(SPACES)
    if not body:
        return GONE
    if repeated:
        return REPEATED
    return 2 * ("sua".index(role[0]) if role and role[0] in "sua" else 3) + (body[-1] not in ".!?")


def repaired_lines(audit: str, state: int, roles: list[str], texts: list[str]) -> str:
    """The ``role:text`` lines that the edits of some rows leave."""
    out, i = [], 0
    for letter in audit:
        if letter == "D":
            i += 1
        elif letter == "K":
            out.append(f"{roles[i]}:{texts[i]}")
            state, i = {"s": AFTER_S, "u": AFTER_U, "a": AFTER_A}[roles[i][0]], i + 1
        else:
            state = NEXT[state]
            role = "user" if state == AFTER_U else "assistant"
            out.append(f"{role}:" + (texts[i] if letter == "R" else ""))
            i += letter == "R"
    return "\n".join(out)


def illegal_pairs(initials: str) -> int:
    return sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))


def initials_of(roles: list[str]) -> str:
    return "".join(r[:1] or " " for r in roles)


class Rows:
    """The rows of the current conversation, or of its current chunk."""

    def __init__(self) -> None:
        self.roles, self.texts, self.turns, self.size = [], [], [], 0

    def add(self, turn: int | None, role: str, text: str, copies: int) -> None:
        self.roles += [role] * copies
        self.texts += [text] * copies
        self.turns += [turn] * (copies > 0 and turn is not None)
        self.size += copies * (len(role) + len(text))

    def codes(self) -> bytes:
        seen, out = set(), bytearray()
        for pair in zip(self.roles, self.texts):
            out.append(code_of(*pair, pair in seen))
            seen.add(pair)
        return bytes(out)


COUNTS = ("cost", "gaps", "blank", "duplicate", "truncated", "illegal")


def counts_of(codes: bytes) -> list[int]:
    return [codes.count(GONE), codes.count(REPEATED), sum(c < GONE and c & 1 for c in codes)]


def symbols_of(codes: bytes) -> bytes:
    return codes.replace(bytes([REPEATED]), bytes([GONE]))


def _walk(rows: DataFrame, kind: str, id_type: pa.DataType) -> DataFrame:
    """Finished conversations (``whole``), and the chunks of the others."""
    schema = pa.schema([
        ("conv", id_type), ("whole", pa.bool_()), ("pid", pa.int64()), ("chunk", pa.int32()),
        *((c, pa.int64()) for c in COUNTS), ("audit", pa.string()), ("repaired", pa.string()),
        ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("codes", pa.binary()), ("digests", pa.binary()),
        ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64()),
    ])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, pid, out, size = Tables(), TaskContext.get().partitionId(), [], 0

        def finished(conv: object, held: Rows) -> tuple:
            codes = held.codes()
            audit, state, vector, cost = tables.trace(symbols_of(codes))
            cost += tables.vectors[vector][START]
            audit += TAIL[state]
            gaps = held.turns[-1] - held.turns[0] + 1 - len(set(held.turns)) if held.turns else 0
            return (conv, True, pid, 0, cost, gaps, *counts_of(codes), illegal_pairs(initials_of(held.roles)),
                    audit, repaired_lines(audit, START, held.roles, held.texts), *[None] * 7)

        def piece(conv: object, held: Rows, chunk: int) -> tuple:
            digests = b"".join(hashlib.blake2b(f"{len(r)}:{r}{t}".encode(), digest_size=16).digest() for r, t in zip(held.roles, held.texts))
            ends = (held.turns[0], held.turns[-1]) if held.turns else (None, None)
            return (conv, False, pid, chunk, *[None] * 8, held.roles, held.texts, held.codes(), digests, *ends, len(set(held.turns)))

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        first, chunk, held, now = True, 0, None, None
        for batch in batches:
            for conv, turn, role, text, copies in zip(*(c.to_pylist() for c in batch.columns)):
                if held is None or conv != now:
                    if held is not None:
                        row = piece(now, held, chunk) if first or chunk else finished(now, held)
                        out.append(row)
                        size += held.size
                        first = False
                    now, held, chunk = conv, Rows(), 0
                held.add(turn, role, text, copies)
                if len(held.roles) >= CHUNK_ROWS or held.size >= CHUNK_BYTES:
                    out.append(piece(now, held, chunk))
                    size += held.size
                    held, chunk = Rows(), chunk + 1
                if size >= CHUNK_BYTES or len(out) >= CHUNK_ROWS:
                    yield batch_of()
                    out.clear()
                    size = 0
        if held is not None:
            out.append(piece(now, held, chunk))
        if out:
            yield batch_of()

    columns = (f"conv {kind}, whole boolean, pid long, chunk int, " + ", ".join(f"{c} long" for c in COUNTS)
               + ", audit string, repaired string, roles array<string>, texts array<string>, codes binary, digests binary"
               ", first_turn long, last_turn long, turns long")
    return rows.mapInArrow(walk, columns)


KEY = ["ck", "pid", "chunk"]


def _with_repeats(pieces: DataFrame) -> DataFrame:
    """(ck, pid, chunk, codes, function, ...) with the rows that an earlier chunk holds marked as repeated."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [{d[i : i + 16] for i in range(0, len(d), 16)} for d in batch.column(3).to_pylist()]
            row = pa.array(np.repeat(np.arange(len(digests)), [len(d) for d in digests]), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).take(row) for i in range(3)), pa.array([x for d in digests for x in d], pa.binary())],
                names=[*KEY, "digest"])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables()
        for batch in batches:
            codes_out, functions, counts, ends = [], [], [], []
            for codes, digests, initials, late in zip(*(batch.column(c).to_pylist() for c in ("codes", "digests", "initials", "late"))):
                codes, late = bytearray(codes), set(late or ())
                for i in range(len(codes) if late else 0):
                    if codes[i] != GONE and digests[16 * i : 16 * i + 16] in late:
                        codes[i] = REPEATED
                codes = bytes(codes)
                codes_out.append(codes)
                functions.append(tables.function(symbols_of(codes)))
                counts.append([*counts_of(codes), illegal_pairs(initials)])
                ends.append(initials[:1] + initials[1:][-1:])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in (*KEY, "first_turn", "last_turn", "turns")), pa.array(ends, pa.string()),
                 pa.array(codes_out, pa.binary()), pa.array(functions, pa.binary()), pa.array(counts, pa.list_(pa.int64()))],
                names=[*KEY, "first_turn", "last_turn", "turns", "ends", "codes", "function", "counts"])

    held = pieces.select(*KEY, "digests").mapInArrow(distinct, "ck string, pid long, chunk int, digest binary")
    firsts = held.groupBy("ck", "digest").agg(F.min(F.struct("pid", "chunk")).alias("first"), F.count(F.lit(1)).alias("m")).where("m > 1")
    late = held.join(firsts, ["ck", "digest"]).where(F.struct("pid", "chunk") > F.col("first")).groupBy(*KEY).agg(F.collect_list("digest").alias("late"))
    initials = F.concat_ws("", F.transform("roles", lambda r: F.coalesce(F.nullif(F.substring(r, 1, 1), F.lit("")), F.lit(" "))))
    light = pieces.select(*KEY, "codes", "digests", initials.alias("initials"), "first_turn", "last_turn", "turns")
    return light.join(late, KEY, "left").mapInArrow(
        mark, "ck string, pid long, chunk int, first_turn long, last_turn long, turns long, ends string, "
              "codes binary, function binary, counts array<bigint>")


def _plan(marked: DataFrame) -> DataFrame:
    """(ck, pid, chunk, behind, state, last, counts): where each chunk begins and what is behind it."""

    def plan(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: (r["pid"], r["chunk"]))
        tables, behind, cost = Tables(), 0, 0
        for row in reversed(rows):
            v, c, row["leave"] = tables.read(row["function"])
            row["behind"] = behind
            cost += int(c[behind])
            behind = int(v[behind])
        state, end, gaps, low, high = START, "", 0, None, None
        for row in rows:
            row["state"] = state
            state = int(row["leave"][row["behind"], state])
            row["counts"][-1] += illegal_pairs(end + row["ends"][:1])
            end = row["ends"][-1:] or end
            if row["turns"]:
                gaps += row["turns"] - (high == row["first_turn"])
                low = row["first_turn"] if low is None else low
                high = row["last_turn"]
        gaps = high - low + 1 - gaps if low is not None else 0
        head = [[cost + tables.vectors[behind][START], gaps]] + [[0, 0]] * (len(rows) - 1)
        tails = [None] * (len(rows) - 1) + [TAIL[state]]
        return pa.table({
            "ck": pa.array([r["ck"] for r in rows], pa.string()), "pid": pa.array([r["pid"] for r in rows], pa.int64()),
            "chunk": pa.array([r["chunk"] for r in rows], pa.int32()), "behind": pa.array([r["behind"] for r in rows], pa.int32()),
            "state": pa.array([r["state"] for r in rows], pa.int32()), "tail": pa.array(tails, pa.string()),
            "counts": pa.array([h + r["counts"] for h, r in zip(head, rows)], pa.list_(pa.int64())),
        })

    return marked.drop("codes").groupBy("ck").applyInArrow(
        plan, "ck string, pid long, chunk int, behind int, state int, tail string, counts array<bigint>")


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables = Tables()
    for batch in batches:
        audits, texts = [], []
        for row in batch.to_pylist():
            audit = tables.trace(symbols_of(row["codes"]), row["behind"], row["state"])[0] + (row["tail"] or "")
            audits.append(audit)
            texts.append(repaired_lines(audit, row["state"], row["roles"], row["texts"]))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("conv", *KEY, "counts")), pa.array(audits, pa.string()), pa.array(texts, pa.string())],
            names=["conv", *KEY, "counts", "audit", "repaired"])


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", copies: Column | None = None) -> DataFrame:
    """(conv, whole, pid, chunk, cost, gaps, blank, duplicate, truncated, illegal, audit, repaired).

    One row for a conversation that one task could repair (``whole``), else one
    row per chunk, ordered by (pid, chunk): counts add up, edits and repaired
    lines are joined. ``copies`` says how often a row stands (default: once).
    """
    kind = rows.schema[conv_col].dataType.simpleString()
    source = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        *[F.coalesce(F.col(c), F.lit(" ")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))],
        (F.lit(1) if copies is None else copies).cast("int").alias("copies"),
    )
    id_type = source.select("conv").limit(0).toArrow().schema.field("conv").type
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), "role", "text"]
    walked = _walk(source.orderBy(*order), kind, id_type).checkpoint()
    key = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit(""))
    pieces = walked.where("NOT whole").withColumn("ck", key)
    marked = _with_repeats(pieces).checkpoint()
    plan = _plan(marked).join(marked.select(*KEY, "codes"), KEY)
    chunks = pieces.select("conv", *KEY, "roles", "texts").join(plan, KEY).mapInArrow(
        _traced, f"conv {kind}, ck string, pid long, chunk int, counts array<bigint>, audit string, repaired string")
    numbers = [F.col("counts")[i].alias(c) for i, c in enumerate(COUNTS)]
    return walked.where("whole").select("conv", "whole", "pid", "chunk", *COUNTS, "audit", "repaired").union(
        chunks.select("conv", F.lit(False), "pid", "chunk", *numbers, "audit", "repaired"))


def digests(parts: DataFrame, conv_name: str = "conv_id") -> DataFrame:
    """One row per conversation of :func:`repair`, its repaired lines as a SHA-256."""
    kind = parts.schema["conv"].dataType.simpleString()
    id_type = parts.select("conv").limit(0).toArrow().schema.field("conv").type

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv", id_type), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())])
        now, state = None, None

        def done() -> pa.RecordBatch:
            conv, sums, audit, digest, _ = state
            row = (conv, *sums, "".join(audit), digest.hexdigest())
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for row in batch.to_pylist():
                if state is None or row["ck"] != now:
                    if state is not None:
                        yield done()
                    now, state = row["ck"], [row["conv"], [0] * len(COUNTS), [], hashlib.sha256(), False]
                state[1] = [a + row[c] for a, c in zip(state[1], COUNTS)]
                state[2].append(row["audit"])
                if row["repaired"]:
                    state[3].update((("\n" if state[4] else "") + row["repaired"]).encode())
                    state[4] = True
        if state is not None:
            yield done()

    key = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit(""))
    cut = parts.where("NOT whole").withColumn("ck", key).repartition("ck").sortWithinPartitions(*KEY)
    joined = cut.mapInArrow(stream, f"conv {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string")
    whole = parts.where("whole").select("conv", *COUNTS, "audit", F.sha2("repaired", 256).alias("repaired_sha256"))
    return whole.union(joined).withColumnRenamed("conv", conv_name)


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, copies): rows with reproducible faults, by crc32 of ``conv:turn``."""
    named = {n: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for n, c in
             (("conv", conv_col), ("turn", turn_col), ("role", role_col), ("text", text_col))}
    draw = F.crc32(F.concat(named["conv"], F.lit(":"), named["turn"]).cast("binary")) % 20
    return rows.select(
        conv_col, turn_col, F.when(draw == 4, "user").otherwise(named["role"]).alias(role_col),
        F.when(draw == 1, "").when(draw == 2, F.regexp_replace(named["text"], "[.!?]", "")).otherwise(named["text"]).alias(text_col),
        F.when(draw == 0, 0).when(draw == 3, 2).otherwise(1).alias("copies"),
    )
