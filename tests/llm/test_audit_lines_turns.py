"""Source divergence, conversation repair and line dedup against brute force, and their edge cases."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import conversations, divergence, line_dedup
from quarry.llm.queries import op12_conversation_repair
from quarry.session import table

SF = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\x0c\r"

# --- operator 11 -----------------------------------------------------------


def brute_divergence(rows, min_docs, top):
    docs = [((lang or ""), (source or ""), (text or "")) for lang, source, text in rows]
    words = []
    for lang, source, text in docs:
        out, now = [], ""
        for c in text + " ":
            if c.isascii() and not c.isalpha():
                if now:
                    out.append(now)
                now = ""
            else:
                now += c.lower() if c.isascii() else c
        words.append((lang, source, out))
    held = defaultdict(Counter)
    for lang, _, ws in words:
        held[lang].update(set(ws))
    out = []
    for lang in {d[0] for d in docs}:
        kept = sorted(w for w, n in held[lang].items() if n >= min_docs)
        sources = sorted({d[1] for d in docs if d[0] == lang})
        counts = {s: Counter() for s in sources}
        for x, s, ws in words:
            if x == lang:
                counts[s].update(w for w in ws if w in set(kept))
        whole = sum(counts.values(), Counter())

        def share(c, w):
            return 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + len(kept))

        for s in sources:
            part = [(t, sum((share(counts[s], w) - share(counts[t], w)) ** 2 // share(counts[t], w) for w in kept)) for t in sources if t != s]
            for i, (t, v) in enumerate(sorted(part, key=lambda x: (-x[1], x[0].encode())), 1):
                out.append((lang, s, "pair", t, v, i))
            part = [(w, (share(counts[s], w) - share(whole, w)) ** 2 // share(whole, w)) for w in kept
                    if counts[s][w] and share(counts[s], w) > share(whole, w)]
            for i, (w, v) in enumerate(sorted(part, key=lambda x: (-x[1], x[0].encode()))[:top], 1):
                out.append((lang, s, "term", w, v, i))
    return sorted(out)


def corpus(seed=5, n=120):
    rng = random.Random(seed)
    vocabulary = ["a", "Abc", "abcd", "abcde", "abcdefgh", "abcdefghi", "abcdefghij", "ß", "straße", "日本語" * 4, "日本語" * 5, "x" * 70]
    rows = []
    for _ in range(n):
        words = [rng.choice(vocabulary) + rng.choice(["", "", "q", str(rng.randint(0, 3))]) for _ in range(rng.randint(0, 12))]
        rows.append((rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "s3", None]), " ".join(words) or None))
    return rows + [("xx", "only", "alone"), ("xx", "other", None), ("yy", "single", "no pair here")]


@pytest.mark.parametrize(("first", "buckets", "cells"), [(8, 1024, 1 << 19), (1, 2, 8), (4, 1, 1)])
def test_divergence_equals_brute_force(spark, monkeypatch, first, buckets, cells):
    for name, value in (("FIRST", first), ("BUCKETS", buckets), ("CELLS", cells), ("ENTRIES", 40)):
        monkeypatch.setattr(divergence, name, value)
    rows = corpus()
    docs = spark.createDataFrame(rows, "lang string, source string, text string").withColumn("n", F.lit(1)).withColumn("key", F.lit("k"))
    got = [tuple(r) for r in divergence.divergence(docs.repartition(5), top=4).collect()]
    assert sorted(got) == brute_divergence(rows, 3, 4)


def test_divergence_of_nothing(spark):
    empty = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.divergence(empty).count() == 0


def test_prefixes_and_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "FIRST", 4)
    assert [(n, sorted(p)) for n, p in divergence.levels_of({b"abcdefghi", b"abcd", b"abcde"})] == [(4, [b"abcd"]), (8, [b"abcdefgh"])]
    assert [divergence.parent_length(n) for n in (1, 4, 5, 8, 9, 16, 17)] == [0, 0, 4, 4, 8, 8, 16]
    monkeypatch.setattr(divergence, "PIECE", 3)
    text = "Äbc d'E  fgh1i".encode()
    assert [t for part in divergence.terms_of(text) for t in part] == ["Äbc".encode(), b"d", b"e", b"fgh", b"i"]


def test_discarded_prefixes_hide_their_terms():
    counts = divergence.Counts()
    for text in (b"prefixone prefixone", b"prefixtwo", b"prefixtwo prefixone", b"prefixtwo", b"prefaced"):
        counts.add("s", text)
    blocks = [divergence.pickle.loads(divergence.zlib.decompress(b)) for _, b in counts.blocks()]
    kept = [divergence.refined([b], 3) for b in blocks]
    assert [(t, c.tolist()) for t, _, c in kept if t] == [([b"prefixtwo"], [[3]])]
    assert divergence.share(np.asarray([2 * 10**12]), np.asarray([3 * 10**12 + 7])).tolist() == [1 + 10**9 * (2 * 10**12 + 1) // (3 * 10**12 + 7)]


# --- operator 12 -----------------------------------------------------------


def brute_repair(rows):
    """(counts, audit, repaired) of ordered (turn, role, text) by a search over all cheapest strings."""
    faults, seen = [], set()
    for _, role, text in rows:
        body = text.rstrip(SPACES)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    # forward over (rows read, output so far as its last letter): least (cost, audit, output)
    best = {(0, ""): (0, "", ())}
    done = None
    todo = [(0, "", (), 0, "")]
    import heapq
    settled = set()
    while todo:
        cost, audit, output, i, last = heapq.heappop(todo)
        if (i, last) in settled:
            continue
        settled.add((i, last))
        if i == len(rows) and last in ("", "a"):
            done = cost, audit, output
            break
        ways = []
        new = "a" if last == "u" else "u"
        ways.append((3, "I", i, new, ("user:" if new == "u" else "assistant:",)))
        if i < len(rows):
            _, role, text = rows[i]
            ways.append((4, "D", i + 1, last, ()))
            if faults[i] not in ("blank", "duplicate"):
                late = 3 * (faults[i] == "truncated")
                x = role[:1]
                if (x == "s" and last == "") or (x == "u" and last != "u") or (x == "a" and last == "u"):
                    ways.append((late, "K", i + 1, x, (f"{role}:{text}",)))
                ways.append((3 + late, "R", i + 1, new, (("user:" if new == "u" else "assistant:") + text,)))
        for c, letter, j, end, line in ways:
            heapq.heappush(todo, (cost + c, audit + letter, output + line, j, end))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (done[0], gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), done[1], hashlib.sha256("\n".join(done[2]).encode()).hexdigest())


def brute_damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv] += []
        role, text = (" " if x is None else x for x in (role, text))
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if draw == 1 else "".join(c for c in text if c not in ".!?") if draw == 2 else text
        role = "user" if draw == 4 else role
        out[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(draw, 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in out.items()}


def talk(seed=3, n=60, most=14):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(n)]:
        for turn in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "Why?", "cut", "", " \n", None, f"row {turn}.", "ß…"])
            rows.append((conv, rng.choice([turn, turn, None, turn * 2]), role, text))
    return rows


def answer(df):
    return {r["conv_id"]: (*(r[c] for c in conversations.COUNTS), r["audit"], r["repaired_sha256"]) for r in df.collect()}


def whole_answer(docs):
    damaged = conversations.damage(docs)
    return answer(conversations.digests(conversations.repair(damaged, copies=F.col("copies"))))


@pytest.mark.parametrize("chunk", [4096, 5, 1])
def test_repair_equals_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(conversations, "CHUNK_ROWS", chunk)
    rows = talk()
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    docs = docs.withColumn("copies", F.lit(7)).withColumn("conv", F.lit(1)).withColumn("chunk", F.lit(1))
    assert whole_answer(docs) == {c: brute_repair(r) for c, r in brute_damage(rows).items()}


def test_repair_query_equals_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert answer(op12_conversation_repair(spark, SF)) == {c: brute_repair(r) for c, r in brute_damage(rows).items()}


def test_one_hot_conversation_of_string_identifiers(spark, monkeypatch):
    monkeypatch.setattr(conversations, "CHUNK_ROWS", 50)
    rng = random.Random(8)
    rows = [("hot" if rng.random() < 0.7 else f"c{i % 40}", i, rng.choice(["user", "assistant", "system"]), rng.choice(["Ok.", f"{i}.", f"{i}"])) for i in range(1500)]
    docs = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    assert whole_answer(docs) == {c: brute_repair(r) for c, r in brute_damage(rows).items()}


def test_tables_equal_single_steps():
    tables, rng = conversations.Tables(), random.Random(1)
    single = conversations.Tables(block=1)
    for _ in range(300):
        run = bytes(rng.randrange(conversations.SYMBOLS) for _ in range(rng.randint(0, 23)))
        assert tables.trace(run) == single.trace(run)
        v, c, s = tables.read(tables.function(run))
        behind, state = rng.randrange(len(tables.vectors)), rng.randrange(4)
        audit, after, ahead, cost = tables.trace(run, behind, state)
        assert (after, ahead, cost) == (s[behind, state], v[behind], c[behind])


def test_conversations_without_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert whole_answer(spark.createDataFrame([], schema)) == {}
    docs = spark.createDataFrame([(1, 0, "user", "gone."), (2, None, "user", "Hi.")], schema)
    none = conversations.digests(conversations.repair(docs, copies=F.when(F.col("conv_id") == 1, 0).otherwise(1)))
    assert answer(none)[1] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


# --- operator 13 -----------------------------------------------------------


def brute_lines(rows, min_chars=20, min_docs=3):
    def key(line):
        line = line.strip(SPACES)
        return "".join(c.lower() if c.isascii() else c for c in line) if len(line) >= min_chars else None

    texts = [(i, (t or "").split("\n")) for i, t in rows]
    docs, owner = Counter(), {}
    for i, lines in texts:
        for k in {key(line) for line in lines} - {None}:
            docs[k] += 1
            if i is not None and (k not in owner or owner[k] < i):
                owner[k] = i
    out = []
    for i, lines in texts:
        stay = [x for x in lines if not ((k := key(x)) and docs[k] >= min_docs and k in owner and (i is None or owner[k] != i))]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def lines_of(seed=2, n=200, kind=int):
    rng = random.Random(seed)
    pool = [f"This line stands in documents {i:03d}" for i in range(60)] + ["ä" * 19, "ä" * 20, "Ä" * 20, "short", "", "\t "]
    rows = []
    for i in range(n):
        text = "\n".join(rng.choice(["", "  ", "\t"]) + (x.upper() if rng.random() < 0.2 else x) + rng.choice(["", " ", "\r"])
                         for x in (rng.choice(pool) for _ in range(rng.randint(0, 9))))
        rows.append((None if rng.random() < 0.03 else kind(i // 2 if rng.random() < 0.2 else i), rng.choice([text, text, text, None, ""])))
    common = "everyone holds this very common line"
    rows += [(kind(1000 + i), common + f"\nown text number {i} of this one") for i in range(60)]
    rows += [(None, "a line that only rows without an identifier hold")] * 4 + [(kind(5000), "one line three times over\n" * 3)] * 3
    return rows


@pytest.mark.parametrize("kind", [int, str])
@pytest.mark.parametrize(("heavy", "keys"), [(1 << 16, 1 << 16), (8, 4)])  # the second: nearly all keys in many shards
def test_lines_equal_brute_force(spark, monkeypatch, kind, heavy, keys):
    monkeypatch.setattr(line_dedup, "HEAVY", heavy)
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", keys)
    monkeypatch.setattr(line_dedup, "ENTRIES", 50)
    rows = lines_of(kind=kind)
    docs = spark.createDataFrame(rows, f"doc_id {'long' if kind is int else 'string'}, text string")
    docs = docs.withColumns({c: F.lit(1) for c in ("id", "me", "uid", "shard", "kind", "lost")})
    got = [tuple(r) for r in line_dedup.dedup_lines(docs.repartition(6)).collect()]
    assert sorted(got, key=str) == brute_lines(rows)


def test_lines_of_nothing(spark):
    assert line_dedup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_line_table_finds_its_keys_only():
    rng = np.random.default_rng(3)
    hi, lo = rng.integers(0, 2**63, (2, 5000)).astype(np.uint64)
    arrays = line_dedup.LineTable.build(hi, lo, np.arange(5000), -np.arange(5000))
    found = line_dedup.LineTable(*arrays)
    at = found.find(hi, lo)
    assert sorted(at) == list(range(5000))
    assert (found.counts[at] == np.arange(5000)).all() and (found.owners[at] == -np.arange(5000)).all()
    assert (found.find(lo, hi) == -1).all()
    assert 8 * len(arrays[1]) < 5 * 5000  # bits of the hash itself, per key
    none = line_dedup.LineTable(*line_dedup.LineTable.build(hi[:0], lo[:0], hi[:0], hi[:0].astype(np.int64)))
    assert (none.find(hi, lo) == -1).all()
