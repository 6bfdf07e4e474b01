"""Operators against brute force, libraries and exact round trips."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from conftest import SMALL
from quarry.llm import decontaminate, exact_dedup, graph, main_text, near_duplicates, ppm_language, prefix_tokens, sharding, toxicity
from quarry.llm.wordhash import plain_words, utf8

MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())


def test_words_do_not_depend_on_pieces(monkeypatch):
    data, offsets = utf8(pa.array(["Ab  cd", "", None, "ab\tcd é" * 50, "x"]))
    whole = plain_words().words(data, offsets)
    monkeypatch.setattr("quarry.llm.wordhash.PIECE", 7)
    pieces = plain_words().words(data, offsets)
    assert all((a == b).all() for a, b in zip(whole, pieces))
    assert len(set(whole[2].tolist())) == len({"ab", "cd", "é", "éab", "x"})


def test_code_lengths_are_exact(monkeypatch):
    train = [("en", "the cat and the dog sat on the mat of the house"), ("de", "der hund und die katze sassen auf der matte")]
    counts = Counter()
    for lang, text in train:
        raw = text.encode()
        for k in range(ppm_language.DEPTH + 1):
            for i in range(len(raw) - k):
                counts[lang, raw[i : i + k], raw[i + k]] += 1
    rows = [(lang, int.from_bytes(c + bytes([b]), "big") | (len(c) + 1) << 56, n) for (lang, c, b), n in counts.items()]
    model = ppm_language.build(["de", "en"], rows)
    follow = defaultdict(dict)
    for (lang, c, b), n in counts.items():
        follow[lang, c][b] = n

    def cost(lang, context, byte):
        f = follow.get((lang, context))
        if f and byte in f:
            return -math.log2(f[byte] / (sum(f.values()) + len(f)))
        escape = -math.log2(len(f) / (sum(f.values()) + len(f))) if f else 0
        return escape + (cost(lang, context[1:], byte) if context else 8.0)

    texts = ["the cat sat", "die hunde und", "", "zzz é", "the house of the dog " * 40]
    want = [[sum(cost(lang, t.encode()[max(0, j - 4) : j], t.encode()[j]) for j in range(len(t.encode()))) for lang in ("de", "en")] for t in texts]
    data, offsets = utf8(pa.array(texts))
    assert np.allclose(model.code_lengths(data, offsets), want, rtol=1e-5)
    monkeypatch.setattr(ppm_language, "PIECE", 100)
    assert np.allclose(model.code_lengths(data, offsets), want, rtol=1e-5)


def test_trees_stay_whole_with_many_languages():
    rng = np.random.default_rng(5)
    rows, samples = [], {}
    for i in range(30):
        name, text = f"l{i:02}", bytes(rng.integers(0, 250, 4000 if i else 60).astype(np.uint8).tolist())
        samples[name] = text
        counts = Counter(text[j : j + k + 1] for k in range(ppm_language.DEPTH + 1) for j in range(len(text) - k))
        rows += [(name, int.from_bytes(g, "big") | len(g) << 56, n) for g, n in counts.items()]
    model = ppm_language.build(sorted(samples), rows)
    data = np.frombuffer(b"".join(samples[n][:60] for n in model.languages), np.uint8)
    bits = model.code_lengths(data, np.arange(0, len(data) + 1, 60))
    assert [model.languages[i] for i in bits.argmin(axis=1)] == model.languages
    for i, name in enumerate(model.languages):
        text, want = samples[name], 0.0
        for p in range(60):  # every gram of the text is in its own tree, at full depth
            context = text[max(0, p - ppm_language.DEPTH) : p]
            after = [text[j + len(context)] for j in range(len(text) - len(context)) if text.startswith(context, j)]
            want -= math.log2(after.count(text[p]) / (len(after) + len(set(after))))
        assert abs(bits[i, i] - want) < 1e-3 * want


def test_language_accuracy_on_rows_not_learned_from(spark):
    rows = E.queries()["op1_language_id"](spark, MID).join(spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right = rows.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.98


def test_machine_equals_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    machine = toxicity.Machine(0.3, rng.normal(0, 0.3, (toxicity.TERMS, 5)).astype(np.float32))
    rows = [[1, 5, 9], [], [7], [2, 3, 5, 8, 11]]
    want = [
        0.3 + sum(machine.table[i, 0] for i in r) + sum(float(machine.table[i, 1:] @ machine.table[j, 1:]) for i, j in itertools.combinations(r, 2))
        for r in rows
    ]
    got = machine.raw(np.array(sum(rows, []), np.int32), np.cumsum([len(r) for r in rows]))
    assert np.allclose(got, want, atol=1e-4)


def test_machine_learns_a_pair_of_terms():
    rng = random.Random(3)
    rows = [([t for t in (1, 2) if rng.random() < 0.5] + [rng.randint(10, 30)]) for _ in range(1500)]
    labels = np.array([float(1 in r and 2 in r) for r in rows])
    terms, ends = np.array(sum(rows, []), np.int32), np.cumsum([len(r) for r in rows])
    machine = toxicity.fit(terms, ends, labels, passes=30)
    assert ((machine.score(terms, ends) >= 0.5) == labels).mean() > 0.97


def test_toxicity_on_rows_not_learned_from(spark):
    rows = E.queries()["op3_toxicity"](spark, MID).join(spark.read.parquet(f"{MID}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r["predicted"] for r in rows if not r["toxic"]) == 0
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    assert sum(toxic) >= 0.6 * len(toxic)


def test_trie_counts_and_spills():
    rng = random.Random(5)
    keys = [bytes(rng.choices(b"ab", k=rng.randint(0, 8))) for _ in range(600)]
    trie, spilled = exact_dedup.PatriciaTrie(), []
    for i, key in enumerate(keys):
        trie.insert(key, (0, False, i), 1)
        if i % 150 == 149:
            spilled += list(trie.spill())
    rows, owner = Counter(), {}
    for key, o, n in [*spilled, *trie.texts()]:
        rows[key] += n
        owner[key] = min(o, owner.get(key, o))
    assert rows == Counter(keys) and all(owner[k][2] == keys.index(k) for k in rows)


def test_equal_hashes_do_not_join_texts(spark, monkeypatch):
    class Same:
        def __init__(self, body):
            pass

        def digest(self):
            return b"\0" * 8

    monkeypatch.setattr(exact_dedup.xxhash, "xxh64", Same)
    rows = [(i, t) for i, t in enumerate(["ab", "a b", "ba", "b", "ab", "bb"])]
    found = exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["keep_id"] for r in found} == {0: 1, 1: 1, 2: 2, 3: 3, 4: 1, 5: 5}


def test_growing_a_tree_moves_rows_into_the_new_subtree_only(spark):
    ids = spark.range(4000).select(F.col("id").cast("string").alias("k"))
    old, new = sharding.even_tree(), sharding.grown(sharding.even_tree(), 3.0)
    rows = sharding.place(sharding.place(ids, F.col("k"), old, "a"), F.col("k"), new, "b").collect()
    assert {r["b"] for r in rows if r["a"] != r["b"]} == {24}
    sizes = Counter(r["a"] for r in rows)
    assert set(sizes) == set(range(24)) and min(sizes.values()) > 100
    assert 0.07 < sum(r["b"] == 24 for r in rows) / 4000 < 0.16
    heavy = sharding.Node("root", (*old.children[:1], sharding.Node("r1", old.children[1].children[:2])))
    rows = sharding.place(sharding.place(ids, F.col("k"), old, "a"), F.col("k"), heavy, "b").collect()
    assert all(r["a"] == r["b"] or r["a"] >= 12 for r in rows)  # rows of the lighter region move out or within


def test_shards_query(spark, texts):
    rows = E.queries()["op6_shards"](spark, SMALL).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["size"] == len((texts[r["doc_id"]] or "").encode()) + 8
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>Head &amp; line</h1><p>First   <b>bold</b><br>text.</p><aside>side</aside><p>Zz.</p><div class="ad">Buy</div>
<form><p>Name</p><input></form><section class="comments"><p>the best of the comments, and it is a long one that goes on</p></section>
<p>Last &lt;one&gt;</p></article><footer>&copy; the owner</footer></body>"""


def test_main_text():
    reader, stops = main_text.Reader(), set(main_text.STOP_WORDS)
    assert main_text.main_text(PAGE, reader, stops) == "Head & line\nFirst bold text.\nZz.\nLast <one>"
    plain = "<div>Menu</div><p>" + "the cat of the house is in it and that was for the dog " * 4 + "</p><p>Short one.</p><p>" + "and it was the best of the days for all that was in the world " * 4 + "</p>"
    found = main_text.main_text(plain, reader, stops).split("\n")
    assert len(found) == 3 and found[1] == "Short one."
    assert main_text.main_text("<article><p>Only <b>this", reader, stops) == "Only this"


def test_hidden_elements_end_where_they_should():
    reader, stops = main_text.Reader(), set(main_text.STOP_WORDS)
    first, last = "It was the best of times and it was the worst of times.", "The end of the story is not here, but in the next one."
    for odd in (
        '<svg class="i" />', "<svg><path d='M0'>", "<button>Buy", "<p>Size <select><option>S<option>M</p>", "<option>S", "<math/>",
        "<button><span>Buy", "<object data='x'>", "<iframe src='x'>", "<noscript>", "<template/>",
        "<svg><title>t</title><text>Buy</text></svg>", "<select><option>S<option>M</select>", "<button><div>Buy</div></button>",
    ):
        page = f"<body><article><p>{first}</p>{odd}<p>{last}</p></article><footer>Legal <button>Top</button></footer></body>"
        text = main_text.main_text(page, reader, stops)
        assert text.replace("Size\n", "") == f"{first}\n{last}", odd
    page = f"<article><title-bar>Tales</title-bar><p>{first}</p><button-group><p>{last}</p></button-group></article>"
    assert main_text.main_text(page, reader, stops) == f"Tales\n{first}\n{last}"


def test_pages_in_other_languages_and_with_teasers():
    reader, stops = main_text.Reader(), set(main_text.STOP_WORDS)
    menu = "<div><a href='a'>Home</a> <a href='b'>About us and the news</a></div>"
    for text in (
        "\u0412 \u043d\u0430\u0447\u0430\u043b\u0435 \u0431\u044b\u043b\u043e \u0441\u043b\u043e\u0432\u043e, \u0438 \u0441\u043b\u043e\u0432\u043e \u0431\u044b\u043b\u043e \u0443 \u043d\u0435\u0433\u043e. " * 6,
        "Litwo, ojczyzno moja, ty jeste\u015b jak zdrowie, ile ci\u0119 trzeba ceni\u0107, ten tylko si\u0119 dowie. " * 4,
        "\u543e\u8f29\u306f\u732b\u3067\u3042\u308b\u3002\u540d\u524d\u306f\u307e\u3060\u7121\u3044\u3002" * 6,
    ):
        text = text.strip()
        found = main_text.main_text(f"{menu}<div><p>{text}</p><p>{text[:30]}</p><p>{text}</p></div>{menu}", reader, stops)
        assert found == "\n".join((text, " ".join(text[:30].split()), text))
    notice = "This is the page of the club, and it is for all of the members that are here and in the town."
    foreign = ("Litwo, ojczyzno moja, ty jeste\u015b jak zdrowie. " * 6).strip()
    assert foreign in main_text.main_text(f"<p>{notice}</p><p>{foreign}</p>", reader, stops)
    prose = ("It was the best of times and it was the worst of times. " * 5).strip()
    page = f"{menu}<article><p>Read more of the story</p></article><div><p>{prose}</p><p>{prose}</p></div>"
    assert main_text.main_text(page, reader, stops).split("\n")[-2:] == [prose, prose]
    # a list of words among prose that the stop words know stays out
    tags = "red green blue white black " * 10
    assert main_text.main_text(f"<p>{prose}</p><div>{tags}</div><p>{prose}</p>", reader, stops) == f"{prose}\n{prose}"


def jaccard_groups(texts, k):
    sets = {}
    for i, t in texts.items():
        words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]
        sets[i] = set(zip(*(words[j:] for j in range(k)))) if len(words) >= k else ({tuple(words)} if words else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)):
            n = len(x & y)
            if 100 * n >= 80 * (len(x) + len(y) - n):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_of_a_table(spark, texts, k):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = near_duplicates.near_duplicates(docs, words=k).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == jaccard_groups(texts, k)


def test_near_duplicates_around_the_threshold(spark, monkeypatch):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    base = rng.choices(words, k=120)
    texts = {}
    for i in range(220):
        copy = [rng.choice(words) if rng.random() < (i % 7) * 0.02 else w for w in base]
        texts[1000 - i] = " ".join(copy)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for batches, small in (((1, 3), 16), ((), 0), ((2,), 3)):
        monkeypatch.setattr(near_duplicates, "BATCHES", batches)
        monkeypatch.setattr(near_duplicates, "SMALL", small)
        rows = near_duplicates.near_duplicates(docs, words=2).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == jaccard_groups(texts, 2)


@pytest.mark.parametrize("block", [1024, 40])
def test_near_duplicates_of_a_loose_group_make_few_pairs(spark, monkeypatch, block):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(5000)]
    base = rng.choices(words, k=150)
    texts = {}
    for i in range(800):
        copy = list(base)
        for j in rng.sample(range(150), rng.choice((3, 4, 5, 6))):  # a copy is linked to fewer than half of the others
            copy[j] = rng.choice(words)
        texts[i] = " ".join(copy)
    made = Counter()

    def counted(name):
        real = getattr(near_duplicates, name)

        def run(*given):
            made["pairs"] += given[0].count() if name == "confirmed" else 0
            out = real(*given).cache()
            made["links", name] += out.count()
            return out

        monkeypatch.setattr(near_duplicates, name, run)

    for name in ("confirmed", "forests"):
        if hasattr(near_duplicates, name):
            counted(name)
    monkeypatch.setattr(near_duplicates, "SMALL", 4)
    monkeypatch.setattr(near_duplicates, "BLOCK", block, raising=False)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    rows = near_duplicates.near_duplicates(docs, words=2).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == jaccard_groups(texts, 2)
    assert made["pairs"] <= 6 * len(texts)
    assert 0 < made["links", "forests"] <= 6 * len(texts)


@pytest.mark.parametrize("size", [60, 1500])  # the larger ones need a longer sketch
def test_forest_joins_what_all_links_join(size):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, size).astype(np.uint64)
    sets = []
    for i in range(60):
        new = rng.integers(0, 1 << 63, size).astype(np.uint64)
        sets.append(np.unique(np.where(rng.random(size) < 0.02 + 0.02 * (i % 5), new, base)))
    linked = {(i, j) for i, j in itertools.combinations(range(60), 2)
              if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}

    def groups(parts, links):
        label = parts.tolist()
        for i, j in links:
            label = [label[i] if x == label[j] else x for x in label]
        return {frozenset(np.flatnonzero(np.array(label) == x).tolist()) for x in label}

    for sides in (np.zeros(60, np.int64), rng.integers(0, 2, 60)):
        for parts in (np.arange(60), np.arange(60) // 2):
            across = {(i, j) for i, j in linked if not sides.any() or sides[i] != sides[j]}
            found = near_duplicates.forest(parts, sides, sets, 80)
            assert {tuple(sorted(map(int, x))) for x in found} <= across
            assert groups(parts, found) == groups(parts, across) and len(found) < 60 <= len(across)


def test_near_duplicates_of_many_rows(spark, duck):
    texts = dict(duck.execute(f"SELECT doc_id, text FROM '{MID}/documents.parquet'").fetchall())
    rows = near_duplicates.near_duplicates(spark.read.parquet(f"{MID}/documents.parquet"), words=2).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == jaccard_groups(texts, 2)


def test_identifiers_with_several_texts_keep_all_links(spark):
    rng = random.Random(4)

    def text():
        return [f"w{rng.randrange(10_000)}" for _ in range(80)]

    rows, linked = [], {}
    for i in range(20):
        for j, other in enumerate((100 + i, 200 + i)):
            words = text()
            rows += [(i, " ".join(words)), (other, " ".join([*words[:-1], "changed"]))]
        linked |= {i: i, 100 + i: i, 200 + i: i}
    rows += [(300, rows[0][1]), (301, " ".join(text())), (302, " ".join(text()))]  # an exact copy, two of their own
    linked |= {300: 0, 301: 301, 302: 302}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = near_duplicates.near_duplicates(docs, words=2).collect()
    assert len(found) == len(rows) and {r["doc_id"]: r["component_id"] for r in found} == linked
    assert {r["doc_id"] for r in found if r["kept"]} == {i for i, c in linked.items() if i == c}


def test_links_are_written_to_few_files(spark, monkeypatch):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(5000)]
    texts = {}
    for i in range(60):
        base = rng.choices(words, k=80)
        for j in range(3):
            texts[3 * i + j] = " ".join([*base[:-1], f"end{j}"])
    kept, checkpoints, keep, real = [], [], near_duplicates.Scratch.keep, near_duplicates.components

    def counted(self, df):
        out = keep(self, df)
        kept.append((tuple(out.columns), len(out.inputFiles())))
        return out

    def parts(edges):
        out = real(edges)
        checkpoints.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(near_duplicates.Scratch, "keep", counted)
    monkeypatch.setattr(near_duplicates, "components", parts)
    adaptive = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(adaptive)
    spark.conf.set(adaptive, "false")
    try:
        docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
        rows = near_duplicates.near_duplicates(docs, words=2).collect()
    finally:
        spark.conf.set(adaptive, before)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == jaccard_groups(texts, 2)
    links = next(n for columns, n in kept if columns == ("a", "b"))
    assert links == 1 and set(checkpoints) == {1}, (links, checkpoints)


@pytest.mark.parametrize("kind", ["stars", "hub", "random"])
def test_components_take_no_round_that_changes_nothing(spark, monkeypatch, kind):
    rng = random.Random(11)
    edges = {
        "stars": [(c, c + i) for c in (100, 200, 300) for i in range(1, 40)],
        "hub": [(50, i) for i in range(100) if i != 50],
        "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(330)],
    }[kind]
    parent = {n: n for edge in edges for n in edge}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    cut, frame = [], type(spark.range(0))
    checkpoint = frame.checkpoint
    monkeypatch.setattr(frame, "checkpoint", lambda self, *a, **k: cut.append(out := checkpoint(self, *a, **k)) or out)
    found = graph.components(spark.createDataFrame(edges, "a int, b int")).collect()
    assert sorted(map(tuple, found)) == sorted((n, root(n)) for n in parent if root(n) != n)
    states = [sorted(map(tuple, c.collect())) for c in cut]
    assert all(x != y for x, y in zip(states, states[1:]))
    if kind != "random":
        assert len(cut) == {"stars": 1, "hub": 2}[kind]


def test_nothing_is_joined_to_components_that_do_not_exist_yet(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[:n]) for n in (60, 59, 58, 57)] + ["x1 x2 x3 x4 x5 x6"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    plans, keep = [], near_duplicates.Scratch.keep

    def planned(self, df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return keep(self, df)

    monkeypatch.setattr(near_duplicates.Scratch, "keep", planned)
    rows = near_duplicates.near_duplicates(docs, words=2).collect()
    assert {r.doc_id: r.component_id for r in rows} == {0: 0, 1: 0, 2: 0, 3: 0, 4: 4}
    assert not any(re.search(r"LogicalRDD \[node#\d+, component#\d+\]", p) for p in plans[1:])


def test_parity_bound_never_rules_out_a_link():
    rng = np.random.default_rng(2)
    for _ in range(200):
        common = rng.integers(0, 1 << 63, 80).astype(np.uint64)
        a, b = (np.concatenate([common, rng.integers(0, 1 << 63, 10).astype(np.uint64)]) for _ in range(2))
        apart = sum(int(x ^ y).bit_count() for x, y in zip(near_duplicates.parity_sketch(a).view(np.uint64).tolist(), near_duplicates.parity_sketch(b).view(np.uint64).tolist()))
        assert apart <= 20 and 180 * apart <= 20 * 180


def test_leaks_of_a_table(spark, texts, duck):
    items = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
    windows = defaultdict(set)
    for i, t in items:
        w = re.findall(r"\w+", t.lower())
        for p in range(len(w) - 12):
            windows[tuple(w[p : p + 13])].add(i)
    want = set()
    for d, t in texts.items():
        w = re.findall(r"\w+", (t or "").lower())
        for p in range(len(w) - 12):
            want |= {(d, i) for i in windows.get(tuple(w[p : p + 13]), ())}
    assert {(r["doc_id"], r["item_id"]) for r in E.queries()["op9_decontaminate"](spark, SMALL).collect()} == want


def test_templates(spark):
    item = "Today Anna buys 3 apples for 12 dollars and later gives 3 of them to Bob before the sun goes down"
    docs = [
        (1, "Well. " + item + " again"),
        (2, item.replace("Anna", "Maria").replace("Bob", "Tom").replace("12", "40").replace("3", "7")),
        (3, item.replace("3 of", "5 of")),  # the same slot filled in two ways
        (4, item.replace("Bob", "Anna")),  # two slots filled alike
        (5, item.replace("apples", "pears").replace("later", "soon").replace("before", "when")),
        (6, item.replace("12 dollars", "12.50 euros")),
    ]
    found = decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(9, item)], "item_id long, text string")
    ).collect()
    by = {r["doc_id"]: r for r in found}
    assert {1, 2, 6} <= set(by) and 5 not in by
    assert by[1]["n_exact"] == by[1]["n_windows"] and by[2]["n_exact"] == 0
    assert by[3]["n_windows"] < by[1]["n_windows"]  # windows with both fillings don't count


def test_one_changed_slot_keeps_the_verbatim_windows(spark):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(40)]
    number, name = [*words], [*words]
    number[2] = number[30] = "3"
    name[2], name[30] = "Anna", "Bob"
    items = [(1, " ".join(number)), (2, " ".join(name))]
    number[30], name[30] = "5", "Anna"
    docs = [(1, " ".join(number)), (2, " ".join(name))]
    found = decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    by = {(r["doc_id"], r["item_id"]): r for r in found}
    for i in (1, 2):
        # windows start at 0 to 27; those at 18 to 27 hold the changed word
        assert (by[i, i]["n_windows"], by[i, i]["n_exact"], by[i, i]["first_place"]) == (18, 18, 0)


def test_short_items_copies_in_other_case_and_names_that_start_a_sentence(spark):
    items = [
        (1, "What is 37 times 12?"), (2, "What is 15 percent of 80?"), (3, "Compute 12 plus 45 minus 3"), (4, "Name 3 rivers"),
        (5, "Tom has 3 apples and buys 4 more at the shop. Tom gives 2 of them to his sister and eats 1."),
        (6, "The sum of 1 2 3 4 5 6 7 8 9 10 11 12 13 is wanted by Élodie"), (7, "\u0421\u043a\u043e\u043b\u044c\u043a\u043e \u0431\u0443\u0434\u0435\u0442 2 \u0438 2"),
    ]
    docs = [
        (1, "Well, what is 40 times 9 then"), (2, "- What is 20 percent of 95? -"), (3, "compute 7 plus 8 minus 9 now"),
        (4, "NAME 3 RIVERS!"), (14, "Name 4 rivers"), (5, items[4][1].replace("Tom", "Anna")), (15, items[4][1].upper()),
        (6, "Yes: " + items[5][1].lower()), (7, items[6][1].upper()), (8, "what is 40 plus 9"), (9, items[4][1].replace("Tom gives", "Bob gives")),
        (10, "Compute 12 plus 45 minus 3, he said"),
    ]
    found = decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    by = {(r["doc_id"], r["item_id"]): r for r in found}
    assert set(by) - {(9, 5)} == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (15, 5), (6, 6), (7, 7), (10, 3)}
    assert all(by[k]["n_exact"] == by[k]["n_windows"] for k in ((4, 4), (15, 5), (6, 6), (7, 7), (10, 3)))
    assert by[5, 5]["n_exact"] < by[5, 5]["n_windows"] == by[15, 5]["n_windows"]


def test_token_counts(spark, texts):
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    library = Tokenizer.from_file(path)
    rows = E.queries()["op10_token_counts"](spark, SMALL).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows} == {
        i: (len(t.encode()), n, n > 1024) for i, t in texts.items() for n in [len(library.encode(t, add_special_tokens=False).ids)]
    }


def test_counts_of_prefixes():
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    library, vocabulary = Tokenizer.from_file(path), prefix_tokens.Vocabulary(open(path, encoding="utf-8").read())
    rng = random.Random(1)
    texts = ["".join(rng.choices("aabcdeetthhing  \n\t'sll've0123.,!?éèß中🙂İ the and", k=60)) for _ in range(60)]
    for text in texts:
        prefix = prefix_tokens.PrefixCounts(vocabulary, text)
        counts = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
        assert [prefix.at(k) for k in range(len(text) + 1)] == counts
        for budget in (0, 3, 10):
            assert counts[prefix.longest_within(budget)] <= budget
    special = ["<|endoftext|>", "a<|endoftext|><|endoftext|> b", "x" * 3000, " " * 3000]
    got = [n for g in prefix_tokens.groups(special) for n in prefix_tokens.count_texts(vocabulary, g, {})]
    assert got == [len(library.encode(t, add_special_tokens=False).ids) for t in special]


def test_pipeline(spark, texts):
    """run() against its stages done by hand: groups by brute force, leaks by word windows, mix by the rows left."""
    rows = corpus_pipeline.run(spark, SMALL).collect()
    lettered = {i: t for i, t in texts.items() if t and any(map(str.isalpha, t))}
    groups = jaccard_groups(lettered, 5)
    kept = {i: t for i, t in lettered.items() if groups[i][1] == i}
    leaks = {r["doc_id"] for r in E.queries()["op9_decontaminate"](spark, SMALL).collect()}
    left = set(kept) - leaks
    from quarry.llm import mixing

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    taken = {r["doc_id"]: r["copies"] for r in mixing.mix(docs.where(F.col("doc_id").isin(sorted(left)))).collect()}
    assert Counter(r["doc_id"] for r in rows) == Counter({i: n for i, n in taken.items() if n})
    assert {"doc_id", "text", "lang", "source", "n_chars", "shard", "slot"} <= set(rows[0].__fields__)
    assert all(r["text"] == texts[r["doc_id"]] for r in rows)


def test_functions_travel_without_the_package():
    from pyspark import cloudpickle

    payload = cloudpickle.dumps(near_duplicates.shingle_sets)
    assert b"runs_of_rows" in payload


def test_machine_learns_balanced_terms_that_differ_as_a_pair():
    rng = np.random.default_rng(1)
    held = rng.random((6000, 2)) < 0.5
    fill = [f"filler{i}" for i in range(200)]
    texts = [" ".join([*rng.choice(fill, 8), *(["alpha"] if a else []), *(["omega"] if b else [])]) for a, b in held]
    labels = (held[:, 0] != held[:, 1]).astype(float)
    hasher = toxicity.term_words()
    learned, rest = (toxicity.terms_of(hasher, *utf8(pa.array(part))) for part in (texts[:4000], texts[4000:]))
    machine = toxicity.fit(*learned, labels[:4000])
    assert ((machine.score(*rest) > 0.5) == (labels[4000:] == 1)).mean() > 0.95
    none = toxicity.telling_pairs(*learned, np.zeros(4000), np.zeros(toxicity.TERMS, bool))
    assert not none.any()


PROSE = "The cat sat on the mat and it was the best of all the days that we had. " * 4


@pytest.mark.parametrize("page", [
    "<div class=\"layout has-sidebar\"><article><p>{}</p></article></div>",
    "<div class=\"no-comments\"><article><p>{}</p></article></div>",
    "<form id=\"aspnetForm\"><nav>Menu</nav><article><p>{}</p></article></form>",
    "<form id=\"aspnetForm\"><nav>Menu</nav><div><p>{}</p></div></form>",
    "<article><div data-id=\"social\"><p>{}</p></div></article>",
    "<div id=\"sidebar-wrap\"><main><p>{}</p></main></div>",
    "<div class=\"widget\"><p>{}</p></div><div class=\"ad\">Buy it now</div>",
    "<p>{}</p><div id=\"comments\"><article><p>I like the cat and it is the best of all.</p></article></div>",
])
def test_layout_words_hide_no_page(page):
    reader, stops = main_text.Reader(), set(main_text.STOP_WORDS)
    assert main_text.main_text(f"<html><body>{page.format(PROSE)}</body></html>", reader, stops) == PROSE.strip()


def test_pages_without_article_tags_read_the_same(duck):
    reader, stops = main_text.Reader(), set(main_text.STOP_WORDS)
    hit = wrong = missed = 0
    for (page,) in duck.execute("SELECT html FROM pages").fetchall():
        plain = re.sub(r"<(/?)(?:article|main)\b", r"<\1div", page)
        tagged, found = (set(main_text.main_text(p, reader, stops).split("\n")) for p in (page, plain))
        hit, wrong, missed = hit + len(tagged & found), wrong + len(found - tagged), missed + len(tagged - found)
    assert hit / (hit + missed) > 0.95 and hit / (hit + wrong) > 0.95


def test_stray_end_tags_take_linear_time():
    import time

    reader, stops, took = main_text.Reader(), set(main_text.STOP_WORDS), []
    for n in (5_000, 40_000):
        began = time.perf_counter()
        main_text.main_text("<b>" * n + "x" + "</i>" * n, reader, stops)
        took.append(time.perf_counter() - began)
    assert took[1] < 30 * max(took[0], 0.02)


def test_shards_and_slots_equal_brute_force(spark, texts):
    import zlib

    import xxhash

    def hashed(*parts):
        seed = 42  # of the engine's hash; every part seeds the next
        for p in parts:
            seed = xxhash.xxh64(p.encode() if isinstance(p, str) else p.to_bytes(8, "little", signed=True), seed=seed).intdigest()
        return seed >> 16

    def descend(key, node, path=""):
        while node.children:
            draws = [(-math.log((hashed(key, f"{path}/{i}") + 0.5) / 2**48) / c.weight, i) for i, c in enumerate(node.children)]
            i = min(draws)[1]
            node, path = node.children[i], f"{path}/{i}"
        return node.shard

    tree = sharding.even_tree()
    rows = sharding.shard(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()
    assert len(rows) == len(texts) and {r["law"] for r in rows} == {"key"}
    order = defaultdict(list)
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 8, zlib.crc32(raw))
        assert r["shard"] == descend(str(r["doc_id"]), tree)
        assert r["grown_shard"] == descend(str(r["doc_id"]), sharding.grown(tree))
        order[r["shard"]].append((hashed(str(r["doc_id"]), r["text_crc32"], r["size"], "slot"), r["slot"]))
    for held in order.values():
        assert [slot for _, slot in sorted(held)] == list(range(len(held)))
