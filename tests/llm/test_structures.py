"""Embedding whitening, the conversation trie and licence scans against brute force."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from plotloom.llm import license_scan, trie, whitening

VECTORS = "vec_id long, embedding array<float>"
TURNS = "conv_id long, turn long, role string, text string"
DOCS = "doc_id long, text string"


# Whitening -------------------------------------------------------------------------


def dense(vectors):
    x = np.floor(64 * np.array(vectors, dtype=np.float32).astype(float))
    return x - x.mean(axis=0)


def whitened(spark, rows, components=32, partitions=3):
    frame = spark.createDataFrame(rows, VECTORS).repartition(partitions)
    model = whitening.fit(frame, "embedding", components)
    return model, whitening.whiten(frame, model, "vec_id", "embedding").collect()


@pytest.mark.parametrize("dims, count, components", [(64, 400, 32), (100, 300, 20), (5, 50, 32)])
def test_components_are_those_of_a_dense_solver(spark, dims, count, components):
    draw = np.random.default_rng(dims)
    scale = np.linspace(3, 1, dims)
    rows = [(i, (draw.standard_normal(dims) * scale).tolist()) for i in range(count)]
    model, found = whitened(spark, rows, components)
    x = dense([v for _, v in rows])
    values, axes = np.linalg.eigh(x.T @ x / count)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    assert model.n == count and len(model.values) == min(components, dims)
    assert np.allclose(model.values, values, rtol=1e-12)
    assert np.allclose(model.explained, values / np.trace(x.T @ x / count), rtol=1e-9)
    got = np.array([r["whitened"] for r in sorted(found)])
    want = x @ axes / np.sqrt(values)
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got * signs - want).max() < 1e-8
    assert model.identity_error < 1e-9 and model.residual <= 1e-9 * values[0]


def test_flat_spectrum_grows_the_block(spark):
    draw = np.random.default_rng(1)
    rows = [(i, draw.standard_normal(80).tolist()) for i in range(4000)]
    model, _ = whitened(spark, rows, 10)
    x = dense([v for _, v in rows])
    assert np.allclose(model.values, np.linalg.eigvalsh(x.T @ x / len(x))[::-1][:10], rtol=1e-10)


def test_deviation_is_exact(spark):
    rows = [(0, [1.5, -2.0, 0.0]), (1, [0.25, 7.0, 1.0]), (1, [0.25, 7.0, 1.0]), (None, [-30000000.0, 1.0, 2.0])]
    _, found = whitened(spark, rows)
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    sums = [sum(column) for column in zip(*x)]
    want = [sum((4 * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    got = sorted((r["deviation"] if r["deviation"] is not None else -1) for r in found)
    assert got == sorted(w if w < 1 << 63 else -1 for w in want)
    assert [r["vec_id"] for r in found].count(1) == 2 and None in [r["vec_id"] for r in found]


def test_unusable_vectors_are_left_out(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i), float(i * i % 7), 1.0 if i % 2 else 0.0]) for i in range(10)]
    bad = [(20, None), (21, []), (22, [1.0, None, 2.0]), (23, [nan, 1.0, 2.0]), (24, [1.0, -inf, 2.0]), (25, [1.0, 2.0]), (26, [1e30, 0.0, 0.0])]
    model, found = whitened(spark, good + bad)
    assert sorted(r["vec_id"] for r in found) == list(range(10)) and model.n == 10


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)]])
def test_tables_without_variance_have_no_component(spark, rows):
    model, found = whitened(spark, rows)
    assert len(model.values) == 0 and all(r["whitened"] == [] for r in found)
    assert len(found) == sum(v is not None for _, v in rows)


def test_constant_directions_have_no_component(spark):
    draw = np.random.default_rng(2)
    rows = [(i, [*(draw.standard_normal(3) * 4).tolist(), 5.0, 5.0]) for i in range(40)]
    model, _ = whitened(spark, rows)
    assert len(model.values) == 3 and model.identity_error < 1e-9


def test_other_columns_of_a_vector_table_may_have_any_name(spark):
    rows = [(i, [float(i % 3), float(i % 5)]) for i in range(30)]
    names = ["deviation", "whitened", "n", "x", "length", "count", "place", "data"]
    frame = spark.createDataFrame(rows, VECTORS).withColumns({name: F.lit("own") for name in names})
    model = whitening.fit(frame, "embedding", 2)
    assert whitening.whiten(frame, model, "vec_id", "embedding").count() == 30


def test_many_partitions_add_up_in_groups(spark):
    rows = [(i, [float(i % 3), float(i % 5), float(i % 7)]) for i in range(200)]
    one, _ = whitened(spark, rows, partitions=2)
    many, _ = whitened(spark, rows, partitions=50)
    assert one.n == many.n == 200 and np.allclose(one.values, many.values, rtol=1e-12)


# Trie ------------------------------------------------------------------------------


def brute_trie(convs):
    members, kids = defaultdict(list), defaultdict(int)
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    for path in members:
        if path:
            kids[path[:-1]] += 1
    leaves, saved, ends = defaultdict(int), defaultdict(int), defaultdict(list)
    for path, own in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not kids[path]
            saved[path[:d]] += (len(own) - 1) * len(path[-1][1].encode()) if path else 0
    for conv, turns in convs.items():
        ends[tuple(turns)].append(conv)

    def digest(path):
        return hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest()

    return sorted(
        (min(own), len(path), min(members[path[:-1]]) if path else -9, len(own), kids[path], leaves[path], saved[path], digest(path))
        for path, own in members.items()
    )


def in_order(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [(role, text) for _, _, role, text in sorted(turns)] for conv, turns in own.items()}


def brute_rebuilt(rows):
    own = in_order(rows)
    out = {}
    for conv, turns in own.items():
        head = zlib.crc32(str(conv).encode()) % 9
        base = conv - int(math.fmod(conv, 5))
        out[conv] = own.get(base, [])[:head] + turns[head:]
    return out


def spark_trie(numbered, convs):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    found = trie.prefix_trie(numbered, convs).select(*names).collect()
    return sorted(tuple(-9 if v is None else v for v in row) for row in found)


def rebuilt_trie(frame):
    conv = F.col("conv_id")
    head = F.crc32(conv.cast("string").cast("binary")) % 9
    return spark_trie(*trie.shared_heads(trie.placed(frame), conv - conv % 5, head))


@pytest.fixture
def small_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "5")
    yield
    spark.conf.set(name, before)


def random_turns(seed, convs, sizes, share=0.95):
    draw, rows = random.Random(seed), []
    for conv in range(convs):
        for turn in range(draw.choice(sizes)):
            usual = draw.random() < share
            text = f"usual {turn}" if usual else draw.choice(["other", "é", "", None])
            rows.append((conv - 3, turn, "user" if turn % 2 == 0 else None, text))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [[1, 2, 5, 8], [0, 1, 3, 64, 65, 128, 129, 200]])
def test_trie_of_rebuilt_conversations(spark, small_batches, sizes):
    rows = random_turns(len(sizes), 60, sizes, 0.97 if max(sizes) > 60 else 0.8)
    frame = spark.createDataFrame(rows, TURNS).repartition(5)
    assert rebuilt_trie(frame) == brute_trie(brute_rebuilt(rows))


def test_one_conversation_may_hold_most_rows(spark, small_batches):
    rows = [(7, i, "user", f"text {i % 10}") for i in range(3000)] + random_turns(2, 9, [1, 2, 3])
    rows += [(8, i, "user", f"text {i % 10}") for i in range(2900)]
    frame = spark.createDataFrame(rows, TURNS).repartition(6)
    got = {(r["conv_id"], r["place"]): r["size"] for r in trie.placed(frame).collect()}
    order = in_order(rows)
    assert got == {(c, i): len(text.encode()) for c, turns in order.items() for i, (_, text) in enumerate(turns)}
    numbered = trie.placed(frame)
    nodes = {row[:7]: row[7] for row in spark_trie(numbered, trie.lengths(numbered))}
    chain = [key for key in nodes if key[0] == 7 and key[1] > 3]
    shared = sorted(key[1] for key in chain if key[3] == 2)
    assert shared == list(range(4, 2901)) and len(chain) == 2997
    # What the second conversation saves from depth 4 on, the bytes of one copy.
    assert next(key[6] for key in chain if key[1] == 4) == sum(len(f"text {i % 10}") for i in range(3, 2900))


def test_many_equal_conversations(spark, small_batches):
    rows = [(c, t, "user", f"{t}") for c in range(400) for t in range(3)] + [(1000, 0, "user", "0"), (1001, 0, "user", "x")]
    frame = spark.createDataFrame(rows, TURNS).repartition(4)
    numbered = trie.placed(frame)
    assert spark_trie(numbered, trie.lengths(numbered)) == brute_trie(in_order(rows))


def test_nulls_repeats_and_clashing_names_in_turns(spark):
    rows = [(None, 1, "user", "nobody"), (1, None, "user", "first"), (1, 2, None, None), (1, 2, None, None)]
    rows += [(2, None, "user", "first"), (2, 1, "", ""), (-4, 0, "user", "first"), (2**62, 5, "user", "long " * 50000)]
    names = ["a", "b", "size", "place", "part", "n", "k", "g", "x", "own", "leaf", "ends", "chance"]
    frame = spark.createDataFrame(rows, TURNS).withColumns({name: F.lit("own") for name in names})
    assert rebuilt_trie(frame) == brute_trie(brute_rebuilt(rows))


def test_no_conversations_no_nodes(spark):
    frame = spark.createDataFrame([], TURNS)
    assert rebuilt_trie(frame) == []


def test_conversations_without_turns_are_members_of_the_root(spark):
    frame = spark.createDataFrame([(5, 0, "user", "a")], TURNS)
    convs = spark.createDataFrame([(5, 1), (3, 0), (4, 0)], "conv_id long, n long")
    got = spark_trie(trie.placed(frame), convs)
    assert got == brute_trie({5: [("user", "a")], 3: [], 4: []})
    alone = spark_trie(trie.placed(frame.limit(0)), convs.where("n = 0"))
    assert alone == brute_trie({3: [], 4: []})


def test_nodes_with_their_turns(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "bot", "b"), (2, 0, "user", "a")]
    frame = spark.createDataFrame(rows, TURNS)
    numbered = trie.placed(frame)
    turns = frame.select("conv_id", F.col("turn").alias("place"), "role", "text")
    nodes = trie.with_turns(trie.prefix_trie(numbered, trie.lengths(numbered)), turns)
    got = sorted((r["depth"], r["role"], r["text"], r["n_convs"]) for r in nodes.where("depth > 0").collect())
    assert got == [(1, "user", "a", 2), (2, "bot", "b", 1)]


# Licences --------------------------------------------------------------------------


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found, word = [], ""
    for c in lower + " ":
        if c.isascii() and not (c.isdigit() or "a" <= c <= "z"):
            if word:
                found.append(word)
            word = ""
        else:
            word += c
    return found


def brute_licences(texts):
    """Per text: words, base places and alignments, by trying every template at every place."""
    cut = [words_of(t) for t in texts]
    holding = {w: sum(w in words for words in cut) for w in license_scan.vocabulary()}
    index = license_scan.build_index(len(texts), holding)
    out = []
    for words in cut:
        at = lambda i: words[i] if 0 <= i < len(words) else None  # noqa: E731, B023
        base = []
        for i in range(len(words)):
            for phrase, label in license_scan.BASE:
                parts = phrase.split()
                if words[i : i + len(parts)] == parts:
                    base.append((label, i))
        found = set()
        for t, (label, _, phrases) in enumerate(license_scan.TEMPLATES):
            template, rare = index.words[t], index.rare[t]
            for begin in range(-len(template), len(words)):
                votes = sum(at(begin + q) == template[q] for q in rare)
                if votes < (len(rare) + 1) // 2:
                    continue
                stands = True
                for phrase in phrases:
                    parts = phrase.split()
                    q = next(q for q in range(len(template)) if template[q : q + len(parts)] == parts)
                    stands &= any(
                        all(at(begin + q + off + j) == w for j, w in enumerate(parts))
                        for off in range(-license_scan.DRIFT, license_scan.DRIFT + 1)
                    )
                weights = index.weights[t]
                share = sum(w for q, w in enumerate(weights) if at(begin + q) == template[q]) / sum(weights)
                if stands and round(share, 6) >= license_scan.SHARE:
                    found.add((label, t, begin, min(round(share, 6), 1.0)))
        out.append((len(words), base, found))
    return out


def spark_licences(frame):
    docs = frame.select("doc_id", "text")
    index = license_scan.build_index(*license_scan.frequencies(docs))
    rows = license_scan.scan(frame, index).collect()
    return {
        r["doc_id"]: (r["n_words"], [tuple(b) for b in r["base"]], {(x[0], x[1], x[2], round(x[3], 6)) for x in r["licences"]})
        for r in rows
    }


def licence_texts():
    draw = random.Random(4)
    filler = "the of and software license use free this to in a general mit apache cc by 4 0 wörd".split()
    texts = [None, "", " \n", "MIT License", "the MIT\nLICENSE. mit license", "mit-licenSe", "mit li cense", "mit licenſe"]
    texts += ["Apache License, Version 2.0", "GNU Lesser General Public License", "Licensed under CC BY-NC 4.0.", "worK mit İ license"]
    texts += [" ".join(draw.choice(filler) for _ in range(draw.randrange(200))) for _ in range(60)]
    for _, notice, _ in license_scan.TEMPLATES:
        words = notice.split()
        texts.append("x " * draw.randrange(5) + notice.upper() + " y")
        changed = [draw.choice(filler) if draw.random() < 0.1 else w for w in words]
        texts.append(" ".join(changed))
        cut = draw.randrange(len(words))
        texts.append(" ".join(words[:cut] + ["extra", "words"] + words[cut:]))
        texts.append(" ".join(words[cut:]))
    texts.append("word " * 40000 + "released under the mit license " * 2000)
    return texts


def test_licences_as_found_by_trying_every_place(spark):
    texts = licence_texts()
    got = spark_licences(spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(4))
    want = brute_licences(texts)
    for i, (n, base, found) in enumerate(want):
        assert got[i][0] == n, texts[i]
        assert got[i][1] == base
        assert got[i][2] == found, (texts[i] or "")[:300]
    assert sum(bool(found) for _, _, found in want) > 40


def test_every_notice_is_found_by_its_label(spark):
    texts = [f"Some words first.\n{notice}.\nAnd after." for _, notice, _ in license_scan.TEMPLATES]
    got = spark_licences(spark.createDataFrame(list(enumerate(texts)), DOCS))
    for i, (label, _, _) in enumerate(license_scan.TEMPLATES):
        assert (label, i) in {(x[0], x[1]) for x in got[i][2]}


def test_rows_of_one_id_and_clashing_names_in_documents(spark):
    rows = [(None, "mit license"), (None, "mit license"), (None, "apache license"), (1, None)]
    names = ["n_words", "base", "licences", "_words", "_row", "_places", "_votes", "_agreed", "word", "held"]
    frame = spark.createDataFrame(rows, DOCS).withColumns({name: F.lit("own") for name in names})
    index = license_scan.build_index(*license_scan.frequencies(frame))
    found = license_scan.scan(frame, index)
    assert sorted(found.columns) == sorted(["doc_id", "text", *names])
    assert sorted(str([b[0] for b in r["base"]]) for r in found.collect()) == ["['apache']", "['mit']", "['mit']", "[]"]
    assert {r["_words"] for r in found.collect()} == {"own"}


def test_no_documents_no_rows(spark):
    frame = spark.createDataFrame([], DOCS)
    assert license_scan.scan(frame, license_scan.build_index(*license_scan.frequencies(frame))).count() == 0


def test_licence_scan_runs_no_python(spark):
    frame = spark.createDataFrame([(1, "mit license")], DOCS)
    plan = license_scan.scan(frame, license_scan.build_index(1, {}))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
