"""Near-dedup and fingerprints against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from plotloom.llm import fingerprints, graph, near_dedup, words

DOCS = "doc_id long, text string"
CLASHING = ["cls", "band", "root", "block", "goal", "extra", "signature", "key_a", "class_id", "_kept_id"]


def docs_of(spark, rows, partitions=3):
    return spark.createDataFrame(rows, DOCS).repartition(partitions)


def with_clashes(frame):
    return frame.withColumns({name: F.lit(f"own {name}") for name in CLASHING})


def prose(draw, count, letters="abcdefghilmnorst"):
    return " ".join("".join(draw.choice(letters) for _ in range(draw.randrange(2, 9))) for _ in range(count))


def shingles(text):
    own = (text or "").split()
    return Counter(tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))) if own else Counter()


def jaccard(a, b):
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def near(draw, text, edits):
    own = text.split()
    for _ in range(edits):
        own[draw.randrange(len(own))] = prose(draw, 1)
    return " ".join(own)


def brute_classes(rows, threshold=0.8):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            if jaccard(sets[x][1], sets[y][1]) >= threshold:
                parent[max(find(x), find(y))] = min(find(x), find(y))
    groups = {}
    for x in range(len(rows)):
        groups.setdefault(find(x), []).append(rows[x][0])
    return {frozenset(Counter(g).items()) for g in groups.values()}


# Words -----------------------------------------------------------------------------


def test_shingles_depend_on_words_only(monkeypatch):
    draw = random.Random(1)
    texts = [prose(draw, n) for n in (0, 1, 2, 4, 5, 6, 50, 400)] + ["  a\n\tb  ", "", "x" * 5000]
    data = [t.encode() for t in texts]
    values, bounds = words.batch_shingles(data)
    assert np.diff(bounds).tolist() == [sum(shingles(t).values()) for t in texts]
    for i, text in enumerate(data):
        alone, _ = words.batch_shingles([b"\n" + text.replace(b" ", b" \t ") + b" "])
        np.testing.assert_array_equal(alone, values[bounds[i] : bounds[i + 1]])
    monkeypatch.setattr(words, "PIECE", 64)
    monkeypatch.setattr(words, "_POWERS", {})
    np.testing.assert_array_equal(words.batch_shingles(data)[0], values)


def test_signatures_estimate_weighted_jaccard():
    draw = random.Random(2)
    errors = []
    for _ in range(60):
        a = (prose(draw, 40) + " ") * 1 + " ".join([prose(draw, 1)] * draw.randrange(1, 60))
        b = near(draw, a, draw.randrange(1, 10)) + " ".join([a.split()[-1]] * draw.randrange(30))
        flat, bounds = words.batch_shingles([a.encode(), b.encode()])
        owner, values, count = words.multisets(flat, bounds)
        names = near_dedup.bag_signatures(owner, values, count, 2)
        assert (names != 0).all()
        errors.append((names[0] == names[1]).mean() - jaccard(shingles(a), shingles(b)))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_overlap_is_exact():
    draw = random.Random(3)
    left = [prose(draw, n, "ab") for n in (0, 3, 9, 60, 200, 0)]
    right = [prose(draw, 2, "ab"), left[1], near(draw, left[2], 1), near(draw, left[3], 2), left[4] + " " + left[4], ""]
    found = near_dedup.overlap([t.encode() for t in left], [t.encode() for t in right])
    np.testing.assert_allclose(found, [jaccard(shingles(a), shingles(b)) for a, b in zip(left, right)])


# Components ------------------------------------------------------------------------


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, i) for i in range(101, 150)]
    links = spark.createDataFrame(chain + star + [(7, 7), (200, 201), (201, 200)], "a long, b long")
    found = {r.node: r.root for r in graph.components(links).collect()}
    roots = {i: 0 for i in range(1, 61)} | {i: 100 for i in range(101, 150)} | {201: 200}
    assert {n: r for n, r in found.items() if n != r} == roots


# Near-dedup ------------------------------------------------------------------------


def test_classes_against_brute_force(spark):
    draw = random.Random(4)
    rows = []
    for _ in range(25):
        text = prose(draw, draw.randrange(3, 150))
        group = [text] + [near(draw, text, draw.randrange(0, 5)) for _ in range(draw.randrange(6))] + [text]
        rows += [(len(rows) + i, t) for i, t in enumerate(group)]
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "one  two"), (905, "two one"), (906, "b " * 20000)]
    found = near_dedup.near_classes(with_clashes(docs_of(spark, rows))).collect()
    got = {}
    for r in found:
        got.setdefault(r.class_id, []).append(r.doc_id)
    assert {frozenset(Counter(g).items()) for g in got.values()} == brute_classes(rows)
    assert all(min(g) == c for c, g in got.items())


def test_a_large_group_of_near_copies(spark):
    draw = random.Random(5)
    text = prose(draw, 120)
    rows = [(i, near(draw, text, draw.randrange(4))) for i in range(300)]
    rows += [(1000 + i, prose(draw, 120)) for i in range(50)]
    found = near_dedup.near_classes(docs_of(spark, rows)).collect()
    got = {}
    for r in found:
        got.setdefault(r.class_id, []).append(r.doc_id)
    assert {frozenset(Counter(g).items()) for g in got.values()} == brute_classes(rows)


def test_links_behind_likelier_partners(spark):
    draw = random.Random(31)
    text = prose(draw, 400)
    # Hardly a pair reaches the threshold, but all are likely by signature.
    rows = [(i, near(draw, text, draw.randrange(6, 8))) for i in range(200)]
    found = near_dedup.near_classes(docs_of(spark, rows)).collect()
    got = {}
    for r in found:
        got.setdefault(r.class_id, []).append(r.doc_id)
    assert {frozenset(Counter(g).items()) for g in got.values()} == brute_classes(rows)


def test_pairs_of_a_large_unlinked_group_are_no_rows(spark, monkeypatch):
    """All pairs are likely and hardly one is a link; they are compared inside tasks, across several blocks."""
    draw = random.Random(32)
    text = prose(draw, 400)
    rows = [(i, near(draw, text, draw.randrange(6, 8))) for i in range(240)]
    monkeypatch.setattr(near_dedup, "BLOCK", 48)
    asked = []
    verified = near_dedup.verified

    def counted(pairs, *rest):
        asked.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(near_dedup, "verified", counted)
    found = near_dedup.near_classes(docs_of(spark, rows)).collect()
    got = {}
    for r in found:
        got.setdefault(r.class_id, []).append(r.doc_id)
    assert {frozenset(Counter(g).items()) for g in got.values()} == brute_classes(rows)
    # At most one pair per class and band, and those of small bands.
    assert sum(asked) <= (near_dedup.BANDS + near_dedup.ALL_PAIRS) * len(rows) < len(rows) ** 2 / 2


def test_one_row_of_each_class_stays(spark):
    draw = random.Random(6)
    text, other = prose(draw, 80), prose(draw, 80)
    rows = [(5, text), (3, text), (3, text), (9, near(draw, text, 1)), (4, other), (None, other), (None, prose(draw, 30))]
    rows += [(None, text + " "), (20, ""), (21, None)]
    kept = near_dedup.drop_near_copies(with_clashes(docs_of(spark, rows)))
    assert kept.columns == ["doc_id", "text", *CLASHING]
    texts = kept.collect()
    assert Counter((r.text or "").strip() for r in texts) == Counter([text, other, rows[6][1], ""])
    assert sorted((r.doc_id for r in texts), key=lambda i: -1 if i is None else i) == [None, None, None, 20]


def test_repeated_rows_of_one_document(spark):
    draw = random.Random(7)
    rows = [(1, prose(draw, 50))] * 3 + [(2, prose(draw, 50))]
    assert sorted(r.doc_id for r in near_dedup.drop_near_copies(docs_of(spark, rows)).collect()) == [1, 2]


def test_near_dedup_of_an_empty_table(spark):
    assert near_dedup.near_classes(docs_of(spark, [])).count() == 0
    assert near_dedup.drop_near_copies(docs_of(spark, [])).count() == 0


# Fingerprints ----------------------------------------------------------------------


def set_jaccard(a, b):
    a, b = set(shingles(a)), set(shingles(b))
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("partitions", [1, 4])
def test_edits(spark, partitions):
    draw = random.Random(8)
    rows = [(i * 7, prose(draw, draw.randrange(80))) for i in range(90)]
    rows += [(1000, None), (1001, ""), (1002, "é😀" * 9), (1003, rows[0][1]), (2**60 + 1, "far"), (None, "no id"), (None, "z")]
    found = fingerprints.with_edits(with_clashes(docs_of(spark, rows, partitions))).collect()
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    got = {(r.doc_id, r.n_chars, r.edited_sha256): r for r in found}
    assert len(found) == len(rows)
    off = []
    for k, (doc_id, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = got[doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()]
        off += [r.near_edited - set_jaccard(text, edited), r.near_next - set_jaccard(text, following)]
    assert np.abs(off).mean() < 0.04
    prints = {(r.doc_id): r.fingerprint for r in found}
    assert prints[1003] == prints[0] and prints[1000] == prints[1001]


def test_one_document_is_its_own_neighbour(spark):
    row = fingerprints.with_edits(docs_of(spark, [(1, "abcd")])).collect()[0]
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and row.near_next == 1.0
    assert fingerprints.with_edits(docs_of(spark, [])).count() == 0


def test_similar_pairs(spark):
    draw = random.Random(9)
    base = [prose(draw, 100) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(base)] + [(100 + i, near(draw, t, 1)) for i, t in enumerate(base)] + [(200, base[0])]
    members, pairs = fingerprints.similar_pairs(docs_of(spark, rows))
    assert {r.doc_id: r.class_id for r in members.collect()}[200] == 0
    got = {(r.a, r.b): r.similarity for r in pairs.collect()}
    expected = {(i, 100 + i): set_jaccard(base[i], rows[20 + i][1]) for i in range(20)}
    assert set(got) == {p for p, s in expected.items() if s >= 0.8}
    assert all(abs(got[p] - expected[p]) < 1e-12 for p in got)


def test_similar_rows_beside_an_unlike_least_class(spark):
    draw = random.Random(12)
    text = prose(draw, 400)
    rows = [(i, near(draw, text, draw.randrange(6, 9))) for i in range(1, 60)]
    rows += [(None, near(draw, rows[0][1], 1)), (5, near(draw, rows[1][1], 1)), (70, rows[0][1]), (80, None), (81, "")]
    sets = [set(shingles(t)) for _, t in rows]
    parent = list(range(len(rows)))
    expected = set()
    for x in range(len(rows)):
        for y in range(x):
            union = sets[x] | sets[y]
            if not union or len(sets[x] & sets[y]) / len(union) >= 0.8:
                old, new = max(parent[x], parent[y]), min(parent[x], parent[y])
                parent = [new if p == old else p for p in parent]
                if sets[x] != sets[y]:
                    expected.add(frozenset((rows[x], rows[y])))
    least = {}
    for (doc_id, _), p in zip(rows, parent):
        least[p] = min(least.get(p, doc_id), doc_id, key=lambda v: -1 if v is None else v) if p in least else doc_id
    docs = docs_of(spark, rows)
    found = Counter((r.doc_id, r.n_chars, r.group_id) for r in fingerprints.with_groups(docs).collect())
    assert found == Counter((i, len(t or ""), least[p]) for (i, t), p in zip(rows, parent))
    pairs = Counter(tuple(sorted((r.a, r.b), key=str)) for r in fingerprints.similar_pairs(docs)[1].collect())
    # The copy of the first row is of its class.
    named = [tuple(sorted((i for i, _ in pair), key=str)) for pair in expected if 70 not in {i for i, _ in pair}]
    assert pairs == Counter(named)


def test_groups_go_with_the_texts_in_one_exchange(spark):
    draw = random.Random(13)
    a, b, c = (prose(draw, 120) for _ in range(3))
    rows = [(1, a), (2, b), (5, near(draw, a, 1)), (5, near(draw, b, 1)), (5, c), (9, c), (9, None), (None, b)]
    rows += [(20 + i, prose(draw, 40)) for i in range(40)]
    found = fingerprints.with_groups(docs_of(spark, rows))
    # Neither texts nor fingerprints are joined or sent a second time.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    got = Counter((r.doc_id, r.n_chars, r.group_id) for r in found.collect())
    expected = [1, None, 1, None, 5, 5, 9, None] + [20 + i for i in range(40)]
    assert got == Counter((i, len(t or ""), g) for (i, t), g in zip(rows, expected))
    assert fingerprints.with_groups(docs_of(spark, [])).count() == 0
    assert fingerprints.with_groups(docs_of(spark, [(None, None)])).first().group_id is None


def test_only_bands_of_several_classes_are_kept():
    draw = random.Random(14)
    entries = sorted((draw.randrange(60), draw.randrange(4)) for _ in range(150))
    entries += [(99, 1)] * 7 + [(100, 1)] * 5 + [(100, 2)] * 5
    members = [(None, 3, None, 8), (None, 4, 2, 9)]
    rows = members + [(band, cls, None, None) for band, cls in entries]
    several = {band for band, _ in entries if len({c for x, c in entries if x == band}) > 1}
    expected = sorted({e for e in entries if e[0] in several})
    for size in (1, 2, 3, 7, len(rows)):
        batches = [fingerprints._banded(*zip(*rows[i : i + size])) for i in range(0, len(rows), size)]
        found = [tuple(r.values()) for out in fingerprints._shared(batches) for r in out.to_pylist()]
        assert [r for r in found if r[0] is None] == members
        assert [r[:2] for r in found if r[0] is not None] == expected


def test_texts_that_are_not_needed_are_left_out_before_the_join(spark):
    docs = docs_of(spark, [(i, "text") for i in range(-500, 500)] + [(None, "text")])
    ids = spark.createDataFrame([(i,) for i in range(-500, 500, 10)] + [(None,)], "id long")
    found = {r.doc_id for r in fingerprints._likely_rows(docs, ids).collect()}
    assert found >= {None, *range(-500, 500, 10)} and len(found) < 110


def test_slices_of_pairs_are_bounded_by_what_they_inflate_to():
    import zlib

    import pyarrow as pa

    texts = [b"x" * n for n in (5, 400, 10, 3000, 1, 1, 1)]
    packed = pa.array([zlib.compress(t) for t in texts], pa.binary())
    slices = list(near_dedup.pair_slices(packed, packed, 1000))
    assert [b for b, *_ in slices] == [0, 3, 4]
    assert [t for _, left, _ in slices for t in left] == texts == [t for *_, right in slices for t in right]
    assert all(2 * sum(map(len, left)) <= 1000 or len(left) == 1 for _, left, _ in slices)
    assert list(near_dedup.pair_slices(packed.slice(0, 0), packed.slice(0, 0))) == []
