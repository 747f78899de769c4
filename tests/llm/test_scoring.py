"""Toxicity, language-model scoring, byte pairs and chat on small cases and against brute force."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from plotloom.llm import bpe, chat, coding, hidden_markov, toxicity

DOCS = "doc_id long, text string"
CLASHING = ["chunk", "flag", "words", "codes", "ids", "decoded", "label", "score", "_id", "symbols", "place"]
EDGES = [(1000, None), (1001, ""), (1002, " \n\t "), (1003, "é" * 30000), (1004, "word " * 30000), (None, "no id here")]


def docs_of(spark, rows, partitions=3):
    return spark.createDataFrame(rows, DOCS).repartition(partitions)


def with_clashes(frame):
    return frame.withColumns({name: F.lit(f"own {name}") for name in CLASHING})


def prose(draw, words, letters="abcdefghilmnorst"):
    return " ".join("".join(draw.choice(letters) for _ in range(draw.randrange(2, 9))) for _ in range(words))


# Codes -----------------------------------------------------------------------------


@pytest.mark.parametrize("numbers", [[], [0], [127, 128, 16383, 16384, 2**21, 2**28, 2**40], list(range(1000))])
def test_packed_numbers(numbers):
    assert coding.unpack(coding.pack(np.array(numbers, dtype=np.int64))).tolist() == numbers


def test_packed_words():
    words = [b"", b"a", b"\x00\n", "é".encode(), b"x" * 70000]
    assert coding.unpack_words(coding.pack_words(words)) == words
    assert coding.unpack_words(coding.pack_words([])) == []


# Byte pairs ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    tiktoken = pytest.importorskip("tiktoken")
    public = pytest.importorskip("public_tokenizers")
    ranks, pattern = bpe.default_tokenizer()
    return ranks, pattern, tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_pairs_as_the_library_does(spark, tokenizer):
    ranks, pattern, library = tokenizer
    draw = random.Random(1)
    alphabet = list("ab cé\n\t.'s1² \x1d\x85\xa0ǅ漢😀‍'") + ["'ll", "<|endoftext|>", "  ", "the ", "ing"]
    rows = [(i, "".join(draw.choice(alphabet) for _ in range(draw.randrange(200)))) for i in range(200)] + EDGES
    rows += [(i, t) for i, t in rows[:5]]
    encoded = bpe.encode(with_clashes(docs_of(spark, rows)), ranks, pattern)
    found = bpe.digests(encoded, ranks).collect()
    read = Counter(bytes(r.decoded).decode() for r in bpe.decode(encoded.withColumn("decoded", F.lit(1)), ranks).collect())
    assert read == Counter(text or "" for _, text in rows)
    expected = Counter()
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        expected[
            doc_id,
            len(ids),
            hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest(),
        ] += 1
    assert Counter(tuple(r) for r in found) == expected


def test_byte_pairs_of_small_chunks(spark, tokenizer, monkeypatch):
    ranks, pattern, library = tokenizer
    monkeypatch.setattr(bpe, "BATCH_WORDS", 3)
    draw = random.Random(2)
    rows = [(i, prose(draw, 40)) for i in range(30)]
    found = {r.doc_id: r.ids for r in bpe.encode(docs_of(spark, rows), ranks, pattern).collect()}
    assert found == {i: library.encode_ordinary(t) for i, t in rows}


def test_byte_pairs_of_an_empty_table(spark, tokenizer):
    ranks, pattern, _ = tokenizer
    assert bpe.decode(bpe.encode(docs_of(spark, []), ranks, pattern), ranks).count() == 0


def test_long_words_merge_like_short_ones(tokenizer):
    ranks, _, library = tokenizer
    draw = random.Random(3)
    for size in (1, 2, 7, 100, 3000):
        word = "".join(draw.choice("aabbcthein") for _ in range(size))
        # Letters only: the pattern takes the whole word.
        assert bpe.merge(word.encode(), ranks) == library.encode_ordinary(word)


def test_packing_and_decoding_take_little_memory(tokenizer):
    import tracemalloc

    import pyarrow as pa

    numbers = np.random.default_rng(4).integers(0, 1 << 40, 1 << 21) >> np.arange(1 << 21) % 40
    tracemalloc.start()
    packed = coding.pack(numbers)
    unpacked = coding.unpack(packed)
    # The numbers themselves take 16 MiB.
    assert tracemalloc.get_traced_memory()[1] < 56 << 20
    tracemalloc.stop()
    assert np.array_equal(numbers, unpacked) and len(coding.unpack(coding.pack(numbers[:0]))) == 0
    ids = pa.array([[1] * 200_000, None, [], [2] * 100_000, [3] * 400_000, [4]], pa.list_(pa.int32()))
    batches = [pa.record_batch([ids], ["ids"]), pa.record_batch([ids[:0]], ["ids"])]
    found = [[len(a) for a in arrays] for _, arrays in bpe._id_slices(batches, "ids")]
    assert found == [[200_000, 0, 0], [100_000], [400_000], [1]]


def test_materialised_stages_send_short_batches(spark):
    from plotloom.operators.sizing import cut_lineage
    from plotloom.session import BATCH_ROWS

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.record_batch([pa.array([batch.num_rows], pa.int64())], ["n"])

    found = [r.n for r in cut_lineage(spark.range(0, 4500, 1, 1).mapInArrow(sizes, "n long")).collect()]
    assert sum(found) == 4500 and max(found) == BATCH_ROWS and spark.conf.get(name) == before


# Hidden Markov model ---------------------------------------------------------------


@pytest.fixture
def small_model(monkeypatch):
    monkeypatch.setattr(hidden_markov, "STATES", 3)
    monkeypatch.setattr(hidden_markov, "SYMBOLS", 5)
    return hidden_markov.random_model(np.array([0.3, 0.1, 0.2, 0.25, 0.15]))


def test_forward_against_all_paths(small_model):
    sequences = [np.array(s) for s in ([0], [4, 1], [2, 2, 0, 3], [1, 0, 1, 4, 3])]
    found = hidden_markov.log_likelihoods(sequences, small_model)
    for sequence, value in zip(sequences, found):
        total = 0.0
        for path in itertools.product(range(3), repeat=len(sequence)):
            p = small_model.start[path[0]] * small_model.emit[path[0], sequence[0]]
            for a, b, symbol in zip(path, path[1:], sequence[1:]):
                p *= small_model.move[a, b] * small_model.emit[b, symbol]
            total += p
        assert math.isclose(value, math.log10(total), rel_tol=1e-9)


def test_expected_counts_against_all_paths(small_model):
    sequences = [np.array(s) for s in ([2, 2, 0, 3], [1], [4, 1, 0])]
    starts, moves, emitted, likelihood = hidden_markov.expected_counts(sequences, small_model)
    want = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))
    for sequence in sequences:
        weights = {}
        for path in itertools.product(range(3), repeat=len(sequence)):
            p = small_model.start[path[0]] * small_model.emit[path[0], sequence[0]]
            for a, b, symbol in zip(path, path[1:], sequence[1:]):
                p *= small_model.move[a, b] * small_model.emit[b, symbol]
            weights[path] = p
        total = sum(weights.values())
        for path, p in weights.items():
            want[0][path[0]] += p / total
            for a, b in zip(path, path[1:]):
                want[1][a, b] += p / total
            for state, symbol in zip(path, sequence):
                want[2][state, symbol] += p / total
    for got, expected in zip((starts, moves, emitted), want):
        np.testing.assert_allclose(got, expected, rtol=1e-5)
    assert math.isclose(likelihood, hidden_markov.log_likelihoods(sequences, small_model).sum(), rel_tol=1e-9)


def test_baum_welch_never_gets_worse(small_model):
    draw = np.random.default_rng(1)
    sequences = [draw.integers(0, 5, 30) % (2 + i % 4) for i in range(20)]
    shares = np.full(5, 0.2)
    model, before = small_model, -np.inf
    for _ in range(10):
        *counts, likelihood = hidden_markov.expected_counts(sequences, model)
        assert likelihood >= before - 0.05
        before, model = likelihood, hidden_markov.improved(*counts, shares)


def test_training_goes_on_until_the_likelihood_settles(spark):
    draw = np.random.default_rng(3)
    rows = []
    for _ in range(900):
        # Runs of two kinds of symbols, so that there are states to be found.
        kind = np.repeat(draw.integers(0, 2, 12), 5)
        rows.append((bytearray((kind * 300 + draw.integers(0, 300, 60)).astype("<u2").tobytes()),))
    sequences = spark.createDataFrame(rows, "symbols binary").repartition(3)
    counts = np.bincount(np.concatenate([np.frombuffer(r[0], "<u2") for r in rows]), minlength=hidden_markov.SYMBOLS)
    shares = (counts + 0.5) / (counts + 0.5).sum()
    model = hidden_markov.train(sequences, shares)
    every = [np.frombuffer(r[0], "<u2") for r in rows]
    *found, likelihood = hidden_markov.expected_counts(every, model)
    after = hidden_markov.expected_counts(every, hidden_markov.improved(*found, shares))[-1]
    assert after - likelihood <= 2e-5 * abs(likelihood)


def test_training_begins_near_its_end(spark, monkeypatch):
    """A random model creeps for dozens of rounds; that of all pairs of neighbours is most of the way there."""
    draw = np.random.default_rng(5)
    every = []
    for _ in range(600):
        kind = np.repeat((draw.integers(0, 8) + np.arange(10)) % 8, 4)
        every.append((kind * 30 + draw.integers(0, 30, 40)).astype("<u2"))
    sequences = spark.createDataFrame([(bytearray(s.tobytes()),) for s in every], "symbols binary").repartition(3)
    pairs = hidden_markov.pair_counts(sequences)
    want = np.zeros_like(pairs)
    for s in every:
        np.add.at(want, (s[:-1], s[1:]), 1)
    assert (pairs == want).all()
    counts = np.bincount(np.concatenate(every), minlength=hidden_markov.SYMBOLS)
    shares = (counts + 0.5) / (counts + 0.5).sum()
    rounds = []
    once = hidden_markov.baum_welch_round
    monkeypatch.setattr(hidden_markov, "baum_welch_round", lambda *a: rounds.append(once(*a)) or rounds[-1])
    hidden_markov.train(sequences, shares)
    random = hidden_markov.expected_counts(every, hidden_markov.random_model(shares))[-1]
    first, last = rounds[0][1], rounds[-1][1]
    assert random < first <= last and last - first < 0.2 * (last - random)


def test_long_sequences_do_not_underflow():
    model = hidden_markov.random_model(np.full(hidden_markov.SYMBOLS, 1 / hidden_markov.SYMBOLS))
    value = hidden_markov.log_likelihoods([np.zeros(50000, dtype=np.int64), np.array([1])], model)
    assert np.isfinite(value).all() and value[0] < -100000


def test_scores(spark):
    draw = random.Random(4)
    tongues = ["abcde", "lmnop", "vwxyz"]
    rows = [(i, "A " + prose(draw, draw.randrange(5, 120), tongues[i % 3])) for i in range(300)] + EDGES
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 1
    found = hidden_markov.score(with_clashes(docs_of(spark, rows)), held).collect()

    def split(text):
        return (text or "").encode().lower().split() + [b""]

    def is_held(doc_id):
        return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1

    counts = Counter(w for i, t in rows if not is_held(i) for w in split(t))
    total, types = sum(counts.values()), len(counts)
    texts = dict(rows)
    for r in found:
        own = split(texts[r.doc_id])
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (types + 1))) for w in own)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (is_held(r.doc_id), len(own), total)
        assert r.n_known == sum(counts[w] > 0 for w in own)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    ordinary = [r for r in found if r.doc_id is not None and r.doc_id < 1000 and r.held_out]
    assert sum(r.score for r in ordinary) > sum(r.base_score for r in ordinary)
    assert len(found) == len(rows)


def test_probabilities_of_all_one_token_continuations_sum_to_one():
    """Symbols and shares within them: a proper distribution over known tokens and one unknown per symbol."""
    mass, types = np.array([5.0, 3.0, 0.0]), np.array([1.0, 2.0, 0.0])
    shares = [[1.0], [(n + 0.5) / (3 + 0.5 * 3) for n in (2, 1, 0)], [0.5 / 0.5]]
    for i, own in enumerate(shares):
        assert math.isclose(sum(own), 1.0), (mass[i], types[i])


def test_scores_without_training_rows(spark):
    found = hidden_markov.score(docs_of(spark, [(1, "a b"), (2, None)]), F.lit(True)).collect()
    assert {r.train_tokens for r in found} == {0} and all(np.isfinite(r.score) for r in found)
    assert hidden_markov.score(docs_of(spark, []), F.lit(False)).count() == 0


# Toxicity --------------------------------------------------------------------------


def test_toxicity(spark):
    draw = random.Random(5)
    insults = ["dunderhead", "nincompoop", "blockhead"]
    rows, labels = [], []
    for i in range(5000, 6500):
        words = prose(draw, draw.randrange(20, 120)).split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(1 + len(words) // 25):
                words.insert(draw.randrange(len(words)), draw.choice(insults).upper() if i % 2 else draw.choice(insults))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    known = [(i, t) for i, t in labels if i % 4 != 2] + [(None, 1), (5007, None), (5008, 5), labels[11]]
    table = spark.createDataFrame(known, "doc_id long, label int")
    found = toxicity.score(with_clashes(docs_of(spark, rows + EDGES)), table).collect()
    got = {r.doc_id: r for r in found}
    held = [(got[i].predicted, t) for i, t in labels if i % 4 == 2]
    assert np.mean([p == t for p, t in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    empty = {got[i].score for i in (1000, 1001, 1002)}
    assert len(empty) == 1 and abs(empty.pop() - 0.2) < 0.02
    assert len(found) == len(rows) + len(EDGES)


def test_toxicity_probabilities_sum_to_one():
    draw = random.Random(6)
    words = sorted({w.encode() for w in prose(draw, 200, "abcd").split()})
    keys, _ = toxicity.grams(words)
    known, counts = np.unique(keys, return_counts=True)
    model = toxicity.build_model(known, np.column_stack((counts, counts)))
    # Equal counts: both classes say the same about everything, seen or not.
    np.testing.assert_allclose(model.word_values(words + [b"zzz", "é".encode()]), 0, atol=1e-12)
    context = np.uint64(int.from_bytes(b"  abc", "big"))
    every = (context << np.uint64(8)) | np.arange(256, dtype=np.uint64)
    one_sided = toxicity.build_model(known, np.column_stack((counts, np.where(counts > 1, counts, 0))))
    ratio = one_sided._ratio(every)
    assert np.isfinite(ratio).all()


def test_toxicity_without_labels(spark):
    docs = docs_of(spark, [(1, "a text"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, label int")
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    one = spark.createDataFrame([(1, 1)], "doc_id long, label int")
    assert {r.score for r in toxicity.score(docs, one).collect()} == {1.0}
    assert toxicity.score(docs_of(spark, []), one).count() == 0


# Chat ------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string"


def test_chat_round_trip_of_control_strings(spark):
    draw = random.Random(7)
    parts = ["\\", "[", "<", "/s>", "[INST]", " [/INST]", "</s>", "<s> ", " ", "x", "[TE", "XT]", "é", "😀", "\n", "$1"]
    roles = ["user", "assistant", "system", "tool", "[TEXT] ", "a\\", "", None]
    rows = [
        (draw.choice([1, 2, 3, None]), i, draw.choice(roles), None if i % 9 == 0 else "".join(draw.choices(parts, k=12)))
        for i in range(500)
    ]
    rows.append(rows[0])
    frame = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("own") for c in ("state", "first", "place", "segments")})
    formatted = chat.format_turns(frame)
    for conv in (1, 2, 3, None):
        mine = formatted.where(F.col("conv_id").eqNullSafe(F.lit(conv))).orderBy("place").collect()
        text = "".join(s.text for r in mine for s in r.segments)
        expected = sorted(
            ((t, r or "", x or "") for c, t, r, x in rows if c == conv), key=lambda t: t
        )
        assert chat.parse(text) == [(r, x) for _, r, x in expected]
        back = next(r for r in chat.read_back(formatted).collect() if r.conv_id == conv)
        learned = "".join(x for _, r, x in expected if r == "assistant")
        assert (back.n_turns, back.loss_chars, back.formatted_chars) == (len(expected), len(learned), len(text))
        assert back.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
        turns = "".join(f"{r}\n{x}\n" for _, r, x in expected)
        assert back.turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()


@pytest.mark.parametrize(
    ("roles", "allowed"),
    [
        (["user", "assistant"], [True, True]),
        (["system", "user", "assistant", "user"], [True, True, True, True]),
        (["assistant", "user"], [False, True]),
        (["user", "user", "assistant"], [True, False, True]),
        (["user", "system"], [True, False]),
        (["tool"], [False]),
        ([None], [False]),
        (["start", "user"], [False, False]),
    ],
)
def test_turn_order(spark, roles, allowed):
    frame = spark.createDataFrame([(1, i, r, "t") for i, r in enumerate(roles)], TURNS)
    formatted = chat.format_turns(frame)
    assert [r.allowed for r in formatted.orderBy("place").collect()] == allowed
    ends = roles[-1] in chat.INSTRUCT.ends
    assert chat.read_back(formatted).first().in_order == (all(allowed) and ends)


def test_chat_of_an_empty_table(spark):
    assert chat.read_back(chat.format_turns(spark.createDataFrame([], TURNS))).count() == 0


def test_a_template_with_ambiguous_marks_is_refused():
    with pytest.raises(ValueError):
        chat.Template(follows={}, ends=(), marks={"user": ("a]", "[b[")}, loss=(), other=("[x]", "[y]", "[z]"))
