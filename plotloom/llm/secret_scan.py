"""Secret scans in DataFrame functions only: fixed patterns, and two character Markov models.

Three patterns give the base spans.  Besides them, every run of 20 or more key characters is
scored by two first-order Markov models of characters, one of random strings and one of
ordinary identifiers; a run whose mean log-likelihood ratio per step is above a threshold is
reported as kind ``markov`` unless a base span overlaps it.

The models are trained from labelled samples (value, label) by counting character pairs in
Spark.  What reaches the driver is one number per pair of the 80 possible characters and
label, however many samples there are.

Defined results: a null text counts as empty and has no span.  Positions are code points from
0, ends exclusive.  Matches of one kind are found from the left and do not overlap; those of
different base kinds may.  Rows are independent, so repeated rows get equal results.  Further
columns are passed through; one named ``spans`` is replaced.  Without samples both models are
uniform and no run is reported.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# An assignment counts if the value has 6 characters.
ASSIGN = "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ASSIGN_VALUE = 6
# A whole run is one match, so asking for the length in the pattern drops the shorter runs.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "(?<![0-9a-f])[0-9a-f]{24,}"
RUN = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
WORD = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{6,}"
KINDS = ("assign", "access", "hex", "markov")

# Key characters lie between '+' and 'z'.
FIRST_CHAR, CHARS = 43, 80
# Added to every character's count.
SMOOTHING = 0.5
# Pseudo-counts with which the pairs of a first character lean on the characters' overall shares.
BACKOFF = 20
# Mean log-likelihood ratio per step, in nats, above which a run is reported.
THRESHOLD = 1.0
# Expected number of documents whose strings serve as labelled samples.
SAMPLE_DOCS = 2000

SPANS = "array<struct<start:int,kind:int,end:int>>"


def match_spans(text: Column, pattern: str, matches: Column, kind: int, keep: Column) -> Column:
    """Spans of the matches whose flag in ``keep`` is set.

    A match starts after all pieces and matches before it; one pass over the matches.
    """
    pieces = F.transform(F.split(text, pattern, -1), F.length)
    parts = F.arrays_zip(pieces.alias("gap"), F.transform(matches, F.length).alias("size"), keep.alias("keep"))
    parts = parts.cast("array<struct<gap:int,size:int,keep:boolean>>")

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + part["gap"]
        end = start + F.coalesce(part["size"], F.lit(0))
        span = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end")))
        spans = F.when(part["keep"], F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    nothing = F.array().cast(SPANS)
    begin = F.struct(F.lit(0).alias("at"), nothing.alias("spans"))
    found = F.aggregate(parts, begin, step, lambda state: state["spans"])
    return F.when(F.exists(keep, lambda k: k), found).otherwise(nothing)


def always(matches: Column) -> Column:
    return F.transform(matches, lambda m: F.lit(True))


def all_matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def base_spans(docs: DataFrame) -> DataFrame:
    """Adds ``_base``, the spans of the three patterns, to a table with ``_text``."""
    text = F.col("_text")
    found = docs.withColumns(
        {
            "_assign": all_matches(text, ASSIGN),
            "_access": all_matches(text, ACCESS),
            "_hex": all_matches(text, HEX),
        }
    )
    value = F.transform("_assign", lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= ASSIGN_VALUE)
    return found.withColumn(
        "_base",
        F.array_sort(
            F.concat(
                match_spans(text, ASSIGN, F.col("_assign"), 0, value),
                match_spans(text, ACCESS, F.col("_access"), 1, always(F.col("_access"))),
                match_spans(text, HEX, F.col("_hex"), 2, always(F.col("_hex"))),
            )
        ),
    )


def sample_strings(docs: DataFrame, size: int = SAMPLE_DOCS) -> DataFrame:
    """Labelled samples (value, label) from about ``size`` documents chosen by hash.

    Random strings (1): values that the base patterns find there, and the base-64 and
    base-16 digests of the sampled texts.  Ordinary identifiers (0): the other words of at
    least six key characters.
    """
    total = docs.count()
    share = 1.0 if total <= size else size / total
    # The upper 53 bits as a number from 0 to 1.
    place = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 11) / float(1 << 53)
    chosen = docs.where(place < share).select(F.coalesce("text", F.lit("")).alias("_text"))
    found = base_spans(chosen).select(
        "_text",
        F.transform("_base", lambda s: F.substring("_text", s["start"] + 1, s["end"] - s["start"])).alias("_values"),
        all_matches(F.col("_text"), WORD).alias("_words"),
    )
    digest = F.sha2("_text", 256)
    values = F.flatten(
        F.array(
            F.transform("_values", lambda v: F.regexp_extract(v, "([A-Za-z0-9+/_=-]+)$", 1)),
            F.array(F.base64(F.unhex(digest)), F.substring(digest, 1, 40)),
        )
    )
    ordinary = F.filter("_words", lambda w: ~F.exists("_values", lambda v: v.contains(w)))
    labelled = F.concat(
        F.transform(values, lambda v: F.struct(v.alias("value"), F.lit(1).alias("label"))),
        F.transform(ordinary, lambda v: F.struct(v.alias("value"), F.lit(0).alias("label"))),
    )
    return found.select(F.explode(labelled).alias("s")).select("s.value", "s.label")


def code(char: Column) -> Column:
    return F.ascii(char) - FIRST_CHAR


def pair_places(value: Column) -> Column:
    """Place of each character pair of the value in a table of all pairs."""
    chars = F.split(value, "")
    last = F.length(value) - 2
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: code(F.get(chars, i)) * CHARS + code(F.get(chars, i + 1))
    )


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio (random to ordinary) of every character pair, row by row."""
    usable = samples.where(F.col("value").rlike("^[+-z]{2,}$") & F.col("label").isin(0, 1))
    counted = (
        usable.select("label", F.explode(pair_places(F.col("value"))).alias("pair")).groupBy("label", "pair").count()
    )
    counts = [[0] * (CHARS * CHARS) for _ in range(2)]
    for row in counted.collect():  # at most 2 * 80 * 80 rows
        counts[row["label"]][row["pair"]] = row["count"]
    logs = []
    for table in counts:
        by_second = [sum(table[b::CHARS]) + SMOOTHING for b in range(CHARS)]
        overall = [n / sum(by_second) for n in by_second]
        totals = [sum(table[a * CHARS : (a + 1) * CHARS]) + BACKOFF for a in range(CHARS)]
        logs.append([math.log((n + BACKOFF * overall[i % CHARS]) / totals[i // CHARS]) for i, n in enumerate(table)])
    return [random - ordinary for ordinary, random in zip(*logs)]


def mean_ratio(value: Column, model: list[float]) -> Column:
    """Mean log-likelihood ratio per step; the table is a constant of 6,400 numbers."""
    table = F.split(F.lit(",".join(f"{x:.4f}" for x in model)), ",").cast("array<double>")
    total = F.aggregate(pair_places(value), F.lit(0.0), lambda acc, place: acc + F.get(table, place))
    return total / (F.length(value) - 1)


def scan(docs: DataFrame, model: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """The documents with ``spans``: (start, kind, end) by start, then kind; kind indexes ``KINDS``."""
    kept = [c for c in docs.columns if c.lower() != "spans"]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.coalesce("text", F.lit("")).alias("_text"),
    )
    runs = base_spans(rows).withColumn("_runs", all_matches(F.col("_text"), RUN))
    scored = runs.withColumn("_likely", F.transform("_runs", lambda r: mean_ratio(r, model) > threshold))
    likely = match_spans(F.col("_text"), RUN, F.col("_runs"), 3, F.col("_likely"))
    free = F.filter(
        likely, lambda s: ~F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    )
    spans = F.array_sort(F.concat("_base", free))
    # First all results, then the columns of the row, which may have any name.
    done = scored.select("_row", spans.alias("_spans"))
    return done.select(*[F.col("_row")[c].alias(c) for c in kept], F.col("_spans").alias("spans"))
