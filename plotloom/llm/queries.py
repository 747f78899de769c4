"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotloom.llm import bpe, chat, decontam, fingerprints, hidden_markov, lines, near_dedup, quality, secret_scan, toxicity
from plotloom.llm import license_queries, trie_queries, vector_queries  # noqa: F401  (they register theirs)
from plotloom.llm.registry import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]

LINES_SQL = """
with split as (select doc_id, text, string_split(coalesce(text, ''), chr(10)) as ls from documents),
starts as (select doc_id, ls, unnest(range(0, len(ls) - 2)) as p from split where len(ls) >= 3),
found as (select doc_id, p, ls[p + 1] as a, ls[p + 2] as b, ls[p + 3] as c from starts),
ranked as (
  select doc_id, p, row_number() over (partition by a, b, c order by doc_id, p) as nth
  from found where a <> '' or b <> '' or c <> ''),
covered as (
  select distinct doc_id, unnest([p, p + 1, p + 2]) as line from ranked where nth > 1),
islands as (
  select doc_id, line, line - row_number() over (partition by doc_id order by line) as island from covered),
spans as (select doc_id, min(line) as first, max(line) as last from islands group by doc_id, island),
removed as (
  select doc_id, sum(last - first + 1) as n,
    string_agg(concat(first, '-', last), ',' order by first) as spans from spans group by doc_id),
numbered as (select doc_id, unnest(ls) as line, unnest(range(0, len(ls))) as p from split),
kept as (
  select n.doc_id, string_agg(n.line, chr(10) order by n.p) as text
  from numbered n anti join covered c on n.doc_id = c.doc_id and n.p = c.line group by n.doc_id)
select s.doc_id, case when s.text is null then 0 else len(s.ls) end as n_lines,
  cast(coalesce(r.n, 0) as bigint) as n_removed, coalesce(r.spans, '') as removed_lines,
  case when r.n is null then s.text else coalesce(k.text, '') end as text
from split s left join removed r on s.doc_id = r.doc_id left join kept k on s.doc_id = k.doc_id"""


@query("op1_line_dedup", LINES_SQL)
def op1_line_dedup(spark, folder):
    found = lines.dedup_lines(table(spark, folder, "documents"))
    spans = F.transform("removed_lines", lambda s: F.concat_ws("-", s["first"], s["last"]))
    return found.select("doc_id", "n_lines", "n_removed", F.array_join(spans, ",").alias("removed_lines"), "text")


def spans_text(spans):
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in secret_scan.KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


@query("op10_secret_scan")
def op10_secret_scan(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = secret_scan.train(secret_scan.sample_strings(docs))
    found = secret_scan.scan(docs, model).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["kind"] < 3)

    def of_kind(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        of_kind(0).alias("n_assign"),
        of_kind(1).alias("n_access"),
        of_kind(2).alias("n_hex"),
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )


@query("op8_near_dedup")
def op8_near_dedup(spark, folder):
    """Every document with its class and the least document of the same text."""
    return near_dedup.near_classes(table(spark, folder, "documents"))


@query("op7_fingerprints")
def op7_fingerprints(spark, folder):
    """Every row beside its edited and its next text, with the group of similar rows that it is in."""
    return fingerprints.with_groups(table(spark, folder, "documents"))


@query("op3_byte_bpe")
def op3_byte_bpe(spark, folder):
    ranks, pattern = bpe.default_tokenizer()
    return bpe.digests(bpe.encode(table(spark, folder, "documents"), ranks, pattern), ranks)


def part_of(parts):
    """crc32 of the id as text, modulo the number of parts."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(parts))


@query("op9_lm_scoring")
def op9_lm_scoring(spark, folder):
    return hidden_markov.score(table(spark, folder, "documents"), part_of(5) == 1)


@query("op6_toxicity")
def op6_toxicity(spark, folder):
    held_out = part_of(4) == 2
    labels = table(spark, folder, "labels").where(~held_out).select("doc_id", F.col("toxic").alias("label"))
    found = toxicity.score(table(spark, folder, "documents"), labels)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


# A conversation that consists of control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


@query("op4_chat_format")
def op4_chat_format(spark, folder):
    extra = spark.createDataFrame(
        [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)],
        "conv_id long, turn long, role string, text string",
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_turns(rows))


@query("op2_decontaminate")
def op2_decontaminate(spark, folder):
    """One row per passage found, with the document and the item."""
    return decontam.find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op5_quality")
def op5_quality(spark, folder):
    return quality.classify(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "score", "keep")
