"""The query on licence notices and its SQL."""

from __future__ import annotations

import string

from pyspark.sql import functions as F

from plotloom.llm import license_scan
from plotloom.llm.registry import query, table


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


def license_sql() -> str:
    templates = license_scan.template_words()
    words = [(t, q, w) for t, template in enumerate(templates) for q, w in enumerate(template)]
    labels = [(t, label) for t, (label, _, _) in enumerate(license_scan.TEMPLATES)]
    phrases = []
    for t, (_, _, texts) in enumerate(license_scan.TEMPLATES):
        for number, text in enumerate(texts):
            parts = text.split()
            q = next(q for q in range(len(templates[t])) if templates[t][q : q + len(parts)] == parts)
            phrases += [(t, number, q + j, w) for j, w in enumerate(parts)]
    base = [(label, j, w) for text, label in license_scan.BASE for j, w in enumerate(text.split())]
    return f"""
with template(t, q, word) as (values {_values(words)}),
labelled(t, label) as (values {_values(labels)}),
phrase(t, number, q, word) as (values {_values(phrases)}),
base_phrase(label, j, word) as (values {_values(base)}),
texts as (
  select row_number() over () as r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words
  from documents),
cut as (select r, unnest(words) as word, unnest(range(0, len(words))) as p from texts),
hit as (select * from cut where word in (select word from template)),
holding as (select word, count(distinct r) as n from hit group by word),
weighed as (
  select t.*, coalesce(h.n, 0) as n, 1 + ln(((select count(*) from texts) + 1) / (coalesce(h.n, 0) + 1)) as weight
  from template t left join holding h on h.word = t.word),
ranked as (select *, row_number() over (partition by t order by n, q) as nth, sum(weight) over (partition by t) as total
  from weighed),
rare as (select * from ranked where nth <= {license_scan.RARE}),
needed as (select t, (count(*) + 1) // 2 as votes from rare group by t),
agreed as (
  select v.r, v.t, v.at from (
    select h.r, x.t, h.p - x.q as at, count(*) as votes from hit h join rare x on x.word = h.word group by all) v
  join needed n on n.t = v.t and v.votes >= n.votes),
sizes as (select t, number, count(*) as size from phrase group by all),
standing as (
  select a.r, a.t, a.at, f.number, s.shift, count(*) as same
  from agreed a join phrase f on f.t = a.t cross join (select unnest(range(-{license_scan.DRIFT}, {license_scan.DRIFT} + 1)) as shift) s
    join hit h on h.r = a.r and h.p = a.at + f.q + s.shift and h.word = f.word
  group by all),
verified as (
  select a.r, a.t, a.at from standing a join sizes z on z.t = a.t and z.number = a.number and z.size = a.same
  group by a.r, a.t, a.at
  having count(distinct a.number) = (select count(*) from sizes y where y.t = a.t)),
shared as (
  select v.r, v.t, least(round(sum(x.weight / x.total), 6), 1.0::double) as share
  from verified v join ranked x on x.t = v.t join hit h on h.r = v.r and h.p = v.at + x.q and h.word = x.word
  group by v.r, v.t, v.at),
found as (
  select s.r, l.label, s.share from shared s join labelled l on l.t = s.t where s.share >= {license_scan.SHARE}),
base as (
  select f.r, f.label, f.p from (
    select h.r, b.label, h.p - b.j as p, count(*) as same from hit h join base_phrase b on b.word = h.word group by all) f
  join (select label, count(*) as size from base_phrase group by label) z on z.label = f.label and z.size = f.same),
based as (
  select r, count(*) as n, min(p) as first_word, max(p) as last_word,
    string_agg(distinct label, ',' order by label) as labels from base group by r),
every as (select r, label from found union select r, label from base),
named as (select r, string_agg(label, ',' order by label) as labels from every group by r),
best as (select r, max(share) as share from found group by r)
select x.doc_id, len(x.words) as n_words, coalesce(b.n, 0) as n_base, cast(b.first_word as bigint) as first_word,
  cast(b.last_word as bigint) as last_word, coalesce(b.labels, '') as base_labels, coalesce(n.labels, '') as labels,
  coalesce(s.share, 0.0::double) as score
from texts x left join based b on b.r = x.r left join named n on n.r = x.r left join best s on s.r = x.r"""


def label_list(labels):
    return F.array_join(F.sort_array(F.array_distinct(labels)), ",")


@query("op13_license_scan", license_sql())
def op13_license_scan(spark, folder):
    """Base places and the licences that the index finds, for every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = license_scan.scan(docs, license_scan.build_index(*license_scan.frequencies(docs)))
    base = F.transform("base", lambda b: b["label"])
    more = F.transform("licences", lambda x: x["label"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.get("base", F.lit(0))["first_word"].cast("long").alias("first_word"),
        F.get("base", F.size("base") - 1)["first_word"].cast("long").alias("last_word"),
        label_list(base).alias("base_labels"),
        label_list(F.concat(base, more)).alias("labels"),
        F.coalesce(F.array_max(F.transform("licences", lambda x: x["share"])), F.lit(0.0)).alias("score"),
    )
