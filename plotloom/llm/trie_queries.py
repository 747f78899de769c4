"""The query on rebuilt conversations and its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotloom.llm import trie
from plotloom.llm.registry import query, table

# The checksum of a number's digits is taken bit by bit: each byte is followed by seven zeros.
TRIE_SQL = """
with own as (
  select conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} order by turn nulls first) as s
  from conversations where conv_id is not null group by conv_id),
checked as (
  select conv_id, s, list_reduce(
      list_prepend(4294967295::bigint, flatten(list_transform(string_split(conv_id::varchar, ''),
        lambda c: [ord(c)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
      lambda a, v: xor(xor(a, v) >> 1, 3988292384 * (xor(a, v) & 1))) as crc
  from own),
heads as (select conv_id, s, xor(crc, 4294967295) % 9 as h from checked),
rebuilt as (
  select c.conv_id, list_concat(coalesce(b.s[1:c.h], []), c.s[c.h + 1:]) as s
  from heads c left join heads b on b.conv_id = c.conv_id - c.conv_id % 5),
prefixes as (select conv_id, len(s) as length, s, unnest(range(0, len(s) + 1)) as depth from rebuilt),
members as (select conv_id, depth, s[1:depth] as prefix, length = depth as ended from prefixes),
nodes as (
  select depth, prefix, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ended), '')) as ends_sha256
  from members group by depth, prefix),
kids as (
  select depth - 1 as depth, prefix[1:depth - 1] as prefix, count(*) as n from nodes where depth > 0 group by all),
full_nodes as (
  select n.*, coalesce(k.n, 0) as n_children, p.conv_id as parent_conv_id
  from nodes n left join kids k on k.depth = n.depth and k.prefix = n.prefix
    left join nodes p on p.depth = n.depth - 1 and p.prefix = n.prefix[1:n.depth - 1]),
paths as (
  select unnest(range(0, depth + 1)) as up, prefix, n_children,
    case when depth = 0 then 0 else (n_convs - 1) * strlen(prefix[depth].text) end as saved
  from full_nodes),
sums as (
  select up as depth, prefix[1:up] as prefix, count(*) filter (n_children = 0) as n_leaves, sum(saved) as saved
  from paths group by all)
select n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children, s.n_leaves,
  cast(s.saved as bigint) as saved_tokens, n.ends_sha256
from full_nodes n join sums s on s.depth = n.depth and s.prefix = n.prefix"""


@query("op12_prefix_trie", TRIE_SQL)
def op12_prefix_trie(spark, folder):
    """The trie of all conversations, each rebuilt on the head of the first one of its five."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    conv = F.col("conv_id")
    head = F.crc32(conv.cast("string").cast("binary")) % 9
    rebuilt, convs = trie.shared_heads(trie.placed(turns), conv - conv % 5, head)
    return trie.prefix_trie(rebuilt, convs).withColumnRenamed("ends", "ends_sha256")
