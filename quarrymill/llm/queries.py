"""Queries of the corpus operators, each over its whole table, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from quarrymill.llm import (
    embedding_pq, hpy_model, language_id, lexical_search, license_scan, line_dedup, minhash, mixing, packing, prefix_trie,
    simhash, token_counts, token_records,
)
from quarrymill.tables import Tables

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        _QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            _SQL[name] = sql
        return fn

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@query("op1_language_id")
def op1(t: Tables) -> DataFrame:
    """Fitted on the rows that are not held out; predicted from the text alone."""
    held = (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0)
    model = language_id.fit(t.documents.where(~held))
    rows = t.documents.select("doc_id", held.alias("held_out"), language_id.predict(F.col("text"), model).alias("r"))
    return rows.select("doc_id", "held_out", "r.*")


@query("op2_mixture")
def op2(t: Tables) -> DataFrame:
    return mixing.mix(t.documents).select("doc_id", "size", "source_size", "target", "taken", "copies")


@query("op3_simhash")
def op3(t: Tables) -> DataFrame:
    return simhash.near_duplicates(t.documents).select(
        "doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query("op4_embedding_pq")
def op4(t: Tables) -> DataFrame:
    return embedding_pq.links(t.embeddings)


@query("op5_token_counts")
def op5(t: Tables) -> DataFrame:
    counted = token_counts.token_counts(F.col("text"), public_tokenizers.path("piece_bpe_32k.model"))
    return t.documents.select("doc_id", counted.alias("r")).select("doc_id", "r.*")


@query("op6_line_dedup", """
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
keyed as (
  select doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from lines),
frequent as (
  select k from (select distinct doc_id, k from keyed where length(k) >= 1) group by k having count(*) >= 10)
select doc_id, count(*) as n_lines, count(f.k) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where f.k is null), '')) as kept_sha256
from keyed left join frequent f on keyed.k = f.k
group by doc_id
""")
def op6(t: Tables) -> DataFrame:
    return line_dedup.dedup(t.documents).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op7_token_records")
def op7(t: Tables) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    index = token_records.write_records(t.documents, path, end_id=1)
    return token_records.digests(index, token_records.id_bytes(t.spark, path))


@query("op9_minhash")
def op9(t: Tables) -> DataFrame:
    return minhash.compare_edited(t.documents)


@query("op8_packing")
def op8(t: Tables) -> DataFrame:
    return packing.pack(t.documents, keep=["doc_id"])


@query("op10_license_scan")
def op10(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", license_scan.scan(F.col("text")).alias("r")).select("doc_id", "r.*")
    base = F.filter("spans", lambda s: s.exact)
    starts = F.transform(base, lambda s: s.first_word.cast("bigint"))

    def names(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s.label))), ",")

    return rows.select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        names(base).alias("base_labels"), names(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s.likeness)), F.lit(0.0)).alias("score"), "spans",
    )


@query("op12_prefix_trie", """
with table256 as (
  select list(c order by i) as tab from (
    select i, list_reduce(list_prepend(i, range(8)::bigint[]),
      lambda c, b: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) as c
    from range(256) t(i))),
crcs as (
  select c, xor(list_reduce(
      list_prepend(4294967295, list_transform(string_split(c::varchar, ''), lambda s: ascii(s)::bigint)),
      lambda r, b: xor(r // 256, tab[xor(r % 256, b) + 1])), 4294967295) % 9 as h
  from (select distinct conv_id as c from conversations where conv_id is not null), table256),
turns as (
  select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), sha256(coalesce(text, ''))) as seq
  from conversations where conv_id is not null),
sizes as (select c, count(*) as n from turns group by c),
rebuilt as (
  select crcs.c, t.seq as pos, role, text from crcs join turns t on t.c = crcs.c - crcs.c % 5 and t.seq <= crcs.h
  union all
  select crcs.c, least(crcs.h, coalesce(b.n, 0)) + t.seq - crcs.h, role, text
  from crcs join turns t on t.c = crcs.c and t.seq > crcs.h left join sizes b on b.c = crcs.c - crcs.c % 5),
paths as (
  select c, pos as d, text, list(sha256(octet_length(encode(role)) || ':' || role || text)) over (partition by c order by pos) as path
  from rebuilt
  union all select c, 0, '', [] from crcs),
keyed as (select c, d, text, md5(array_to_string(path, ',')) as node from paths),
nodes as (
  select node, d, min(c) as conv_id, count(*) as n_convs, octet_length(encode(min(text))) as bytes
  from keyed group by node, d),
parents as (
  select n.*, p.conv_id as parent_conv_id
  from nodes n left join keyed k on k.c = n.conv_id and k.d = n.d - 1 left join nodes p on p.node = k.node and p.d = k.d),
kids as (select parent_conv_id as conv_id, d - 1 as d, count(*) as n_children from parents where d > 0 group by all),
full_nodes as (
  select p.*, coalesce(k.n_children, 0) as n_children from parents p left join kids k on k.conv_id = p.conv_id and k.d = p.d),
subtree as (
  select up.node, up.d, sum((q.n_convs - 1) * q.bytes) as saved_tokens, count(*) filter (where q.n_children = 0) as n_leaves
  from full_nodes q join keyed up on up.c = q.conv_id and up.d <= q.d group by up.node, up.d),
ends as (
  select k.node, k.d, sha256(string_agg(k.c::varchar, ',' order by k.c)) as ends_sha256
  from keyed k join (select c, max(d) as d from keyed group by c) l on l.c = k.c and l.d = k.d group by k.node, k.d)
select f.conv_id, f.d as depth, f.parent_conv_id, f.n_convs, f.n_children, s.n_leaves,
       cast(s.saved_tokens as bigint) as saved_tokens, coalesce(e.ends_sha256, sha256('')) as ends_sha256
from full_nodes f join subtree s on s.node = f.node and s.d = f.d left join ends e on e.node = f.node and e.d = f.d
""")
def op12(t: Tables) -> DataFrame:
    return prefix_trie.conversation_trie(t.conversations)


@query("op13_lexical_search", r"""
with words as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents),
lengths as (select doc_id, count(*)::bigint as n from words group by doc_id),
totals as (select count(*)::bigint as n_docs, sum(n)::bigint as n_terms from lengths),
asked as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark),
tfs as (
  select w.doc_id, w.term, count(*)::bigint as tf from words w semi join asked a on a.term = w.term group by w.doc_id, w.term),
weights as (
  select term, floor(1000 * ln((2.0::double * n_docs + 2) / (2.0::double * count(*) + 1)))::bigint as w
  from tfs, totals group by term, n_docs),
impacts as (
  select t.doc_id, t.term, w.w * ((1000000000 * t.tf) // (1000 * t.tf + 20 * (50 + (50 * l.n * n_docs) // n_terms))) as impact
  from tfs t join weights w on w.term = t.term join lengths l on l.doc_id = t.doc_id, totals),
scores as (
  select a.item_id, i.doc_id, sum(i.impact)::bigint as score from asked a join impacts i on i.term = a.term group by a.item_id, i.doc_id),
ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score from scores where score > 0)
select item_id, rank::integer as rank, doc_id, score from ranked where rank <= 50
""")
def op13(t: Tables) -> DataFrame:
    return lexical_search.search(t.documents, t.benchmark)


@query("op11_hpy_model")
def op11(t: Tables) -> DataFrame:
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    model = hpy_model.fit(t.documents.where(~held))
    return hpy_model.score(t.documents, model, held).withColumn("train_tokens", F.lit(model.tokens).cast("bigint"))
