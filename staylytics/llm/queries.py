"""The operators of this package as registered queries over the whole given tables, and SQL where it can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylytics.llm import align, chat, decontam, embed_dedup, fim, langid, mixing, packing, quality, secrets, sharding, simhash, token_counts
from staylytics.llm.common import held_out

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "n_links", F.col("component").alias("component_id"), "kept")


ORACLES["op1_embedding_near_dedup"] = """
with recursive vec as (
  select vec_id, label, cast(embedding as double[]) as v from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
    and len([x for x in embedding if x <> 0]) > 0
), links as (
  select a.vec_id as a, b.vec_id as b from vec a join vec b on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= 0.93
), reach(id, node) as (
  select vec_id, vec_id from embeddings union select r.id, l.b from reach r join links l on l.a = r.node
)
select r.id as vec_id, (select count(*) from links l where l.a = r.id) as n_links, min(r.node) as component_id, r.id = min(r.node) as kept
from reach r group by r.id
"""


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, ~held_out())
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    return langid.identify(rows, model, carry=("held_out",))


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken")


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


PROBE = "\\### Assistant: </turn> ok"


@query
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    kinds = dict(turns.dtypes)
    probe = spark.range(2).select(
        F.lit(-7).cast(kinds["conv_id"]).alias("conv_id"),
        F.col("id").cast(kinds["turn"]).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    return chat.read_back(chat.format_turns(turns.union(probe)))


ORACLES["op6_chat_format"] = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized as (
  select *, length(role) + length(text) + 14
    + length(role || text) - length(replace(role || text, '\', ''))
    + length(role) - length(replace(role, ':', ''))
    + coalesce(list_sum([length(x) - 2 for x in regexp_extract_all(role, '#{3,}')]), 0)
    + coalesce(list_sum([length(x) - 2 for x in regexp_extract_all(text, '#{3,}')]), 0)
    + len(regexp_extract_all(role, '</turn>')) + len(regexp_extract_all(text, '</turn>')) as chars
  from turns
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn nulls first, role, text)) as loss_sha256,
  cast(sum(chars) as bigint) as formatted_chars
from sized group by conv_id
"""


@query
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, before and after personal data is taken out."""
    return token_counts.edited_counts(table(spark, sf_dir, "documents"), edits=token_counts.redactions)


@query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out().alias("held_out"))
    stats = quality.statistics(docs, carry=("held_out",))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality.fit(stats.where("not held_out"), labels)
    out = quality.score(stats, model, carry=("held_out",))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.transform(table(spark, sf_dir, "documents"))
    digests = [F.sha2(c, 256).alias(n) for c, n in ((F.col("output"), "output_sha256"), (fim.restored(), "restored_sha256"))]
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


ORACLES["op11_fill_in_middle"] = """
with drawn as (
  select doc_id, coalesce(text, '') as t, sha256('1:' || doc_id) as h, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as units
  from documents
), cut as (
  select *, len(units) as n, cast('0x' || h[1:8] as bigint) as h1, cast('0x' || h[9:16] as bigint) as h2,
    cast('0x' || h[17:24] as bigint) as h3, cast('0x' || h[25:32] as bigint) as h4 from drawn
), parts as (
  select doc_id, t, n,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
      when h4 % 100 < 20 then 'spm' else 'psm' end as form,
    array_to_string(units[1:least(h1 % (n + 1), h2 % (n + 1))], '') as p,
    array_to_string(units[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') as m,
    array_to_string(units[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') as s
  from cut
)
select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then length(p) end as prefix_chars,
  case when form <> 'plain' then length(m) end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(t) as restored_sha256
from parts
"""


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.score(table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("groups", "groups_sha256")


@query
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.with_checksums(packing.pack(table(spark, sf_dir, "documents")))
