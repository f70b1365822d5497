"""Registered queries of the training-data operators, and the SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bloomline.llm.common import scratch_path, table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bloomline.llm.packing import pack

    return pack_digests(pack(table(spark, sf_dir, "documents"), tokenizer_path()))


def pack_digests(pieces: DataFrame, *more: str) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", *more
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bloomline.llm import quality

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learn = table(spark, sf_dir, "labels").where(quality.remainder("doc_id", 4) != 2)
    scored = quality.score(docs, quality.train(docs, learn))
    return scored.select(
        "doc_id",
        F.coalesce(quality.remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_LEVEL).cast("int").alias("predicted"),
    )


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bloomline.llm.bpe import bpe_digests

    return bpe_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bloomline.llm import langid, quality

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(quality.remainder("doc_id", 3) == 1, F.lit(False))
    predicted = langid.predict(docs.select("doc_id", "text"), langid.train(docs.where(~held_out)))
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bloomline.llm.jaccard import jaccard_groups

    return jaccard_groups(table(spark, sf_dir, "documents"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bloomline.llm.chat import format_chats, read_chats

    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    read = read_chats(format_chats(turns.unionByName(probe)))
    listed = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(listed, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "valid",
        F.col("bad_turn").cast("bigint").alias("bad_turn"),
    )


OP6_SQL = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed as (
  select *, row_number() over same - 1 as place, lag(role) over same as before, lead(role) over same is null as last
  from turns window same as (partition by conv_id order by turn nulls first, role, text)
), written as (
  select *, role || chr(10) || text || chr(10) as line,
    length(regexp_replace(case when role in ('system', 'user', 'assistant') then text else length(role) || chr(10) || role || text end,
      '(<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|<s>|</s>|<<TURN>>|<</TURN>>)', '\\\1', 'g'))
    + case role when 'system' then 17 when 'user' then 15 when 'assistant' then 9 else 19 end as size,
    case coalesce(before, '') when '' then role in ('system', 'user') and place = 0 when 'system' then role = 'user'
      when 'user' then role = 'assistant' when 'assistant' then role = 'user' else false end as good
  from placed
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(line, '' order by turn nulls first, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), ''))
    as loss_sha256,
  cast(sum(size) as bigint) as formatted_chars,
  coalesce(bool_and(good) and bool_or(last and role in ('user', 'assistant')), false) as valid,
  min(place) filter (where not good) as bad_turn
from written group by conv_id
"""


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bloomline.llm.html import main_text

    texts = main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return texts.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bloomline.llm.exact_dedup import exact_dedup

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup(docs, keep="max").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP8_SQL = """
with d as (select doc_id, coalesce(text, '') as body from documents)
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = max(doc_id) over same as kept, sha256(body) as text_sha256
from d window same as (partition by body)
"""

def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every picture with its class; and for every 50th, edited and cropped, the classes where copies of it were found."""
    from bloomline.llm.media import find_copies, pictures

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    asked = pictures(vectors.where("vec_id % 50 = 0"), "vec_id", "embedding", edited=True)
    found, members = find_copies(asked, pictures(vectors, "vec_id", "embedding"))
    listed = found.groupBy(F.col("query_id").alias("media_id")).agg(F.sort_array(F.collect_list(F.struct("class_id", "votes"))).alias("found"))
    return members.join(listed, "media_id", "left").select(
        F.col("media_id").alias("vec_id"),
        "class_id",
        "copies",
        F.when(F.col("media_id") % 50 == 0, F.coalesce("found.class_id", F.array().cast("array<bigint>"))).alias("found_ids"),
        F.when(F.col("media_id") % 50 == 0, F.coalesce("found.votes", F.array().cast("array<int>"))).alias("found_votes"),
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bloomline.llm.warc import read_warc, write_warc

    path = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    records = read_warc(spark, path, with_payload=False).where("reason is null")
    return records.select(
        F.col("record_id").cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


OP10_SQL = """
with p as (select page_id, encode(coalesce(html, '')) as payload from pages),
d as (select page_id, octet_length(payload) as payload_bytes, sha256(payload) as payload_digest from p),
f as (select *, min(page_id) over (partition by payload_digest) as first_id from d)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and page_id <> first_id then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id <> first_id then first_id end as refers_to
from f
"""


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bloomline.llm import whitening

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(vectors, "embedding", components=16)
    explained = F.array(*[F.lit(v / model.trace) for v in model.values]).cast("array<double>")
    return whitening.apply(vectors, "embedding", model).select(
        "vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")
    ).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bloomline.llm import repair

    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.digests(repair.repair(repair.damage(turns)))



def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bloomline.llm import secrets

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.fit(secrets.samples(docs))).select("doc_id", "spans")
    plain = F.filter("spans", lambda s: s.kind != "format")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("bigint").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    return found.select(
        "doc_id", *(count(k) for k in secrets.PATTERNS), F.sha2(joined(plain), 256).alias("base_sha256"), joined("spans").alias("spans")
    )


#: Scores from here on count as good quality.
QUALITY_LEVEL = 0.7

QUERIES = {
    "op1_packing": op1_packing,
    "op2_quality": op2_quality,
    "op3_bpe": op3_bpe,
    "op4_langid": op4_langid,
    "op5_jaccard": op5_jaccard,
    "op6_chat": op6_chat,
    "op7_html": op7_html,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_media": op9_media,
    "op10_warc": op10_warc,
    "op11_whitening": op11_whitening,
    "op12_repair": op12_repair,
    "op13_secrets": op13_secrets,
}
SQL = {"op6_chat": OP6_SQL, "op8_exact_dedup": OP8_SQL, "op10_warc": OP10_SQL}
