"""The registered queries of the corpus operators, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineflow.llm import align, langid, mixing, neighbours, packing, pieces, pii, preference, quality, records, simhash, topk, trie
from lineflow.llm.common import cut, held_out, table, tokenizer_path


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the documents that aren't held out; predicts every document."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~held_out(F.col("doc_id"))))
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), langid.predict(docs, model).alias("x"))
    return found.select("doc_id", "held_out", "x.lang_pred", "x.score")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes and decodes every whole text by Viterbi over the piece scores; beside it by merges, as the library reads this BPE file."""
    original = F.xxhash64(F.replace(F.coalesce("text", F.lit("")), F.lit(pieces.SPACE), F.lit(" ")))
    docs = table(spark, sf_dir, "documents").withColumn("original", original)
    path = tokenizer_path("piece_bpe_32k.model")
    decoded = pieces.encode(docs, path, ("viterbi", "merges"), keep=("original",), decoded=True)
    return decoded.select(
        "doc_id", (F.length("ids_0") / 4).cast("long").alias("n_tokens"), F.crc32("ids_0").alias("ids_crc32"),
        (F.length("ids_1") / 4).cast("long").alias("merges_tokens"), F.crc32("ids_1").alias("merges_crc32"),
        ((F.xxhash64("text_0") == F.col("original")) & (F.xxhash64("text_1") == F.col("original"))).alias("round_trip"),
    )


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest integer inner products of every 50th vector."""
    vectors = topk.quantized(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, F.expr("pmod(id, 50) = 0"), 5)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3-word shingles, links at 3 or fewer differing bits."""
    found = simhash.groups(table(spark, sf_dir, "documents"), shingle=3, limit=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the labelled documents that aren't held out; scores every document."""
    stats = cut(quality.features(table(spark, sf_dir, "documents")))
    model = quality.learn(None, table(spark, sf_dir, "labels"), stats)
    found = quality.scored(stats, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all documents as record files and reads the files back."""
    _, index = records.write_with_index(table(spark, sf_dir, "documents"))
    return records.numbered(index).select("doc_id", "start", "n_tokens", "ids_crc32")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans of every whole text, and the spans of revealing terms."""
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("__base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{pii.KINDS[k]}")
    return found.select("doc_id", *map(count, range(4)), F.sha2(pii.spans_string(F.col("__base")), 256).alias("base_sha256"), pii.spans_string(F.col("__spans")).alias("spans"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found for every 20th vector."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.expr("pmod(id, 20) = 0"), 20)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of 2048 ids."""
    return packing.pack(table(spark, sf_dir, "documents"), 2048).drop("ids")


def op10_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2k and 2k + 1 as chosen and rejected: the table has no marks of preference."""
    return preference.format_pairs(preference.adjacent_pairs(table(spark, sf_dir, "conversations")))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all conversations, which branch off from each fifth."""
    return trie.trie(trie.rebuilt(table(spark, sf_dir, "conversations")))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligns the tokens of every whole text; links are scored by their counts in all documents."""
    found = align.aligned_counts(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixes the sources of all documents, which weigh 1, 2, 3, repeating; how many words of each document the mix takes."""
    documents, mixed = mixing.mix(table(spark, sf_dir, "documents"), texts=False)
    return mixing.taken(documents, mixed).select("doc_id", "size", "source_size", "target", "taken")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_exact_top_k": op3_exact_top_k,
    "op4_simhash": op4_simhash,
    "op5_quality": op5_quality,
    "op6_token_records": op6_token_records,
    "op7_pii": op7_pii,
    "op8_neighbours": op8_neighbours,
    "op9_packing": op9_packing,
    "op10_preference": op10_preference,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_token_alignment": op12_token_alignment,
    "op13_mixing": op13_mixing,
}

ORACLES: dict[str, str] = {
    "op3_exact_top_k": """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as double)) as q from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
),
s as (
  select a.vec_id as query_id, b.vec_id, cast(list_dot_product(a.q, b.q) as bigint) as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0
)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from s qualify row_number() over (partition by query_id order by score desc, vec_id) <= 5
""",
    "op10_preference": """
with t as (
  select pair_id, side, row_number() over (partition by pair_id, side order by turn, role, text) as n, role,
         '<|' || role || '|>' || chr(10) as head, text || '<|end|>' || chr(10) as body, text
  from (select conv_id // 2 as pair_id, conv_id % 2 as side, turn, role, text from conversations)
),
matched as (
  select pair_id, n, coalesce(a.role = b.role and a.text = b.text, false) as same
  from (select * from t where side = 0) a full join (select * from t where side = 1) b using (pair_id, n)
),
sides as (select pair_id, count(distinct side) as k from t group by 1),
prefix as (
  select pair_id, case when k = 2 then coalesce(min(n) filter (not same) - 1, max(n)) else 0 end as p
  from matched join sides using (pair_id) group by pair_id, k
),
parts as (
  select pair_id, side, p,
         coalesce(string_agg(head || body, '' order by n) filter (n <= p), '') as prompt,
         coalesce(string_agg(head || body, '' order by n) filter (n > p), '') as completion,
         coalesce(string_agg(repeat('0', length(head)) || repeat(case when role = 'assistant' then '1' else '0' end, length(body)), '' order by n) filter (n > p), '') as mask
  from t join prefix using (pair_id) group by pair_id, side, p
)
select pair_id, coalesce(max(prompt) filter (side = 0), '') as prompt, cast(max(p) as integer) as n_prompt_turns,
       max(completion) filter (side = 0) as chosen, max(mask) filter (side = 0) as chosen_mask,
       max(completion) filter (side = 1) as rejected, max(mask) filter (side = 1) as rejected_mask
from parts group by pair_id
""",
    "op11_conversation_trie": """
with recursive turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         md5(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as h,
         row_number() over (partition by conv_id order by turn nulls first, md5(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) as n
  from conversations where conv_id is not null
),
bytes as (select distinct conv_id, ascii(unnest(string_split(conv_id::varchar, ''))) as b, generate_subscripts(string_split(conv_id::varchar, ''), 1) as i from turns),
bits as (
  select conv_id, 0 as i, 4294967295::bigint as crc from (select distinct conv_id from turns)
  union all
  select c.conv_id, c.i + 1, list_reduce([xor(c.crc, b.b::bigint), 0, 0, 0, 0, 0, 0, 0, 0], lambda s, z: xor(s >> 1, 3988292384 * (s & 1)))
  from bits c join bytes b on b.conv_id = c.conv_id and b.i = c.i + 1
),
branched as (select conv_id, xor(max_by(crc, i), 4294967295) % 9 as h from bits group by conv_id),
parts as (
  select b.conv_id, 0 as part, t.n, t.h, t.text from branched b join turns t on t.conv_id = b.conv_id - b.conv_id % 5 and t.n <= b.h
  union all
  select b.conv_id, 1, t.n, t.h, t.text from branched b join turns t on t.conv_id = b.conv_id and t.n > b.h
),
rebuilt as (
  select conv_id, row_number() over (partition by conv_id order by part, n) as depth, strlen(text) as size,
         string_agg(h, '') over (partition by conv_id order by part, n) as path
  from parts
  union all
  select conv_id, 0, 0, '' from branched
),
lengths as (select conv_id, max(depth) as d from rebuilt group by 1),
nodes as (
  select path, min(conv_id) as conv_id, any_value(depth) as depth, count(*) as n_convs, any_value(size) as size,
         coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (depth = d), '') as ends
  from rebuilt join lengths using (conv_id) group by path
),
family as (
  select n.*, p.path as up, p.conv_id as parent_conv_id
  from nodes n left join nodes p on n.depth > 0 and p.path = substr(n.path, 1, length(n.path) - 32)
),
kids as (select up as path, count(*) as n_children from family where up is not null group by 1),
ones as (
  select f.*, coalesce(n_children, 0) as n_children, (n_convs - 1) * size as saved, (n_children is null)::bigint as leaf from family f left join kids using (path)
),
subtrees as (
  select a.path, sum(o.leaf) as n_leaves, sum(o.saved) as saved_tokens
  from ones o, lateral (select unnest(range(o.depth + 1)) as d) u, lateral (select substr(o.path, 1, 32 * u.d) as path) a group by 1
)
select conv_id, cast(depth as bigint) as depth, parent_conv_id, n_convs, n_children, cast(n_leaves as bigint) as n_leaves, cast(saved_tokens as bigint) as saved_tokens, sha256(ends) as ends_sha256
from ones join subtrees using (path)
""",
}
