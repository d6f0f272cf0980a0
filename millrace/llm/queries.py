"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import chat_format, decontaminate, embedding_dedup, hard_negatives, html_extract, licences, mixing, near_dedup, prefix_trie, suffix_dedup, token_shards, toxicity, warc
from millrace.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def byte_tokenizer() -> str:
    """Place of the byte-level vocabulary on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of each category, and the toxic flag, of every document."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op7_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, written to wavelet-matrix shards and read back."""
    return token_shards.tokenise(table(spark, sf_dir, "documents"), byte_tokenizer())


@query
def op8_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items met in every document with at most 5 % edits."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licence sentences and licences of every document."""
    return licences.scan(table(spark, sf_dir, "documents"))


ORACLE["op9_licence_scan"] = licences.scan_sql()


@query
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, read back and summed up."""
    turns = chat_format.with_control_strings(table(spark, sf_dir, "conversations"))
    return chat_format.read_back(chat_format.format_conversations(turns))


@query
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages that an earlier one has."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op6_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate links and component of every vector."""
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op2_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


@query
def op11_web_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to web archives and read back."""
    records = warc.archive(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every shared beginning of the rebuilt conversations, with totals of what follows it."""
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(table(spark, sf_dir, "conversations")))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor's first positives."""
    return hard_negatives.mine(hard_negatives.stirred_labels(table(spark, sf_dir, "embeddings")))


REACH = """
reach(doc, other) as (select doc, doc from nodes union select reach.doc, link.b from reach join link on reach.other = link.a),
least as (select doc, min(other) as component_id from reach group by doc)"""
ORACLE["op5_near_duplicates"] = rf"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as ws from documents),
s as (select doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
        else list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) end) as sh from w),
n as (select doc_id, count(*) as n from s group by doc_id),
c as (select a.doc_id as x, b.doc_id as y, count(*) as k from s a join s b on a.sh = b.sh and a.doc_id < b.doc_id group by all),
near as (select x, y from c join n p on p.doc_id = x join n q on q.doc_id = y where 100 * k >= 85 * (p.n + q.n - k)),
link as (select x as a, y as b from near union all select y, x from near),
nodes as (select distinct doc_id as doc from documents), {REACH}
select d.doc_id, coalesce(n.n, 0) as n_shingles, component_id, d.doc_id = component_id as kept
from documents d left join n on n.doc_id = d.doc_id join least on least.doc = d.doc_id"""
ORACLE["op6_embedding_duplicates"] = f"""
with recursive v as (select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings),
ok as (select * from v where label is not null and e is not null and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
         and len(list_filter(e, lambda x: x <> 0)) > 0),
link as (select p.vec_id as a, q.vec_id as b from ok p join ok q
         on p.label = q.label and len(p.e) = len(q.e) and p.vec_id <> q.vec_id where list_cosine_similarity(p.e, q.e) >= 0.98),
nodes as (select distinct vec_id as doc from v), {REACH}
select vec_id, coalesce(k.n, 0) as n_links, component_id, vec_id = component_id as kept
from v join least on least.doc = vec_id left join (select a, count(*) as n from link group by a) k on k.a = vec_id"""
ORACLE["op10_chat_format"] = r"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
           union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
a as (select conv_id, count(*) as n_turns, string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as said,
             coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn, role, text), '') as loss,
             sum(20 + length(regexp_replace(role, '[\\<\[\n]', '..', 'g')) + length(regexp_replace(text, '[\\<\[]', '..', 'g'))) as long
      from t group by conv_id)
select conv_id, n_turns, sha256(said) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256,
       cast(long + 4 as bigint) as formatted_chars from a"""
ORACLE["op13_hard_negatives"] = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, embedding,
                  list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e from embeddings
           where vec_id is not null and label is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, r.vec_id as other, a.label = r.label as same,
             cast(list_dot_product(a.e, r.e) as bigint) as score
      from v a join v r on a.vec_id <> r.vec_id and len(a.e) = len(r.e) where a.vec_id % 50 = 0),
p as (select * from s where same qualify row_number() over (partition by anchor_id order by score desc, other) <= 5),
n as (select p.anchor_id, p.other as positive_id, s.other as negative_id, p.score as positive_score, s.score as negative_score,
             row_number() over (partition by p.anchor_id, p.other order by s.score desc, s.other) as rank
      from p join s on s.anchor_id = p.anchor_id and not s.same and 100 * s.score between 50 * p.score and 95 * p.score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from n where rank <= 3"""
ORACLE["op11_web_archive"] = """
with p as (select page_id, coalesce(html, '') as body, sha1(coalesce(html, '')) as sha from pages),
b as (select *, array_to_string(list_transform(range(1, 41), lambda i: ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111',
        '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111'][instr('0123456789abcdef', substr(sha, i, 1))]), '') as bits from p),
f as (select *, min(page_id) over (partition by body) as first from b)
select page_id, strlen(body) as payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(1 +
         16 * cast(substr(bits, 5 * i + 1, 1) as integer) + 8 * cast(substr(bits, 5 * i + 2, 1) as integer) +
         4 * cast(substr(bits, 5 * i + 3, 1) as integer) + 2 * cast(substr(bits, 5 * i + 4, 1) as integer) +
         cast(substr(bits, 5 * i + 5, 1) as integer) as integer), 1)), '') as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id <> first then first end as refers_to from f"""
ORACLE["op12_prefix_trie"] = """
with t as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
                  row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as place
           from conversations where conv_id is not null),
c as (select conv_id, conv_id - conv_id % 100 as base, xor(list_reduce(list_concat([4294967295],
             list_transform(range(1, strlen(cast(conv_id as varchar)) + 1), lambda i: cast(ascii(substr(cast(conv_id as varchar), i, 1)) as bigint))),
             lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda p, q: xor(p >> 1, (p & 1) * 3988292384))), 4294967295) % 6 as h
      from (select distinct conv_id from t)),
r as (select c.conv_id, t.place, t.role, t.text from c join t on t.conv_id = c.base and t.place < h
      union all select c.conv_id, t.place, t.role, t.text from c join t on t.conv_id = c.conv_id and t.place >= h),
k as (select conv_id, row_number() over w as depth, string_agg(sha256(length(role) || ':' || role || text), '') over w as node, length(text) as size
      from r window w as (partition by conv_id order by place)),
s as (select conv_id, depth, node, size from k union all select conv_id, 0, '', 0 from c),
l as (select conv_id, max(depth) as last from s group by conv_id),
n as (select node, min(depth) as depth, min(s.conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * min(size) as own,
             coalesce(string_agg(case when depth = last then cast(s.conv_id as varchar) end, ',' order by s.conv_id), '') as ends
      from s join l on l.conv_id = s.conv_id group by node),
e as (select n.*, p.conv_id as parent_conv_id from n left join n p on n.depth > 0 and p.node = left(n.node, 64 * (n.depth - 1)) and p.depth = n.depth - 1),
ch as (select parent_conv_id, depth - 1 as depth, count(*) as n_children from e where depth > 0 group by all),
f as (select e.*, coalesce(n_children, 0) as n_children from e left join ch on ch.parent_conv_id = e.conv_id and ch.depth = e.depth),
u as (select s.node, sum(own) as saved, count(*) filter (f.n_children = 0) as n_leaves
      from f join s on s.conv_id = f.conv_id and s.depth <= f.depth group by s.node)
select f.conv_id, f.depth, parent_conv_id, n_convs, n_children, n_leaves, cast(saved as bigint) as saved_tokens, sha256(ends) as ends_sha256
from f join u on u.node = f.node"""
