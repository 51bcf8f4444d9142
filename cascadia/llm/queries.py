"""The registered queries of the numbered operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cascadia.llm import (
    bpe,
    compression,
    context_trees,
    hnsw,
    importance,
    merkle,
    near_documents,
    near_lines,
    packing,
    prefix_trie,
    secret_scan,
    surrogates,
    token_files,
)
from cascadia.llm.common import documents, shared_folder

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


#: Key of the surrogates in the registered query; a real run brings its own.
SURROGATE_KEY = b"registered-query"


def op1_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = hnsw.near_vectors(vectors, 0.9)
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "token-files")
    token_files.write_token_files(documents(spark, sf_dir), folder, VOCABULARY, end_id=2)
    return token_files.read_token_files(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op3_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.quality_rules(documents(spark, sf_dir))


def op4_line_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with an earlier equal line or one within a word's edit."""
    return near_lines.near_lines(documents(spark, sf_dir)).select(
        F.col("doc").alias("doc_id"), "line", F.col("first_doc").alias("first_doc_id"), "first_line", "n_edits"
    )


def op5_minhash_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_documents.near_documents(documents(spark, sf_dir), words=3, percent=85)
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), VOCABULARY, end_id=1).drop("ids")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(documents(spark, sf_dir), RANKS)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("spans")).alias("spans"),
    )


def op8_speculative_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_round_trip(documents(spark, sf_dir), VOCABULARY)


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text with its personal data replaced."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return surrogates.replace_personal_data(docs, SURROGATE_KEY, count="n_replaced")


def op10_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-odds, noisy score and verdict of every document."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = importance.quality_scores(documents(spark, sf_dir), labels)
    return importance.gumbel_top_k(scores).select(F.col("key").alias("doc_id"), "log_odds", "gumbel", "kept")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return prefix_trie.conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether its possibly altered row folds to the root."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    altered = F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return merkle.audit(documents(spark, sf_dir), {"n_chars": altered})


def op13_context_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and context-tree scores of every document; those of one remainder are held out."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return context_trees.score_documents(documents(spark, sf_dir), held_out)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hnsw": op1_hnsw,
    "op2_token_files": op2_token_files,
    "op3_compression_bands": op3_compression_bands,
    "op4_line_neighbours": op4_line_neighbours,
    "op5_minhash_hamming": op5_minhash_hamming,
    "op6_packing": op6_packing,
    "op7_secret_scan": op7_secret_scan,
    "op8_speculative_bpe": op8_speculative_bpe,
    "op9_surrogates": op9_surrogates,
    "op10_importance": op10_importance,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_merkle": op12_merkle,
    "op13_context_trees": op13_context_trees,
}

# SQL for the operators that it can express on the given tables. Words are split and lower-cased
# in ASCII, as the operators do.
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def _words(text: str) -> str:
    return _WORDS.format(_LOWER.format(text))


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    bits = "list_reduce([xor(h, b)] || range(8)::ubigint[], lambda v, k: xor(v >> 1, (v & 1) * 3988292384))"
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::ubigint)"
    return f"xor(list_reduce([4294967295::ubigint] || {codes}, lambda h, b: {bits}), 4294967295::ubigint)"


def _leaf(n_chars: str) -> str:
    columns = ("doc_id", "source", "lang", n_chars, "text")
    parts = (f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')" for c in columns)
    return f"sha256({' || '.join(parts)})"


#: One level up from a list of digests, and from a digest beside its sibling.
_RISE = "[sha256(a[2 * i + 1] || coalesce(a[2 * i + 2], '')) for i in range((len(a) + 1) // 2)]"
_BESIDE = "sha256(case when p % 2 = 1 then coalesce(a[p], '') || h else h || coalesce(a[p + 2], '') end)"
_SIBLING = "coalesce(case when p % 2 = 1 then a[p] else a[p + 2] end, '')"

ORACLE_SQL: dict[str, str] = {
    "op1_hnsw": """
      with recursive v as (
        select vec_id, embedding::double[] as e from embeddings
        where vec_id is not null and len(embedding) > 0
          and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
          and len(list_filter(embedding, lambda x: x <> 0)) > 0),
      p as (select a.vec_id as x, b.vec_id as y from v a join v b
            on a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.9),
      r as (select vec_id, vec_id as c from v union select p.y, r.c from r join p on p.x = r.vec_id)
      select vec_id, n_links, component_id, vec_id = component_id as kept from (
        select vec_id, (select count(*) from p where x = vec_id) as n_links,
               coalesce((select min(c) from r where r.vec_id = embeddings.vec_id), vec_id) as component_id
        from embeddings)""",
    "op4_line_neighbours": f"""
      with l as (
        select *, row_number() over (order by doc_id, line) as pos from (
          select doc_id, cast(i - 1 as int) as line, {_words("parts[i]")} as w
          from (select doc_id, string_split(text, chr(10)) as parts from documents), unnest(range(1, len(parts) + 1)) t(i))
        where len(w) > 0),
      f as (select w, min(pos) as pos from l group by w),
      v as (select pos, len(w) as n, i, list_concat(w[:i - 1], w[i + 1:]) as x
            from f, unnest(range(1, len(w) + 1)) t(i) where len(w) >= {near_lines.MIN_EDIT_WORDS}),
      near as (
        select pos, min(earlier) as earlier from (
          select a.pos, b.pos as earlier from v a join v b on a.x = b.x and a.i = b.i and a.n = b.n and a.pos > b.pos
          union all
          select greatest(a.pos, b.pos), least(a.pos, b.pos) from v a join f b on a.x = b.w
          where len(b.w) >= {near_lines.MIN_EDIT_WORDS})
        group by pos),
      found as (
        select l.pos, f.pos as earlier, 0 as n_edits from l join f on l.w = f.w where l.pos <> f.pos
        union all select pos, earlier, 1 from near)
      select a.doc_id, a.line, b.doc_id as first_doc_id, b.line as first_line, n_edits
      from found join l a on a.pos = found.pos join l b on b.pos = found.earlier""",
    "op5_minhash_hamming": f"""
      with recursive w as (select doc_id, {_words("text")} as w from documents),
      s as (select distinct doc_id, case when len(w) >= 3 then w[i:i + 2] else w end as g
            from w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) t(i) where len(w) > 0),
      n as (select doc_id, count(*) as n from s group by doc_id),
      c as (select a.doc_id as x, b.doc_id as y, count(*) as common
            from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
      p as (select x, y from c join n a on a.doc_id = x join n b on b.doc_id = y
            where 100 * common >= 85 * (a.n + b.n - common)),
      r as (select doc_id, doc_id as c from documents union select p.y, r.c from r join p on p.x = r.doc_id)
      select doc_id, n_shingles, component_id, doc_id = component_id as kept from (
        select doc_id, coalesce((select n from n where n.doc_id = documents.doc_id), 0) as n_shingles,
               (select min(c) from r where r.doc_id = documents.doc_id) as component_id
        from documents)""",
    "op11_prefix_trie": f"""
      with t as (
        select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
               row_number() over (partition by conv_id order by turn nulls first,
                 md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as pos
        from conversations where conv_id is not null),
      c as (select conv_id, conv_id - conv_id % 20 as base, {_crc32("conv_id::varchar")} % 4 as heads from t group by conv_id),
      r as (
        select c.conv_id, 0 as part, t.pos, {{'role': role, 'text': text}} as turn from c join t on t.conv_id = c.base and t.pos <= heads
        union all
        select c.conv_id, 1, t.pos, {{'role': role, 'text': text}} from c join t using (conv_id) where t.pos > heads),
      l as (select conv_id, list(turn order by part, pos) as path from r group by conv_id),
      p as (select conv_id, coalesce(path, []) as path from c left join l using (conv_id)),
      m as (select conv_id, path[:d] as node, d as depth, d = len(path) as is_end from p, unnest(range(len(path) + 1)) u(d)),
      n as (
        select node, depth, min(conv_id) as conv_id, count(*) as n_convs,
               sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (is_end), '')) as ends_sha256,
               (count(*) - 1) * case when depth = 0 then 0
                 else len(regexp_extract_all(node[depth].text, '[^\\x20\\x09-\\x0D]+')) end as saved
        from m group by node, depth),
      k as (select node[:depth - 1] as parent, count(*) as n_children from n where depth > 0 group by 1),
      w as (select n.*, coalesce(n_children, 0) as n_children from n left join k on n.node = k.parent),
      s as (
        select above, sum(saved)::bigint as saved_tokens, count(*) filter (n_children = 0) as n_leaves
        from (select node[:d] as above, saved, n_children from w, unnest(range(depth + 1)) u(d)) group by above)
      select w.conv_id, w.depth, v.conv_id as parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, w.ends_sha256
      from w join s on s.above = w.node left join n v on w.depth > 0 and v.node = w.node[:w.depth - 1]""",
    "op12_merkle": f"""
      with recursive l as (
        select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as p from (
          select doc_id, lang, {_leaf("n_chars")} as leaf,
                 {_leaf(f"(n_chars + case when {_crc32('doc_id::varchar')} % 7 = 0 then 1 else 0 end)")} as altered
          from documents)),
      t as (
        select lang, 0 as level, list(leaf order by p) as a from l group by lang
        union all select lang, level + 1, {_RISE} from t where len(a) > 1),
      s as (
        select lang, a[1] as subroot, row_number() over (order by lang nulls first) - 1 as rank from t where len(a) = 1),
      u as (
        select 0 as level, list(subroot order by rank) as a from s
        union all select level + 1, {_RISE} from u where len(a) > 1),
      c as (
        select doc_id, lang, leaf, 0 as level, p, altered as h, '' as proof from l
        union all
        select c.doc_id, c.lang, c.leaf, c.level + 1, p // 2, {_BESIDE}, proof || {_SIBLING}
        from c join t on c.lang is not distinct from t.lang and c.level = t.level and len(a) > 1),
      e as (
        select doc_id, leaf, subroot, 0 as level, rank as p, h, proof from c
        join s on c.lang is not distinct from s.lang
        where c.level = (select max(level) from t where t.lang is not distinct from c.lang)
        union all
        select e.doc_id, e.leaf, e.subroot, e.level + 1, p // 2, {_BESIDE}, proof || {_SIBLING}
        from e join u on e.level = u.level and len(a) > 1)
      select doc_id, leaf, subroot, a[1] as root, sha256(proof) as proof_sha256, h as folded_root, h = a[1] as verified
      from e, u where len(a) = 1 and e.level = u.level""",
}
