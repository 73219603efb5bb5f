"""The queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import conversations, embedding_dedup, html_text, languages, mixing, near_dup, nearest, packing, pii, quality, spelling, substring_dedup, urls

RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]

#: The key of the test tables' pseudonyms. Corpora need one of their own, which nobody else knows.
PII_KEY = "key of the test tables"


def tokenizer_file() -> str:
    """The public vocabulary file that documents are packed by; every executor has it in the same place."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url, judged by the rules and else by its host's templates. Null and odd urls have an empty host and path."""
    return urls.filtered(table(spark, sf_dir, "pages"), RULES)


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes of it. Null texts have no words and are never taken."""
    return mixing.taken_words(mixing.mix(table(spark, sf_dir, "documents")))


def op3_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal values replaced, and what was replaced. Null and empty texts stay as they are."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymised(docs, PII_KEY, found="replaced")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All passages of 50 or more words that repeat across documents. Null and shorter texts have none; texts may be of any length."""
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its set's size and component, at a similarity of 0.85. Null and wordless texts link with nothing."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its score; rows that are held out, like all others, are scored by their text alone, empty ones too."""
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    out = quality.scored(docs, model, ["doc_id"])
    return out.select(
        "doc_id", quality.held_out("doc_id").alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= 0.7).cast("int").alias("predicted")
    )


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text. Null html and pages without text: empty; pages and blocks may be of any length."""
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its links and component, at a cosine of 0.93. Vectors that can't be compared link with nothing."""
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"), at_least=0.93)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence. Null texts are the end mark alone."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file(), size=2048, end=0)


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors found for each vector whose id is divisible by 50. Vectors that can't be compared take no part."""
    return nearest.nearest(table(spark, sf_dir, "embeddings"), k=5, is_query=F.col("vec_id") % 50 == 0)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of all texts with its commonest near word. Null texts have no words; a word is of six letters and five occurrences at least."""
    return spelling.variants(spelling.words(table(spark, sf_dir, "documents")))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language. Null texts and texts without letters: ``und`` with score 0. Rows without an id are never learnt from."""
    docs = table(spark, sf_dir, "documents")
    model = languages.train(docs, ~languages.held_out("doc_id"))
    return languages.predicted(docs, model, {"doc_id": F.col("doc_id"), "held_out": languages.held_out("doc_id")})


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired. Null roles and texts are a space; a conversation without turns left has an empty audit."""
    return conversations.repairs(conversations.damaged(table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filter, op2_source_mix, op3_pii_pseudonyms, op4_substring_dedup, op5_near_duplicates, op6_quality, op7_main_text, op8_embedding_dedup, op9_packing,
        op10_nearest, op11_spelling_variants, op12_language_id, op13_conversation_repair,
    )
}


_OP5 = r"""with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words from documents),
    s as (select doc_id, case when len(words) >= 5 then list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) when len(words) > 0 then [array_to_string(words, ' ')] else [] end as shingles from w),
    one as (select doc_id, unnest(shingles) as shingle from s), n as (select doc_id, len(shingles) as n from s),
    shared as (select a.doc_id as a, b.doc_id as b, count(*) as k from one a join one b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all),
    linked as (select a, b from shared join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 85 * (x.n + y.n - k)), both_ways as (select a, b from linked union all select b, a from linked),
    reached as (select doc_id, doc_id as node from n union select r.doc_id, l.b from reached r join both_ways l on l.a = r.node)
    select doc_id, n::bigint as n_shingles, component_id, doc_id = component_id as kept from n join (select doc_id, min(node) as component_id from reached group by doc_id) using (doc_id)"""

_OP8 = """with recursive v as (select vec_id, label, list_transform(embedding, lambda x: x::double) as e from embeddings where label is not null and embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
    u as (select *, sqrt(list_dot_product(e, e)) as size from v),
    linked as (select a.vec_id as a, b.vec_id as b from u a join u b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e) where list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.93),
    reached as (select vec_id, vec_id as node from embeddings union select r.vec_id, l.b from reached r join linked l on l.a = r.node),
    counts as (select a as vec_id, count(*) as n from linked group by a)
    select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id = component_id as kept from (select vec_id, min(node) as component_id from reached group by vec_id) left join counts using (vec_id)"""

#: One step of crc32 for each value of a byte, made by the polynomial.
_OP11 = r"""with recursive crc_table as (select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: case when (c & 1) = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t from (select unnest(range(256)) as i)),
    runs as (select coalesce(doc_id::varchar, '') as doc, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) as run from documents),
    counted as (select doc, run, count(*) as k, hex(encode(doc || ':' || run)) as x from runs group by doc, run),
    hashed as (select run, k, xor(4294967295, list_reduce([4294967295] || list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::bigint), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) as h from counted, crc_table),
    w as (select word, sum(k)::bigint as n from (select case when h % 199 = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, k from hashed) where length(word) >= 6 group by word having sum(k) >= 5),
    less as (select word, n, i, left(word, i) || substr(word, i + 2) as rest from (select word, n, unnest(range(length(word)))::int as i from w)),
    pairs as (select a.word as a, b.word as b, b.n as m from less a join less b on a.rest = b.rest and a.i = b.i and a.word <> b.word union select w.word, l.word, l.n from w join less l on l.rest = w.word union select l.word, w.word, w.n from w join less l on l.rest = w.word),
    best as (select a as word, count(*) as n_near, max(m) as m from pairs group by a), form as (select best.word, min(b) as form from best join pairs on a = best.word and pairs.m = best.m group by best.word),
    r as (select w.word, w.n, coalesce(n_near, 0)::bigint as n_near, case when m >= 5 * w.n then form end as form, case when m >= 5 * w.n then m end as form_n from w left join best using (word) left join form using (word)),
    reached as (select word, word as root, form as next from r union all select q.word, r.word, r.form from reached q join r on r.word = q.next)
    select word, form, root, n, n_near, form_n::bigint as form_n from r join (select word, root from reached where next is null) using (word)"""

_OP13 = r"""with recursive crc_table as (select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: case when (c & 1) = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t from (select unnest(range(256)) as i)),
    d as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations),
    h as (select d.*, xor(4294967295, list_reduce([4294967295] || list_transform(range(length(k)), lambda i: ascii(substr(k, i + 1, 1))::bigint), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 as h from d, crc_table),
    damaged as (select conv_id, turn, case when h = 4 then 'user' else role end as role, case h when 1 then '' when 2 then translate(text, '.!?', '') else text end as text, unnest(range(case h when 0 then 0 when 3 then 2 else 1 end)) as again from h),
    o as (select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text), again) as i from damaged),
    f as (select *, case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 1 when row_number() over (partition by conv_id, role, text order by i) > 1 then 2 when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') then 3 else 0 end as fault,
      left(role, 1) as r, lag(left(role, 1)) over (partition by conv_id order by i) as p from o),
    facts as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 1) as blank, count(*) filter (fault = 2) as duplicate, count(*) filter (fault = 3) as truncated,
      count(*) filter (p is not null and p || r not in ('su', 'ua', 'au')) as illegal from f group by conv_id),
    ins(s, z, c, a, x) as (values (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''), (0, 2, 3, 'I', chr(10) || 'user:'), (1, 2, 3, 'I', chr(10) || 'user:'), (3, 2, 3, 'I', chr(10) || 'user:'), (2, 3, 3, 'I', chr(10) || 'assistant:'),
      (0, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
    op(a, s, z, r) as (values ('D', 0, 0, null), ('D', 1, 1, null), ('D', 2, 2, null), ('D', 3, 3, null), ('K', 0, 1, 's'), ('K', 0, 2, 'u'), ('K', 1, 2, 'u'), ('K', 3, 2, 'u'), ('K', 2, 3, 'a'), ('R', 0, 2, null), ('R', 1, 2, null), ('R', 3, 2, null), ('R', 2, 3, null)),
    go as (select conv_id, 0::bigint as i, 0 as s, {'c': 0, 'a': '', 'x': ''} as v from facts
      union all select g.conv_id, g.i + 1, op.z, min({'c': g.v.c + ins.c + case op.a when 'D' then 4 when 'R' then 3 else 0 end + case when op.a <> 'D' and f.fault = 3 then 3 else 0 end, 'a': g.v.a || ins.a || op.a,
        'x': g.v.x || ins.x || case op.a when 'D' then '' when 'K' then chr(10) || f.role || ':' || f.text else chr(10) || case op.z when 2 then 'user:' else 'assistant:' end || f.text end})
        from go g join f on f.conv_id is not distinct from g.conv_id and f.i = g.i + 1 join ins on ins.s = g.s join op on op.s = ins.z and (op.r is null or op.r = f.r) and (op.a = 'D' or f.fault in (0, 3)) group by g.conv_id, g.i, op.z),
    n as (select conv_id, count(*) as n from f group by conv_id),
    best as (select g.conv_id, min({'c': g.v.c + ins.c, 'a': g.v.a || ins.a, 'x': g.v.x || ins.x}) as v from go g join ins on ins.s = g.s and ins.z in (0, 3) left join n on n.conv_id is not distinct from g.conv_id where g.i = coalesce(n.n, 0) group by g.conv_id),
    ids as (select distinct conv_id from conversations)
    select ids.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(v.c, 0)::bigint as cost, coalesce(v.a, '') as audit,
      sha256(coalesce(substr(v.x, 2), '')) as repaired_sha256 from ids left join facts on facts.conv_id is not distinct from ids.conv_id left join best on best.conv_id is not distinct from ids.conv_id"""

#: SQL of the queries whose whole result follows from their contract. It looks at all pairs, so it is for small tables.
SQL: dict[str, str] = {"op5_near_duplicates": _OP5, "op8_embedding_dedup": _OP8, "op11_spelling_variants": _OP11, "op13_conversation_repair": _OP13}
