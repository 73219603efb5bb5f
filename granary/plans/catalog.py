"""The operators bound to whole test tables, each with the SQL that returns the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions import boxes as fb
from granary.functions import hashing, labels, numbers, paths, pixels, policy
from granary.operators import accounting, actions, dedup, learning, manifest, metrics, qc, reconcile, review, split, validation
from granary.operators import boxes as ob

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _md5(column: str) -> F.Column:
    return F.md5(F.col(column).cast("binary"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The assets: doc_id, source, lang, n_chars, md5, split."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", _md5("text").alias("md5"))
    return docs.withColumn("split", hashing.split_by_hash(F.col("md5")))


_FRACTION = "(cast('0x' || substr({0}, 1, 8) as bigint)::double / 4294967295::double)"
_SPLIT = "case when {0} < 0.7::double then 'train' when {0} < 0.7::double + 0.2::double then 'valid' else 'test' end"


def _split_sql(digest: str) -> str:
    return _SPLIT.format(_FRACTION.format(digest))


_DOCS = f"docs as (select doc_id, source, lang, n_chars, md5(text) as md5, {_split_sql('md5(text)')} as split from documents)"


# --- labels, paths and hashes ---------------------------------------------------------------------------------------


@query(r"""select p_partkey, trim(regexp_replace(lower(p_brand), '[^\p{L}\p{N}]+', '_', 'g'), '_') as brand,
    trim(regexp_replace(lower(p_name), '[^\p{L}\p{N}]+', '_', 'g'), '_') as name from part""")
def label_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "part").select("p_partkey", labels.normalize_label(F.col("p_brand")).alias("brand"), labels.normalize_label(F.col("p_name")).alias("name"))


@query("""with x as (select doc_id, lower(trim(' ' || upper(lang) || ' ')) as l from documents)
    select doc_id, case l when 'en' then 'map' when 'it' then 'review' when 'fr' then 'ignore' else 'review' end as action,
    case l when 'en' then 'english' end as target from x""")
def label_policy_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = labels.Policy(targets=("english",), mapping={"en": "english", "it": "italian"}, ignore=("fr",), review=("de",), unknown="review")
    decided = policy.apply(F.concat(F.lit(" "), F.upper("lang"), F.lit(" ")))
    return _read(spark, sf_dir, "documents").select("doc_id", decided.alias("x")).select("doc_id", "x.action", "x.target")


@query("""with m as (select doc_id, case when source = 'src3' then case lang when 'en' then 'english' else 'negative' end
      else case lang when 'en' then 'english' when 'es' then 'spanish' else lang end end as mapped from documents),
    n as (select *, mapped in ('negative', 'fr') as neg, mapped not in ('negative', 'fr', 'english', 'spanish') as outside from m)
    select doc_id, case when neg or outside then 'negative' else mapped end as mapped, neg or outside as is_negative,
      case when not neg and mapped = 'spanish' then 'pending' else 'approved' end as status,
      case when neg then 'mapped_negative' when outside then 'out_of_taxonomy_default_negative' when mapped = 'spanish' then 'check_spanish' else '' end as reason
    from n""")
def label_canonicalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    how = labels.Labelling({"en": "english", "es": "spanish"}, "src3", {"en": "english"}, ("negative", "fr"), {"es": "check_spanish"}, ("english", "spanish"))
    return _read(spark, sf_dir, "documents").select("doc_id", how.apply(F.col("lang"), F.col("source")).alias("x")).select("doc_id", "x.*")


_REASONS = ["'single_object_only'", "'heavy occlusion'", "'dense shelf'", "'single broken object'", "'other'", "'one_box_only'", "'multi_object'"]


@query(f"""with r as (select doc_id, case doc_id % 7 {' '.join(f'when {i} then {r}' for i, r in enumerate(_REASONS))} end as old from documents)
    select doc_id, case when old in ('single_object_only', 'one_box_only') then 'possible_missing_instances' when old like '%occlusion%' then 'ambiguous_occlusion'
      when old like '%dense%' or old like '%multi_object%' then 'crowded_scene_needs_review' when old like '%single%object%' then 'possible_missing_instances' else old end as reason from r""")
def review_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = F.element_at(F.array(*[F.lit(r.strip("'")) for r in _REASONS]), (F.col("doc_id") % 7 + 1).cast("int"))
    return _read(spark, sf_dir, "documents").select("doc_id", labels.review_reason(old).alias("reason"))


@query(f"select doc_id, {_split_sql('md5(text)')} as split from documents")
def stable_split_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", "split")


@query(f"""select doc_id, {_split_sql("md5(lang || ':' || md5(text))")} as split from documents""")
def stable_split_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", hashing.split_by_key(F.col("lang"), F.col("md5")).alias("split"))


_PATHS = "'Raw/' || source || '/' || case lang when 'en' then 'TRAIN' when 'fr' then 'val' when 'de' then 'test' else 'x' end || '/Images/' || source || '__' || lang || '.' || doc_id || '.JPG'"


@query(f"""with p as (select doc_id, {_PATHS} as path from documents)
    select doc_id, '.JPG' as suffix, regexp_replace(split_part(path, '/', 5), '\\.JPG$', '') as stem, 'Images' as folder, true as is_image,
      case when path like '%/TRAIN/%' then 'train' when path like '%/val/%' then 'valid' when path like '%/test/%' then 'test' else 'unsplit' end as split,
      replace(regexp_replace(path, '\\.JPG$', '.txt'), '/Images/', '/labels/') as label_path, split_part(split_part(path, '/', 5), '__', 1) as source,
      substr(sha1('s:' || path), 1, 16) as uid,
      's__l__train__' || substr(sha1(path), 1, 8) || '__' || regexp_replace(split_part(path, '/', 5), '\\.JPG$', '') || '.JPG' as export_name,
      regexp_replace(regexp_replace(split_part(path, '/', 5), '\\.JPG$', ''), '[^\\p{{L}}\\p{{N}}_-]', '_', 'g') as safe from p""")
def path_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = F.when(F.col("lang") == "en", F.lit("TRAIN")).when(F.col("lang") == "fr", F.lit("val")).when(F.col("lang") == "de", F.lit("test")).otherwise("x")
    path = F.concat(F.lit("Raw/"), "source", F.lit("/"), folder, F.lit("/Images/"), "source", F.lit("__"), "lang", F.lit("."), "doc_id", F.lit(".JPG"))
    p, files = F.col("path"), _read(spark, sf_dir, "documents").select("doc_id", path.alias("path"))
    return files.select(
        "doc_id", paths.suffix(p).alias("suffix"), paths.stem(p).alias("stem"), paths.parent_name(p).alias("folder"), paths.is_image(p).alias("is_image"),
        paths.split_of(p, "unsplit").alias("split"), paths.label_path(p).alias("label_path"), paths.source_of_stem(paths.stem(p)).alias("source"),
        paths.unique_id(F.lit("s"), p).alias("uid"), paths.export_name(F.lit("s"), F.lit("l"), F.lit("train"), F.sha1(p.cast("binary")), p).alias("export_name"),
        paths.safe_stem(paths.stem(p)).alias("safe"),
    )


# --- duplicates -----------------------------------------------------------------------------------------------------


@query(f"""with {_DOCS}, r as (select *, row_number() over (partition by md5 order by source, doc_id) as k from docs)
    select split, source, count(*) as n from r where k = 1 group by all""")
def flagship_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup.kept_rows(_documents(spark, sf_dir).select("doc_id", "source", "md5", "split"), "md5", [F.col("source"), F.col("doc_id")])
    return accounting.counted(kept, "split", "source")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without their copies, counted by split and source."""
    return flagship_counts(spark, sf_dir)


@query(f"""with {_DOCS} select doc_id, md5, row_number() over (partition by md5 order by source, doc_id)::int as duplicate_rank,
    case when row_number() over (partition by md5 order by source, doc_id) = 1 then 'canonical' else 'duplicate' end as duplicate_role from docs""")
def exact_dedup_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.ranked(_documents(spark, sf_dir).select("doc_id", "md5", "source"), "md5", ["source", "doc_id"]).drop("source")


@query(f"""with {_DOCS}, r as (select md5, doc_id, row_number() over (partition by md5 order by source, doc_id) as k from docs)
    select md5, a.doc_id as kept, b.doc_id as dropped from r a join r b using (md5) where a.k = 1 and b.k > 1""")
def duplicates_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicates_report(_documents(spark, sf_dir), "md5", "doc_id", [F.col("source"), F.col("doc_id")])


@query(f"with {_DOCS} select doc_id, n_chars, md5 from docs qualify row_number() over (partition by md5 order by n_chars desc, doc_id) = 1")
def exact_dedup_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.kept_rows(_documents(spark, sf_dir).select("doc_id", "n_chars", "md5"), "md5", [-F.col("n_chars"), F.col("doc_id")])


_KEYED = f"""keyed as (select doc_id, md5, {_split_sql("md5(doc_id::varchar)")} as own from docs)"""


@query(f"""with {_DOCS}, {_KEYED}, r as (select *, row_number() over (partition by md5 order by case own when 'test' then 0 when 'valid' then 1 when 'train' then 2 else 99 end, doc_id) as k from keyed)
    select md5, max(case when k = 1 then doc_id end) as keeper, string_agg(case when k > 1 then doc_id::varchar end, ',' order by doc_id) as removed, count(*) as n
    from r group by md5 having count(*) > 1""")
def dedup_split_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).withColumn("own", hashing.split_by_hash(F.md5(F.col("doc_id").cast("string").cast("binary"))))
    out = dedup.groups_with_keeper(docs, "md5", "doc_id", [fb.priority(F.col("own"), ("test", "valid", "train"), 99), F.col("doc_id")])
    return out.withColumn("removed", F.array_join(F.transform("removed", lambda x: x.cast("string")), ","))


@query(f"""with {_DOCS}, firsts as (select md5, source, min(doc_id) as first_id from docs group by all), p as (select md5, string_agg(source, '|' order by first_id) as sources from firsts group by md5)
    select md5, sources, case when count(distinct source) > 1 then 'mixed' else min(source) end as source, string_agg(distinct split, '|' order by split) as split
    from docs join p using (md5) group by md5, sources""")
def merge_duplicate_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).withColumn("sources", F.array("source"))
    return dedup.merged_payload(docs, "md5", [F.col("doc_id")], "sources", "source", "split").withColumn("sources", F.array_join("sources", "|"))


@query(f"""with {_DOCS} select doc_id, md5, (doc_id % 3)::int as stage from docs qualify row_number() over (partition by md5 order by doc_id % 3, doc_id) = 1""")
def first_writer_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "md5", (F.col("doc_id") % 3).cast("int").alias("stage"))
    return dedup.first_writer(docs, "md5", [F.col("stage"), F.col("doc_id")])[0]


def _hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "embeddings").select("vec_id", "label", hashing.sign_hash(F.col("embedding")).alias("hash"))


_HASHES = """h as (select vec_id, label, list_sum(list_transform(range(1, 33), lambda i: case when embedding[i] >= 0 then 1::bigint << (32 - i)::int else 0::bigint end))::bigint as x,
    list_sum(list_transform(range(33, 65), lambda i: case when embedding[i] >= 0 then 1::bigint << (64 - i)::int else 0::bigint end))::bigint as y from embeddings)"""


@query(f"""with {_HASHES} select a.vec_id as a, b.vec_id as b, (bit_count(xor(a.x, b.x)) + bit_count(xor(a.y, b.y)))::int as distance
    from h a join h b on a.x >> 24 = b.x >> 24 and a.vec_id < b.vec_id where bit_count(xor(a.x, b.x)) + bit_count(xor(a.y, b.y)) <= 24""")
def near_dup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.similar_pairs(_hashes(spark, sf_dir), "vec_id", "hash", prefix=2, at_most=24)


@query(f"""with recursive {_HASHES}, o as (select vec_id::varchar as id, x, y, x >> 24 as bucket, row_number() over (partition by x >> 24 order by vec_id::varchar) as k from h),
    r as (select id, bucket, k, [{{'x': x, 'y': y}}] as leaders, 1::bigint as mine from o where k = 1 union all
      select id, bucket, k, case when mine is null then list_append(leaders, {{'x': x, 'y': y}}) else leaders end, coalesce(mine, len(leaders) + 1) from (
        select o.id, o.bucket, o.k, o.x, o.y, r.leaders, list_position(list_transform(r.leaders, lambda l: bit_count(xor(l.x, o.x)) + bit_count(xor(l.y, o.y)) <= 24), true)::bigint as mine
        from r join o on o.bucket = r.bucket and o.k = r.k + 1))
    select id, 'near_' || lpad(lower(to_hex(leaders[mine].x)), 8, '0') || substr(lpad(lower(to_hex(leaders[mine].y)), 8, '0'), 1, 4) as group_id from r""")
def near_dup_leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.leaders(_hashes(spark, sf_dir), "vec_id", "hash", prefix=2, at_most=24)


# --- splits, quotas and samples -------------------------------------------------------------------------------------

_PLACED = "row_number() over (partition by {0} order by sha1('42:' || doc_id), doc_id)"
_APPORTION = """s as (select {0}, n, floor(n * 0.7::double) as a, floor(n * 0.2::double) as b, floor(n * 0.1::double) as c from c0),
    f as (select *, n * 0.7::double - a as fa, n * 0.2::double - b as fb, n * 0.1::double - c as fc, n - a - b - c as rest from s),
    q as (select {0}, a + case when (fb > fa)::int + (fc > fa)::int < rest then 1 else 0 end as train, b + case when (fa >= fb)::int + (fc > fb)::int < rest then 1 else 0 end as valid from f)"""


@query(f"""with c0 as (select lang, count(*) as n from documents group by lang), {_APPORTION.format('lang')},
    r as (select doc_id, lang, {_PLACED.format('lang')} as k from documents)
    select doc_id, lang, case when k <= train then 'train' when k <= train + valid then 'valid' else 'test' end as split from r join q using (lang)""")
def apportion_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.assigned(_read(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", "doc_id", 42)


@query(f"""with l as (select doc_id, quality = 0 as negative, {_split_sql("md5(doc_id::varchar)")} as split from labels),
    w as (select split, round_even(count(*)::double * 0.2::double / 0.8::double, 0)::bigint as quota from l where not negative group by split),
    u as (select split, quota, sum(quota) over (order by case split when 'train' then 0 when 'valid' then 1 else 2 end) as high from w),
    p as (select doc_id, row_number() over (order by sha1('42:' || doc_id), doc_id) as k from l where negative)
    select doc_id, split from p join u on k > high - quota and k <= high""")
def negative_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 0).alias("negative"), hashing.split_by_hash(F.md5(F.col("doc_id").cast("string").cast("binary"))).alias("split"))
    return split.with_negatives(rows, "doc_id", "negative", 42, 0.2).select("doc_id", "split")


@query(f"""with c as (select greatest(1, floor(max(n) * 1.5))::bigint as cap from (select lang, count(*) as n from documents where lang <> 'en' group by lang)),
    r as (select doc_id, lang, {_PLACED.format('lang')} as k from documents) select doc_id, lang from r, c where lang <> 'en' or k <= cap""")
def rebalance_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.rebalanced(_read(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", "doc_id", "en", 1.5, 42)


@query("""select p_partkey, p_type, row_number() over (partition by p_type order by p_retailprice desc, p_partkey)::int as place from part
    qualify place <= length(p_type) * 2""")
def per_class_topn_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    limits = part.select("p_type", (F.length("p_type") * 2).alias("batch_size")).distinct()
    return split.first_n(part, ["p_type"], [F.desc("p_retailprice"), F.col("p_partkey")], limits, "batch_size").select("p_partkey", "p_type", "place")


@query("select p_brand, (length(p_brand) * 9)::int as target, count(*) as available from part group by all having count(*) < length(p_brand) * 9")
def target_shortfalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _read(spark, sf_dir, "part").select("p_brand")
    limits = part.select("p_brand", (F.length("p_brand") * 9).alias("target")).distinct()
    return split.shortfalls(part, ["p_brand"], limits, "target")


# --- review and decisions -------------------------------------------------------------------------------------------


@query("""with q as (select doc_id, source, lang as reason, md5(text) as g, n_chars as size, n_chars * 10 as pixels, 'doc/' || lpad(doc_id::varchar, 12, '0') as path from documents where doc_id not in (select doc_id from labels)),
    c as (select *, count(*) over (partition by source) as s, count(*) over (partition by reason) as r, count(*) over (partition by g) as n from q),
    m as (select max(s) as ms, max(r) as mr, max(n) as mn from c),
    p as (select doc_id, source, path, n, round(60.0::double * (n / mn) + 20.0::double * (ms / s) + 10.0::double * (r / mr)
      + 5.0::double * (log10(greatest(size, 1)::double + 1) / 5.0::double) + 5.0::double * (log10(greatest(pixels, 1)::double + 1) / 6.0::double), 4) as priority_score from c, m),
    k as (select doc_id, priority_score, row_number() over (order by priority_score desc, n desc, source, path) as rank from p)
    select doc_id, priority_score, rank::int as rank, (floor((rank - 1) / 60) + 1)::int as batch, ((rank - 1) % 60 + 1)::int as batch_rank from k""")
def review_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").join(_read(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")
    path = F.concat(F.lit("doc/"), F.lpad(F.col("doc_id").cast("string"), 12, "0"))
    queue = docs.select("doc_id", "source", F.col("lang").alias("reason"), _md5("text").alias("group_id"), F.col("n_chars").alias("size"), (F.col("n_chars") * 10).alias("pixels"), path.alias("path"))
    return review.prioritised(queue).select("doc_id", "priority_score", "rank", "batch", "batch_rank")


def _decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two decisions for each label; the later one counts."""
    rows = _read(spark, sf_dir, "labels").select("doc_id", F.concat(F.lit("q"), "quality").alias("late"), F.concat(F.lit("t"), "toxic").alias("early"))
    first = rows.select("doc_id", F.col("early").alias("decision"), F.lit("open").alias("state"), F.lit(1).alias("sequence"))
    return first.union(rows.select("doc_id", "late", F.when(F.col("late") == "q0", F.lit("")).otherwise("done"), F.lit(2)))


@query("""select doc_id, case when quality is null then lang else 'q' || quality end as decision, case when quality is null then 'pending' when quality = 0 then '' else 'done' end as state
    from documents left join labels using (doc_id)""")
def decision_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    queue = _read(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("decision"), F.lit("pending").alias("state"))
    return review.overridden(queue, _decisions(spark, sf_dir), "doc_id", ["decision", "state"], "sequence")


@query("""with d as (select doc_id, lang, quality is not null and lang <> 'en' as hit, 'q' || quality as decision from documents left join labels using (doc_id))
    select doc_id, case when hit and decision = 'q1' then 'q1' when hit then 'negative' else lang end as mapped, case when hit then decision <> 'q1' else false end as is_negative,
      case when hit and decision = 'q1' then 'manual_review' when hit then 'manual_review_out_of_taxonomy' else '' end as reason,
      case when hit or lang = 'en' then 'approved' else 'pending' end as status, hit as applied from d""")
def review_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("lang") == "en", F.lit("approved")).otherwise("pending")
    rows = _read(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("mapped"), F.lit(False).alias("is_negative"), status.alias("status"), F.lit("").alias("reason"))
    return review.reviewed(rows, _decisions(spark, sf_dir), "doc_id", ("q1",))


# --- accounting -----------------------------------------------------------------------------------------------------


@query(f"""with {_DOCS}, tax as (select unnest(['en', 'fr', 'it']) as class), tg as (select * from (values ('en', '1000', '10'), ('es', 'many', '5'), ('pt', '7', '')) t(class, target, batch_size)),
    u as (select lang as class, count(distinct md5) as available, count(distinct md5) - count(distinct case when doc_id % 2 = 0 then md5 end) as unused from docs group by lang),
    l as (select lang as class, count(*) as labelled, count(*) filter (split = 'train') as train, count(*) filter (split = 'valid') as valid, count(*) filter (split = 'test') as test from docs join labels using (doc_id) group by lang),
    k as (select class from tax union select class from tg union select class from u union select class from l)
    select class, coalesce(available, 0) as available, coalesce(unused, 0) as unused, coalesce(labelled, 0) as labelled, coalesce(train, 0) as train, coalesce(valid, 0) as valid, coalesce(test, 0) as test,
      target, batch_size, coalesce(labelled, 0) + coalesce(unused, 0) as suggested_target, case when try_cast(target as bigint) is not null then greatest(0, try_cast(target as bigint) - coalesce(labelled, 0)) end as gap_to_target
    from k left join u using (class) left join l using (class) left join tg using (class)""")
def class_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).withColumnRenamed("lang", "class")
    taxonomy = spark.createDataFrame([("en",), ("fr",), ("it",)], "class string")
    targets = spark.createDataFrame([("en", "1000", "10"), ("es", "many", "5"), ("pt", "7", "")], "class string, target string, batch_size string")
    used = F.count_distinct(F.when(F.col("doc_id") % 2 == 0, F.col("md5")))
    unlabelled = docs.groupBy("class").agg(F.count_distinct("md5").alias("available"), (F.count_distinct("md5") - used).alias("unused"))
    labelled = docs.join(_read(spark, sf_dir, "labels").select("doc_id"), "doc_id")
    labelled = labelled.groupBy("class").agg(F.count("*").alias("labelled"), *[F.count_if(F.col("split") == s).alias(s) for s in paths.SPLITS])
    return accounting.class_accounting(taxonomy, unlabelled, labelled, targets)


@query(f"""with {_DOCS}, r as (select *, row_number() over (partition by md5 order by source, doc_id) as k, case when doc_id % 4 = 0 then 'planned' else 'unused' end as status from docs)
    select source, count(*) as raw_count, count(distinct md5) as unique_count, count(*) filter (k > 1) as duplicate_count, count(*) filter (k = 1 and status = 'unused') as unused_count,
      count(*) filter (status = 'planned') as planned_count from r group by source""")
def source_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = dedup.ranked(_documents(spark, sf_dir).select("doc_id", "source", "md5"), "md5", ["source", "doc_id"])
    return accounting.inventory(docs.withColumn("status", F.when(F.col("doc_id") % 4 == 0, F.lit("planned")).otherwise("unused")), "source")


@query(f"with {_DOCS} select lang, count(distinct md5) as total_unique from docs where doc_id % 3 <> 2 or doc_id % 2 = 0 group by lang")
def union_of_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return accounting.union_counts(docs.where("doc_id % 3 <> 2"), docs.where("doc_id % 2 = 0"), "lang", "md5")


@query("select p_name, count(*) as n from part group by p_name having count(*) < 40")
def low_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounting.rare(_read(spark, sf_dir, "part"), "p_name", 40)


@query("""with c as (select source, lang, count(*) as n from documents group by all)
    select source, '{' || string_agg('"' || lang || '":' || n, ',' order by lang) || '}' as breakdown from c group by source""")
def json_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounting.breakdown(_read(spark, sf_dir, "documents"), "source", "lang")


# --- reconciliation and increments ----------------------------------------------------------------------------------


@query("""select o_orderkey as key, 'images_without_labels' as side from orders where o_orderkey not in (select l_orderkey from lineitem)
    union all select distinct l_orderkey, 'labels_without_images' from lineitem where l_orderkey not in (select o_orderkey from orders)""")
def set_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"))
    return reconcile.sides(images, _read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key")), "key")


@query(f"""with {_DOCS}, e as (select distinct md5 from docs where doc_id % 3 <> 0), i as (select distinct md5 from docs where doc_id % 4 <> 0), l as (select distinct md5 from docs join labels using (doc_id))
    select md5, 'missing_images' as finding from (select * from e except select * from i) union all select md5, 'unexpected_images' from (select * from i except select * from e)
    union all select md5, 'missing_labels' from (select * from e except select * from l) union all select md5, 'unexpected_labels' from (select * from l except select * from e)""")
def manifest_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    labelled = docs.join(_read(spark, sf_dir, "labels").select("doc_id"), "doc_id")
    return reconcile.manifest_audit(docs.where("doc_id % 3 <> 0"), docs.where("doc_id % 4 <> 0"), labelled, "md5")


@query(f"with {_DOCS} select doc_id, case when doc_id % 10 = 0 then 'missing' else 'different' end as finding from docs where doc_id % 10 = 0 or doc_id % 7 = 0")
def content_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "md5")
    output = docs.where("doc_id % 10 <> 0").withColumn("md5", F.when(F.col("doc_id") % 7 == 0, F.lit("x")).otherwise(F.col("md5")))
    return reconcile.content_audit(docs, output, "doc_id", "md5")


@query(f"""with {_DOCS}, b as (select * from docs where doc_id % 5 < 4), i as (select * from docs where doc_id % 5 = 4 and md5 not in (select md5 from b)
      qualify row_number() over (partition by md5 order by split, doc_id) = 1)
    select doc_id, md5, split, 'base' as origin from b union all select doc_id, md5, split, 'incremental' from i""")
def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "md5", "split")
    return reconcile.merged(docs.where("doc_id % 5 < 4"), docs.where("doc_id % 5 = 4"), "md5", [F.col("split"), F.col("doc_id")])


@query(f"""with {_DOCS}, e as (select split, source, count(*) as last from docs where doc_id % 5 < 4 group by all)
    select doc_id, row_number() over (partition by split, source order by doc_id) + coalesce(last, 0) as index from docs left join e using (split, source) where doc_id % 5 = 4""")
def running_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "split", "source")
    existing = docs.where("doc_id % 5 < 4").groupBy("split", "source").agg(F.count("*").alias("index"))
    return reconcile.numbered_on(docs.where("doc_id % 5 = 4"), existing, ["split", "source"], [F.col("doc_id")]).select("doc_id", "index")


_STEM = "source || case doc_id % 5 when 1 then '__2' when 2 then '__2__2' when 3 then '__4' else '' end"


@query(f"""with recursive o as (select doc_id, source as family, {_STEM} as stem, row_number() over (partition by source order by doc_id) as k from documents),
    r as (select doc_id, family, k, stem as made, [stem] as used from o where k = 1 union all select doc_id, family, k, made, list_append(used, made) from (
      select o.doc_id, o.family, o.k, r.used, list_filter(list_concat([o.stem], list_transform(range(2, o.k + 2), lambda i: o.stem || '__' || i)), lambda c: not list_contains(r.used, c))[1] as made
      from r join o on o.family = r.family and o.k = r.k + 1))
    select doc_id, made || '.txt' as unique_name from r""")
def unique_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "documents").select("doc_id", F.concat(F.expr(_STEM), F.lit(".txt")).alias("name"))
    return reconcile.unique_names(rows, "name", [F.col("doc_id")]).select("doc_id", "unique_name")


@query("select o_orderkey as id from orders where o_orderkey in (select l_orderkey from lineitem where l_returnflag in ('A', 'N'))")
def coco_semijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    categories = spark.createDataFrame([(0, " A"), (1, "N "), (2, "R")], "id int, name string")
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    annotations = _read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("image_id"), flag.alias("category_id"))
    policy = labels.Policy(targets=("a", "n"), mapping={"a": "a", "n": "n", "r": "other"})
    images = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return manifest.kept_images(images, manifest.mapped_annotations(annotations, categories, policy))


@query("""with f as (select 'region/' || r_regionkey as path, sha256(r_name) as h from region union all select 'nation/' || n_nationkey, sha256(n_name) from nation)
    select sha256(string_agg(path || h, '' order by string_split(path, '/'))) as sha256 from f""")
def manifest_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = _read(spark, sf_dir, "region").select(F.concat(F.lit("region/"), "r_regionkey").alias("path"), F.sha2(F.col("r_name").cast("binary"), 256).alias("sha256"))
    return manifest.digest(one.union(_read(spark, sf_dir, "nation").select(F.concat(F.lit("nation/"), "n_nationkey"), F.sha2(F.col("n_name").cast("binary"), 256))))


# --- label lines and boxes ------------------------------------------------------------------------------------------

_LINE = """case l_suppkey % 6 when 0 then 'bad row' when 1 then '' when 2 then 'nan 0.1 0.2 0.3 0.4' when 3 then concat_ws(' ', l_linenumber, l_discount, l_tax, '0.5', l_tax, '0.5', '0.9')
    when 4 then concat_ws(' ', l_linenumber, l_discount, '1.5', l_tax, '1e-1') else concat_ws(' ', l_linenumber, l_discount, l_tax, '0.5', '0.25') end"""


def _label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "lineitem").select(F.expr(_LINE).alias("line"))


@query(f"""with l as (select {_LINE} as line, l_suppkey % 6 as k from lineitem)
    select line, case k when 0 then 'malformed' when 1 then 'empty' when 2 then 'malformed' when 3 then 'polygon' else 'box' end as kind, k = 5 as valid, count(*) as n from l group by all""")
def box_parse_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("line")
    return _label_lines(spark, sf_dir).groupBy("line").agg(F.count("*").alias("n")).select("line", fb.classify(line).alias("kind"), fb.parsed(line).isNotNull().alias("valid"), "n")


@query(f"""with l as (select distinct {_LINE} as line, l_linenumber as c, l_discount as d, l_tax as t from lineitem where l_suppkey % 6 = 3)
    select distinct line, c::int as class_id, round((least(d, 0.5) + greatest(d, 0.5)) / 2, 9) as xc, round((least(t, 0.9) + 0.9) / 2, 9) as yc, round(abs(0.5 - d), 9) as w, round(0.9 - least(t, 0.9), 9) as h from l""")
def polygon_to_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _label_lines(spark, sf_dir).distinct().select("line", fb.polygon_box(F.col("line")).alias("b")).where("b is not null")
    return found.select("line", "b.class_id", *[F.round(F.col(f"b.{c}"), 9).alias(c) for c in ("xc", "yc", "w", "h")])


_BOXES = """d as (select distinct l_orderkey as image, l_returnflag as class, l_suppkey, round(l_quantity / 50, 6) as xc, 0.4 + ((l_suppkey % 100) / 100) / 5 as yc, round(0.4 + l_discount, 6) as w, round(0.4 + l_tax, 6) as h from lineitem),
    b as (select *, 'src' || (l_suppkey % 3) as source_id, row_number() over (order by image, class, l_suppkey, xc, yc, w, h) as box_id from d)"""


def _boxes(spark: SparkSession, sf_dir: str, by: tuple[str, ...] = ()) -> DataFrame:
    """by: columns that boxes are dealt by once, where what follows groups by them."""
    items = _read(spark, sf_dir, "lineitem")
    rows = items.select(
        F.col("l_orderkey").alias("image"), F.col("l_returnflag").alias("class"), "l_suppkey", F.round(F.col("l_quantity") / 50, 6).alias("xc"),
        (F.lit(0.4) + ((F.col("l_suppkey") % 100) / 100) / 5).alias("yc"), F.round(F.lit(0.4) + F.col("l_discount"), 6).alias("w"), F.round(F.lit(0.4) + F.col("l_tax"), 6).alias("h"),
    )
    rows = (rows.repartition(*by) if by else rows).distinct()
    # An id that needs no order over all rows: its parts, as text.
    box_id = F.concat_ws("/", "image", "class", "l_suppkey", *[F.format_number(c, 6) for c in ("xc", "yc", "w", "h")])
    return rows.select("image", "class", F.concat(F.lit("src"), F.col("l_suppkey") % 3).alias("source_id"), box_id.alias("box_id"), "xc", "yc", "w", "h")


_OVERLAP = """p as (select a.image, a.class, a.w * a.h as one, b.w * b.h as two,
      greatest(0, least(a.xc + a.w / 2, b.xc + b.w / 2) - greatest(a.xc - a.w / 2, b.xc - b.w / 2)) * greatest(0, least(a.yc + a.h / 2, b.yc + b.h / 2) - greatest(a.yc - a.h / 2, b.yc - b.h / 2)) as shared
      from b a join b on a.image = b.image and a.class = b.class and a.box_id < b.box_id),
    m as (select image, class, shared / (one + two - shared) as iou, shared / least(one, two) as of_smaller from p)"""


@query(f"""with {_BOXES}, {_OVERLAP} select image, class, count(*) as pairs, count(*) filter (iou >= 0.85) as by_iou, round(sum(iou), 5) as iou, round(sum(of_smaller), 5) as of_smaller
    from m where iou >= 0.85 or of_smaller >= 0.9 group by all""")
def box_overlap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = ob.overlapping(_boxes(spark, sf_dir), ["image", "class"])
    return pairs.groupBy("image", "class").agg(
        F.count("*").alias("pairs"), F.count_if(F.col("iou") >= 0.85).alias("by_iou"), F.round(F.sum("iou"), 5).alias("iou"), F.round(F.sum("of_smaller"), 5).alias("of_smaller")
    )


@query(f"""with recursive {_BOXES}, t as (select *, concat_ws('/', image, class, l_suppkey, printf('%.6f', xc), printf('%.6f', yc), printf('%.6f', w), printf('%.6f', h)) as id, source_id = 'src0' as made from b),
    o as (select *, row_number() over (partition by image, class order by id) as k from t),
    q as (select a.image, a.class, a.k as i, c.k as j, a.id as one, c.id as two, (a.made, a.w * a.h, a.id) > (c.made, c.w * c.h, c.id) as first_goes, a.w * a.h as wa, c.w * c.h as wc,
      greatest(0, least(a.xc + a.w / 2, c.xc + c.w / 2) - greatest(a.xc - a.w / 2, c.xc - c.w / 2)) * greatest(0, least(a.yc + a.h / 2, c.yc + c.h / 2) - greatest(a.yc - a.h / 2, c.yc - c.h / 2)) as shared
      from o a join o c on a.image = c.image and a.class = c.class and a.k < c.k),
    p as (select image, class, list({{'goes': case when first_goes then one else two end, 'stays': case when first_goes then two else one end,
      'why': case when shared / (wa + wc - shared) >= 0.85 then 'iou_threshold' else 'coverage_threshold' end}} order by i, j) as pairs
      from q where shared / (wa + wc - shared) >= 0.85 or shared / least(wa, wc) >= 0.9 group by all),
    r as (select image, class, pairs, pairs[1] as loss from p union all select image, class, pairs, pairs[1] from (
      select image, class, list_filter(pairs, lambda x: x.goes <> loss.goes and x.stays <> loss.goes) as pairs from r) where len(pairs) > 0)
    select t.image, t.class, t.id as box_id, loss is null as kept, loss.stays as kept_by, loss.why as reason from t left join r on r.image = t.image and r.class = t.class and r.loss.goes = t.id""")
def box_dedupe_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _boxes(spark, sf_dir, ("image", "class")).withColumns({"seq": F.col("box_id"), "box_source": F.when(F.col("source_id") == "src0", F.lit("synthetic_full_image")).otherwise("label")})
    return ob.deduplicated(rows, ["image", "class"])


@query(f"""with {_BOXES}, g as (select image, count(distinct source_id) as s, string_agg(distinct source_id, '|' order by source_id) as all_sources, string_agg(distinct class, '|' order by class) as accepted_classes,
      min(case source_id when 'src2' then '0' when 'src0' then '1' else '2' end || source_id) as first, bool_or(class = 'A') and bool_or(class = 'R') as both_classes, count(distinct class) as c,
      count(*) as n, count(*) filter (class = 'A') as losers from b group by image)
    select image, substr(first, 2) as kept_source, all_sources, accepted_classes, case when s > 1 and both_classes then 'resolved_conflict' when s > 1 and c = 1 then 'deduped_same_class_labels'
      when s > 1 then 'merged_multiclass_labels' else 'single_source' end as status, (n - case when s > 1 and both_classes then losers else 0 end)::int as kept,
      (case when s > 1 and both_classes then losers else 0 end)::int as dropped from g""")
def cross_source_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _boxes(spark, sf_dir).withColumnRenamed("class", "decision_class")
    out = ob.merged_sources(rows, "image", ("src2", "src0"), loser="A", winner="R")
    return out.withColumns({"kept": F.size("kept_boxes"), "dropped": F.size("dropped_boxes")}).drop("kept_boxes", "dropped_boxes")


@query(f"""with {_BOXES}, g as (select image, count(distinct source_id) as sources, count(distinct case when class <> 'N' then source_id end) as accepted_sources,
      string_agg(distinct class, '|' order by class) as decisions from b group by image)
    select *, case when accepted_sources > 1 then 'accepted_cross_source' when accepted_sources = 1 then 'accepted_single_source' else 'not_export_ready' end as relevance from g where sources > 1""")
def export_relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _boxes(spark, sf_dir).withColumnRenamed("class", "decision_class").withColumn("accepted", F.col("decision_class") != "N")
    return ob.export_relevance(rows, "image", "accepted")


# --- quality rules --------------------------------------------------------------------------------------------------

_FILES = f"""i as (select o_orderkey, o_orderpriority as source, {_split_sql("md5(o_orderkey::varchar)")} as split from orders),
    n as (select l_orderkey as o_orderkey, count(*) as boxes from lineitem group by 1), f as (select i.*, coalesce(boxes, 0) as boxes from i left join n using (o_orderkey))"""


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = _read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("source"), hashing.split_by_hash(F.md5(F.col("o_orderkey").cast("string").cast("binary"))).alias("split"))
    lines = accounting.counted(_read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", name="boxes")
    return reconcile.attached(images, lines, "o_orderkey").withColumn("boxes", F.coalesce("boxes", F.lit(0))).drop("has_label")


@query(f"with {_FILES} select split, boxes as size, count(*) as n from f where boxes > 0 group by all")
def box_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _files(spark, sf_dir).withColumn("line", F.explode(F.sequence(F.lit(0), F.col("boxes").cast("int")))).where("line > 0")
    return accounting.histogram(lines, ["split"], "o_orderkey")


@query(f"""with {_FILES} select split, count(*) as files, count(*) filter (boxes > 0) as labelled, count(*) filter (boxes = 0) as empty, count(*) filter (boxes > 1) as multi,
    count(*) filter (boxes > 1) / count(*) filter (boxes > 0) as multi_ratio, count(*) filter (boxes = 0) / count(*) as empty_ratio from f group by split""")
def qc_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.box_ratios(_files(spark, sf_dir), ["split"])


@query(f"""with {_FILES}, r as (select split, count(*) filter (boxes > 1) / count(*) filter (boxes > 0) as m, count(*) filter (boxes = 0) / count(*) as e from f group by split)
    select 'low_multi_box_ratio' as rule, 'warn' as severity, split, null::varchar as subject, m as observed, 0.91::double as threshold from r where m < 0.91
    union all select 'high_empty_ratio', 'error', split, null, e, 0.01::double from r where e > 0.01""")
def qc_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratios = qc.box_ratios(_files(spark, sf_dir), ["split"])
    return qc.united(qc.low_multi_ratio(ratios, 0.91, 1), qc.high_empty_ratio(ratios, 0.01, 1, "error"))


@query(f"""with {_FILES}, s as (select split, source, count(*) as files, count(*) filter (boxes > 4) / count(*) as own_ratio from f group by all),
    w as (select split, count(*) filter (boxes > 4) / count(*) as split_ratio from f group by split)
    select split, source, files, own_ratio, split_ratio from s join w using (split) where files >= 3 and split_ratio > 0 and own_ratio < split_ratio * 0.99""")
def qc_source_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _files(spark, sf_dir)
    counts = lambda *keys: files.groupBy(*keys).agg(F.count("*").alias("files"), F.count_if(F.col("boxes") > 4).alias("multi"))
    return qc.source_drops(counts("split", "source"), counts("split"), 0.99, 3)


@query(f"""with {_FILES} select o_orderkey, split, source, boxes, case when boxes = 0 then 'possible_missing_instances' else 'crowded_scene_needs_review' end as reason
    from f where boxes = 0 or boxes >= 5""")
def qc_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.queue(_files(spark, sf_dir))


@query(f"""with {_FILES}, present as (select distinct split, l_returnflag as class from f join lineitem on l_orderkey = o_orderkey),
    expected as (select s.split, c.class from (select unnest(['train', 'valid', 'test']) as split) s, (select unnest(['A', 'N', 'R', 'X']) as class) c)
    select 'missing_class' as rule, 'warn' as severity, split, class as subject, null::double as observed, null::double as threshold from expected anti join present using (split, class)""")
def qc_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("class"))
    present = _files(spark, sf_dir).join(lines, "o_orderkey").select("split", "class").distinct()
    expected = spark.createDataFrame([(s, c) for s in paths.SPLITS for c in "ANRX"], "split string, class string")
    return qc.absent_classes(present, expected)


@query(f"""with {_FILES} select split, count(*) as files, count(*) filter (boxes = 0) as empty_files, count(*) filter (boxes > 1) as multi_box_files, sum(boxes)::bigint as boxes
    from f group by grouping sets ((split), ())""")
def audit_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounting.by_split_and_total(_files(spark, sf_dir))


# --- runs and reports -----------------------------------------------------------------------------------------------

_RUNS = "runs as (select event_type as run, day(ts)::int as epoch, round(avg(value), 6) as metric from events group by all)"


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _read(spark, sf_dir, "events").select(F.col("event_type").alias("run"), F.dayofmonth("ts").alias("epoch"), "value")
    return events.groupBy("run", "epoch").agg(F.round(F.avg("value"), 6).alias("metric"))


@query(f"with {_RUNS} select run, arg_max(epoch, (metric, -epoch)) as best_epoch, max(metric) as best, max(epoch) as latest_epoch, arg_max(metric, epoch) as latest from runs group by run")
def run_best_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.best_and_latest(_runs(spark, sf_dir), "metric")


@query(f"with {_RUNS} select run, epoch, metric, round(metric - lag(metric) over (partition by run order by epoch), 6) as delta from runs")
def run_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.step_changes(_runs(spark, sf_dir), "metric").withColumn("delta", F.round("delta", 6))


@query(f"""with {_RUNS}, e as (select min(m) as m from (select max(epoch) as m from runs group by run) where m > 0) select run, epoch, metric from runs, e where epoch between greatest(0, m - 4) and m""")
def run_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.latest_epochs(_runs(spark, sf_dir), 5, "shared")


@query(f"""with {_RUNS}, r as (select min(run) as lo, max(run) as hi from runs) select a.epoch, a.metric as one, b.metric as other, round(b.metric - a.metric, 6) as delta
    from r join runs a on a.run = lo join runs b on b.run = hi and a.epoch = b.epoch""")
def run_against(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _runs(spark, sf_dir)
    ends = runs.agg(F.min("run").alias("lo"), F.max("run").alias("hi"))
    one, other = (runs.join(F.broadcast(ends), F.col("run") == F.col(c)).select("epoch", "metric") for c in ("lo", "hi"))
    return metrics.against(one, other, "metric").withColumn("delta", F.round("delta", 6))


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    bits = F.conv(F.substr("hash", F.lit(1), F.lit(8)), 16, 10).cast("long")
    return _hashes(spark, sf_dir).select(F.col("label").alias("truth"), (bits % 10).cast("int").alias("predicted"))


_PREDICTED = f"{_HASHES}, t as (select label as truth, (x % 10)::int as predicted from h)"
_REPORT = """k as (select truth as class from t union select predicted from t), r as (select class, (select count(*) from t where truth = class and predicted = class) as hit,
    (select count(*) from t where truth = class) as support, (select count(*) from t where predicted = class) as said from k),
    p as (select class, case when said > 0 then hit / said else 0 end as precision, case when support > 0 then hit / support else 0 end as recall, support from r),
    f as (select class, precision, recall, case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0 end as f1, support from p)"""


@query(f"with {_PREDICTED} select truth, predicted, count(*) as n from t group by all")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion(_predictions(spark, sf_dir))


@query(f"with {_PREDICTED} select truth, predicted, count(*) as n from t where truth <> predicted group by all order by n desc, truth, predicted limit 12")
def confusion_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.top_confusions(_predictions(spark, sf_dir))


@query(f"with {_PREDICTED}, {_REPORT} select class, round(precision, 9) as precision, round(recall, 9) as recall, round(f1, 9) as f1, support from f")
def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.class_report(_predictions(spark, sf_dir)).withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


@query(f"""with {_PREDICTED}, {_REPORT} select round((select avg((truth = predicted)::int) from t), 9) as accuracy, round(avg(f1), 9) as macro_f1, round(sum(f1 * support) / sum(support), 9) as weighted_f1,
    sum(support)::bigint as support from f""")
def overall_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.overall(_predictions(spark, sf_dir)).withColumns({c: F.round(c, 9) for c in ("accuracy", "macro_f1", "weighted_f1")})


@query("""select conv_id, turn, case when regexp_full_match(t, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') then t::double else 0 end as number,
    case when regexp_full_match(t, '[+-]?[0-9]+') then t::bigint else 0 end as whole from (select *, case turn % 4 when 0 then '' when 1 then turn || '.5e1' when 2 then '1d' else turn::varchar end as t from conversations)""")
def numeric_coercions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.when(F.col("turn") % 4 == 0, F.lit("")).when(F.col("turn") % 4 == 1, F.concat("turn", F.lit(".5e1"))).when(F.col("turn") % 4 == 2, F.lit("1d")).otherwise(F.col("turn").cast("string"))
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", t.alias("t"))
    return rows.select("conv_id", "turn", numbers.number_or_zero(F.col("t")).alias("number"), numbers.whole_or_zero(F.col("t")).alias("whole"))


# --- validation, rewritten labels and plans -------------------------------------------------------------------------

#: The same lines, some of them with a coordinate that isn't a number.
_NAN_LINE = f"case when l_suppkey % 6 in (4, 5) and l_partkey % 5 = 0 then concat_ws(' ', l_linenumber, 'nan', case when l_suppkey % 6 = 4 then '1.5' else '0.25' end, l_tax, 'NaN') else {_LINE} end"

_FILE_SQL = f"""l as (select l_orderkey, {_LINE} as line, l_suppkey % 6 as kind, l_linenumber as c, l_discount as d, l_tax as t from lineitem where l_orderkey % 7 < 3),
    lf as (select 'train/labels/' || l_orderkey || '.txt' as path, l_orderkey::varchar as stem, list_sort(list(line)) as lines from l where line <> '' group by l_orderkey),
    im as (select 'train/images/' || o_orderkey || '.jpg' as path, o_orderkey::varchar as stem, md5(o_orderkey::varchar) as md5 from orders where o_orderkey % 7 < 4)"""

_NAN_FILE_SQL = _FILE_SQL.replace(_LINE, _NAN_LINE)


def _label_files(spark: SparkSession, sf_dir: str, line: str = _LINE) -> DataFrame:
    """(path, stem, lines): a label file for some orders, with their items' lines."""
    rows = _read(spark, sf_dir, "lineitem").where("l_orderkey % 7 < 3").select("l_orderkey", F.expr(line).alias("line")).where("line <> ''")
    rows = rows.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    return rows.select(F.concat(F.lit("train/labels/"), "l_orderkey", F.lit(".txt")).alias("path"), F.col("l_orderkey").cast("string").alias("stem"), "lines")


def _image_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, stem, md5): an image for some more orders."""
    rows = _read(spark, sf_dir, "orders").where("o_orderkey % 7 < 4").select("o_orderkey", F.col("o_orderkey").cast("string").alias("stem"))
    return rows.select(F.concat(F.lit("train/images/"), "o_orderkey", F.lit(".jpg")).alias("path"), "stem", F.md5(F.col("stem").cast("binary")).alias("md5"))


_FINDING = "select '{0}' as rule, '{1}' as severity, null::varchar as split, {2} as subject, {3}::double as observed, {4}::double as threshold"


def _counted(rule: str, rows: str, severity: str = "error") -> str:
    return f"select * from ({_FINDING.format(rule, severity, 'null::varchar', 'count(*)', 'null')} from ({rows})) where observed > 0"


_SIDES = " union all ".join((_counted("images_without_labels", "select stem from im except select stem from lf"), _counted("labels_without_images", "select stem from lf except select stem from im")))
_COPIES = """cp as (select md5(doc_id::varchar) as md5, case when doc_id % 90 = 0 then '/' else '' end || 'in/' || doc_id as source_path, 'm.csv' as source_manifest, case when doc_id % 70 = 0 then '' else 'o' end as output_image, 'l' as output_label from documents
    union all select md5(doc_id::varchar), 'in', 'm.csv', 'o', 'http://l' from documents where doc_id % 100 = 0)"""


@query(f"""with {_FILE_SQL}, {_COPIES}
    {_FINDING.format('excluded_class', 'error', "'thing'", 'null', 'null')} union all
    {_FINDING.format('image_count', 'error', 'null::varchar', 'count(*)', '5')} from im union all {_FINDING.format('label_count', 'error', 'null::varchar', 'count(*)', '5')} from lf union all {_SIDES} union all
    {_counted('duplicate_md5s', 'select md5 from cp group by md5 having count(*) > 1')} union all
    {_FINDING.format('unexpected_label', 'error', 'path', 'null', 'null')} from lf where lines <> ['0 0.5 0.5 0.95 0.95'] union all
    {_FINDING.format('non_relative_manifest_path', 'error', "'source_path:' || source_path", 'null', 'null')} from cp where source_path like '/%' union all
    {_FINDING.format('non_relative_manifest_path', 'error', "'output_image:'", 'null', 'null')} from cp where output_image = '' union all
    {_FINDING.format('non_relative_manifest_path', 'error', "'output_label:' || output_label", 'null', 'null')} from cp where output_label like 'http%'""")
def batch_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    digest = F.md5(F.col("doc_id").cast("string").cast("binary"))
    source = F.concat(F.when(F.col("doc_id") % 90 == 0, F.lit("/")).otherwise(""), F.lit("in/"), "doc_id")
    one = docs.select(digest.alias("md5"), source.alias("source_path"), F.lit("m.csv").alias("source_manifest"), F.when(F.col("doc_id") % 70 == 0, F.lit("")).otherwise("o").alias("output_image"), F.lit("l").alias("output_label"))
    two = docs.where("doc_id % 100 = 0").select(digest, F.lit("in"), F.lit("m.csv"), F.lit("o"), F.lit("http://l"))
    return validation.batch_findings(_image_files(spark, sf_dir), _label_files(spark, sf_dir), one.union(two), 5, "thing", excluded=("thing",))


@query(f"""with {_NAN_FILE_SQL}, sent as (select md5(o_orderkey::varchar) as md5 from orders where o_orderkey % 7 in (0, 5)), back as (select md5 from im), none as (select md5 from sent where false),
    w as (select * from l where line <> '') {_SIDES} union all
    {_counted('original_md5s_missing_from_images', 'select * from sent except select * from back')} union all {_counted('unexpected_image_md5s', 'select * from back except select * from sent')} union all
    {_counted('original_md5s_missing_from_labels', 'select * from sent')} union all {_counted('malformed_rows', 'select 1 from w where kind in (0, 2, 3)')} union all
    {_counted('out_of_range_rows', 'select 1 from w where kind = 4')} union all {_counted('nonzero_class_rows', 'select 1 from w where kind in (4, 5) and c <> 0')}""")
def roundtrip_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = _image_files(spark, sf_dir).withColumn("path", F.concat(F.lit("train/images/"), "md5", F.lit(".jpg")))
    sent = _read(spark, sf_dir, "orders").where("o_orderkey % 7 in (0, 5)").select(F.md5(F.col("o_orderkey").cast("string").cast("binary")).alias("md5"))
    return validation.roundtrip(images, _label_files(spark, sf_dir, _NAN_LINE), sent)["findings"]


@query(f"""with {_NAN_FILE_SQL}, w as (select l_orderkey, line, kind, c, 'train/labels/' || l_orderkey || '.txt' as path from l where line <> ''),
    ln as (select md5(doc_id::varchar) as md5 from documents union all select md5('3')), f as (
    {_FINDING.format('malformed_label', 'error', "path || ':' || line", 'null', 'null').replace('null::varchar as split', "'train' as split")} from w where kind in (0, 3) union all
    {_FINDING.format('non_numeric_label', 'error', "path || ':' || line", 'null', 'null').replace('null::varchar as split', "'train' as split")} from w where kind = 2 union all
    {_FINDING.format('invalid_class_id', 'error', "path || ':' || c", 'c', '3').replace('null::varchar as split', "'train' as split")} from w where kind in (4, 5) and c > 3 union all
    {_FINDING.format('out_of_range_label', 'error', "path || ':' || line", 'null', 'null').replace('null::varchar as split', "'train' as split")} from w where kind = 4 union all {_SIDES} union all
    {_counted('duplicate_md5s', 'select md5 from ln group by md5 having count(*) > 1')}) select * from f""")
def frozen_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select(F.md5(F.col("doc_id").cast("string").cast("binary")).alias("md5"))
    lineage = docs.union(spark.range(1).select(F.md5(F.lit("3").cast("binary"))))
    train = lambda rows: rows.withColumn("split", F.lit("train"))
    return validation.frozen_findings(train(_image_files(spark, sf_dir)), train(_label_files(spark, sf_dir, _NAN_LINE)), lineage, 4)


@query(f"""with {_FILE_SQL}, w as (select l_orderkey, line, case when kind in (4, 5) then 'kept' when kind = 3 and t < 0.9 and d <> 0.5 then 'converted' when kind = 3 then 'invalid' else 'malformed' end as fate,
      case when kind in (4, 5) then line when kind = 3 then concat_ws(' ', c, printf('%.6f', (least(d, 0.5) + greatest(d, 0.5)) / 2), printf('%.6f', (least(t, 0.9) + 0.9) / 2), printf('%.6f', greatest(d, 0.5) - least(d, 0.5)), printf('%.6f', 0.9 - least(t, 0.9))) end as new
      from l where line <> ''),
    g as (select l_orderkey, coalesce(string_agg(new, chr(10) order by line, new) || chr(10), '') as content, string_agg(line, chr(10) order by line) || chr(10) as old, count(*) filter (fate = 'kept') as box_rows_unchanged,
      count(*) filter (fate = 'converted') as polygon_rows_converted, count(*) filter (fate = 'malformed') as malformed_rows_dropped, count(*) filter (fate = 'invalid') as invalid_polygon_rows_dropped from w group by l_orderkey)
    select 'train/labels/' || l_orderkey || '.txt' as path, 'train' as split, content, content <> old as changed, box_rows_unchanged::int as box_rows_unchanged, polygon_rows_converted::int as polygon_rows_converted,
      malformed_rows_dropped::int as malformed_rows_dropped, invalid_polygon_rows_dropped::int as invalid_polygon_rows_dropped from g""")
def polygon_row_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _label_files(spark, sf_dir).select("path", F.concat(F.array_join("lines", "\n"), F.lit("\n")).alias("content"))
    return validation.normalised_labels(files)


@query("""with l as (select l_orderkey, l_linenumber as c, l_discount as d, l_tax as t, concat_ws(' ', l_linenumber, l_discount, l_tax, '0.5', '0.25') as line from lineitem where l_suppkey % 6 = 5)
    select l_orderkey::varchar as path, case when bool_and(c = 1) then string_agg(concat_ws(' ', '7', printf('%.12g', d), printf('%.12g', t), '0.5', '0.25'), '|' order by line) end as lines from l group by l_orderkey""")
def strict_label_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "lineitem").where("l_suppkey % 6 = 5").select(F.col("l_orderkey").cast("string").alias("path"), F.expr("concat_ws(' ', l_linenumber, l_discount, l_tax, '0.5', '0.25')").alias("line"))
    files = rows.groupBy("path").agg(F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("content"))
    return validation.strict_files(files, 1, 7).withColumn("lines", F.array_join("lines", "|"))


@query(f"""with {_BOXES}, n as (select *, row_number() over (partition by image order by box_id) - 1 as k from b), p as (select a.image as path, a.k as a, c.k as b, greatest(a.w * a.h, 1e-12) as one, greatest(c.w * c.h, 1e-12) as two,
      greatest(0, least(a.xc + a.w / 2, c.xc + c.w / 2) - greatest(a.xc - a.w / 2, c.xc - c.w / 2)) * greatest(0, least(a.yc + a.h / 2, c.yc + c.h / 2) - greatest(a.yc - a.h / 2, c.yc - c.h / 2)) as shared
      from n a join n c on a.image = c.image and a.k < c.k)
    select path, count(*) as pairs, sum(round(shared / one * 1000000)::bigint)::bigint as a_covered, sum(round(shared / two * 1000000)::bigint)::bigint as b_covered, sum(round(shared / least(one, two) * 1000000)::bigint)::bigint as smaller_covered
    from p where shared > 0 and greatest(shared / one, shared / two) >= 0.9 group by path""")
def label_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.struct("class", "l_suppkey", "xc", "yc", "w", "h")
    rows = _boxes(spark, sf_dir).withColumn("l_suppkey", F.split("box_id", "/")[2].cast("long")).select(F.col("image").alias("path"), order.alias("at"), "xc", "yc", "w", "h")
    pairs = validation.label_overlaps(rows)
    return pairs.groupBy("path").agg(F.count("*").alias("pairs"), *[F.sum(F.round(F.col(c) * 1_000_000).cast("long")).alias(c) for c in ("a_covered", "b_covered", "smaller_covered")])


@query("select doc_id, source_path from (select doc_id, case doc_id % 4 when 0 then 'a/' || doc_id || '.JPG' when 1 then '/a/' || doc_id || '.jpg' when 2 then 'a/' || doc_id || '.txt' else 'a/' || doc_id || '.png' end as source_path from documents) where doc_id % 4 in (0, 3) and doc_id in (select doc_id from labels)")
def existing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 4
    path = F.when(k == 0, F.concat(F.lit("a/"), "doc_id", F.lit(".JPG"))).when(k == 1, F.concat(F.lit("/a/"), "doc_id", F.lit(".jpg"))).when(k == 2, F.concat(F.lit("a/"), "doc_id", F.lit(".txt"))).otherwise(F.concat(F.lit("a/"), "doc_id", F.lit(".png")))
    there = _read(spark, sf_dir, "labels").select(path.alias("path"))
    return reconcile.existing(_read(spark, sf_dir, "documents").select("doc_id", path.alias("source_path")), there, "source_path")


@query("""with m as (select doc_id, 'i/' || doc_id as image, 'l/' || case when quality = 0 then 'x' else '' end || doc_id as label from labels), p as (select doc_id, 'i/' || doc_id as image, 'l/' || doc_id as label from documents)
    select doc_id, 'pair' as side from p where (image, label) not in (select (image, label) from m) union all select doc_id, 'label' from p where label not in (select label from m)""")
def orphan_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.concat(F.lit("l/"), F.when(F.col("quality") == 0, F.lit("x")).otherwise(""), "doc_id")
    seed = _read(spark, sf_dir, "labels").select(F.concat(F.lit("i/"), "doc_id").alias("image"), label.alias("label"))
    pairs = _read(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("i/"), "doc_id").alias("image"), F.concat(F.lit("l/"), "doc_id").alias("label"))
    by_pair = reconcile.orphans(pairs, seed, ["image", "label"]).select("doc_id", F.lit("pair").alias("side"))
    return by_pair.union(reconcile.orphans(pairs, seed, ["label"]).select("doc_id", F.lit("label")))


@query("select 'delete' as action, 'out/train/' || source || '/' || doc_id || '.JPG' as source, null::varchar as target, null::varchar as content from documents where doc_id not in (select doc_id from labels)")
def keep_set_deletions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = lambda slash: F.concat(F.lit(f"train{slash}"), "source", F.lit(slash), "doc_id")
    docs = _read(spark, sf_dir, "documents")
    kept = docs.join(_read(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi").select(F.concat(path("\\"), F.lit(".jpg")).alias("path"))
    return actions.keep_only(docs.select(F.concat(path("/"), F.lit(".JPG")).alias("path")), kept, "out")


@query(f"""with {_DOCS}, r as (select *, row_number() over (partition by md5 order by doc_id) as k from docs), g as (select doc_id from r where k > 1)
    select 'delete' as action, 'd/train/images/' || doc_id || '.png' as source, null::varchar as target, null::varchar as content from g union all select 'delete', 'd/train/labels/' || doc_id || '.txt', null, null from g""")
def duplicate_deletions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).withColumn("path", F.concat(F.lit("train/images/"), "doc_id", F.lit(".png")))
    return actions.drop_duplicates(dedup.groups_with_keeper(docs, "md5", "path", [F.col("doc_id")]), "d")


@query("""select 'move' as action, 'old/' || case doc_id % 3 when 0 then 'images/val/' when 1 then 'labels/train/' else 'test/images/' end || doc_id as source,
    'new/' || case doc_id % 3 when 0 then 'valid/images/' when 1 then 'train/labels/' else 'test/images/' end || doc_id as target, null::varchar as content from documents""")
def layout_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 3
    old = F.concat(F.when(k == 0, F.lit("images/val/")).when(k == 1, F.lit("labels/train/")).otherwise("test/images/"), "doc_id")
    return actions.to_split_first(_read(spark, sf_dir, "documents").select(old.alias("path")), "old", "new")


@query("""select doc_id::varchar as priority_rank, '1' as batch_rank, lang as decision, '' as notes, 'why' as reason, lang as current_label, source as source_dataset, 'x.' || case when doc_id % 2 = 0 then 'PNG' else 'webp' end as original_filename,
    'raw/' || doc_id || '.bmp' as source_relpath, 'images/' || case when length(doc_id::varchar) < 4 then lpad(doc_id::varchar, 4, '0') else doc_id::varchar end || '__' || source || '__u' || doc_id || case when doc_id % 2 = 0 then '.png' else '.webp' end as copied_image,
    case when doc_id in (select doc_id from labels) then 'ok' else 'missing_source' end as copy_status, 'u' || doc_id as unique_id from documents""")
def review_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("priority_rank"), F.lit("1").alias("batch_rank"), F.concat(F.lit("u"), "doc_id").alias("unique_id"), F.col("source").alias("source_dataset"),
        F.when(F.col("doc_id") % 2 == 0, F.lit("x.PNG")).otherwise("x.webp").alias("original_filename"), F.concat(F.lit("raw/"), "doc_id", F.lit(".bmp")).alias("source_relpath"),
        F.col("lang").alias("mapped_label"), F.lit("why").alias("reason"),
    )
    files = _read(spark, sf_dir, "labels").select(F.concat(F.lit("raw/"), "doc_id", F.lit(".bmp")).alias("path"))
    return actions.review_package(rows, files, "in", "out")[0]


# --- configuration, reports -----------------------------------------------------------------------------------------


@query("""select case lang when 'en' then 'en' else lang end as canonical_class, case lang when 'en' then 'Inglês' else arg_min(source, doc_id) filter (trim(source) <> '' and doc_id % 3 > 0) end as display_label from documents group by lang""")
def class_display_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit(" "), "source")).otherwise(" ")
    rows = _read(spark, sf_dir, "documents").select(F.concat("lang", F.lit(" ")).alias("canonical_class"), shown.alias("portuguese_display_label"), "doc_id")
    return policy.display_labels(rows, {"en": "Inglês"}, "doc_id")


@query("select p_partkey from part where p_name like '%batery%' or p_partkey % 50 in (3, 7)")
def misspelt_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 50
    name = F.concat("p_name", F.when(k == 3, F.lit(" tonner")).when(k == 7, F.lit("cartdrige x")).otherwise(" toner"))
    return _read(spark, sf_dir, "part").where(policy.misspelt(name)).select("p_partkey")


@query("""select id, type, root, canonical_class, action, source_family, source_trust, case when action = 'exclude_for_now' then 'excluded' when action = 'manual_separation_required' then 'manual' when type = 'direct_yolo' then type else 'unsupported_type:' || type end as route,
    mapped_class, case when action = 'active' and mapped_class is not null and files > 50 then files else coalesce(files, 0) end as files, case when action <> 'active' then action when mapped_class is null then 'unmapped_class' when files is null then 'missing' else 'active' end as status from (
    select source as id, case when n % 2 = 0 then 'direct_yolo' else 'odd' end as type, 'r/' || source as root, '' as canonical_class, case n % 5 when 0 then 'exclude_for_now' when 1 then 'manual_separation_required' else 'active' end as action, '' as source_family, '' as source_trust,
      case when n % 3 > 0 then 'c' || n end as mapped_class, case when n % 7 > 0 then files end as files from (select source, length(source) + ascii(right(source, 1)) as n, count(*) as files from documents group by source))""")
def source_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from granary.sources import tables

    n = F.length("source") + F.ascii(F.substr("source", F.length("source"), F.lit(1)))
    rows = _read(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("files")).withColumn("n", n)
    action = F.when(F.col("n") % 5 == 0, F.lit("exclude_for_now")).when(F.col("n") % 5 == 1, F.lit("manual_separation_required")).otherwise("active")
    sources = rows.select(
        F.col("source").alias("id"), F.when(F.col("n") % 2 == 0, F.lit("direct_yolo")).otherwise("odd").alias("type"), F.concat(F.lit("r/"), "source").alias("root"),
        F.lit("").alias("canonical_class"), action.alias("action"), F.lit("").alias("source_family"), F.lit("").alias("source_trust"),
    )
    class_map = rows.where("n % 3 > 0").select(F.col("source").alias("source_folder"), F.concat(F.lit("c"), "n").alias("canonical_class"))
    return tables.source_status(tables.dispatched(sources, ("direct_yolo",)), class_map, rows.where("n % 7 > 0").select(F.col("source").alias("id"), "files"))


@query(f"""with {_FILES}, present as (select distinct split, l_returnflag as class from f join lineitem on l_orderkey = o_orderkey)
    select 'required_class_unknown' as rule, 'error' as severity, 'valid' as split, 'Q' as subject, null::double as observed, null::double as threshold
    union all select 'required_class_missing', 'error', s, 'X', null, null from (select unnest(['valid', 'test']) as s) where (s, 'X') not in (select (split, class) from present)""")
def qc_required_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("class"))
    present = _files(spark, sf_dir).join(lines, "o_orderkey").select("split", "class").distinct()
    return qc.required_classes(present, {"valid": ("A", "X", "Q"), "test": ("X", "R")}, ("A", "N", "R", "X"))


@query(f"with l as (select quality, {_split_sql('md5(doc_id::varchar)')} as split from labels) select split, avg((quality = 0)::int) as share, 0.2::double as target, 0.02::double as tolerance from l group by split")
def qc_negative_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "labels").select((F.col("quality") == 0).alias("negative"), hashing.split_by_hash(F.md5(F.col("doc_id").cast("string").cast("binary"))).alias("split"))
    return qc.negative_share(rows, "negative", 0.2, 0.02)


@query("""with c as (select lang, count(*) as n, sum(n_chars)::bigint as letters from documents group by lang) select * from c union all select 'total', sum(n)::bigint, sum(letters)::bigint from c""")
def class_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _read(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("letters"))
    return accounting.with_total(counts, "lang")


@query("select doc_id, (select count(*) from documents where lang <> 'en') as total from documents where lang <> 'en' order by doc_id limit 50")
def capped_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.capped(_read(spark, sf_dir, "documents").where("lang <> 'en'").select("doc_id"), ["doc_id"], 50)


@query("select lang || '::' || source as key, count(*) as n, round(count(*) filter (n_chars > 1000) / count(*), 9) as long_share from documents group by lang, source having count(*) > 1")
def composite_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = _read(spark, sf_dir, "documents").withColumn("key", accounting.joined_key("lang", "source"))
    long = accounting.counted(keyed.where("n_chars > 1000"), "key", name="long")
    both = accounting.repeated(keyed, "key").join(long, "key", "left").withColumn("long", F.coalesce("long", F.lit(0)))
    return accounting.with_ratio(both, "long_share", "long", "n").withColumn("long_share", F.round("long_share", 9)).drop("long")


@query("""select doc_id, 'class_batches/' || lang || '/b1/train/images/' || md5(text) || '.jpg' as planned, md5(text) as md5, lang as before from documents""")
def planned_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(_md5("text"), F.lit("_x.jpg"))
    planned = paths.planned_path(F.col("lang"), F.lit("b1"), "images", _md5("text"), F.lit(".jpg"))
    return _read(spark, sf_dir, "documents").select("doc_id", planned.alias("planned"), paths.md5_of_name(name).alias("md5"), paths.before_underscore(F.concat("lang", F.lit("_a_b"))).alias("before"))


@query("""with f as (select l_returnflag || '/' || l_linestatus as folder, l_returnflag || '/' || l_linestatus || '/' || l_orderkey || '.' || l_linenumber as path, sha256(l_orderkey::varchar) as h from (select distinct l_returnflag, l_linestatus, l_orderkey, l_linenumber from lineitem))
    select folder, count(*) as files, sha256(string_agg(path || h, '' order by path)) as sha256 from f group by folder""")
def folder_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _read(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber").distinct()
    path = F.concat("l_returnflag", F.lit("/"), "l_linestatus", F.lit("/"), "l_orderkey", F.lit("."), "l_linenumber")
    return manifest.folder_digests(items.select(path.alias("path"), F.sha2(F.col("l_orderkey").cast("string").cast("binary"), 256).alias("sha256")))


# --- scans, label lines and listings --------------------------------------------------------------------------------

_FOLDERS = "case doc_id % 4 when 0 then 'dismissed_dark' when 1 then 'Dismissed_old' when 2 then '__pycache__' else 'kept' end"


@query(f"select doc_id, doc_id % 4 in (0, 2) as by_name, doc_id % 4 <> 3 as by_part, true as image, trim(lower({_FOLDERS}), '_') as label from documents")
def blocked_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.expr(_FOLDERS), F.lit("/"), "doc_id", F.lit(".PNG"))
    files = _read(spark, sf_dir, "documents").select("doc_id", path.alias("path"))
    p = F.col("path")
    return files.select("doc_id", paths.is_blocked(p, exact=True).alias("by_name"), paths.is_blocked(p).alias("by_part"), paths.is_image(p).alias("image"), labels.normalize_label(paths.parent_name(p)).alias("label"))


_CONTENT = "case o_orderkey % 3 when 0 then '' when 1 then ' a ' || o_orderkey || chr(13) || chr(10) || chr(10) || 'b' else chr(9) || chr(10) || o_orderkey end"


@query("select o_orderkey, case o_orderkey % 3 when 0 then '' when 1 then 'a ' || o_orderkey || '|b' else o_orderkey::varchar end as lines, (case o_orderkey % 3 when 0 then 0 when 1 then 2 else 1 end)::int as n from orders")
def label_file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fb.lines(F.expr(_CONTENT))
    return _read(spark, sf_dir, "orders").select("o_orderkey", F.array_join(lines, "|").alias("lines"), F.size(lines).alias("n"))


_NEGATIVE_LINE = "concat_ws(' ', l_linenumber + case when l_suppkey % 9 = 0 then 0.5 else 0 end, '0.5 0.5 0.1 0.1')"


@query("select l_orderkey::varchar as path from lineitem group by l_orderkey having bool_and(l_linenumber in (1, 2, 3)) and not bool_or(l_linenumber = 2) and count(*) > 0")
def negatives_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    from granary.sources import filetree

    rows = _read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("path"), F.expr(_NEGATIVE_LINE).alias("line"))
    files = rows.groupBy("path").agg(F.array_join(F.collect_list("line"), "\n").alias("content"))
    return filetree.negatives_of(files, [1, 2, 3], [2]).select("path")


@query(f"""with l as (select distinct {_LINE} as line, l_suppkey % 6 as k, l_linenumber as c from lineitem) select distinct line, case when k in (4, 5) and c = 1 then '0' || substr(line, 2) when k in (4, 5) and c = 2 then '5' || substr(line, 2)
    when k in (4, 5) and c = 3 then '0' || substr(line, 2) end as remapped from l""")
def remapped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.create_map(*[F.lit(x) for x in (1, "Cat", 2, "dog", 3, "cat", 4, "cow")])
    ids = F.create_map(*[F.lit(x) for x in ("cat", 0, "dog", 5)])
    return _label_lines(spark, sf_dir).distinct().select("line", fb.remapped(F.col("line"), names, ids).alias("remapped"))


@query("select doc_id, case doc_id % 3 when 0 then source || '__x' when 1 then source else 'folder' end as bucket from documents")
def source_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 3
    stem = F.when(k == 0, F.concat("lang", F.lit("__"), "source", F.lit("__x__"), "doc_id")).when(k == 1, F.concat("source", F.lit("__"), "doc_id")).otherwise(F.concat(F.lit("plain"), "doc_id"))
    return _read(spark, sf_dir, "documents").select("doc_id", paths.source_bucket(stem, F.col("lang"), F.lit("folder")).alias("bucket"))


_REVIEW_SQL = f"""l as (select l_orderkey, {_LINE} as line, l_suppkey % 6 = 5 and l_linenumber <= 9 as good from lineitem where l_suppkey % 6 <> 3),
    f as (select l_orderkey, count(*) filter (line <> '') as lines, count(*) filter (good) as boxes from l group by l_orderkey),
    o as (select o_orderkey, coalesce(lines, 0) as lines, coalesce(boxes, 0) as boxes, lines is null as missing from orders left join f on l_orderkey = o_orderkey)"""


@query(f"""with {_REVIEW_SQL}, s as (select *, case when missing then 'missing_label' when lines = 0 then 'empty_label' when boxes = lines then 'ok' when boxes > 0 then 'warning_malformed_ignored' else 'malformed_label' end as status,
      case when boxes > 0 then 'label' when missing then 'synthetic_missing_label' else 'synthetic_full_image' end as box_source from o)
    select md5(o_orderkey::varchar) || '__s__box' || lpad(i::varchar, 4, '0') as review_box_id, status, box_source, i::int as box_index from (select *, unnest(range(0, greatest(boxes, 1))) as i from s)""")
def review_box_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _read(spark, sf_dir, "lineitem").where("l_suppkey % 6 <> 3").select("l_orderkey", F.expr(_LINE).alias("line")).groupBy("l_orderkey").agg(F.array_join(F.collect_list("line"), "\n").alias("content"))
    files = _read(spark, sf_dir, "orders").join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    key = F.col("o_orderkey").cast("string")
    return ob.review_rows(files.select(F.md5(key.cast("binary")).alias("md5"), F.lit("s").alias("source_id"), key.alias("path"), "content")).select("review_box_id", "status", "box_source", "box_index")


@query("select l_orderkey, l_linenumber, l_suppkey, l_quantity as xc from lineitem where l_returnflag in ('A', 'R') and l_linestatus = 'F' and l_quantity <= 1 and l_discount between 0 and 1 and l_tax between 0 and 1")
def accepted_review_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.col("l_returnflag").alias("decision_class"), F.when(F.col("l_linestatus") == "F", F.lit("done")).otherwise("pending").alias("review_status"), F.col("l_quantity").alias("xc"), F.lit(0.5).alias("yc"), F.col("l_discount").alias("w"), F.col("l_tax").alias("h"))
    return ob.accepted_boxes(items, ("A", "R")).select("l_orderkey", "l_linenumber", "l_suppkey", "xc")


@query("""with c as (select vec_id, list_transform(embedding, lambda x: floor(x * 100)::bigint) as v from embeddings), m as (select vec_id, v, list_sum(v)::bigint as total from c),
    h as (select vec_id, list_sum(list_transform(range(1, 33), lambda i: case when v[i] * 64 >= total then 1::bigint << (32 - i)::int else 0::bigint end))::bigint as x,
      list_sum(list_transform(range(33, 65), lambda i: case when v[i] * 64 >= total then 1::bigint << (64 - i)::int else 0::bigint end))::bigint as y from m)
    select vec_id, lpad(lower(to_hex(x)), 8, '0') || lpad(lower(to_hex(y)), 8, '0') as hash from h""")
def mean_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = F.transform("embedding", lambda x: F.floor(x * 100))
    return _read(spark, sf_dir, "embeddings").select("vec_id", hashing.mean_hash(cells).alias("hash"))

@query()
def stochastic_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class that stochastic steps on four fifths of the vectors say of all of them."""
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("features"), F.col("label").cast("string").alias("label"))
    model = learning.train_stochastic(rows.where("vec_id % 5 <> 0"), "vec_id", epochs=5)
    return learning.predicted_linear(model, rows).select("vec_id", "label", "predicted")


_GREY = "(floor(x::double * 1000)::bigint % 256 + 256) % 256"


@query(f"""with pic as (select vec_id, (i // 16)::int as y, (i % 16)::int as x, v from (select vec_id, unnest(range(64)) as i, unnest(list_transform(embedding, lambda x: {_GREY})) as v from embeddings where vec_id % 7 <> 3)),
    grid as (select n, o, i, (o + 0.5::double) * n / 8 as c, greatest(1::double, n / 8::double) as wide from (values (4), (16)) t(n), range(8) r(o), range(16) q(i) where i < n),
    near as (select n, o, i, abs((i - c + 0.5::double) / wide) as d from grid where i >= trunc(greatest(0, c - 2 * wide + 0.5::double)) and i < trunc(c + 2 * wide + 0.5::double)),
    value as (select n, o, i, case when d < 1 then (1.5::double * d - 2.5::double) * d * d + 1 when d < 2 then ((-0.5::double * d + 2.5::double) * d - 4) * d + 2 else 0 end as w from near),
    even as (select n, o, i, w / sum(w) over (partition by n, o) as w from value), w as (select n, o, i, trunc(w * 4194304 + case when w < 0 then -0.5::double else 0.5::double end)::bigint as w from even),
    a as (select vec_id, y, o as x, greatest(0, least(255, floor((sum(v * w) + 2097152)::double / 4194304)))::bigint as v from pic join w on w.n = 16 and w.i = pic.x group by vec_id, y, o),
    b as (select vec_id, o as y, x, greatest(0, least(255, floor((sum(v * w) + 2097152)::double / 4194304)))::bigint as v from a join w on w.n = 4 and w.i = a.y group by vec_id, o, x),
    m as (select vec_id, avg(v) as mean from b group by vec_id),
    bits as (select vec_id, sum(case when v >= mean and y < 4 then 1::bigint << (31 - 8 * y - x)::int else 0 end)::bigint as hi, sum(case when v >= mean and y >= 4 then 1::bigint << (63 - 8 * y - x)::int else 0 end)::bigint as lo from b join m using (vec_id) group by vec_id)
    select vec_id, lpad(lower(to_hex(hi)), 8, '0') || lpad(lower(to_hex(lo)), 8, '0') as hash from bits union all select vec_id, substr(sha1(vec_id::varchar), 1, 16) from embeddings where vec_id % 7 = 3""")
def pixel_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of 4 x 16 grey pixels, made of vectors; some can't be decoded."""
    grey = F.transform("embedding", lambda x: F.lpad(F.hex(F.pmod(F.floor(x.cast("double") * 1000), F.lit(256))), 2, "0"))
    data = F.when(F.col("vec_id") % 7 != 3, F.unhex(F.array_join(grey, ""))).otherwise(F.lit("text").cast("binary"))
    image = F.struct(F.lit(4).alias("height"), F.lit(16).alias("width"), F.lit(1).alias("nChannels"), data.alias("data"))
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", image.alias("image"), F.sha1(F.col("vec_id").cast("string").cast("binary")).alias("sha1"))
    return pixels.average_hashes(rows, "image", "sha1").select("vec_id", "hash")


@query("select doc_id, quality, quality is not null as has_label from documents left join labels using (doc_id)")
def attached_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.attached(_read(spark, sf_dir, "documents").select("doc_id"), _read(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")


@query("select count(*) as stale from (select distinct o_custkey as stem from orders where o_custkey not in (select c_custkey from customer where c_custkey % 3 > 0))")
def stale_label_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = _read(spark, sf_dir, "customer").where("c_custkey % 3 > 0").select(F.col("c_custkey").alias("stem"))
    return reconcile.missing(_read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("stem")), images, "stem").agg(F.count("*").alias("stale"))


@query("select doc_id from documents where doc_id not in (select doc_id from labels where toxic = 0)")
def fresh_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.new_rows(_read(spark, sf_dir, "documents").select("doc_id"), _read(spark, sf_dir, "labels").where("toxic = 0").select("doc_id"), "doc_id")


@query(f"""with l as (select {_LINE} as line, l_suppkey % 6 as k, l_linenumber as c, l_returnflag as split, l_orderkey::varchar as path from lineitem)
    select 'malformed_line' as rule, 'warn' as severity, split, path as subject, null::double as observed, null::double as threshold from l where k in (0, 1, 2, 3)
    union all select 'class_out_of_range', 'error', split, path, c::double, 3::double from l where k in (4, 5) and c > 3 union all select 'missing_split', 'error', 'X', null, null, null""")
def bad_label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("split"), F.col("l_orderkey").cast("string").alias("path"), F.expr(_LINE).alias("line"))
    return qc.united(qc.bad_lines(rows, 4), qc.missing_splits(rows, ("A", "N", "R", "X")))


@query(f"""with {_DOCS}, r as (select doc_id, split, source, row_number() over (partition by split, source order by sha1('7:' || doc_id), doc_id) as k from docs), t as (select split, source, k, doc_id from r where k <= length(split) + 2)
    select doc_id, split, source, k::int as place from t""")
def capped_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "split", "source")
    caps = docs.select("split", "source", (F.length("split") + 2).alias("cap")).distinct()
    return split.first_n(docs, ["split", "source"], split.seeded(7, "doc_id"), caps, "cap").select("doc_id", "split", "source", "place")


@query("select row_number() over (order by r_regionkey)::int - 1 as class_id, r_name as name, case when r_regionkey < 3 then r_regionkey / 10 end as ap from region")
def per_class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [r["r_name"] for r in _read(spark, sf_dir, "region").orderBy("r_regionkey").collect()]  # a row a class
    return spark.createDataFrame(metrics.per_class(names, ap=[0.0, 0.1, 0.2]), "class_id int, name string, ap double")


@query("select 'delete' as action, 'runs/' || source || '/epoch' || doc_id || '.pt' as source, n_chars as length from documents where doc_id % 3 = 0 union all select 'delete', 'runs/last.pt', n_chars from documents where doc_id % 3 = 1")
def pruned_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from granary.sources import sinks

    k = F.col("doc_id") % 3
    path = F.when(k == 0, F.concat("source", F.lit("/epoch"), "doc_id", F.lit(".pt"))).when(k == 1, F.lit("last.pt")).otherwise(F.concat("source", F.lit("/last.pt")))
    files = _read(spark, sf_dir, "documents").select(path.alias("path"), F.col("n_chars").alias("length"))
    return sinks.prune_plan(files, ["**/epoch*.pt", "last.pt"], "runs")


@query("""select 'copy' as action, 'in/' || doc_id || '.jpg' as source, 'out/' || lang || '/images/' || md5(text) || '.jpg' as target, null::varchar as content from documents
    union all select 'write', null, 'out/' || lang || '/labels/' || md5(text) || '.txt', case when doc_id % 2 = 0 then '0 0.5 0.5 0.95 0.95' || chr(10) else '' end from documents""")
def export_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = lambda kind, ending: F.concat("lang", F.lit(f"/{kind}/"), _md5("text"), F.lit(ending))
    lines = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit(fb.SEED_BOX))).otherwise(F.array().cast("array<string>"))
    rows = _read(spark, sf_dir, "documents").select(F.concat(F.lit("in/"), "doc_id", F.lit(".jpg")).alias("s"), folder("images", ".jpg").alias("i"), folder("labels", ".txt").alias("l"), lines.alias("lines"))
    return actions.exported(rows, "s", "i", "l", "lines", "out")


@query("select doc_id, doc_id % 3 < 2 as seed from documents")
def seed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 3
    line = F.when(k == 0, F.lit("0 0.5 0.5 1 1")).when(k == 1, F.lit("0 0.5 0.5 0.95 0.95")).otherwise("0 0.5 0.5 0.9 0.95")
    return _read(spark, sf_dir, "documents").select("doc_id", fb.is_seed(line).alias("seed"))
