"""Queries of the training-data operators over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import block_max, bpe, cover_tree, interpolation, line_dedup, mixing, multiprobe, packing, private_data, simhash, toxicity, url_lists, variants
from .common import read_table


def op1_cover_tree_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    graded = toxicity.grade(docs.select("doc_id", "text"), toxicity.fit_model(docs, labels))
    return graded.select("doc_id", "expected_severity", "p_toxic", (F.col("p_toxic") > toxicity.DECISION).alias("toxic"))


def spans_text(column: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op5_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = private_data.find_private_data(read_table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in private_data.KINDS]
    return found.select("doc_id", *counts, F.sha2(spans_text("base"), 256).alias("base_sha256"), spans_text("spans").alias("spans"))


def token_digests(encoded: DataFrame) -> DataFrame:
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(bpe.encode_decode(read_table(spark, sf_dir, "documents")))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiprobe.nearest(read_table(spark, sf_dir, "embeddings"))


FIRST_DAY = "2024-01-01"


def dated_changes(pages: DataFrame) -> DataFrame:
    """A list made from the hosts that occur: digits of the pattern's MD5 give its dates. No table of lists is supplied."""
    host, path = url_lists.host_of(F.col("url")), F.split(url_lists.path_of(F.col("url")), "/", -1)
    domains = pages.select(F.regexp_extract(host, r"([^.]+\.[^.]+\.[^.]+)$", 1).alias("pattern")).where("pattern <> ''").distinct()
    segments = pages.select(host.alias("h"), path.alias("p")).where("h <> '' and p[0] <> ''").select("h", F.col("p")[0].alias("s"), F.get("p", F.lit(1)).alias("s2")).distinct()
    paths = segments.select(F.concat("h", F.lit("/"), "s").alias("pattern")).distinct()
    deeper = segments.where("s2 <> ''").select(F.concat("h", F.lit("/"), "s", F.lit("/"), "s2", F.lit("/")).alias("pattern"))

    def digit(n: int):
        return F.instr(F.lit("0123456789abcdef"), F.substring("md5", n, 1)) - 1

    known = domains.withColumn("md5", F.md5("pattern")).select("pattern", (digit(1) * 16 + digit(2)).alias("a"), digit(3).alias("b"), digit(4).alias("c")).where("c < 12")
    first = known.select("pattern", F.lit(True).alias("active"), F.col("a").alias("day"))
    off = known.select("pattern", F.lit(False).alias("active"), (F.col("a") + 20 + 5 * F.col("b")).alias("day"))
    again = known.where("b % 2 = 0").select("pattern", F.lit(True).alias("active"), (F.col("a") + 120).alias("day"))
    some = paths.withColumn("md5", F.md5("pattern")).where(digit(1) == 0).select("pattern", F.lit(True).alias("active"), (digit(2) * 16).alias("day"))
    deep = deeper.withColumn("md5", F.md5("pattern")).where(digit(1) < 4).select("pattern", F.lit(True).alias("active"), (digit(2) * 16).alias("day"))
    return first.unionAll(off).unionAll(again).unionAll(some).unionAll(deep).select("pattern", "active", F.date_add(F.to_date(F.lit(FIRST_DAY)), F.col("day").cast("int")).alias("at"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    day = F.pmod(F.col("page_id") * 7919, F.lit(365)).cast("int")
    captures = pages.withColumn("day", day).withColumn("fetched", F.date_add(F.to_date(F.lit(FIRST_DAY)), day))
    return url_lists.filter_captures(captures, dated_changes(pages)).select("page_id", "day", "blocked", "pattern")


def op9_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation.score_documents(read_table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(read_table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "sequence_tokens", "step")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_max.ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(read_table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {f.__name__: f for f in (
    op1_cover_tree_near_dedup, op2_source_mixing, op3_simhash_near_dedup, op4_toxicity, op5_private_data,
    op6_bpe, op7_nearest_neighbours, op8_url_filters, op9_interpolated_lm, op10_line_dedup,
    op11_packing, op12_ranked_search, op13_spelling_variants,
)}

ORACLE_SQL = {
    "op1_cover_tree_near_dedup": """
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.93
), reach as (
  select a as vec_id, b as other from links
  union
  select r.vec_id, l.b from reach r join links l on r.other = l.a
), n as (select a as vec_id, count(*) as n from links group by a),
m as (select vec_id, min(other) as least from reach group by vec_id)
select e.vec_id, coalesce(n.n, 0) as n_links, least(e.vec_id, coalesce(m.least, e.vec_id)) as component_id,
       e.vec_id = least(e.vec_id, coalesce(m.least, e.vec_id)) as kept
from embeddings e left join n on e.vec_id = n.vec_id left join m on e.vec_id = m.vec_id
""",
    "op8_url_filters": r"""
with p as (
  select page_id, url, cast((page_id * 7919) % 365 as integer) as day,
    lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+?)\.?(?::[0-9]*)?(?:[/?#]|$)', 1)) as host,
    string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)', 1), '/') as segs
  from pages
), d as (
  select distinct regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) as pattern from p
), k as (
  select pattern, (strpos('0123456789abcdef', substr(md5(pattern), 1, 1)) - 1) * 16 + strpos('0123456789abcdef', substr(md5(pattern), 2, 1)) - 1 as a,
    strpos('0123456789abcdef', substr(md5(pattern), 3, 1)) - 1 as b, strpos('0123456789abcdef', substr(md5(pattern), 4, 1)) - 1 as c
  from d where pattern <> ''
), s as (
  select distinct host || '/' || segs[1] as pattern from p where host <> '' and segs[1] <> ''
), s2 as (
  select distinct host || '/' || segs[1] || '/' || segs[2] || '/' as pattern from p where host <> '' and segs[1] <> '' and segs[2] <> ''
), changes as (
  select pattern, true as active, a as since from k where c < 12
  union all select pattern, false, a + 20 + 5 * b from k where c < 12
  union all select pattern, true, a + 120 from k where c < 12 and b % 2 = 0
  union all select pattern, true, (strpos('0123456789abcdef', substr(md5(pattern), 2, 1)) - 1) * 16 from s where substr(md5(pattern), 1, 1) = '0'
  union all select pattern, true, (strpos('0123456789abcdef', substr(md5(pattern), 2, 1)) - 1) * 16 from s2 where substr(md5(pattern), 1, 1) in ('0', '1', '2', '3')
), clean as (select lower(split_part(pattern, '/', 1)) || rtrim(substr(pattern, length(split_part(pattern, '/', 1)) + 1), '/') as pattern, since, bool_or(active) as active from changes group by 1, 2),
spans as (select pattern, active, since as valid_from, lead(since) over (partition by pattern order by since) as valid_to from clean),
labels as (select page_id, day, host, segs, string_split(host, '.') as ls from p where host <> ''),
keys as (
  select page_id, day, array_to_string(ls[i:len(ls)], '.') as pattern
  from (select page_id, day, ls, unnest(generate_series(1, greatest(1, len(ls) - 1))) as i from labels)
  union all select page_id, day, host || '/' || array_to_string(segs[1:i], '/') from (select *, unnest(generate_series(1, len(segs))) as i from labels) where segs[i] <> ''
), hits as (
  select k.page_id, max({'n': length(k.pattern), 'p': k.pattern}) as best
  from keys k join spans s on k.pattern = s.pattern and s.active and s.valid_from <= k.day and (s.valid_to is null or k.day < s.valid_to)
  group by k.page_id
)
select p.page_id, p.day, h.page_id is not null as blocked, h.best.p as pattern from p left join hits h on p.page_id = h.page_id
""",
    "op10_line_dedup": """
with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
l as (select doc_id, unnest(ls) as line, generate_subscripts(ls, 1) as pos from d),
k as (select doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
c as (select key, max(doc_id) as last from k where length(key) >= 40 group by key having count(distinct doc_id) >= 5)
select k.doc_id, count(*) as n_lines, count(*) filter (where c.last is not null and k.doc_id <> c.last) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not (c.last is not null and k.doc_id <> c.last)), '')) as kept_sha256
from k left join c on k.key = c.key group by k.doc_id
""",
}
