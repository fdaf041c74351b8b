"""The operators over the whole test tables, and the SQL that some of them must equal."""

from collections.abc import Callable
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayposts.llm import (
    bpe,
    codes,
    embeddings,
    lines,
    mixing,
    near,
    packing,
    quality,
    scoring,
    secrets,
    spelling,
    tokens,
    toxicity,
)
from wayposts.llm.text import crc_fold

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("slots")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    counts = [F.col(f"stats.{c}").alias(c) for c in quality.COUNTS]
    return quality.judged(docs.select("doc_id", "text"), labels).select(
        "doc_id",
        *counts,
        quality.base_failed(F.col("stats")).alias("base_failed"),
        F.col("rule").isNull().alias("kept"),
        "rule",
    )


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    held_out = crc_fold(F.col("doc_id"), 3) == 1
    known = (
        labels.where("toxic in (0, 1)")
        .where(~held_out)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    model = toxicity.fit(docs, known)
    return toxicity.score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
        "spans",
    )


def op6_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near.near_classes(table(spark, sf_dir, "documents"))
    return classes.select(
        "doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept")
    )


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.linked_vectors(table(spark, sf_dir, "embeddings"))


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    gone = F.coalesce(F.col("gone"), F.array().cast("array<int>"))
    return lines.without_lines(docs).select(
        "doc_id",
        F.size(gone).cast("long").alias("n_deleted"),
        F.array_join(gone, ",").alias("deleted"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scoring.score(docs, crc_fold(F.col("doc_id"), 5) != 1)


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    compressed = codes.compress(table(spark, sf_dir, "embeddings"))
    listed = ",".join(map(str, compressed.books.ravel().tolist()))
    return codes.with_label_error(compressed.codes).select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(sha256(listed.encode()).hexdigest()).alias("codebooks_sha256"),
    )


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents")))
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def queries() -> dict[str, Query]:
    return {
        "op1_mix": op1_mix,
        "op2_quality": op2_quality,
        "op3_secrets": op3_secrets,
        "op4_tokens": op4_tokens,
        "op5_toxicity": op5_toxicity,
        "op6_near": op6_near,
        "op7_embeddings": op7_embeddings,
        "op8_lines": op8_lines,
        "op9_packing": op9_packing,
        "op10_scoring": op10_scoring,
        "op11_codes": op11_codes,
        "op12_spelling": op12_spelling,
        "op13_bpe": op13_bpe,
    }


_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

_MIX = rf"""
with sized as (
    select doc_id, source, {_WORDS} as size,
           md5(coalesce(cast(doc_id as varchar), '')) as shuffled
    from documents
), sources as (
    select source, cast(sum(size) as bigint) as source_size,
           [1, 2, 3][cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as int)] as weight
    from sized group by source
), levels as (
    select *,
           (sum(source_size) over () - coalesce(sum(3 * source_size) over before, 0))::double
               / sum(weight) over onward as level
    from sources
    window before as (order by 3 * source_size / weight, source nulls last
                      rows between unbounded preceding and 1 preceding),
           onward as (order by 3 * source_size / weight, source nulls last
                      rows between current row and unbounded following)
), targets as (
    select source, source_size, row_number() over (order by source nulls last) as sid,
           case when 3 * source_size / weight <= level then (3 * source_size)::double
                else max(case when 3 * source_size / weight > level then level end) over ()
                     * weight end as target
    from levels
), axis as (
    select sized.*, sid, source_size, target, cast(round(target) as bigint) as words,
           cast(sum(size) over (partition by sized.source order by shuffled, doc_id, size
                rows unbounded preceding) as bigint) - size as start
    from sized join targets on sized.source is not distinct from targets.source
), stretches as (
    select *, high - target as low, ceil(round(target) / 1024)::bigint as needed
    from (select *, sum(target) over (order by sid rows unbounded preceding) as high from targets)
    where target > 0
), points as (
    select slot, (slot + 1)::hugeint * {mixing._GOLDEN} % {2**mixing._BITS}::hugeint as point, total
    from (select sum(source_size)::bigint as total, unnest(range((sum(source_size)::bigint + 1023) // 1024)) as slot
          from sources)
), dealt as (
    select slot, sid, row_number() over (partition by sid order by slot) - 1 as rank
    from points join stretches
      on point / {2**mixing._BITS}::double * total >= low and point / {2**mixing._BITS}::double * total < high
), missing as (
    select sid, unnest(range(have, needed)) as rank
    from (select sid, any_value(needed) as needed, count(slot) as have
          from stretches left join dealt using (sid) group by sid)
), slots as (
    select slot, sid, rank from dealt
    union all
    select (select count(*) from points) - 1 + row_number() over (order by rank, sid), sid, rank
    from missing
), blocks as (
    select doc_id, size, source, shuffled, start,
           unnest(range((pass * source_size + start) // 1024,
                        (least(pass * source_size + start + size, words) - 1) // 1024 + 1)) as rank, sid
    from axis, range(3) as t(pass)
    where size > 0 and pass * source_size + start < words
), firsts as (
    select sid, start, doc_id, min(slot) as first_slot
    from blocks join slots using (sid, rank) group by all
)
select axis.doc_id, cast(size as bigint) as size, source_size, target,
       cast(case when size = 0 then 0
            else (words // source_size) * size
                 + greatest(0, least(size, words % source_size - axis.start)) end as bigint) as taken,
       case when size > 0 then first_slot end as first_slot
from axis left join firsts
  on axis.sid = firsts.sid and axis.start = firsts.start and axis.doc_id is not distinct from firsts.doc_id
"""

_LINES = r"""
with worded as (
    select doc_id, pos, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as wc
    from (select doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos,
                 unnest(string_split(text, chr(10))) as line
          from documents)
    where regexp_matches(line, '[^\x20\x09-\x0D]')
), numbered as (
    select *, row_number() over (partition by doc_id order by pos) as i from worded
), spans as (
    select a.doc_id, a.i as lo, b.i as hi, string_agg(c.line, chr(10) order by c.i) as body,
           sum(c.wc) as words, any_value(a.wc) as first_wc, any_value(b.wc) as last_wc
    from numbered a
    join numbered b on a.doc_id = b.doc_id and b.i between a.i and a.i + 49
    join numbered c on a.doc_id = c.doc_id and c.i between a.i and b.i
    group by all
), shortest as (
    select * from spans
    where words >= 50 and (words - first_wc < 50 or words - last_wc < 50)
), later as (
    select s.doc_id, s.lo, s.hi
    from (select *, min((doc_id, lo)) over (partition by body) as source from shortest) s
    where (s.doc_id, s.lo) > s.source
), gone as (
    select distinct n.doc_id, n.pos
    from numbered n join later l on n.doc_id = l.doc_id and n.i between l.lo and l.hi
), kept as (
    select d.doc_id, string_agg(d.line, chr(10) order by d.pos) as text
    from (select doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos,
                 unnest(string_split(text, chr(10))) as line
          from documents) d
    left join gone g on d.doc_id = g.doc_id and d.pos = g.pos
    where g.pos is null
    group by d.doc_id
)
select d.doc_id, coalesce(len(g.ats), 0)::bigint as n_deleted,
       coalesce(array_to_string(g.ats, ','), '') as deleted,
       coalesce(k.text, '') as text
from documents d
left join (select doc_id, list(pos order by pos) as ats from gone group by doc_id) g using (doc_id)
left join kept k using (doc_id)
"""


_KEPT_VECTORS = """
with kept as materialized (
    select vec_id, label, row_number() over (order by vec_id nulls last, embedding) as rn,
           list_transform(embedding, lambda x: floor(1024 * x::double)) as q
    from embeddings
    where embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), parts as materialized (
    select rn, p, list_slice(q, p * len(q) // 4 + 1, (p + 1) * len(q) // 4) as v
    from kept, range(4) as t(p)
), book0 as materialized (
    select p, rn - 1 as e, v as c from parts where rn <= 256
)"""

_ASSIGNED_CODES = """, near{r} as materialized (
    select rn, p, min({{'d': list_dot_product(v, v) - 2 * list_dot_product(v, c)
                            + list_dot_product(c, c), 'e': e}}) as best
    from parts join book{r} using (p) group by rn, p
)"""

_NEXT_BOOK = """, mean{r} as materialized (
    select p, e, list(mean order by i) as c
    from (select p, best.e as e, i, floor(sum(x) / count(*)) as mean
          from (select rn, p, unnest(v) as x, generate_subscripts(v, 1) as i from parts)
          join near{r} using (rn, p) group by all)
    group by p, e
), book{n} as materialized (
    select p, e, coalesce(m.c, b.c) as c from book{r} b left join mean{r} m using (p, e)
)"""

_CODES = (
    _KEPT_VECTORS
    + "".join(_ASSIGNED_CODES.format(r=r) + _NEXT_BOOK.format(r=r, n=r + 1) for r in range(4))
    + _ASSIGNED_CODES.format(r=4)
    + """
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
       (select sha256(string_agg(array_to_string(list_transform(c, lambda x: x::bigint), ','), ','
                                 order by p, e)) from book4) as codebooks_sha256
from kept join (
    select rn, string_agg(printf('%02x', cast(best.e as int)), '' order by p) as code,
           cast(sum(best.d) as bigint) as error
    from near4 group by rn) using (rn)
"""
)


def oracle_sql() -> dict[str, str]:
    return {"op1_mix": _MIX, "op8_lines": _LINES, "op11_codes": _CODES}
