"""Mixing sources to target weights by a low-discrepancy schedule (DataFrame functions only).

Every source's documents form one stream in shuffled order, cut into blocks of equally many words. Slots of
a golden-ratio sequence fall through the cumulative shares of the sources; the r-th slot of a source takes
block r mod n of its stream, so any prefix of the schedule holds the sources close to their shares. Prefix
sums over a source run in two levels (buckets of the shuffle key, then rows), so one source may hold any
share of the rows. Only tables of one row a source are ordered as a whole.

Defined cases: null or empty texts and texts without words have size 0 and are never taken; a null source is
a source of its own, last in order; a null or repeated doc_id is a document like any other (rows that repeat
an id share its place in the shuffle, ordered by size); an empty table gives an empty result; other columns
are ignored, whatever their names. Reruns agree: the order depends on doc_id alone.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.llm.common import WORD, save, table

#: 2 ** 32 divided by the golden ratio; multiples of it modulo 2 ** 32 are the points of the schedule.
GOLDEN = 2654435769
TURN = 1 << 32
BLOCK_WORDS, LEAST_BLOCKS = 256, 512
CHUNK = 4096


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and the key of the shuffled order."""
    key = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), key.alias("key"))


def targets(sizes: DataFrame, weights=(1, 2, 3), most: int = 3) -> DataFrame:
    """One row a source: its size, weight, target, block length, number of blocks and slots.

    Weights share all words; a target stops at `most` times its source's size and the excess is shared again
    by weight. With sources in order of cap per weight, the first for which the rest's level is within its
    cap gives the level of all that are not capped.
    """
    whole, order = Window.partitionBy(), Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("sidx"))
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("sidx", F.row_number().over(order) - 1)
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("sidx") % len(weights)) + 1).cast("double"))
    s = s.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    s = s.withColumn("total", F.sum("source_size").over(whole).cast("double"))
    s = s.withColumn("before", F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    s = s.withColumn("rest", F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("level", (F.col("total") - F.col("before")) / F.col("rest"))
    s = s.withColumn("level", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("before", "level"))).over(whole)["level"])
    s = s.withColumn("target", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))))
    s = s.withColumn("block", F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.expr(f"source_size div {LEAST_BLOCKS}"))).cast("long"))
    s = s.withColumn("blocks", F.expr("(source_size + block - 1) div block"))
    turns = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    s = s.withColumn("turns", F.least(turns, F.lit(most)).cast("long"))
    s = s.withColumn("slots", (F.col("turns") * F.col("blocks") + F.floor((F.col("target") - F.col("turns") * F.col("source_size")) / F.col("block") + 0.5)).cast("long"))
    return s.withColumn("slots", F.least("slots", F.col("blocks") * most)).select("source", "sidx", "source_size", "target", "block", "blocks", "slots")


def schedule(goals: DataFrame) -> DataFrame:
    """Rows (sidx, slot, rank, block_no, turn): which block of which source each slot takes."""
    spark = goals.sparkSession
    live = goals.where("slots > 0")
    total = live.agg(F.sum("slots")).first()[0] or 0
    #: The sequence misses a share's count by a few slots at most, growing with the logarithm of its length;
    #: every source gets so many more and uses its first `slots` only.
    spare = 8 + int(math.log2(total + 1))
    by = Window.orderBy("sidx")
    live = live.withColumn("wide", F.col("slots") + spare).withColumn("upto", F.sum("wide").over(by))
    live = live.withColumn("n", F.sum("wide").over(Window.partitionBy()).cast("double"))
    live = live.withColumn("lo", F.floor((F.col("upto") - F.col("wide")) / F.col("n") * TURN).cast("long")).withColumn("hi", F.floor(F.col("upto") / F.col("n") * TURN).cast("long"))
    cells = live.select("sidx", "lo", "hi", "slots", "blocks", F.explode(F.sequence(F.expr("lo div 1048576"), F.expr("(hi - 1) div 1048576"))).alias("cell"))
    n = live.agg(F.max("n")).first()[0] or 0
    #: slot * GOLDEN modulo 2 ** 32 in two halves, as the product would not fit.
    point = f"pmod(pmod((id div 65536) % 65536 * {GOLDEN}, {TURN}) * 65536 + (id % 65536) * {GOLDEN}, {TURN})"
    slots = spark.range(int(n)).select(F.col("id").alias("slot"), F.expr(point).alias("point"))
    slots = slots.withColumn("cell", F.expr("point div 1048576")).join(cells, "cell").where("point >= lo and point < hi")
    slots = slots.withColumn("chunk", F.expr(f"slot div {CHUNK}")).select("sidx", "slot", "chunk", "slots", "blocks")
    earlier = slots.groupBy("sidx", "chunk").agg(F.count("*").alias("n"))
    earlier = earlier.select("sidx", "chunk", (F.sum("n").over(Window.partitionBy("sidx").orderBy("chunk")) - F.col("n")).alias("earlier"))
    ranked = slots.withColumn("here", F.row_number().over(Window.partitionBy("sidx", "chunk").orderBy("slot")) - 1)
    ranked = ranked.join(earlier, ["sidx", "chunk"]).withColumn("rank", F.col("earlier") + F.col("here")).where("rank < slots")
    return ranked.select("sidx", "slot", "rank", (F.col("rank") % F.col("blocks")).alias("block_no"), F.expr("rank div blocks").alias("turn"))


def mix(docs: DataFrame, weights=(1, 2, 3), most: int = 3) -> DataFrame:
    """doc_id, source, size, source_size, target and taken: the words of the document that the mix takes, repeats counted."""
    sizes = save(sized(docs), "sizes")
    goals = save(targets(sizes, weights, most), "targets")
    placed = sizes.withColumn("bucket", F.shiftright("key", 48))
    buckets = placed.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    buckets = buckets.select(F.col("source").alias("bs"), F.col("bucket").alias("bb"), (F.sum("n").over(Window.partitionBy("source").orderBy("bucket")) - F.col("n")).alias("offset"))
    inside = Window.partitionBy("source", "bucket").orderBy("key", F.col("doc_id").asc_nulls_first(), "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("here", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(buckets, F.col("source").eqNullSafe(F.col("bs")) & (F.col("bucket") == F.col("bb")))
    placed = placed.select("doc_id", "source", "size", (F.col("offset") + F.col("here")).alias("start"))
    g = goals.withColumnRenamed("source", "gs")
    placed = placed.join(g, F.col("source").eqNullSafe(F.col("gs"))).drop("gs", "slots", "blocks")
    last = F.expr("(start + size - 1) div block")
    pieces = placed.where("size > 0").withColumn("block_no", F.explode(F.sequence(F.expr("start div block"), last)))
    words = F.least(F.col("start") + F.col("size"), (F.col("block_no") + 1) * F.col("block")) - F.greatest(F.col("start"), F.col("block_no") * F.col("block"))
    taken = schedule(goals).groupBy("sidx", "block_no").agg(F.count("*").alias("times"))
    pieces = pieces.withColumn("words", words).join(taken, ["sidx", "block_no"], "left")
    keys = ["doc_id", "source", "size", "source_size", "target", "start"]
    summed = pieces.groupBy(*keys).agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).cast("long").alias("taken"))
    empty = placed.where("size = 0").select(*keys, F.lit(0).cast("long").alias("taken"))
    return summed.unionByName(empty).drop("start")


def take(docs: DataFrame, weights=(1, 2, 3), most: int = 3) -> DataFrame:
    """The mix itself, in the columns of docs: a document once for every time its words are taken.

    A document that the mix takes in part (at most one a source, where its stream ends) gives its first words,
    joined by single spaces. Rows without words are not part of a mix.
    """
    taken = mix(docs, weights, most).where("taken > 0").select(F.col("doc_id").alias("_id"), F.col("size").alias("_size"), F.col("taken").alias("_taken"))
    taken = taken.withColumn("_copy", F.row_number().over(Window.partitionBy("_id").orderBy("_size", "_taken")))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    # The row goes along as one value, so its columns may have any names.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("own"), F.col("text").alias("whole"), size.alias("words")).where("words > 0")
    rows = rows.withColumn("no", F.row_number().over(Window.partitionBy("own").orderBy("words")))
    rows = rows.join(taken, F.col("own").eqNullSafe(F.col("_id")) & (F.col("no") == F.col("_copy")))
    rows = rows.withColumn("turn", F.explode(F.expr("sequence(0L, (_taken - 1) div words)"))).withColumn("keep", F.least(F.col("words"), F.col("_taken") - F.col("turn") * F.col("words")))
    cut = F.array_join(F.slice(F.regexp_extract_all("whole", F.lit(WORD), F.lit(0)), 1, F.col("keep").cast("int")), " ")
    rows = rows.withColumn("whole", F.when(F.col("keep") == F.col("words"), F.col("whole")).otherwise(cut))
    new = {"text": lambda _: F.col("whole"), "n_chars": lambda c: F.char_length("whole").cast(docs.schema[c].dataType)}
    return rows.select(*[new.get(c.lower(), lambda c: F.col("row")[c])(c).alias(c) for c in docs.columns])


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


OP1_SQL = r"""
with sizes as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint as key
  from documents
), s0 as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source asc nulls last) - 1 as sidx from sizes group by source
), s1 as (
  select *, (sidx % 3 + 1)::double as weight, source_size * 3.0::double as cap, sum(source_size) over ()::double as total from s0
), s2 as (
  select *, coalesce(sum(cap) over (order by cap / weight, sidx rows between unbounded preceding and 1 preceding), 0) as before,
    sum(weight) over (order by cap / weight, sidx rows between current row and unbounded following) as rest from s1
), s3 as (
  select *, (select (b.total - b.before) / b.rest from s2 b where (b.total - b.before) / b.rest * b.weight <= b.cap order by b.before, (b.total - b.before) / b.rest limit 1) as level from s2
), s4 as (
  select *, least(cap, coalesce(level * weight, cap)) as target, greatest(1, least(256, source_size // 512))::bigint as block from s3
), s5 as (
  select *, (source_size + block - 1) // block as blocks, case when source_size > 0 then least(floor(target / source_size), 3) else 0 end::bigint as turns from s4
), s6 as (
  select *, least(blocks * 3, (turns * blocks + floor((target - turns * source_size) / block + 0.5))::bigint) as slots from s5
), live as (
  select *, slots + 8 + floor(log2((select sum(slots) from s6) + 1))::bigint as wide from s6 where slots > 0
), edges as (
  select *, sum(wide) over (order by sidx) as upto, (sum(wide) over ())::double as n from live
), spans as (
  select *, floor((upto - wide) / n * 4294967296)::bigint as lo, floor(upto / n * 4294967296)::bigint as hi from edges
), points as (
  select range as slot, (((range // 65536) % 65536 * 2654435769) % 4294967296 * 65536 + (range % 65536) * 2654435769) % 4294967296 as point
  from range((select max(n)::bigint from edges))
), ranked as (
  select sidx, slots, blocks, row_number() over (partition by sidx order by slot) - 1 as rank from points join spans on point >= lo and point < hi
), times as (
  select sidx, rank % blocks as block_no, count(*) as times from ranked where rank < slots group by all
), placed as (
  select doc_id, size, s6.source_size, s6.target, s6.source, s6.sidx, s6.block,
    coalesce(sum(size) over (partition by sizes.source order by key, doc_id nulls first, size rows between unbounded preceding and 1 preceding), 0)::bigint as start
  from sizes join s6 on sizes.source is not distinct from s6.source
), pieces as (
  select *, unnest(generate_series(start // block, (start + size - 1) // block)) as block_no from placed where size > 0
), summed as (
  select doc_id, size, source_size, target, source,
    sum((least(start + size, (pieces.block_no + 1) * block) - greatest(start, pieces.block_no * block)) * coalesce(times, 0))::bigint as taken
  from pieces left join times on pieces.sidx = times.sidx and pieces.block_no = times.block_no
  group by doc_id, size, source_size, target, source, start
)
select doc_id, size, source_size, target, taken, source from summed
union all select doc_id, size, source_size, target, 0::bigint, source from placed where size = 0
"""
