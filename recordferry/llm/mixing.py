"""Mixing sources to target weights by systematic sampling.

Targets: sources in code-point order (null last) weigh 1, 2, 3, 1, 2, 3, ...; they share all words by weight, but no source
gets more than three times its own words; what is over goes to the others by weight until none is above.

Sampling: every document of a source expects target / source words copies.  The documents of a source stand in the order of
a hash, the expected copies are summed up along it, one random offset per source is added, and a document is emitted once
for every integer that its stretch crosses.  The offset is drawn TRIES times by a hash, and the draw whose words come nearest
to the target counts.  Only hashes decide, so reruns agree.

The running sum needs no task that sees a whole source: the order starts with a bucket of the hash, the counts of the buckets
are summed per source over a table of at most BUCKETS rows a source, and ranks are counted inside a bucket only.

Null text has size 0.  A source without words has target 0 and takes nothing.  Repeated rows are rows of their own.  An
empty table gives an empty result.  Further columns are carried along untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordferry.llm.common import saved, word_count

CAP = 3
WEIGHTS = (1, 2, 3)
HEX_DIGITS = 3
BUCKETS = 16 ** HEX_DIGITS
TRIES = 32


def source_order(sizes: DataFrame) -> DataFrame:
    """`sizes` (source, source_size) with `place`, the source's position from 0 in code-point order, null last.

    Spark sorts strings by their UTF-8 bytes, which is code-point order.  Sources are dealt by range and counted per range,
    so that no task sees all of them.
    """
    ranged = saved(sizes.repartitionByRange(F.col("source").asc_nulls_last())
                   .sortWithinPartitions(F.col("source").asc_nulls_last())
                   .select("*", F.monotonically_increasing_id().alias("at")))
    part = F.shiftrightunsigned("at", 33)
    starts = (ranged.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(
                  Window.unboundedPreceding, -1)), F.lit(0))))
    return (ranged.withColumn("part", part).join(starts, "part")
            .select("source", "source_size", (F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias("place")))


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source."""
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    weighed = saved(source_order(sizes).withColumn("weight", weight))
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    # Raise the level until no further source is capped; each round reads one row of sums.
    level, capped = None, 0
    while True:
        under = F.lit(True) if level is None else CAP * F.col("source_size") > F.lit(level) * F.col("weight")
        row = weighed.agg(F.sum(F.when(under, F.col("weight"))), F.sum(F.when(~under, F.col("source_size"))),
                          F.count_if(~under)).first()
        if level is not None and row[2] == capped or not row[0]:
            break
        level, capped = (total - CAP * (row[1] or 0)) / row[0], row[2]
    share = F.lit(float(level or 0.0)) * F.col("weight")
    return weighed.select("source", "source_size",
                          F.least(share, (CAP * F.col("source_size")).cast("double")).alias("target"))


def crossed(offset: Column) -> Column:
    """Integers that the stretch of the document at `rank` crosses; CAP only guards the last bit of the sum."""
    at, rate = F.col("rank"), F.col("rate")
    return F.least(F.floor((at + 1) * rate + offset) - F.floor(at * rate + offset), F.lit(CAP))


def draw(seed: str, number: int) -> Column:
    """The offset in [0, 1) of the source's draw of that number."""
    mark = F.md5(F.concat("named", F.lit(f"/{seed}/{number}")))
    return F.conv(F.substring(mark, 1, 8), 16, 10).cast("double") / float(1 << 32)


def ranked(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """`rows` with what `plan` has on their bucket, and `rank`, their place in their source's order."""
    inside = Window.partitionBy("named", "is_null", "bucket").orderBy("mark", "doc_id", "size")
    return rows.join(plan, ["named", "is_null", "bucket"]).withColumn("rank", F.col("first") + F.row_number().over(inside) - 1)


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", carry: bool = False,
        seed: str = "mix") -> DataFrame:
    """doc_id, source, size, source_size, target, copies; with `carry` also `doc`, the whole row.  All documents, also those
    with 0 copies.  `named` and `is_null` stand for the source in joins, so that a null source meets itself."""
    mark = F.md5(F.concat(F.coalesce(docs[doc_id].cast("string"), F.lit("")), F.lit(f"/{seed}")))
    light = [docs[doc_id].alias("doc_id"), docs[source].alias("source"), word_count(docs[text]).alias("size"), mark.alias("mark"),
             F.substring(mark, 1, HEX_DIGITS).alias("bucket"), F.coalesce(docs[source], F.lit("")).alias("named"),
             docs[source].isNull().alias("is_null")]
    rows = saved(docs.select(*light))
    buckets = saved(rows.groupBy("named", "is_null", "bucket").agg(
        F.any_value("source").alias("source"), F.count("*").alias("n"), F.sum("size").alias("words")))
    before = Window.partitionBy("named", "is_null").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = buckets.select("named", "is_null", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goal = targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size"))).select(
        F.coalesce("source", F.lit("")).alias("named"), F.col("source").isNull().alias("is_null"), "source_size", "target",
        rate.alias("rate"))
    source_key = ["named", "is_null"]
    tries = [f"try{k}" for k in range(TRIES)]
    drawn = goal.withColumns({t: draw(seed, k) for k, t in enumerate(tries)})
    tried = ranked(rows, first.join(drawn, source_key)).groupBy(*source_key, "source_size", "target", "rate", *tries).agg(
        *[F.sum(crossed(F.col(t)) * F.col("size")).alias(f"taken_{t}") for t in tries])
    off = [F.struct(F.abs(F.col(f"taken_{t}") - F.round("target").cast("long")).alias("error"), F.lit(k).alias("try"),
                    F.col(t).alias("offset")) for k, t in enumerate(tries)]
    best = saved(tried.select(*source_key, "source_size", "target", "rate", F.least(*off)["offset"].alias("offset")))
    every = docs.select(*light, F.struct(*[docs[c] for c in docs.columns]).alias("doc")) if carry else rows
    return ranked(every, first.join(best, source_key)).select(
        "doc_id", "source", "size", "source_size", "target", crossed(F.col("offset")).cast("long").alias("copies"),
        *(["doc"] if carry else []))


def emit(docs: DataFrame) -> DataFrame:
    """The mix itself: every row of `docs` as often as it is taken, columns unchanged."""
    taken = mix(docs, carry=True).filter("copies > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")
