"""Tiered matching of source leases and target records.

Each tier is an equi-join, so a tier never compares all pairs of a county-day:
the contained-number tier joins on the rarest five characters of the contained
number (see `index_numbers`).  Hot keys are left to adaptive skew-join splitting, and
uniqueness is tested by an aggregate, which combines before the shuffle, rather
than by a window, which would gather a hot group in one task.  The contained
tiers work on the different numbers of a county-day and attach rows last.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordferry.functions.text import fold
from recordferry.operators.normalize import with_match_keys

SHORTEST_CONTAINED = 5  # fixed value: shorter numbers do not take part in tier 3
GRAM_BUCKETS = 1 << 13  # buckets in which the frequency of 5-character windows is counted

EXACT = "equal number"
PARTIAL = "contained number"
SOURCE_ONLY = "no target record"

PAIR_COLUMNS = ("target_record_id", "target_record_number", "source_lease_id", "source_record_number",
                "target_volume", "target_page", "source_volume", "source_page", "source_county_name")


def _target_side(target: DataFrame) -> DataFrame:
    return with_match_keys(target).select(
        F.col("record_id").alias("target_record_id"),
        F.col("record_number").alias("target_record_number"),
        F.col("number_key").alias("target_key"),
        F.col("volume").alias("target_volume"),
        F.col("page").alias("target_page"),
        F.col("file_date").alias("day"),
        fold(F.col("county_name")).alias("county_key"))


def _source_side(source: DataFrame) -> DataFrame:
    return with_match_keys(source).select(
        F.col("lease_id").alias("source_lease_id"),
        F.col("record_number").alias("source_record_number"),
        F.col("number_key").alias("source_key"),
        F.col("volume").alias("source_volume"),
        F.col("page").alias("source_page"),
        F.col("record_date").alias("day"),
        fold(F.col("county_name")).alias("county_key"),
        F.col("county_name").alias("source_county_name"))


# ---- what is already exported --------------------------------------------------

def not_logged(df: DataFrame, log: DataFrame, lease_column: str = "source_lease_id") -> DataFrame:
    """Rows whose lease has no log row."""
    logged = log.where(F.col("lease_id").isNotNull()).select(F.col("lease_id").alias(lease_column))
    return df.join(logged, lease_column, "left_anti")


def unexported(df: DataFrame, log: DataFrame, mode: str = "intended",
               record_column: str = "target_record_id") -> DataFrame:
    """Rows whose record was not exported, judged by the log's lease id.

    Intended mode keeps a row once if no log row of its record has a lease.
    Reference mode keeps it once if the record has no log row, and once per log
    row without a lease.
    """
    if mode == "intended":
        done = log.where(F.col("lease_id").isNotNull()).select(F.col("record_id").alias(record_column))
        return df.join(done, record_column, "left_anti")
    ids = log.select(F.col("record_id").alias(record_column), F.col("lease_id").alias("logged_lease"))
    return df.join(ids, record_column, "left").where("logged_lease is null").drop("logged_lease")


# ---- tiers -----------------------------------------------------------------------

def match_exact(target: DataFrame, source: DataFrame, keep_unmatched: bool = False) -> DataFrame:
    """Tier 1: number, date and county agree."""
    t = _target_side(target).withColumnRenamed("target_key", "number_key")
    s = _source_side(source).withColumnRenamed("source_key", "number_key")
    how = "left" if keep_unmatched else "inner"
    return s.join(t, ["number_key", "day", "county_key"], how).select(*PAIR_COLUMNS)


def match_volume_page(target: DataFrame, source: DataFrame) -> DataFrame:
    """Tier 2: volume, page, date and county agree, the numbers differ."""
    t, s = _target_side(target).alias("t"), _source_side(source).alias("s")
    same = [F.col(f"t.{a}") == F.col(f"s.{b}") for a, b in (
        ("target_volume", "source_volume"), ("target_page", "source_page"),
        ("day", "day"), ("county_key", "county_key"))]
    differ = F.col("t.target_key") != F.col("s.source_key")
    return s.join(t, reduce(Column.__and__, same) & differ).select(*PAIR_COLUMNS)


# A row of the contained-number index is a gram of a number, or the number as a whole under its rarest gram.  A gram
# on one side meets a whole number on the other; the role keeps the two directions (and, where wanted, equality)
# apart in one join.
SOURCE_AROUND, TARGET_AROUND, EQUAL = 0, 1, 2


def _gram_at(text: str, at: str) -> Column:
    return F.col(text).substr(F.col(at), F.lit(SHORTEST_CONTAINED))


def _first_gram(text: str, at: str) -> Column:
    """Whether the gram at this place was not there before."""
    return F.instr(F.col(text), _gram_at(text, at)) == F.col(at)


def gram_rows(df: DataFrame, text: str) -> DataFrame:
    """`df` with `_at` and `_gram`: the distinct 5-character windows of a text, at their first places.

    Whatever contains a number of five characters or more has all of its grams, so any one of them finds it.
    """
    places = F.sequence(F.lit(1), F.length(text) - (SHORTEST_CONTAINED - 1))
    return (df.where(F.length(text) >= SHORTEST_CONTAINED).withColumn("_at", F.explode(places))
            .where(_first_gram(text, "_at")).withColumn("_gram", _gram_at(text, "_at")))


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(GRAM_BUCKETS)).cast("int")


def gram_frequency(*numbers: DataFrame) -> Column:
    """How many rows hold a gram of each bucket: a scalar subquery of `GRAM_BUCKETS` counts, whatever the input's size.

    Grams share buckets by hash, and rows are counted as they come, without a shuffle of numbers.  The counts only choose under which gram a number is indexed, so a shared bucket can
    make the index larger and never a match wrong.  `numbers` have one column, the text.
    """
    every = reduce(DataFrame.unionByName, [gram_rows(n, n.columns[0]).select("_gram") for n in numbers])
    none = numbers[0].sparkSession.range(GRAM_BUCKETS).select(F.col("id").cast("int").alias("bucket"), F.lit(0).cast("bigint").alias("n"))
    counts = (every.groupBy(_bucket(F.col("_gram")).alias("bucket")).agg(F.count("*").alias("n")).unionByName(none)
              .groupBy("bucket").agg(F.sum("n").alias("n")))
    by_bucket = F.sort_array(F.collect_list(F.struct("bucket", "n")))
    return counts.agg(by_bucket.getField("n").alias("frequency")).scalar()


def with_rarest_gram(df: DataFrame, text: str, frequency: Column) -> DataFrame:
    """Add `_rarest`: the place of the gram that the fewest numbers hold, the first of equals; NULL if there is none.

    Frequency and place share one number, so the choice is a hash aggregate; over rows that are grouped by their columns
    already, as those of `distinct_keys`, it needs no shuffle.
    """
    shift = F.lit(1 << 24)
    places = F.sequence(F.lit(1), F.greatest(F.length(text) - (SHORTEST_CONTAINED - 1), F.lit(1)))
    each = df.withColumn("_at", F.explode(places))
    cost = F.when((F.length(text) >= SHORTEST_CONTAINED) & (F.col("_at") < shift),
                  F.get(frequency, _bucket(_gram_at(text, "_at"))) * shift + F.col("_at"))
    return (each.groupBy(*df.columns).agg(F.min(cost).alias("_cost"))
            .select(*df.columns, F.pmod("_cost", shift).cast("int").alias("_rarest")))


def index_numbers(df: DataFrame, text: str, frequency: Column, piece_role: int, whole_role: int,
                  equal: bool = False) -> DataFrame:
    """Add `contained_key` and `role`: a row for each gram of a number that may hold another, one for the number itself.

    A number enters the index once, under its rarest gram, and asks with each of its grams once, so rows per number are
    its positions, at most, and two.  The join tests the rest.  `equal` adds a row for plain equality, for numbers of
    any length.  Rows of `df` are different numbers.
    """
    size, at = F.length(text), F.col("_at")
    whole, same = 0, -1  # stand in for a place
    last = F.when(size > SHORTEST_CONTAINED, size - (SHORTEST_CONTAINED - 1)).otherwise(whole)
    place = F.when(at == whole, F.col("_rarest")).otherwise(at)
    return (
        with_rarest_gram(df.where(size.isNotNull()), text, frequency)
        .withColumn("_at", F.explode(F.sequence(F.lit(same if equal else whole), last)))
        .withColumn("_place", place)
        .where((at == same) | (F.col("_place").isNotNull() & ((at == whole) | _first_gram(text, "_at"))))
        .withColumn("contained_key", F.when(at == same, F.col(text)).otherwise(_gram_at(text, "_place")))
        .withColumn("role", F.when(at == whole, whole_role).when(at == same, EQUAL).otherwise(piece_role))
        .select(*df.columns, "contained_key", "role")
    )


def _index_sides(source: DataFrame, source_text: str, target: DataFrame, target_text: str, frequency: Column,
                 equal: bool = False) -> tuple[DataFrame, DataFrame]:
    return (index_numbers(source, source_text, frequency, SOURCE_AROUND, TARGET_AROUND, equal),
            index_numbers(target, target_text, frequency, TARGET_AROUND, SOURCE_AROUND, equal))


def _holds(source_text: Column, target_text: Column, role: Column) -> Column:
    """What the index key leaves to be tested."""
    longer = F.length(source_text) - F.length(target_text)
    return (F.when(role == SOURCE_AROUND, (longer > 0) & source_text.contains(target_text))
            .when(role == TARGET_AROUND, (longer < 0) & target_text.contains(source_text))
            .otherwise(source_text == target_text))


def distinct_keys(side: DataFrame, text: str, on: list[str]) -> DataFrame:
    """The different numbers of a side within `on`, and how many rows hold each: all that the index needs to know."""
    return side.where(F.col(text).isNotNull()).groupBy(*on, text).agg(F.count("*").alias("copies"))


def key_pairs(source: DataFrame, source_text: str, target: DataFrame, target_text: str, on: list[str],
              equal: bool = False) -> DataFrame:
    """Pairs of different numbers of which one lies inside the other, longer one (or, with `equal`, equals it).

    Each side is reduced to its different numbers first, so a number that many rows share is indexed once and met
    once; `source_copies` says how many source rows hold it.  Rows are attached by the caller.
    """
    s = distinct_keys(source, source_text, on).withColumnRenamed("copies", "source_copies")
    t = distinct_keys(target, target_text, on).drop("copies")
    frequency = gram_frequency(source.select(source_text), target.select(target_text))
    indexed_s, indexed_t = _index_sides(s, source_text, t, target_text, frequency, equal)
    return (indexed_s.join(indexed_t, ["contained_key", *on, "role"])
            .where(_holds(F.col(source_text), F.col(target_text), F.col("role")))
            .select(*on, source_text, target_text, "source_copies", "role"))


PLACE = ["day", "county_key"]


def match_contained(target: DataFrame, source: DataFrame) -> DataFrame:
    """Tier 3: one number contains the other, both have five characters or more,
    date and county agree, and the source triple occurs once."""
    t, s = _target_side(target), _source_side(source)
    pairs = key_pairs(s, "source_key", t, "target_key", PLACE).where("source_copies = 1")
    return (s.join(pairs, [*PLACE, "source_key"]).join(t, [*PLACE, "target_key"]).select(*PAIR_COLUMNS))


def index_report(target: DataFrame, source: DataFrame) -> DataFrame:
    """What the contained-number index holds of each side: different numbers, grams they ask with, numbers to be found."""
    t, s = (distinct_keys(side, key, PLACE) for side, key in (
        (_target_side(target), "target_key"), (_source_side(source), "source_key")))
    frequency = gram_frequency(s.select("source_key"), t.select("target_key"))
    indexed = zip(("source", "target"), _index_sides(s, "source_key", t, "target_key", frequency, equal=True),
                  ((SOURCE_AROUND, TARGET_AROUND), (TARGET_AROUND, SOURCE_AROUND)))
    rows = [side.agg(F.lit(name).alias("side"), F.count_if(F.col("role") == EQUAL).alias("numbers"),
                     F.count_if(F.col("role") == around).alias("grams"), F.count_if(F.col("role") == whole).alias("findable"))
            for name, side, (around, whole) in indexed]
    return reduce(DataFrame.unionByName, rows)


def key_report(target: DataFrame, source: DataFrame) -> DataFrame:
    """The match at the level of numbers: each pair of equal or contained numbers, with its leases and records counted.

    A pair of numbers that m leases and n records share is one row here and m times n rows in `match_report`.
    """
    t, s = _target_side(target), _source_side(source)
    records = distinct_keys(t, "target_key", PLACE).withColumnRenamed("copies", "records")
    pairs = key_pairs(s, "source_key", t, "target_key", PLACE, equal=True).join(records, [*PLACE, "target_key"])
    return pairs.select(
        *PLACE, "source_key", "target_key", F.col("source_copies").alias("leases"), "records",
        F.when(F.col("role") == EQUAL, EXACT).when(F.col("source_copies") == 1, PARTIAL).alias("match_condition"))


def _findings(target: DataFrame, source: DataFrame) -> DataFrame:
    """Source keys with what they meet, one row per label and target key; without a label if the only hits are
    contained numbers of a triple that occurs more than once."""
    t, s = _target_side(target), _source_side(source)
    pairs = key_pairs(s, "source_key", t, "target_key", PLACE, equal=True)
    label = F.when(F.col("role") == EQUAL, EXACT).when(F.col("source_copies") == 1, PARTIAL)
    return (pairs.withColumn("match_condition", label)
            .select(*PLACE, "source_key", "match_condition",
                    F.when(F.col("match_condition").isNotNull(), F.col("target_key")).alias("target_key"))
            .distinct().withColumn("found", F.lit(True)))


def leases_with_match(target: DataFrame, source: DataFrame) -> DataFrame:
    """Ids of leases that tier 1 or an unguarded tier 3 would match."""
    t, s = _target_side(target), _source_side(source)
    hits = key_pairs(s, "source_key", t, "target_key", PLACE, equal=True).select(*PLACE, "source_key").distinct()
    return s.join(hits, [*PLACE, "source_key"], "left_semi").select("source_lease_id")


# ---- reports -----------------------------------------------------------------------

def source_only(target: DataFrame, source: DataFrame, log: DataFrame) -> DataFrame:
    """Leases neither logged nor matched by number: one anti-join for all reasons."""
    known = leases_with_match(target, source).unionByName(
        log.where("lease_id is not null").select(F.col("lease_id").alias("source_lease_id")))
    absent = {c: F.lit(None).cast(t) for c, t in (
        ("target_record_id", "string"), ("target_record_number", "string"),
        ("target_volume", "int"), ("target_page", "int"))}
    return (_source_side(source).join(known, "source_lease_id", "left_anti")
            .withColumns(absent).select(*PAIR_COLUMNS))


def match_report(target: DataFrame, source: DataFrame, log: DataFrame, mode: str = "intended",
                 ordered: bool = True) -> DataFrame:
    """Exact pairs, contained-number pairs and source-only leases, labelled, in one pass over the leases.

    Numbers are matched first (`key_pairs`), once for all three tiers; leases and records are attached last, and
    the log is asked at the end: by record for pairs, by lease for leases without a match.  Rows without a record
    take a key of their own in that last join, so that they do not meet in one task.
    """
    s, t = _source_side(source), _target_side(target)
    labelled = (s.join(_findings(target, source), [*PLACE, "source_key"], "left")
                .withColumn("match_condition", F.when(F.col("found").isNull(), SOURCE_ONLY)
                            .otherwise(F.col("match_condition")))
                .where("match_condition is not null").drop("found"))
    pairs = labelled.join(t, [*PLACE, "target_key"], "left")
    by_lease = (log.where("lease_id is not null").select(F.col("lease_id").alias("source_lease_id")).distinct()
                .withColumn("lease_logged", F.lit(True)))
    by_record = log.where("record_id is not null").groupBy(F.col("record_id").alias("log_key")).agg(
        F.count("lease_id").alias("done"), F.count_if(F.col("lease_id").isNull()).alias("open_rows"))
    apart = F.concat(F.lit("no record/"), F.col("source_lease_id").cast("string"))
    asked = (pairs.withColumn("log_key", F.coalesce("target_record_id", apart))
             .join(by_record, "log_key", "left").join(by_lease, "source_lease_id", "left"))
    alone = F.col("match_condition") == SOURCE_ONLY
    if mode == "intended":
        report = asked.where(F.when(alone, F.col("lease_logged").isNull()).otherwise(F.coalesce("done", F.lit(0)) == 0))
    else:
        times = F.when(alone, F.when(F.col("lease_logged").isNull(), 1).otherwise(0)).otherwise(F.coalesce("open_rows", F.lit(1)))
        report = asked.withColumn("_time", F.explode(F.array_repeat(F.lit(0), times.cast("int"))))
    report = report.select(*PAIR_COLUMNS, "match_condition")
    if not ordered:
        return report
    # Sorting samples its input first.  A shuffle of the finished report keeps
    # that sample from running the last joins a second time.
    return report.repartition("source_lease_id").orderBy("target_record_id", "source_lease_id")


def match_distinct(target: DataFrame, source: DataFrame, log: DataFrame) -> DataFrame:
    """Distinct pairs of tiers 1 and 2 whose lease is not logged.

    The log is tested once, on the pairs, which are fewer than the leases.
    """
    pairs = match_exact(target, source).unionByName(match_volume_page(target, source))
    return not_logged(pairs, log).distinct()


def match_any_legacy(target: DataFrame, source: DataFrame, log: DataFrame, mode: str = "intended") -> DataFrame:
    """The single-pass OR match on digits-only slices, as three equi-joins.

    Branches: equal number; target volume equals the source number; one digit
    text inside the other with numbers of different length.  Each branch leaves
    out pairs of the branches before it, so their union needs no deduplication.
    """
    t = target.select(
        F.col("record_id").alias("target_record_id"), F.col("digits_number").alias("target_number"),
        F.col("digits_text").alias("target_text"), F.col("volume").alias("target_volume"),
        F.col("page").alias("target_page"), F.col("county_id").alias("target_county_id"),
        F.col("file_date").alias("day"))
    s = source.select(
        F.col("lease_id").alias("source_lease_id"), F.col("digits_number").alias("source_number"),
        F.col("digits_text").alias("source_text"), F.col("volume").alias("source_volume"),
        F.col("page").alias("source_page"), F.col("record_date").alias("day"))
    columns = ("target_record_id", "target_number", "source_lease_id", "source_number", "target_volume",
               "target_page", "source_volume", "source_page", "target_county_id")

    def size(c: str) -> Column:
        return F.length(F.col(c).cast("string"))

    equal_number = F.col("target_number") == F.col("source_number")
    equal_volume = F.col("target_volume").cast("bigint") == F.col("source_number")
    by_number = s.join(t.where("target_number is not null").withColumn(
        "source_number", F.col("target_number")), ["day", "source_number"])
    by_volume = s.join(t.withColumn("source_number", F.col("target_volume").cast("bigint")),
                       ["day", "source_number"]).where(~F.coalesce(equal_number, F.lit(False)))
    long_enough = (size("target_number") >= SHORTEST_CONTAINED) & (size("source_number") >= SHORTEST_CONTAINED)
    numbered_t, numbered_s = t.where("target_number is not null"), s.where("source_number is not null")
    texts = key_pairs(numbered_s, "source_text", numbered_t, "target_text", ["day"]).drop("source_copies", "role")
    by_text = (numbered_s.join(texts, ["day", "source_text"]).join(numbered_t, ["day", "target_text"])
               .select(*columns)
               .where(long_enough & (size("target_number") != size("source_number"))
                      & ~F.coalesce(equal_volume, F.lit(False))))
    pairs = by_number.select(*columns).unionByName(by_volume.select(*columns)).unionByName(by_text)
    return unexported(pairs, log, mode)


def missing_in_target(leases: DataFrame, records: DataFrame, log: DataFrame, updated: str = "created",
                      ordered: bool = True) -> DataFrame:
    """Leases without a log row that points to an existing record, oldest first."""
    arrived = (log.where("lease_id is not null")
               .join(records.select("record_id"), "record_id", "left_semi").select("lease_id"))
    missing = leases.join(arrived, "lease_id", "left_anti")
    # As in `match_report`: the sort's sample must not run the join again.
    return missing.repartition("lease_id").orderBy(updated, "lease_id") if ordered else missing


def _number_keys(side: DataFrame, key: str) -> DataFrame:
    return side.withColumnRenamed(key, "number_key")


def log_fill_candidates(log: DataFrame, target: DataFrame, source: DataFrame) -> DataFrame:
    """Records whose log row lacks a lease and whose number now matches one."""
    open_rows = log.where("lease_id is null").select(F.col("record_id").alias("target_record_id"))
    return (match_exact(target, source).join(open_rows, "target_record_id", "left_semi").distinct()
            .withColumn("category", F.lit("Category 1: in the target, log row without lease")))


def log_fill_choices(log: DataFrame, target: DataFrame, source: DataFrame) -> DataFrame:
    """For each record of `log_fill_candidates`, the least lease and how many compete.

    Leases are reduced per number, date and county before the join, so a number
    that many leases share costs one row and not one row per pair.
    """
    open_rows = log.where("lease_id is null").select(F.col("record_id").alias("target_record_id"))
    per_key = (_number_keys(_source_side(source), "source_key")
               .groupBy("number_key", "day", "county_key")
               .agg(F.min("source_lease_id").alias("least"), F.count_distinct("source_lease_id").alias("leases")))
    records = _number_keys(_target_side(target), "target_key").join(open_rows, "target_record_id", "left_semi")
    return (records.join(per_key, ["number_key", "day", "county_key"])
            .groupBy("target_record_id")
            .agg(F.min("least").alias("source_lease_id"), F.sum("leases").alias("candidates")))


def stage_candidates(source: DataFrame, log: DataFrame, crosswalk: DataFrame, target: DataFrame | None = None,
                     mode: str = "intended") -> DataFrame:
    """Source leases to stage: not logged, and in a county the target knows.

    Intended mode also leaves out leases that a target record matches exactly;
    it needs `target`.  Reference mode tests the log only.
    """
    known = log.where("lease_id is not null").select("lease_id")
    if mode == "intended" and target is not None:
        # Ids of matched leases: only the narrow keys are shuffled by number, and
        # one anti-join on the lease id then serves both reasons.
        keys = ["number_key", "day", "county_key"]
        s = _number_keys(_source_side(source), "source_key").select("source_lease_id", *keys)
        t = _number_keys(_target_side(target), "target_key").select(*keys)
        matched = s.join(t, keys, "left_semi").select(F.col("source_lease_id").alias("lease_id"))
        known = known.unionByName(matched)
    counties = crosswalk.where("tgt_county_id is not null").select(
        F.col("src_county_id").alias("county_id"), "tgt_county_id")
    return source.join(known, "lease_id", "left_anti").join(counties, "county_id")
