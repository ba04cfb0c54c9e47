"""Row counts of the steps of a job, taken while the job runs.

A step is observed where it stands in the plan: the counts arrive with the job that writes or collects its result, and
nothing is read a second time.  A step may name the step whose rows it must keep; `check` raises where a join has
multiplied or lost them.  Counts are those of one run of the plan: put the result in a table, and do not sort it (a
sort samples its input and would count it twice).
"""

from __future__ import annotations

from pyspark.errors import PySparkValueError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ROWS, DIGEST = "rows", "digest"


class FanOut(PySparkValueError):
    """A step changed a number of rows that it must keep."""

    def __init__(self, step: str, rows: int, of: str, of_rows: int):
        super().__init__(f"step {step!r} has {rows} rows, {of!r} had {of_rows}")
        self.step, self.rows, self.of, self.of_rows = step, rows, of, of_rows


class Steps:
    """The observed steps of one job, in order."""

    def __init__(self) -> None:
        self._seen: dict[str, tuple[Observation, str | None, bool]] = {}

    def see(self, df: DataFrame, name: str, of: str | None = None, keeps: bool = False) -> DataFrame:
        """`df`, whose rows are counted as step `name`.  `of` is the step it came from, whose rows it `keeps`, or not."""
        if name in self._seen:
            raise ValueError(f"step {name!r} is there already")
        if keeps and of not in self._seen:
            raise ValueError(f"step {name!r} keeps the rows of a step that is not there: {of!r}")
        observation = Observation(f"rows of {name}")
        self._seen[name] = observation, of, keeps
        return df.observe(observation, F.count(F.lit(1)).alias(ROWS))

    def counts(self) -> dict[str, int]:
        """Rows by step, after the job has run; waits for a job that is still running."""
        return {name: observation.get[ROWS] for name, (observation, _, _) in self._seen.items()}

    def check(self) -> None:
        """Raise `FanOut` for the first step that did not keep what it had to keep."""
        counts = self.counts()
        for name, (_, of, keeps) in self._seen.items():
            if keeps and counts[name] != counts[of]:
                raise FanOut(name, counts[name], of, counts[of])

    def report(self, spark: SparkSession) -> DataFrame:
        """step, step_name, rows_in, rows_out, kept: one row per step."""
        counts = self.counts()
        rows = [F.struct(
            F.lit(i + 1).alias("step"), F.lit(name).alias("step_name"),
            F.lit(counts.get(of)).cast("bigint").alias("rows_in"), F.lit(counts[name]).cast("bigint").alias("rows_out"),
            F.lit(counts[name] == counts[of] if keeps else None).cast("boolean").alias("kept"))
            for i, (name, (_, of, keeps)) in enumerate(self._seen.items())]
        return spark.range(1).select(F.inline(F.array(*rows)))


def run(df: DataFrame) -> None:
    """Run a plan for its counts alone; nothing is kept."""
    df.write.format("noop").mode("overwrite").save()


class Unseen(Steps):
    """Leaves the plan as it is: what jobs use where nobody asks for counts."""

    def see(self, df: DataFrame, name: str, of: str | None = None, keeps: bool = False) -> DataFrame:
        return df


UNSEEN = Unseen()


def content(columns: list[str]) -> tuple[Column, Column]:
    """Row count and a digest of all rows, in any order, NULLs and repeated rows included."""
    each = F.xxhash64(*[F.struct(F.col(f"`{c}`").isNull(), F.col(f"`{c}`")) for c in columns])
    return F.count(F.lit(1)).alias(ROWS), F.sum(each.cast("decimal(38,0)")).alias(DIGEST)


def seen_content(df: DataFrame) -> tuple[DataFrame, Observation]:
    """`df`, and the observation of its rows and digest while it is written."""
    observation = Observation("content")
    return df.observe(observation, *content(df.columns)), observation


def content_of(df: DataFrame) -> tuple[int, int]:
    row = df.agg(*content(df.columns)).first()
    return row[ROWS], int(row[DIGEST] or 0)
