"""Quality rules as a ledger: one bit per failed rule, beside the measurements behind it.

`ledger` measures every text once and evaluates every rule once.  Policies are versioned bit masks over that ledger, so a
new policy, or the question what a rule costs, never reads a text again: `verdict` and `ablation` work on bits alone.

Null text counts as empty: no words, so it fails `few_words`.  Rows are judged one by one, so repeated rows and ties change
nothing, an empty table gives an empty ledger, and further columns of the input are neither read nor changed.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordferry.llm.common import SEPARATORS

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(ord("A"), ord("Z") + 1))
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters")


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES.  Words and lines are compared as bytes."""
    data = (text or "").encode()
    words = data.split()  # bytes.split() takes exactly the six separators
    n_separators = len(data) - len(data.translate(None, SEPARATORS))
    lines = [line for line in data.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        times, end = Counter(windows), 0
        for at, window in enumerate(windows):
            if times[window] > 1:
                repeated += at + 3 - max(at, end)
                end = at + 3
    n_upper = len(data) - len(data.translate(None, UPPER))
    n_lower = len(data) - len(data.translate(None, UPPER.lower()))
    return (len(words), len(text or "") - n_separators, len(data) - len(data.translate(None, SYMBOLS)),
            len(lines), len(lines) - len(set(lines)), repeated, n_upper, n_upper + n_lower)


@F.arrow_udf(T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))
def measured(texts: pa.Array) -> pa.Array:
    columns = zip(*map(measure, texts.to_pylist()))
    arrays = [pa.array(c, pa.int64()) for c in columns] or [pa.array([], pa.int64())] * len(MEASURES)
    return pa.StructArray.from_arrays(arrays, names=list(MEASURES))


#: name, condition of failure over the measurements.  A rule keeps its bit for ever; new rules go to the end.
RULES = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "5 * n_symbols > n_words"),
    ("duplicate_lines", "2 * n_dup_lines > n_lines"),
    ("capitals", "2 * n_upper > n_letters"),
    ("short_or_long_words", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
)
BIT = {name: 1 << at for at, (name, _) in enumerate(RULES)}


def mask(*names: str) -> int:
    return sum(BIT[n] for n in names)


BASE = mask("few_words", "repeated_words")
#: A policy never changes once it is in use; a new version is a new entry.
POLICIES = {
    "base": BASE,
    "v1": BASE | mask("symbols", "duplicate_lines", "capitals"),
    "v2": BASE | mask("symbols", "duplicate_lines", "capitals", "short_or_long_words"),
}
CURRENT = "v1"


def failed_bits(measurements: str) -> Column:
    """The failed rules of the struct column `measurements` as one long; each rule is evaluated once."""
    bits = [F.when(F.expr(_within(condition, measurements)), F.lit(BIT[name])).otherwise(0).cast("long")
            for name, condition in RULES]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return total


def _within(condition: str, struct: str) -> str:
    return " ".join(f"{struct}.{word}" if word in MEASURES else word for word in condition.split())


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc (the whole input row), the measurements, failed (bits).  No shuffle."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), measured(docs[text]).alias("measured"))
    return rows.select("doc", "measured.*", failed_bits("measured").alias("failed"))


def verdict(policy: str = CURRENT, failed: str = "failed") -> Column:
    """True where no rule of the policy failed."""
    return F.col(failed).bitwiseAND(F.lit(POLICIES[policy])) == 0


def ablation(entries: DataFrame, policy: str = CURRENT) -> DataFrame:
    """For each rule of a policy: rule, n_failed, n_only (rows that this rule alone rejects: what dropping it would keep).

    One pass over the ledger: rows are counted per set of bits first, at most 2**len(RULES) counts, then each rule reads
    those counts.
    """
    in_force = POLICIES[policy]
    per_set = entries.groupBy(F.col("failed").bitwiseAND(F.lit(in_force)).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(b).cast("long").alias("bit"))
                                for n, b in BIT.items() if b & in_force]))
    return (per_set.select("bits", "n", rules.alias("r")).groupBy("r.rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only")))


def keep_clean(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The rows of `docs` that the policy keeps, columns unchanged."""
    return ledger(docs).filter(verdict(policy)).select("doc.*")
