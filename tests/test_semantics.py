"""Edge rows of the comparison rules and mapping rules."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from recordferry.functions import rules as R
from recordferry.functions import text as X


def column(rows, kind, values, expression):
    df = rows(f"i int, c {kind}", *[(i, v) for i, v in enumerate(values)])
    return [r[0] for r in df.orderBy("i").select(expression(F.col("c"))).collect()]


def test_integer_key(rows):
    got = column(rows, "string", [None, "", "0", "00", " 12 ", "12A", "12.5", "99999999999"], X.positive_key)
    assert got == [None, None, None, None, 12, None, None, None]


def test_digits(rows):
    texts = ["AB-0123", "12 34", "A/9", "ABC", None]
    assert column(rows, "string", texts, X.digits_number) == [123, 1234, None, None, None]
    assert column(rows, "string", texts, X.digits_text) == ["0123", "1234", "/9", "", None]
    assert column(rows, "string", ["1" * 40], lambda c: X.digits_text(c, 30)) == ["1" * 30]


def test_term_years(rows):
    got = column(rows, "int", [None, 0, 5, 11, 12, 23, 24, 371, 372, 600, 1188], R.term_years)
    assert got == [None, 0, None, None, 1, 1, 2, 30, None, 50, 99]


def test_term_years_over_the_whole_range(rows):
    got = column(rows, "int", list(range(12, 372)), R.term_years)
    assert got == [m // 12 for m in range(12, 372)]


def test_flags(rows):
    assert column(rows, "int", [None, 0, 6], R.extension_flag) == [1, 0, 1]
    assert column(rows, "int", [None, 0, 6], R.extension_unit) == [None, None, "Months"]
    assert column(rows, "double", [None, 0.0, 40.0], R.area_missing_flag) == [-1, 0, 0]


def test_code_maps(rows):
    assert column(rows, "int", [1, 60, 102, 7, None], R.state_code) == [48, 1, 53, None, None]
    assert column(rows, "int", [0, 6, 13, 14, None], R.instrument_code) == ["OGL", "OGL", "RD", None, None]
    assert column(rows, "int", [0, 3, 255, 4, None], R.depth_type) == ["All", "DeeperThan", "No Data", None, None]


def test_file_extension(rows):
    names = [None, "a.PDF", "b.tif.pdf", "c.pdf.tif", "d.jpg", "e.doc", "f.TIF"]
    assert column(rows, "string", names, R.file_extension) == [None, ".pdf", ".pdf", ".pdf", ".jpg", None, ".tif"]


def test_storage_uri(rows):
    assert column(rows, "string", ["s3://b/k", "b/k"], R.storage_uri) == ["s3://b/k", "s3://b/k"]


@pytest.mark.parametrize("mode, last", [("reference", None), ("intended", "B1")])
def test_range_or_block(rows, mode, last):
    df = rows("i int, r double, d string, b string", (0, 5.7, "E", "B1"), (1, None, "E", "B1"), (2, None, None, "B1"))
    got = df.orderBy("i").select(R.range_or_block(F.col("r"), F.col("d"), F.col("b"), mode)).collect()
    assert [r[0] for r in got] == ["5E", "E", last]


def test_text_compares_without_case_and_trailing_blanks(rows):
    df = rows("a string, b string", ("Grantor", "grantor  "), ("a", " a"))
    assert [r[0] for r in df.select(X.fold(F.col("a")) == X.fold(F.col("b"))).collect()] == [True, False]


def test_blank_and_word_nulls(rows):
    assert column(rows, "string", [None, "", "  ", "x "], X.blank_to_null) == [None, None, None, "x "]
    assert column(rows, "string", ["NULL", "null ", "nullx", None], lambda c: X.word_to_null(c, "null")) == \
        [None, None, "nullx", None]


def test_concat_counts_null_as_empty(rows):
    assert column(rows, "string", [None, "a"], lambda c: X.concat_nulls_empty(c, F.lit("b"))) == ["b", "ab"]


def test_path_parts(rows):
    paths = ["a/b.tif.pdf", "a.b/c", ".hidden", "x/.hidden", "a.", None]
    assert column(rows, "string", paths, X.path_extension) == [".pdf", "", "", "", ".", None]
    assert column(rows, "string", ["s3://b/k/x", "k/x", "s3://b/s3://b/k"], lambda c: X.strip_prefix(c, "s3://b/")) == \
        ["k/x", "k/x", "s3://b/k"]


def test_excluded_words(rows):
    texts = ["ALL of it", "parallel", "see remarks", "lot 5", None]
    words = ("ALL", "REMARKS")
    assert column(rows, "string", texts, lambda c: X.contains_word(c, words)) == [True, True, True, False, None]
    assert column(rows, "string", texts, lambda c: X.contains_word(c, words, True)) == [True, False, True, False, None]


def test_shift_and_day(rows):
    df = rows("t string", ("2025-06-30 13:29:59",), ("2025-06-30 13:30:00",)).select(
        F.col("t").cast("timestamp_ntz").alias("t"))
    late = X.shifted(F.col("t"), 630) >= F.lit("2025-07-01").cast("timestamp_ntz")
    assert [r[0] for r in df.select(late).collect()] == [False, True]
    assert [r[0] for r in df.select(X.on_day(F.col("t"), "2025-06-30")).collect()] == [True, True]
    assert [r[0] for r in df.select(X.on_day(F.col("t"), "2025-07-01")).collect()] == [False, False]


def test_royalty_rounds_and_overflow_is_null(rows):
    got = column(rows, "decimal(9,6)", [Decimal("0.123450"), Decimal("0.123449"), Decimal("12.5")],
                 lambda c: c.try_cast("decimal(5,4)"))
    assert got == [Decimal("0.1235"), Decimal("0.1234"), None]


def test_millis_text(rows):
    df = rows("t string", ("2025-07-01 01:02:03.456789",)).select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert df.select(X.millis_text(F.col("t"))).first()[0] == "2025-07-01 01:02:03.456"


def test_stable_id_repeats_and_separates(rows):
    df = rows("a string, b string", ("x", None), ("x", None), (None, "x"))
    ids = [r[0] for r in df.select(X.stable_id(F.col("a"), F.col("b"))).collect()]
    assert ids[0] == ids[1] != ids[2]
