import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from assaykit.functions.labels import range_label, sex_code
from assaykit.functions.numbers import (
    finite_or_null,
    is_numeric_text,
    not_convertible,
    to_double,
)
from assaykit.functions.text import is_blank, item_filename, strict_utf8, strip_whitespace
from conftest import rows

NUMERIC = ["12", "-12", "+12.5", ".5", "5.", "1e3", "-1.2E-3", " 12 ", "\t7\n", "0012"]
OTHER = ["阳性", "NaN", "Infinity", "1d", "1f", "0x10", ".", "1 2", "1e", "--1", "１２", "　3"]
BLANK = ["", "  "]


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def test_numeric_text(spark):
    v = F.col("v")
    df = texts(spark, NUMERIC + OTHER + BLANK + ["\t", "1e400", None]).select(
        "v",
        is_blank(v).alias("blank"),
        is_numeric_text(v).alias("numeric"),
        not_convertible(v, nullable=False).alias("bad"),
        not_convertible(v, nullable=True).alias("bad_nullable"),
    )
    for row in df.collect():
        if row.v is None:
            assert (row.blank, row.numeric, row.bad, row.bad_nullable) == (None, None, True, False)
            continue
        numeric = row.v in NUMERIC or row.v == "1e400"
        assert row.numeric is numeric, row.v
        assert row.blank is (row.v in BLANK), row.v
        assert row.bad is row.bad_nullable is (not numeric), row.v


def test_to_double(spark):
    v = F.col("v")
    good = texts(spark, NUMERIC).select(to_double(v, T.StringType(), "v", False))
    assert [r[0] for r in good.collect()] == [12, -12, 12.5, 0.5, 5, 1000, -0.0012, 12, 7, 12]
    assert rows(texts(spark, [None]).select(to_double(v, T.StringType(), "v", True))) == [(None,)]
    for bad in OTHER + BLANK + ["\t", "1e400", "-1e999"]:
        with pytest.raises(PySparkException, match="finite double"):
            texts(spark, [bad]).select(to_double(v, T.StringType(), "v", True)).collect()
    with pytest.raises(PySparkException, match="must not be NULL"):
        texts(spark, [None]).select(to_double(v, T.StringType(), "v", False)).collect()
    numbers = spark.createDataFrame([(1,), (None,)], "v int")
    assert rows(numbers.select(to_double(v, T.IntegerType(), "v", True))) == [(1.0,), (None,)]


def test_finite(spark):
    values = [1.5, float("nan"), float("inf"), float("-inf"), None, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(finite_or_null(F.col("v")))
    assert [r[0] for r in df.collect()] == [1.5, None, None, None, None, 0.0]


LABELS = [
    (5, 1, 9, 0), (1, 1, 9, 0), (9, 1, 9, 0), (0.5, 1, 9, 1), (9.5, 1, 9, 1), (5, 9, 1, 1),
    (None, 1, 9, None), (5, None, 9, None), (5, 1, None, None), (float("nan"), 1, 9, 1),
]


def test_range_label(spark):
    data = [tuple(None if v is None else float(v) for v in row[:3]) for row in LABELS]
    df = spark.createDataFrame(data, "r double, lo double, hi double")
    out = df.select(range_label(F.col("r"), F.col("lo"), F.col("hi")).alias("label"))
    assert [r.label for r in out.collect()] == [row[3] for row in LABELS]
    assert out.dtypes == [("label", "tinyint")]


def test_sex_code(spark):
    spelled = {"男": "MAN", " 男 ": "MAN", "MAN": "MAN", "女": "WOMAN", "WOMAN": "WOMAN",
               "x": "UNK", "": "UNK", None: "UNK", "man": "UNK", "\t男": "UNK"}
    df = texts(spark, spelled).select("v", sex_code(F.col("v")).alias("code"))
    assert dict(rows(df)) == spelled


def test_filename(spark):
    df = spark.createDataFrame([("a/b\\c\0d", "2/1")], "n string, c string")
    assert df.select(item_filename(F.col("n"), F.col("c"))).first()[0] == "a_b_c_d__2_1.parquet"


def test_strict_utf8(spark):
    df = spark.createDataFrame([(b"\xe4\xb8\xad",), (None,), (b"",)], "v binary")
    assert [r[0] for r in df.select(strict_utf8(F.col("v"))).collect()] == ["中", None, ""]
    for bad in (b"\xff", b"\xc0\x80", b"\xed\xa0\x80", b"a\xe4\xb8"):
        with pytest.raises(PySparkException):
            spark.createDataFrame([(bad,)], "v binary").select(strict_utf8(F.col("v"))).collect()


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=6), min_size=20, max_size=60))
def test_strip_equals_python(spark, values):
    padded = values + [f" 　\x1c\x85{v}\xa0\t\n" for v in values]
    got = [r[0] for r in texts(spark, padded).select(strip_whitespace(F.col("v"))).collect()]
    assert got == [v.strip() for v in padded]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.binary(max_size=6), min_size=10, max_size=40))
def test_validity_equals_python(spark, values):
    def valid(b):
        try:
            b.decode("utf-8")
            return True
        except UnicodeDecodeError:
            return False

    df = spark.createDataFrame([(b,) for b in values], "v binary")
    got = [r[0] for r in df.select(F.is_valid_utf8(F.col("v").cast("string"))).collect()]
    assert got == [valid(b) for b in values]
