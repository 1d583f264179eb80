"""Expressions against pandas and Python on many generated values."""

from __future__ import annotations

import io
import math
import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clearwell.functions import numbers, text
from clearwell.operators import columns as cols, rows as ops
from clearwell.sources import scan

RNG = random.Random(11)


def mixed_texts(alphabet: str, n: int = 3000, longest: int = 8) -> list[str]:
    return ["".join(RNG.choices(alphabet, k=RNG.randint(0, longest))) for _ in range(n)]


def evaluate(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in df.select("i", expression(F.col("v"))).orderBy("i").collect()]


def test_numbers_are_read_as_pandas_reads_them(spark):
    texts = mixed_texts("0123456789.eE+- xdDfF_,", 4000, 6)
    texts += ["1e400", "-1e400", "inf", "-Inf", "+infinity", "nan", "1.", ".5", ".", "", " 7 ", "\t8\n"]
    texts += ["1_000", "1,5", "0x1A", "1d", "2F", "1e", "e5", "--1", "+-1", "1 2", "00012", "1e-320"]
    # A zero with an exponent in the hundreds is an overflow to pandas and a zero here.
    texts = [t for t in texts if not re.fullmatch(r"\s*[+-]?[0.]+[eE][+-]?\d{3,}\s*", t)]
    expected = pd.to_numeric(pd.Series(texts, dtype=object), errors="coerce")
    got = evaluate(spark, texts, numbers.parse_double)
    # The parser of pandas may be off by a last digit.
    wrong = [
        (t, g, e)
        for t, g, e in zip(texts, got, expected)
        if not (math.isnan(e) if g is None else math.isclose(g, e, rel_tol=1e-15))
    ]
    assert wrong == []


def test_floats_round_as_numpy_rounds_them(spark):
    texts = [repr(RNG.uniform(-1e6, 1e6)) for _ in range(2000)] + [f"{RNG.uniform(0, 100):.2f}" for _ in range(2000)]
    expected = pd.to_numeric(pd.Series(texts)).astype("float32").astype("float64")
    got = evaluate(spark, texts, lambda c: numbers.float_or_zero(c).cast("double"))
    assert got == list(expected)


def test_whole_numbers_fill_as_pandas_fills_them(spark):
    texts = [RNG.choice(["", "x", "n/a", str(RNG.randint(-9999, 9999)), f"{RNG.randint(0, 9999)}.0"]) for _ in range(2000)]
    expected = pd.to_numeric(pd.Series(texts), errors="coerce").astype("Int64").fillna(0)
    assert evaluate(spark, texts, numbers.long_or_zero) == list(expected)


def test_strip_equals_python(spark):
    texts = mixed_texts("ab é \t\n\r\f\v\x1c\x1f\x85\xa0 　​")
    assert evaluate(spark, texts, text.strip_whitespace) == [t.strip() for t in texts]


def test_capitalize_equals_python(spark):
    texts = mixed_texts("aBc dÉ")
    assert evaluate(spark, texts, text.capitalize) == [t.strip().capitalize() for t in texts]


def test_snake_values_equal_snake_names(spark):
    texts = mixed_texts("aBC1_ -/(é", 3000, 14)
    assert evaluate(spark, texts, text.snake_text) == [text.snake_name(t) for t in texts]


@pytest.mark.parametrize("tokens", [["NA", "x", "", "NULL", "nan", "7", "None", "n/a", "N/A", "<NA>", "-", "none"]])
def test_missing_texts_equal_those_of_pandas(spark, tmp_path, tokens):
    body = "k,t\n" + "".join(f"{i},{t}\n" for i, t in enumerate(tokens))
    (tmp_path / "t.csv").write_text(body)
    expected = [None if isinstance(v, float) else v for v in pd.read_csv(io.StringIO(body), dtype={"t": object}).t]
    got = scan.read_csv_like_pandas(spark, str(tmp_path / "t.csv")).orderBy(F.col("k").cast("int")).collect()
    assert [r.t for r in got] == expected


def test_dedupe_equals_pandas(spark, rows):
    data = [(RNG.choice([None, 1, 2]), RNG.choice([None, "a", "b"]), RNG.choice([0.5, None])) for _ in range(200)]
    frame = pd.DataFrame(data, columns=["a", "b", "c"]).astype(object).drop_duplicates()
    df = spark.createDataFrame(data, "a int, b string, c double")
    counts = ops.duplicate_count(df).first()
    assert ops.dedupe(df).count() == len(frame) == counts.n_distinct
    assert counts.n_duplicates == len(data) - len(frame)


def test_null_columns_equal_those_of_pandas(spark):
    data = [(1, None, None, "x"), (2, None, 3.0, None)]
    df = spark.createDataFrame(data, "a int, b string, c double, d string")
    assert cols.drop_null_columns(df).columns == list(df.toPandas().dropna(axis="columns", how="all"))
