"""Column functions on hand-made edge frames."""

import math

from pyspark.sql import functions as F

from priceframe.functions import columns as C
from priceframe.schemas import GDP_BIN_EDGES, GDP_BIN_LABELS, NO_DATA_LABEL


def test_parse_thousands_edge_cells(spark):
    rows = [("1,083.28",), ("0",), ("",), (" 7 ",), ("nan",), ("None",), ("x",), (None,), ("1,234,567",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(C.parse_thousands("s")).collect()]
    assert got == [1083.28, 0.0, None, 7.0, None, None, None, None, 1234567.0]


def test_canonical_key(spark):
    df = spark.createDataFrame([("  usa ",), ("Viet Nam",)], "s string")
    up = [r[0] for r in df.select(C.canonical_key("s", "upper")).collect()]
    lo = [r[0] for r in df.select(C.canonical_key("s", "lower")).collect()]
    assert up == ["USA", "VIET NAM"] and lo == ["usa", "viet nam"]


def test_guarded_ratio_and_clamp(spark):
    df = spark.createDataFrame([(10.0, 2.0), (10.0, 0.0), (10.0, -1.0), (10.0, None), (None, 5.0)], "n double, d double")
    got = [r[0] for r in df.select(C.guarded_ratio("n", "d", 1e9)).collect()]
    assert got == [5e9, None, None, None, None]
    c = spark.createDataFrame([(0.2,), (5.0,), (None,)], "x double")
    assert [r[0] for r in c.select(C.clamp_min("x", 1.0)).collect()] == [1.0, 5.0, None]


def test_bin_label_boundaries(spark):
    df = spark.createDataFrame([(4999.99,), (5000.0,), (20000.0,), (None,), (float("nan"),), (-3.0,)], "x double")
    got = [r[0] for r in df.select(C.bin_label("x", GDP_BIN_EDGES, GDP_BIN_LABELS, NO_DATA_LABEL)).collect()]
    assert got == [GDP_BIN_LABELS[0], GDP_BIN_LABELS[1], GDP_BIN_LABELS[2], NO_DATA_LABEL, NO_DATA_LABEL,
                   GDP_BIN_LABELS[0]]


def test_valuation_class_boundary(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (-0.1,), (None,)], "x double")
    dash = [r[0] for r in df.select(C.valuation_class("x", True)).collect()]
    chart = [r[0] for r in df.select(C.valuation_class("x", False)).collect()]
    assert dash == ["Overvalued", "Overvalued", "Undervalued", None]
    assert chart == ["Undervalued", "Overvalued", "Undervalued", None]


def test_decade_pct_and_formats(spark):
    df = spark.createDataFrame([(1997, 0.1234, 2.5), (2000, -0.05, 1234.567)], "y int, r double, p double")
    rows = df.select(C.decade_label("y"), C.pct_round("r", 1), C.fmt_pct("r"), C.fmt_usd("p"),
                     C.hover_text(F.lit("A"), C.pct_round("r", 1), "p")).collect()
    assert rows[0][0] == "1990s" and rows[1][0] == "2000s"
    assert rows[0][1] == 12.3 and rows[1][1] == -5.0
    assert rows[0][2] == "+12.3%" and rows[1][2] == "-5.0%"
    assert rows[0][3] == "$2.50" and rows[1][3] == "$1234.57"
    assert rows[0][4] == "A<br>Valuation: +12.3%<br>Price: $2.50"


def test_round_scaled_matches_binary_rounding(spark):
    # 1.005 is stored just below 1.005: rounding the binary value gives 1.0, as SQL
    # engines do; Spark's round(x, 2) rounds the decimal text "1.005" up to 1.01.
    df = spark.createDataFrame([(1.005,), (-2.5,), (0.125,)], "x double")
    got = [r[0] for r in df.select(C.round_scaled("x", 2)).collect()]
    assert got[0] == 1.0 and got[2] == 0.13
    assert df.select(F.round("x", 2)).first()[0] == 1.01
    assert [r[0] for r in df.select(C.round_scaled("x", 0)).collect()][1] == -3.0
    assert not math.isnan(got[1])
