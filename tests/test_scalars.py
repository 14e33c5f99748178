"""to_int, slug and term-prefix rules."""

from pyspark.sql import functions as F

from valuescope.functions.scalars import shorten_term, shorten_term_col, slug, slug_text, to_int


def test_to_int_edges(spark):
    vals = ["12", " 12 ", "+7", "-3", "0012", "12.5", "1e3", "r-70049", "", None, "1_000",
            "99999999999", "2147483648", "٣"]
    expected = [12, 12, 7, -3, 12, 0, 0, 0, 0, 0, 0, 0, 0, 0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = [r["n"] for r in df.select("i", to_int(F.col("v")).alias("n")).orderBy("i").collect()]
    assert got == expected


def test_slug(spark):
    assert slug_text("dwc:catalogNumber") == "dwc_catalogNumber"
    assert slug_text("http://a.b/c__d") == "http_a_b_c_d"
    df = spark.createDataFrame([("a b--c_d",)], "s string")
    assert df.select(slug("s").alias("x")).first()["x"] == "a_b_c_d"


def test_namespace_prefixes(spark):
    assert shorten_term("http://ns.adobe.com/xap/1.0/rights/X") == "xmpRights:X"
    assert shorten_term("http://ns.adobe.com/xap/1.0/Y") == "xmp:Y"
    assert shorten_term("http://symbiota.org/terms/z") == "symbiotaz"
    assert shorten_term("urn:other") == "urn:other"
    assert shorten_term("http://example.org/terms/a/b", [("http://example.org/terms/", "ex:"),
                                                         ("http://example.org/terms/a/", "exa:")]) == "exa:b"
    df = spark.createDataFrame([("http://ns.adobe.com/xap/1.0/rights/X",), ("http://rs.tdwg.org/dwc/terms/genus",)],
                               "t string")
    assert [r[0] for r in df.select(shorten_term_col("t")).collect()] == ["xmpRights:X", "dwc:genus"]


def test_to_int_unicode_whitespace(spark):
    df = spark.createDataFrame([(" 12　",), ("\t-5\n",), ("1 2",)], "v string")
    assert [r[0] for r in df.select(to_int(F.col("v"))).collect()] == [12, -5, 0]


def test_to_int_64_bits(spark):
    df = spark.createDataFrame([("99999999999",), ("-9223372036854775808",), ("9223372036854775808",)], "v string")
    assert [r[0] for r in df.select(to_int(F.col("v"), bits=64)).collect()] == \
        [99999999999, -9223372036854775808, 0]
