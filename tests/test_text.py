from pyspark.sql import functions as F

from parlance.functions import text


def test_strip_is_that_of_unicode_blanks(spark):
    blanks = text.BLANK_CHARACTERS
    texts = ["", " ", blanks, blanks + "a" + blanks, "a" + blanks + "b", "​a​", "　好 的 ", "é ", "\U0001f600\x1c", None, " x" * 50_000 + " "]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    rows = df.select("i", text.strip(F.col("t")).alias("s"), text.is_blank(F.col("t")).alias("b"), text.blank_to_null(F.col("t")).alias("n")).collect()
    for r in rows:
        t = texts[r.i]
        assert r.s == (None if t is None else t.strip()) and r.b == (None if t is None else not t.strip()) and r.n == ((t or "").strip() or None)
