from pyspark.sql import functions as F

from refpanel import functions as fn
from refpanel.functions.sequence import translate_frame, windows


def one(spark, expr_of, value):
    return spark.createDataFrame([(value,)], "v string").select(expr_of("v").alias("x")).first().x


def test_string_functions(spark):
    assert one(spark, fn.revcomp, "AACGTNacg") == "cgtNACGTT"
    assert one(spark, lambda c: fn.kmers(c, 3), "äbcde") == ["äbc", "bcd", "cde"]
    assert one(spark, lambda c: fn.kmers(c, 3), "a\U0001f600bc") == ["a\U0001f600b", "\U0001f600bc"]
    assert one(spark, lambda c: fn.kmers(c, 3), "ab") == []
    assert one(spark, lambda c: windows(c, 4, 3), "abcdefghij") == ["abcd", "defg", "ghij"]
    assert one(spark, fn.genus_of, "Bacillus_subtilis") == "Bacillus" and one(spark, fn.genus_of, "") == "unknown"
    assert one(spark, fn.header_accession, "a|b|c") == "b" and one(spark, fn.header_accession, "abc") == "abc"
    assert one(spark, fn.extra_id, "bin__LOC_12 x") == "LOC_12" and one(spark, fn.extra_id, "first word") == "first"
    assert one(spark, fn.orf_to_read, "a_b/2_1_22_3") == "a_b/2" and one(spark, fn.orf_to_read, "a_1_2_3") == "a_1_2_3"
    assert one(spark, fn.residues, "") == []


def test_translation(spark):
    assert one(spark, lambda c: translate_frame(c, 1), "ATGTTTTAAGGN") == "MF*X"
    assert one(spark, lambda c: translate_frame(c, 2), "AATGTGGtt") == "MW"


def test_score_bucket_is_monotone(spark):
    df = spark.range(-5000, 5000).select((F.col("id") / 7.3).alias("s")).withColumn("b", fn.score_bucket(F.col("s")))
    got = [r.b for r in df.orderBy("s").collect()]
    assert got == sorted(got)
