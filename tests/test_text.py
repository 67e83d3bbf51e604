"""Diacritic folding: by rule, composed and decomposed alike."""
from pyspark.sql import functions as F

from threadlake.functions.text import tokenize
from threadlake.plans.snippet import snippet_text


def _tokens(spark, text):
    return spark.createDataFrame([(text,)], "text string").select(tokenize(F.col("text"))).first()[0]


def test_fold_beyond_latin(spark):
    assert _tokens(spark, "Tiếng VIỆT ΆΈ Ёлка ṩ") == ["tieng", "viet", "αε", "елка", "s"]


def test_combining_marks_do_not_split(spark):
    assert _tokens(spark, "cafe\u0301s x\u030cy") == ["cafes", "xy"]


def test_letters_without_decomposition_stay(spark):
    assert _tokens(spark, "straße ÆØ") == ["straße", "æø"]


def test_snippet_marks_decomposed_word():
    assert snippet_text("two cafe\u0301s here", [("caf\u00e9s", False)]) == "two >>>caf\u00e9s<<< here"  # snippets are NFC
