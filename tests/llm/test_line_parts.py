from pyspark.sql import functions as F

from marginwatch.llm.line_dedup import _TRIMMED


def test_lines_are_trimmed_as_btrim_does(spark):
    texts = ["", " ", "\t\r ", "a", " a", "a ", "\ta b\r", " a", "a ", " \t é \r", "a\n", None, "\ra\tb", "b  \t"]
    rows = spark.createDataFrame([(t,) for t in texts], "line string")
    bad = rows.where(F.expr(f"not ({_TRIMMED} <=> btrim(line, ' \\t\\r'))")).collect()
    assert bad == []
