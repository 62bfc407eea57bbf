"""Small tables for the operators' tests."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, extra=False):
    """Documents 0, 1, ... with the texts; ``extra`` adds columns whose names clash with inner ones."""
    rows = [(k, t, "en", "s", None if t is None else len(t)) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr("*", "doc_id AS fp", "text AS ids", "1 AS key", "'x' AS n_tokens", "'y' AS word") if extra else df


#: Null, empty, blank, short, odd and long texts, and a repeated one.
EDGES = [None, "", " \n\t ", "a", "a", "Ünïcode — ½ 日本 😀\x00\x1c", "<|endoftext|> <|im_start|>", "word " * 30_000, "x" * 20_000]
