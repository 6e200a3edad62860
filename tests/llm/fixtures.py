"""Small odd tables that every operator must handle."""

LONG = "long word " * 4000
ROWS = [
    (1, "one two three four five six seven\neight nine ten", "en", "a", 0),
    (2, None, "en", None, None),
    (3, "", None, "a", 0),
    (4, "  \n\t ", "fr", "b", 3),
    (5, LONG, "en", "b", len(LONG)),
    (6, "one two three four five six seven\neight nine ten", "en", "c", 0),
    (6, "one two three four five six seven\neight nine ten", "en", "c", 0),
    (None, "no id here, but words all the same", None, None, None),
    (7, "short", "de", "a", 5),
    (8, "été 中文 \U0001f600 naïve", "fr", "a", 12),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHING = ["piece", "bucket", "rank", "block", "tail", "h", "part", "start", "size", "n", "key", "words", "chunk", "score", "features", "id", "t", "d", "k", "x", "y", "s", "z", "u", "v", "__d", "__t", "row", "doc", "hash", "lane", "item", "items", "fp", "words2", "a.b", "cell", "kind"]


def odd(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for c in CLASHING:
        df = df.selectExpr("*", f"'x' AS `{c}`")  # "a.b" must be quoted by whoever names it
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
