"""A small table with every awkward case, with extra columns named like helper columns."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, n_lines long, size long, rep string"
LONG = "word " * 60_000
ROWS = [
    (1, None, None, None, None, 9, 9, 9, "x"),
    (2, "", "en", "s1", 0, 9, 9, 9, None),
    (3, "   \n\t \n", "en", "s1", 7, 9, 9, 9, "x"),
    (4, "one two three four five six seven", "en", "s1", 33, 9, 9, 9, "x"),
    (5, "one two three four five six seven", "en", "s2", 33, 9, 9, 9, "x"),
    (5, "one two three four five six seven", "en", "s2", 33, 9, 9, 9, "x"),
    (6, "short", None, "s2", 5, 9, 9, 9, "x"),
    (7, LONG, "en", "s2", len(LONG), 9, 9, 9, "x"),
    (8, "é日😀 word\r\nword", "fr", "s3", 14, 9, 9, 9, "x"),
    (None, "one two three four five six seven", "en", "s3", 33, None, None, None, None),
]


def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
