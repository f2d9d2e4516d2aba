"""Small tables with the rows that break things, and columns named like the operators' own."""

SF = "/root/testdata/sf0.001"
CLASHES = ("text_", "ids", "spans", "_text", "label", "node", "rank", "shard", "query", "content", "page", "_spans", "row", "_a")
LONG = "wort und andere worte " * 20_000
TEXTS = [
    (1, "the cat sat on the mat and looked at the dog"),
    (1, "the cat sat on the mat and looked at the dog"),
    (2, "the cat sat on the mat and looked at the dog"),
    (3, None),
    (None, "no id but some words of its own in here"),
    (None, None),
    (4, ""),
    (5, " \n\t "),
    (6, LONG),
    (7, "1234 5678 !!! \U0001f600"),
    (8, "a"),
]


def documents(spark, rows=TEXTS):
    """The rows as a documents table with further columns."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)
    rows = [(i, t, "en" if t else None, None, None if t is None else len(t), *["x"] * len(CLASHES)) for i, t in rows]
    return spark.createDataFrame(rows, schema)


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")
