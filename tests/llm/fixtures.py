import re

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

ODD_TEXTS = [
    (5, "Hello world, it's  a test.\n\nNew line \t tab"),
    (5, "Hello world, it's  a test.\n\nNew line \t tab"),
    (5, "another text with the same id"),
    (None, "no id"),
    (None, None),
    (1, None),
    (2, ""),
    (3, " "),
    (4, "a<|endoftext|>b <|endoftext|> c"),
    (6, "é中文 ñandú 😀 ﬁ ½ ▁x 　 y\x1c z"),
    (7, "word " * 4000),
    (8, "x" * 3000),
    (9, "  leading and trailing  "),
    (10, "1234 5678 e=mc² don't we'll"),
    (-3, "negative id"),
]


def odd_docs(spark):
    """Texts with every oddity, and columns that other tables know."""
    rows = [(i, t, "label", 1.5, "piece") for i, t in ODD_TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, row double, piece string")


def texts_of(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
