"""Small tables with every odd case, and the words of a text as the operators define them."""

import re

from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(9000))
PASSAGE = " ".join(f"p{i}" for i in range(70))
BLANKS = " \t\n\r\x0b\x0c"
DOCUMENTS = [
    (1, f"Alpha beta. {PASSAGE} tail one"), (2, f"other start {PASSAGE} and another end"), (3, None), (4, ""), (5, BLANKS),
    (6, "one"), (7, "ONE"), (8, "a b c d e f g"), (9, "A B c d e f g"), (9, "A B c d e f g"), (10, LONG), (11, LONG + " more"),
    (None, PASSAGE), (None, None), (12, PASSAGE + " " + PASSAGE), (13, "naïve café 漢字 ½ 🙂 don't stop it's 12,345 <|endoftext|> end"),
    (14, "\n".join(["same line here"] * 30)), (15, LONG),
]
CLASHES = ("copy", "start", "words", "row", "kept", "part", "halo", "size", "of", "cluster", "band", "ids", "score", "rank", "text2", "host")


def documents(spark, rows=DOCUMENTS):
    """The rows with a source, and columns that the operators use names of."""
    df = spark.createDataFrame([(d, t, ["x", None, "é", "x"][i % 4]) for i, (d, t) in enumerate(rows)],
                               "doc_id long, text string, source string").repartition(3)
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)
