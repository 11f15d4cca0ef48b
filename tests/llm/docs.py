"""Small document tables with the awkward rows every operator must take."""

import random

AWKWARD = [
    (0, "alpha beta gamma delta epsilon zeta", "en", "b"),
    (1, "alpha  beta\tgamma\ndelta epsilon zeta ", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "a"),
    (4, " \t\n\x0b\f\r", "en", "a"),
    (5, "one", "en", None),
    (6, "one", "en", "b"),
    (7, "é ü ñ 😀 x y", "fr", "ü"),
    (8, "word " * 6000, "en", "b"),
    (8, "word " * 6000, "en", "b"),
    (None, "a row without id", None, "a"),
    (10, "x" * 5000 + "y", "en", "b"),
    (11, "x" * 5000 + "z", "en", "b"),
    (12, "x" * 5000 + "y", "en", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


def awkward(spark, rows=AWKWARD, extra=""):
    df = spark.createDataFrame(rows, SCHEMA)
    for c in extra.split():
        df = df.selectExpr("*", f"1 AS {c}")
    return df.repartition(3)


def random_docs(n, seed=0, sources=4, words=60):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(300)]
    return [(i, " ".join(r.choice(vocab) for _ in range(r.randint(1, words))), "en",
             f"s{r.randrange(sources)}") for i in range(n)]
