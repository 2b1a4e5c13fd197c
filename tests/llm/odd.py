"""Rows that every operator has to stand: nulls, empties, ties, repeats, long texts and extra
columns whose names the operators use themselves."""

import random

WORDS = "the of and rain river stone house light over under green winter paper moon glass letter".split()


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", "", ",", ".", "er", "ing"]) for _ in range(n))


def documents(spark, texts=None, empty: bool = False):
    texts = texts or [
        None, "", " \t\n ", "one", "ÀÉ ñ 日本 ▁ \u0000 <|im_end|>", prose(1, 80), prose(1, 80), prose(2, 30000), "12345 ###", prose(3, 60),
    ]
    rows = [(i, t, "en" if i % 2 else None, None if i == 3 else "src", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, prose(4, 50), None, None, None), (None, None, None, None, None)] if len(rows) > 5 else []
    df = spark.createDataFrame([] if empty else rows, "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F

    names = ["key", "k", "h", "t", "y", "fp", "n", "span", "score", "row", "letter", "root", "count", "component_id", "held_out", "open"]
    return df.withColumns({c: F.lit("clash") for c in names})


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
