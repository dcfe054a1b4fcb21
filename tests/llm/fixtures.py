"""Small documents with every awkward case, shared by the tests of the subpackage."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6))) for _ in range(n)) + "."


def awkward(spark):
    """Null columns, empty and blank texts, a very long one, ties, repeated rows, odd spacing,
    and extra columns whose names operators use inside."""
    base = prose(1, 120)
    rows = [
        (1, base, "en", "a", 1), (2, base, None, "a", 2), (2, base, None, "a", 2), (3, None, "en", None, None), (4, "", None, "b", 0),
        (5, " \n\t ", "en", "b", 4), (6, prose(2, 40), "de", None, 5), (None, prose(3, 30), "en", "c", 6), (7, prose(4, 30000), "en", "a", 7),
        (8, "one two three", "en", "c", 8), (9, "one\ttwo  three", "en", "c", 9), (10, prose(5, 60) + "\n" + base + "\n" + prose(6, 30), "en", "b", 10),
        (11, " ".join(["same"] * 50), "en", "d", 11), (12, "é ü 漢字  x y 😀 " + prose(7, 15), "en", "d", 12),
        (13, prose(8, 200), "en", "a", 13), (14, prose(8, 200).replace(prose(8, 200).split()[100], "zzz", 1), "en", "b", 14), (-15, prose(9, 25), "en", "a", 15),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("size", "taken", "mix", "id", "h", "key", "place", "rules", "bucket", "rec", "shard", "slot", "bin", "part", "repeats", "cuts", "v", "class_id", "_mix", "n"):
        df = df.withColumn(c, F.lit(f"extra {c}"))
    return df


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple((x is None, x) for x in t))
