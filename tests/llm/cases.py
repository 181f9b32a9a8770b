"""Documents with every awkward case, and small helpers."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string, score string, slot string"


def words(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def awkward(seed=1, n=120):
    """Rows of documents with nulls, empty, short and long texts, copies, near
    copies, shared passages, repeated rows and columns whose names clash."""
    rng = random.Random(seed)
    en = ["the", "and", "thinking", "of", "house", "water", "nothing", "should", "with", "Other", "there"]
    de = ["der", "und", "nicht", "ich", "schön", "straße", "wasser", "über", "Haus", "zwischen", "lichkeit"]
    out = []
    passage = words(rng, 40, en)
    for i in range(n):
        v = rng.choice([en, de])
        text = words(rng, rng.choice([1, 3, 4, 5, 6, 30, 120]), v)
        if i % 7 == 0:
            text += "\n" + passage + ". " + words(rng, 20, v)
        out.append([i * 3, text, "en" if v is en else "de", rng.choice(["a", "b", "ä", None])])
    for k in range(15):                       # copies up to white space, near copies
        t = out[k][1]
        out.append([1000 + k, t.replace(" ", "  ") if k % 2 else t, out[k][2], "a"])
        w = out[40 + k][1].split(" ")
        w[len(w) // 2] = "changed"
        out.append([2000 + k, " ".join(w), out[40 + k][2], "b"])
    out += [[5000, None, "en", "a"], [5001, "", "en", "a"], [5002, " \t\n", None, "b"], [5003, "12 34 !!", "en", None],
            [None, "an id of null and some words to go with it", "en", "a"], [None, None, None, None],
            [5004, words(rng, 9000, en), "en", "a"], [5005, "x" * 5000, None, "b"],
            [5006, "日本語 テキスト é́ \x01 \x00 ß \xa0 x", "de", "ä"]]
    out += [list(out[5]), list(out[5]), list(out[0])]     # whole rows again
    return [tuple(r) + (len(r[1]) if r[1] is not None else None, "kept", "size", "score", "slot") for r in out]


def frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(df):
    return [tuple(r) for r in df.collect()]


def documents(spark, sf="/root/testdata/sf0.001"):
    return spark.read.parquet(f"{sf}/documents.parquet")


def normal(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")


__all__ = ["F", "awkward", "documents", "empty", "frame", "normal", "plain", "words"]
