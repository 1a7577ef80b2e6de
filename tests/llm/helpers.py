"""Shared inputs: documents with nulls, blanks, repeats, ties, long texts and extra columns whose names operators use inside."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, key string, digest string, tokens string, size string, place string, component string, owner string"
WORDS = "the of and with thing nation hered other ration stand inge mention only there which ingly ably thereof".split()


def frame(spark, texts, first=0):
    rows = [(i + first if t != "NULL-ID" else None, t, "en", "s", len(t or ""), *["x"] * 8) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def edge_texts():
    draw = random.Random(7)
    long = " ".join(draw.choice(WORDS) + str(draw.randint(0, 999)) for _ in range(9000))
    return [None, "", " \n\t", "a", "A  a", "same text of five or six words", "Same text of five or six words", "same text of five or six words", "same  text of five or six words ", "x" * 5000, long, long + " end", "é ñ ü ß　日本語 😀 ½", "<|endoftext|> a<|startoftext|>b", "NULL-ID"]


def collect(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]
