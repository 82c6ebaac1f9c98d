"""Rows that operators must bear: nulls, empty and long texts, repeats, clashing columns."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["pos", "key", "h1", "runs", "words", "word", "found", "rank", "score", "label", "path", "leaf", "size", "hash", "n",
            "sketch", "base", "extra", "value", "parts", "made", "any", "ids", "held_out", "copy", "row_hash", "kind", "u", "v",
            "__score", "__doc", "__hash", "__rows", "__row", "__runs", "kept_0"]

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000)) + "\nThe Same Line.\n" + "z" * 50_000


def odd_rows():
    rows = [
        (1, None, "en", "a", None), (2, "", None, None, 0), (3, LONG, "en", "b", 1), (4, " \t\n\n \x0b", "en", "a", 5),
        (5, "one", "en", "a", 3), (5, "one", "en", "a", 3), (5, "another text with the same id", "en", "a", 3),
        (None, "a text without an id\nThe same line.", None, None, None), (None, None, None, None, None),
        (6, "Ünïcödé 中文 😀 \x1c　 text's end", "xx", "c", 1), (7, "\x00\x01� |$1\\", "en", "c", 1),
    ]
    rows += [(100 + i, f"  the SAME line.\nline of {i} only {i * 7919}\n\nlast\n", "en", f"s{i % 3}", 9) for i in range(12)]
    return rows


def odd_docs(spark):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    for c in CLASHING:
        docs = docs.withColumn(c, F.lit("clash"))
    return docs


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=repr)
