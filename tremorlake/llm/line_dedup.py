"""Line dedup: lines that many documents share are dropped everywhere.

A line's key is the line stripped of ASCII white space at both ends, with A-Z
lower-cased.  Keys travel as 128-bit hashes, never as text:

1. Every line becomes (hash, document, position), range-partitioned by hash and
   document and sorted by position.  A hash that a third of all lines share is
   spread over many ranges, since the document is part of the range key.
2. The sorted stream yields each document's first occurrence of a hash.  Those
   are counted per hash, with a partial count in every range.
3. Occurrences of frequent hashes (broadcast once counted and small, else joined
   with skewed partitions split) are gathered per document as run lengths: the
   compressed keep bitmap.  Only the bitmaps meet the texts again.

Defined results: a null or empty text is one empty line.  Empty keys are never
dropped.  Rows with the same doc_id and text count as one document and each get
the same bitmap; the same doc_id with other texts counts per text.  A null
doc_id is a value like any other.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremorlake.llm.common import ascii_lower, join_rows, keyed, ready, shielding, splittable
from tremorlake.session import broadcast_checked

#: White space that is stripped from a line's ends.
STRIPPED = " \t\n\x0b\x0c\r"
MIN_DOCS = 10
MIN_CHARS = 1


def line_occurrences(rows: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, doc_id, row_hash, pos) of every line whose key has min_chars code points."""
    keys = F.transform(F.split(ascii_lower(F.col("text")), "\n", -1), lambda x: F.btrim(x, F.lit(STRIPPED)))
    lines = rows.select("doc_id", "row_hash", F.posexplode(keys).alias("pos", "key"))
    return lines.filter(F.length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "row_hash", "pos")


def keep_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per document that loses lines: doc_id, row_hash, n_dropped and the dropped runs.

    ``runs`` is the keep bitmap by run length: array of (first, last) line
    numbers, from 0 and inclusive, of the lines that go; all others stay.
    """
    at = ["h1", "h2", "doc_id", "row_hash"]
    ready(docs.sparkSession)
    # Checkpointed, since two plans read it: lines are split and hashed for the ranges' sample and once more.
    placed = (line_occurrences(keyed(docs), min_chars)
              .repartitionByRange(*at).sortWithinPartitions(*at, "pos").checkpoint())
    first = placed.withColumn("nth", F.row_number().over(Window.partitionBy(*at).orderBy("pos"))).filter("nth = 1")
    frequent = first.groupBy("h1", "h2").count().filter(F.col("count") >= min_docs).select("h1", "h2")
    gone = placed.join(broadcast_checked(splittable(frequent)), ["h1", "h2"], "left_semi")
    per_doc = gone.groupBy("doc_id", "row_hash").agg(F.sort_array(F.collect_set("pos")).alias("p"))
    return per_doc.select("doc_id", "row_hash", F.size("p").cast("long").alias("n_dropped"), _runs(F.col("p")).alias("runs"))


def _runs(p: Column) -> Column:
    """Sorted positions -> array of (first, last) of consecutive ones."""
    before = F.concat(F.array(F.lit(-2)), p)
    after = F.concat(F.slice(p, F.lit(2), F.greatest(F.size(p), F.lit(1))), F.array(F.lit(2**31 - 1)))
    firsts = F.filter(F.zip_with(p, F.slice(before, F.lit(1), F.size(p)), lambda a, b: F.when(a - b > 1, a)), lambda x: x.isNotNull())
    lasts = F.filter(F.zip_with(p, after, lambda a, b: F.when(b - a > 1, a)), lambda x: x.isNotNull())
    return F.zip_with(firsts, lasts, lambda a, b: F.struct(a.alias("first"), b.alias("last")))


def apply_bitmap(text: Column, runs: Column) -> Column:
    """The text without the lines of ``runs``; null runs keep the whole text."""
    before = F.concat(F.array(F.lit(-1)), F.transform(runs, lambda r: r["last"]))
    flags = F.flatten(F.zip_with(runs, F.slice(before, F.lit(1), F.size(runs)), lambda r, b: F.concat(
        F.array_repeat(F.lit(True), r["first"] - b - 1), F.array_repeat(F.lit(False), r["last"] - r["first"] + 1))))
    lines = F.arrays_zip(F.split(text, "\n", -1).alias("line"), flags.alias("keep"))
    kept = F.filter(lines, lambda x: F.coalesce(x["keep"], F.lit(True)))
    return F.when(runs.isNull(), text).otherwise(F.array_join(F.transform(kept, lambda x: x["line"]), "\n"))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, runs and the kept text."""
    both = join_rows(keyed(docs), keep_bitmaps(docs, min_docs, min_chars))
    return both.select("doc_id", F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
                       F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
                       "runs", apply_bitmap(F.col("text"), F.col("runs")).alias("kept"))


@shielding
def dedup_documents(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents with all their columns, their texts without frequent lines.

    n_chars, where there is such a column, follows the text.  Unlike the report,
    a null text stays null.
    """
    maps = keep_bitmaps(docs, min_docs, min_chars).select(
        F.col("doc_id").alias("__doc"), F.col("row_hash").alias("__hash"), F.col("runs").alias("__runs"))
    both = docs.join(maps, docs["doc_id"].cast("long").eqNullSafe(maps["__doc"])
                     & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == maps["__hash"]), "left")
    text = apply_bitmap(F.col("text"), F.col("__runs"))
    columns = {"text": text} | ({"n_chars": F.when(F.col("__runs").isNull(), F.col("n_chars")).otherwise(
        F.length(text)).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return both.select(*[columns[c].alias(c) if c in columns else docs[c] for c in docs.columns])
