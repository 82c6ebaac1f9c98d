"""Secret scan: base patterns in every text, set apart by who owns each value in the whole corpus.

Base kinds are found leftmost and non-overlapping per kind:

* assign: a name such as ``token``, then ``=`` or ``:``, then a value of 8+ characters
* access: ``AKIA`` and capital letters or digits, 16+ characters
* hex: 32+ lower-case hexadecimal digits

The method then hashes every candidate value and counts, over all documents, in
how many repositories (documents) and by how many owners (``source``) it stands.
Values of more than MAX_OWNERS owners are widely copied examples; the others
look live.  Further long mixed tokens count as secrets (kind ``token``) only if
they are owner-specific and overlap no base span.

Counting is in two steps, first per value and owner and then per value, so a
value that a third of all documents share stays spread.

Defined results: null or empty texts have no secrets.  Rows with the same doc_id
and text each give their own equal row; a null source is one unknown owner.  An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorlake.llm.common import join_rows, keyed, ready, splittable

#: The base patterns and the least lengths of their values.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 8, 16, 32
#: Long runs with at least one digit and one letter are further candidates.
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
TOKEN_MIN_DIGITS = 4
MAX_OWNERS = 1
KINDS = ["assign", "access", "hex", "token"]

_SPANS = "array<struct<start:int,kind:int,stop:int,value:string>>"


def _spans(text: Column, pattern: str, kind: int, value, ok) -> Column:
    """(start, kind, stop, value) of the matches whose value passes; places in code points.

    Splitting at the matches gives what stands between them; running sums of both lengths are the places.
    """
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))
    none = F.array().cast(_SPANS)

    def step(acc, part):
        start = acc["at"] + F.length(part["gap"])
        stop = start + F.length(part["hit"])
        found = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), stop.alias("stop"), value(part["hit"]).alias("value")))
        return F.struct(F.coalesce(stop, start).alias("at"),
                        F.when(part["hit"].isNotNull() & ok(part["hit"]), F.concat(acc["out"], found.cast(_SPANS))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])


def candidates(docs: DataFrame, owner: str = "source") -> DataFrame:
    """(doc_id, row_hash, owner, base, extra) of every row: span arrays, in text order within a kind."""
    text = F.col("text")
    whole = lambda m: m
    digits = lambda m: F.length(F.regexp_replace(m, "[^0-9]", "")) >= TOKEN_MIN_DIGITS
    base = F.concat(
        _spans(text, ASSIGN, 0, lambda m: F.regexp_extract(m, ASSIGN, 2), lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= ASSIGN_MIN),
        _spans(text, ACCESS, 1, whole, lambda m: F.length(m) >= ACCESS_MIN),
        _spans(text, HEX, 2, whole, lambda m: F.length(m) >= HEX_MIN))
    extra = _spans(text, TOKEN, 3, whole, lambda m: digits(m) & m.rlike("[A-Za-z]"))
    return keyed(docs, owner).select("doc_id", "row_hash", F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
                                     F.sort_array(base).alias("base"), extra.alias("extra"))


def ownership(values: DataFrame) -> DataFrame:
    """(v1, v2, n_owners, n_repos) of every value hash over all of (v1, v2, owner, doc_id, row_hash)."""
    repos = values.groupBy("v1", "v2", "owner", "doc_id", "row_hash").agg(F.lit(1).alias("one"))
    per_owner = repos.groupBy("v1", "v2", "owner").agg(F.count(F.lit(1)).alias("n"))
    return per_owner.groupBy("v1", "v2").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_repos"))


def scan(docs: DataFrame, owner: str = "source", max_owners: int = MAX_OWNERS) -> DataFrame:
    """One row per document: doc_id, the base spans, all spans with their verdict.

    ``found`` holds (start, kind, stop, live, n_owners, n_repos) by start and kind;
    kind counts in KINDS.
    """
    ready(docs.sparkSession)
    rows = candidates(docs, owner).checkpoint()
    inside = F.transform("base", lambda b: F.struct(b["start"].alias("s"), b["stop"].alias("e")))
    free = F.filter("extra", lambda x: ~F.exists(inside, lambda b: (x["start"] < b["e"]) & (b["s"] < x["stop"])))
    spans = rows.select("doc_id", "row_hash", "owner", F.explode(F.concat("base", free)).alias("x")).select(
        "doc_id", "row_hash", "owner", F.col("x.start").alias("start"), F.col("x.kind").alias("kind"), F.col("x.stop").alias("stop"),
        F.xxhash64("x.value").alias("v1"), F.xxhash64(F.lit(1), "x.value").alias("v2"))
    judged = spans.join(splittable(ownership(spans)), ["v1", "v2"]).withColumn("live", F.col("n_owners") <= max_owners)
    kept = judged.filter((F.col("kind") < KINDS.index("token")) | F.col("live"))
    per_doc = kept.groupBy("doc_id", "row_hash").agg(F.sort_array(F.collect_set(
        F.struct("start", "kind", "stop", "live", "n_owners", "n_repos"))).alias("found"))
    return join_rows(rows, per_doc).select(
        "doc_id", "base", F.coalesce("found", F.array().cast(per_doc.schema["found"].dataType)).alias("found"))


def digest(found: DataFrame) -> DataFrame:
    """The scan as counts, a hash of the base spans and all spans as text."""
    name = lambda k: F.element_at(F.array(*[F.lit(x) for x in KINDS]), k + 1)
    written = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x["kind"]), x["start"], x["stop"])), ",")
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(written("base"), 256).alias("base_sha256"), written("found").alias("spans"),
        F.size(F.filter("found", lambda x: x["live"])).cast("long").alias("n_live"),
        F.size(F.filter("found", lambda x: ~x["live"])).cast("long").alias("n_copied"))
