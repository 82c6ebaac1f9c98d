"""Language ID, Merkle manifest and vector codes against brute force and on odd rows."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from tremorlake.llm import language_id, merkle, vector_codes

from .odd import CLASHING, no_docs, odd_docs, odd_rows, rows_of

SF = "/root/testdata/sf0.01"


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


# --- language ID ---------------------------------------------------------------------------

def brute_languages(rows, longest=language_id.LONGEST):
    """(doc_id, language, score) of (doc_id, text, lang) rows by plain dictionaries, all learnable rows and entries learned."""
    word = regex.compile(r"\p{L}[\p{L}\p{M}]*")
    counts, sums = defaultdict(Counter), Counter()
    for doc_id, text, lang in rows:
        if doc_id is None or lang is None or text is None or crc(doc_id) % 4 == 2:
            continue
        for w in word.findall(text.lower()):
            padded = f" {w} "
            for n in range(longest + 1):
                for e in [w] if n == 0 else [padded[i:i + n] for i in range(len(padded) - n + 1)]:
                    counts[n, e][lang] += 1
                    sums[lang, n] += 1
    langs = sorted({lang for lang, _ in sums}, key=lambda x: (-sums[x, 0], x.encode()))

    def value(n, e, lang):
        many = counts[n, e][lang]
        return math.log10(many / sums[lang, n]) if many else -language_id.PENALTY

    out = []
    for doc_id, text, _ in rows:
        ws = word.findall((text or "").lower())
        if not ws or not langs:
            out.append((doc_id, "und", 0.0))
            continue
        total = dict.fromkeys(langs, 0.0)
        for w in ws:
            padded = f" {w} "
            for n in [0, *range(longest, 0, -1)]:
                found = [e for e in ([w] if n == 0 else [padded[i:i + n] for i in range(len(padded) - n + 1)]) if (n, e) in counts]
                if found:
                    break
            for lang in langs:
                total[lang] += sum(value(n, e, lang) for e in found) / len(found) if found else -language_id.PENALTY
        mean = {lang: t / len(ws) for lang, t in total.items()}
        best = max(langs, key=lambda x: mean[x])
        out.append((doc_id, best, 1 / sum(10 ** (m - mean[best]) for m in mean.values())))
    return out


def same_predictions(got, want):
    got, want = (sorted(x, key=lambda r: (repr(r[0]), r[1], round(r[2], 6))) for x in (got, want))
    assert [r[:2] for r in got] == [r[:2] for r in want]
    np.testing.assert_allclose([r[2] for r in got], [r[2] for r in want], rtol=1e-9)


def test_language_equals_brute_force(spark):
    texts = {"en": "the cat and the dog were there", "de": "der Hund und die Katze waren dort", "fr": "le chien et la chatte étaient là"}
    rng = np.random.default_rng(3)
    rows = []
    for i in range(120):
        lang = list(texts)[i % 3]
        words = texts[lang].split()
        made = " ".join(w[:rng.integers(1, len(w) + 1)] + "xyz"[:rng.integers(0, 3)] for w in rng.choice(words, rng.integers(0, 12)))
        rows.append((i, made.upper() if i % 5 == 0 else made, None if i % 11 == 0 else lang))
    rows += [(None, "the cat", "en"), (500, None, "de"), (501, "1234 -- !!", "fr"), (502, "中文", None), (502, "中文", None), (503, "e" * 300 + " " + "ß" * 200, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = rows_of(language_id.classify(docs.repartition(5)), "doc_id", "lang_pred", "score", "held_out")
    same_predictions([r[:3] for r in got], brute_languages(rows))
    assert all(r[3] == (r[0] is not None and crc(r[0]) % 4 == 2) for r in got)


def test_language_on_odd_rows(spark):
    got = rows_of(language_id.classify(odd_docs(spark)), "doc_id", "lang_pred", "score")
    want = brute_languages([(r[0], r[1], r[2]) for r in odd_rows()])
    same_predictions(got, want)
    by_text = Counter(r[1] for r in got)
    assert by_text["und"] == sum(not regex.search(r"\p{L}", r[1] or "") for r in odd_rows())


def test_language_without_rows_or_learned_languages(spark):
    assert language_id.classify(no_docs(spark)).collect() == []
    none = spark.createDataFrame([(1, "the cat", None), (2, None, None)], "doc_id long, text string, lang string")
    assert rows_of(language_id.classify(none), "doc_id", "lang_pred", "score") == [(1, "und", 0.0), (2, "und", 0.0)]


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_id.classify(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").filter("lang is not null and lang_pred <> 'und'")
    right, many = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert many > 150 and right / many > 0.97


def test_language_never_reads_held_out_rows_nor_more_than_its_bounds(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    other = docs.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang"))).withColumn("text", F.when(held, "qqq www").otherwise(F.col("text")))
    a, b = language_id.fit(docs, rows=20), language_id.fit(other, rows=20)
    assert a.languages == b.languages and a.places == b.places and np.array_equal(a.value, b.value)
    assert {r["lang"]: r["count"] for r in language_id.sample(docs, rows=7).groupBy("lang").count().collect()} == dict.fromkeys(a.languages, 7)
    small = language_id.fit(docs, rows=20, entries=2400)
    assert len(small.value) <= 2400 and all(len(p) <= 2400 // 6 for p in small.places)
    hot = docs.withColumn("doc_id", F.when(~held, F.lit(1)).otherwise(F.col("doc_id"))).withColumn("lang", F.lit("en"))
    assert language_id.sample(hot, rows=5).count() == 5


def test_language_of_a_cache_that_fills_up(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    model = language_id.fit(docs)
    texts = [r["text"] for r in docs.collect()] + ["z" * 5000, None, "the " * 9]
    whole = language_id.Scorer(model)
    small = language_id.Scorer(model)
    small.rows = 50
    a = [(lang, s) for langs, score in whole.predict(iter(texts)) for lang, s in zip(langs, score, strict=True)]
    b = [next(zip(*out, strict=True)) for t in texts for out in small.predict(iter([t]))]
    assert [x[0] for x in a] == [x[0] for x in b]
    np.testing.assert_allclose([x[1] for x in a], [x[1] for x in b], rtol=1e-9)
    assert all(len(w) <= language_id.LONG_WORD for w in whole.row)


# --- Merkle manifest -------------------------------------------------------------------------

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_tree(digests, fan=3):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + fan]) for i in range(0, len(levels[-1]), fan)])
    return levels


def plain_path(levels, i, digest, fan=3):
    """(siblings' text, digest at the top with ``digest`` in place i)."""
    siblings = ""
    for level in levels[:-1]:
        at = i - i % fan
        run = level[at:at + fan]
        siblings += "".join(run[:i - at] + run[i - at + 1:])
        run[i - at] = digest
        digest, i = h(*run), i // fan
    return siblings, digest


def plain_manifest(rows):
    by_source = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        changed = text.replace("\n", "") if text is not None and doc_id is not None and crc(doc_id) % 2 == 0 else text
        leaf, other = (h(*map(field, (doc_id, source, lang, n_chars, t))) for t in (text, changed))
        by_source[source].append((doc_id is not None, doc_id or 0, leaf, other, doc_id))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([r[2] for r in sorted(by_source[s])]) for s in sources}
    top = plain_tree([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, (_, _, leaf, other, doc_id) in enumerate(sorted(by_source[s])):
            low, sub = plain_path(trees[s], i, other)
            high, root = plain_path(top, k, sub)
            out.append((doc_id, leaf, trees[s][-1][0], top[-1][0], h(low + high), root, root == top[-1][0]))
    return sorted(out, key=repr)


def some_rows(n, sources):
    return [(i * 7, f"text {i}\nmore" if i % 3 else None if i % 2 else f"no line {i}", "en", sources[i * i % len(sources)], i) for i in range(n)]


@pytest.mark.parametrize("levels,n,sources", [(1, 61, ["a", "b", None, "é", "a"]), (2, 100, ["hot"]), (2, 40, [f"s{i}" for i in range(40)]),
                                              (1, 9, ["x"]), (1, 28, ["x", "y"]), (7, 90, ["a", None]), (3, 1, ["only"]), (2, 82, ["h", "h", "h", "z"])])
def test_manifest_equals_plain_trees(spark, levels, n, sources):
    rows = some_rows(n, sources)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4, "doc_id")
    got = merkle.manifest(docs, levels=levels)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert rows_of(got) == plain_manifest(rows)


def test_manifest_on_odd_rows(spark):
    got = rows_of(merkle.manifest(odd_docs(spark)))
    assert got == plain_manifest(odd_rows())
    assert {r[6] for r in got} == {True, False}
    assert merkle.manifest(no_docs(spark)).collect() == []


def test_a_parent_resumes_the_state_of_its_slot():
    digests = [h(str(i)) for i in range(3)]
    for many in (1, 2, 3):
        parent = merkle.Parent(digests[:many])
        assert parent.digest == h(*digests[:many]) and len(parent.states) == many
        for slot in range(many):
            new = h("new")
            assert parent.fold(slot, new) == h(*digests[:slot], new, *digests[slot + 1:many])
            assert parent.fold(slot, digests[slot]) == parent.digest


def test_positions_of_a_hot_key(spark):
    rows = [(("hot" if i % 5 else f"k{i}") if i % 7 else None, i * 37 % 1000) for i in range(1000)]
    got = merkle.positions(spark.createDataFrame(rows, "key string, at long").repartition(6), "key", ["at"], ["key", "at"]).collect()
    numbers, want = {}, defaultdict(list)
    for r in rows:
        want[r[0]].append(r[1])
    for r in got:
        numbers.setdefault(r["key"], r["tree"])
        assert numbers[r["key"]] == r["tree"] and sorted(want[r["key"]])[r["idx"]] == r["at"]
    order = sorted(want, key=lambda k: (k is not None, k or ""))
    assert sorted(order, key=lambda k: numbers[k]) == order and len(set(numbers.values())) == len(order)
    assert sorted((r["key"] or "", r["idx"]) for r in got) == sorted((k or "", i) for k, v in want.items() for i in range(len(v)))


# --- vector codes ------------------------------------------------------------------------------

def plain_codes(rows, parts=8, entries=16, rounds=6):
    """rows of (vec_id, vector of floats, label) -> expected rows, in plain integers."""
    good = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not good:
        return []
    dim = max(1, -(-max(len(r[1]) for r in good) // parts))
    ints = [[math.floor(4096 * float(x)) for x in r[1]] + [0] * (dim * parts - len(r[1])) for r in good]
    first = sorted(range(len(good)), key=lambda i: (good[i][0] is None, good[i][0] or 0, list(good[i][1])))[:entries]
    books = [[ints[i][p * dim:(p + 1) * dim] for i in first] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            served = defaultdict(list)
            for v in ints:
                x = v[p * dim:(p + 1) * dim]
                served[near(p, x)[1]].append(x)
            books[p] = [[sum(c) // len(c) for c in zip(*served[k], strict=True)] if k in served else e for k, e in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded, by_label = [], Counter()
    for r, v in zip(good, ints, strict=True):
        found = [near(p, v[p * dim:(p + 1) * dim]) for p in range(parts)]
        coded.append((r[0], "".join(f"{k:02x}" for _, k in found), sum(g for g, _ in found), r[2]))
        by_label[r[2]] += coded[-1][2]
    return sorted([(a, b, c, by_label[d], sha) for a, b, c, d in coded], key=repr)


SCHEMA = "vec_id long, embedding array<float>, label int"


def test_codes_equal_brute_force_on_odd_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 16).astype(np.float32)], [None, 1, 2, 2][i % 4]) for i in range(90)]
    rows += [(3, rows[3][1], 7), (3, rows[3][1], 7), (None, rows[4][1], None), (200, [0.5] * 11, 1), (201, [], 1), (202, None, 1),
             (203, [0.1, None], 1), (204, [float("nan")] * 16, 1), (205, [float("inf")] * 16, 1), (206, [-0.00001] * 16, 1), (-4, [0.25] * 16, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in CLASHING:
        if c != "label":
            df = df.withColumn(c, F.lit("clash"))
    assert rows_of(vector_codes.compress(df.repartition(5))) == plain_codes(rows)


def test_codes_of_few_or_no_rows(spark):
    rows = [(i, [float(i), -float(i), 0.5], None) for i in range(5)]
    assert rows_of(vector_codes.compress(spark.createDataFrame(rows, SCHEMA))) == plain_codes(rows)
    assert vector_codes.compress(spark.createDataFrame([], SCHEMA)).collect() == []
    assert vector_codes.compress(spark.createDataFrame([(1, None, 1)], SCHEMA)).collect() == []


def test_search_finds_the_nearest_of_lowest_index_and_spares_distances():
    rng = np.random.default_rng(1)
    for dim, spread in ((1, 3), (8, 2), (8, 700)):
        entries = rng.integers(-spread, spread + 1, (16, dim))
        entries[9] = entries[4]
        parts = rng.integers(-spread, spread + 1, (500, dim))
        index, best, _ = vector_codes.nearest(parts, entries)
        square = np.square(parts[:, None] - entries[None]).sum(2)
        np.testing.assert_array_equal(index, square.argmin(1))
        np.testing.assert_array_equal(best, square.min(1))
    # Entries on a line are parted by their sums alone.
    line = np.arange(16)[:, None] * 100 * np.ones((1, 8), np.int64)
    index, _, computed = vector_codes.nearest(line[rng.integers(0, 16, 1000)].astype(np.int64) + rng.integers(-9, 10, (1000, 8)), line.astype(np.int64))
    assert computed < 2000


def test_an_equal_bound_is_still_looked_at():
    # Sum gap 2, dimension 1: the bound equals the best distance, and the lower index lies behind it.
    index, best, _ = vector_codes.nearest(np.array([[0]]), np.array([[2], [-2]]))
    assert (index[0], best[0]) == (0, 4)
    index, best, _ = vector_codes.nearest(np.array([[0]]), np.array([[-2], [2]]))
    assert (index[0], best[0]) == (0, 4)


def test_components_beyond_64_bits_are_an_error():
    limit = vector_codes.largest_component(64)
    assert limit >= 1 << 27
    ok = pa.array([[limit / 4096] * 64], pa.list_(pa.float64()))
    x = vector_codes.integers(ok, 64)
    assert vector_codes.nearest(x.reshape(8, 8), -x.reshape(8, 8)[:1])[1][0] == 8 * (2 * limit) ** 2
    with pytest.raises(ValueError, match="64 bits"):
        vector_codes.integers(pa.array([[limit / 2048] * 64], pa.list_(pa.float64())), 64)
