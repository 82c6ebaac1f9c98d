"""Byte-level BPE, n-gram join, decontamination, classifiers and top-k against brute force and on odd rows."""

import collections
import hashlib
import math
import random
import re
import struct
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from tremorlake.llm import byte_bpe, decontaminate, exact_topk, graph, ngram_join, quality, text_arrays, toxicity
from tremorlake.llm.queries import BPE_RANKS

from .odd import no_docs, odd_docs, odd_rows, rows_of

PATH = public_tokenizers.path(BPE_RANKS)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def table_of(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS)


# --- words ------------------------------------------------------------------------------

def test_words_are_those_of_the_pattern():
    texts = [r[1] or "" for r in odd_rows()]
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0] + [len(d) for d in data])
    w = text_arrays.words(np.frombuffer(b"".join(data), np.uint8), offsets)
    got = [[] for _ in texts]
    for h, s, e, d in zip(w.hash, w.start, w.stop, w.doc, strict=True):
        got[d].append((b"".join(data)[s:e].decode(), int(h)))
    for t, g in zip(texts, got, strict=True):
        assert [x.translate(LOWER) for x, _ in g] == WORD.findall(t.translate(LOWER))
    same = collections.defaultdict(set)
    for g in got:
        for x, h in g:
            same[x.translate(LOWER)].add(h)
    assert all(len(v) == 1 for v in same.values()) and len({min(v) for v in same.values()}) == len(same)
    buffer = np.frombuffer(b"".join(data), np.uint8)
    for limit in (1, 7, 1000):  # blocks of any size give the same words
        for a, b in zip(w, text_arrays.words(buffer, offsets, limit=limit), strict=True):
            np.testing.assert_array_equal(a, b)


# --- BPE --------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.Vocabulary(byte_bpe.read_ranks(byte_bpe.vocabulary_bytes(PATH)), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference_encoding(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


PARTS = ["a", "b", "'s", " ", "  ", "\n", "\t", "é", "中", "😀", "1", "12", "!", "\x1c", "　", "'re", "xxxx", "\xa0", "İ", "the ", "thing", "'"]


def test_bpe_appends_and_edits_are_exact(vocabulary, reference_encoding):
    rng = random.Random(5)
    some = lambda n: "".join(rng.choice(PARTS) for _ in range(rng.randint(0, n)))
    for _ in range(400):
        editor = byte_bpe.Editor(vocabulary, some(25))
        for _ in range(4):
            if rng.random() < 0.5:
                editor.append(some(3))
            else:
                a = rng.randint(0, len(editor.text))
                editor.replace(a, min(len(editor.text), a + rng.randint(0, 4)), some(3))
            assert editor.ids() == reference_encoding.encode_ordinary(editor.text) == vocabulary.encode(editor.text)


def test_bpe_prefix_table_is_the_encoding_of_every_prefix(vocabulary):
    data, last = "unbelievablyüber".encode(), [-1]
    vocabulary.extend(data, last)
    for n in range(1, len(data) + 1):
        assert [vocabulary.token[i] for i in vocabulary.walk_back(last[:n + 1])] == vocabulary.merged(data[:n])


def test_bpe_caches_are_bounded_in_bytes(vocabulary, reference_encoding, monkeypatch):
    rng = random.Random(9)
    packed = byte_bpe._Packed(vocabulary)
    han = ["".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(2000)) for _ in range(50)]  # without blanks: one chunk each
    for text in han:
        assert list(struct.unpack(f"<{len(packed[text]) // 4}I", packed[text])) == reference_encoding.encode_ordinary(text)
    assert len(packed) == 0 and packed.held == 0 and all(len(p) <= byte_bpe.CACHED_CHARS for p in packed.pieces)
    monkeypatch.setattr(byte_bpe, "CACHE_BYTES", 20_000)
    for i in range(2000):
        text = f" w{i * 7919}"
        assert list(struct.unpack(f"<{len(packed[text]) // 4}I", packed[text])) == reference_encoding.encode_ordinary(text)
        for cache in (packed, packed.pieces):
            held = sum(sys.getsizeof(k) + sys.getsizeof(v) + byte_bpe.ENTRY_BYTES for k, v in cache.items())
            assert cache.held == held <= 20_000


def test_bpe_on_odd_rows(spark, reference_encoding):
    got = byte_bpe.encode_documents(odd_docs(spark), PATH, public_tokenizers.PATTERN)
    want = []
    for d, t, *_ in odd_rows():
        ids = reference_encoding.encode_ordinary(t or "")
        want.append((d, struct.pack(f"<{len(ids)}I", *ids), (t or "").encode()))
    plain = [(r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in got.collect()]
    assert sorted(plain, key=repr) == sorted(want, key=repr)
    assert byte_bpe.encode_documents(no_docs(spark), PATH, public_tokenizers.PATTERN).collect() == []


# --- n-gram join ------------------------------------------------------------------------

def run_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def classes(rows, threshold=0.8):
    by = collections.defaultdict(list)
    for d, t, *_ in rows:
        if run_set(t):
            by[run_set(t)].append(d)
    sets, root = list(by), {}
    links = collections.Counter()
    near = collections.defaultdict(set)
    for i, a in enumerate(sets):
        for b in sets[:i]:
            if len(a & b) >= threshold * len(a | b):
                links[a] += 1
                links[b] += 1
                near[a].add(b)
                near[b].add(a)
    for s in sets:
        if s not in root:
            todo, seen = [s], {s}
            while todo:
                for x in near[todo.pop()] - seen:
                    seen.add(x)
                    todo.append(x)
            for x in seen:
                root[x] = min((d for y in seen for d in by[y] if d is not None), default=None)
    return {(d, t): (root[run_set(t)], links[run_set(t)], len(by[run_set(t)])) for d, t, *_ in rows if run_set(t)}


def variants(seed, words, copies, changes, name):
    rng = random.Random(seed)
    base = [f"{name}{rng.randint(0, 400)}" for _ in range(words)]
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randint(0, changes)):
            w[rng.randrange(len(w))] = f"{name}n{rng.randint(0, 10**6)}"
        out.append(" ".join(w))
    return out


def near_rows():
    texts = variants(1, 120, 60, 3, "a") + variants(2, 40, 10, 1, "b") + variants(3, 300, 8, 4, "c") + variants(4, 25, 5, 6, "d") + ["plain copy of five words"] * 7
    return odd_rows() + [(1000 + i, t, "en", "s", 1) for i, t in enumerate(texts)]


@pytest.mark.parametrize("limits", [{}, {"small": 8, "levels": 4, "block": 8, "runs": 24}])
def test_ngram_join_finds_all_links(spark, limits):
    rows = near_rows()
    docs = spark.createDataFrame(rows, DOCS).withColumn("path", F.lit(1)).withColumn("leaf", F.lit(1)).withColumn("s1", F.lit("x"))
    texts = {(r["doc_id"], r["row_hash"]): r["text"] for r in docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("row_hash"), "text").collect()}
    got = ngram_join.join(docs, **limits).collect()
    want = classes(rows)
    assert len(got) == len(rows)
    for r in got:
        text = texts[r["doc_id"], r["row_hash"]]
        if not run_set(text):
            assert (r["n_links"], r["n_copies"]) == (0, 1) and r["class_id"] in (r["doc_id"], r["row_hash"])
            continue
        class_id, links, copies = want[r["doc_id"], text]
        assert (r["n_links"], r["n_copies"]) == (links, copies)
        assert r["class_id"] == class_id or class_id is None


def test_chosen_paths_reach_the_target_recall(spark):
    """Pairs at the threshold share a leaf after as many splits as there may be, for the runs that the target asks for."""
    rng = np.random.default_rng(31)
    pairs = 4000
    left = rng.integers(0, 1 << 32, (pairs, ngram_join.COORDINATES), dtype=np.uint32)
    equal = rng.random(left.shape) < ngram_join.THRESHOLD
    right = np.where(equal, left, rng.integers(0, 1 << 32, left.shape, dtype=np.uint32))
    rows = [(i, side, bytearray(v[i].tobytes())) for i in range(pairs) for side, v in enumerate((left, right))]
    sets = spark.createDataFrame(rows, "s1 long, s2 long, sketch binary").checkpoint()
    found = {}
    for levels in (1, 3, 5):
        # Buckets of two are split again, so a pair meets only if it stays together through all levels.
        met = ngram_join.leaves(sets, ngram_join.runs_for(), small=1, levels=levels).groupBy("s1", "leaf").count().filter("count > 1")
        found[levels] = met.select("s1").distinct().count() / pairs
    assert found[1] == 1.0 and found[3] >= 0.999 and found[5] >= 0.996
    assert ngram_join.runs_for(0.9) < ngram_join.runs_for() < ngram_join.runs_for(similarity=0.7)
    assert ngram_join.least_equal(0.8) == 39 and ngram_join.least_equal(0.5) == 16


def test_keep_one_of_each_class(spark):
    rows = near_rows()
    docs = spark.createDataFrame(rows, DOCS).withColumn("k", F.lit(0))
    got = ngram_join.keep_one(docs)
    want = classes(rows)
    kept = rows_of(got, "doc_id", "text")
    assert got.columns == docs.columns
    assert {d for d, t in kept if run_set(t) and d is not None} == {c for c, *_ in want.values() if c is not None}
    assert {(d, t) for d, t in kept if not run_set(t)} == {(r[0], r[1]) for r in rows if not run_set(r[1])}


def test_keep_one_tells_classes_of_one_doc_id_apart(spark):
    near = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    rows = [(5, "one"), (5, "one"), (5, "another text with the same id"), (5, ""), (5, ""), (5, "..."), (None, "no id"), (None, "no id"), (None, None),
            (7, near), (8, near + " end"), (9, "one"), (7, "a clean text beside the near copies"), (7, "a clean text beside the near copies")]
    docs = spark.createDataFrame([(d, t, "en", "s", i) for i, (d, t) in enumerate(rows)], DOCS)
    want = collections.Counter([(5, "one"), (5, "another text with the same id"), (5, ""), (5, "..."), (None, "no id"), (None, None), (7, near),
                                (7, "a clean text beside the near copies")])
    assert collections.Counter((r["doc_id"], r["text"]) for r in ngram_join.keep_one(docs).collect()) == want
    joined = ngram_join.join(docs).collect()
    assert len(joined) == len(rows) and len({r["class_key"] for r in joined}) == len(want)


def test_keep_one_keeps_rows_of_each_class_once(spark):
    rows = near_rows()
    got = ngram_join.keep_one(spark.createDataFrame(rows, DOCS)).collect()
    known = collections.Counter((r["doc_id"], r["text"]) for r in got)
    assert set(known.values()) == {1}
    apart = [(5, "one"), (5, "another text with the same id"), (None, "a text without an id\nThe same line.")]
    assert all(known[x] == 1 for x in apart)


def test_ngram_join_no_rows(spark):
    assert ngram_join.join(no_docs(spark)).collect() == []


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7), (5000, 4000)]
    random.Random(1).shuffle(edges)
    got = dict(graph.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(50)} | {5000: 4000, 4000: 4000}


# --- decontamination --------------------------------------------------------------------

def word_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_decontamination_against_brute_force(spark):
    rng = random.Random(2)
    vocabulary = [f"v{i}" for i in range(300)] + ["the", "of", "and"] * 40
    items = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in [3, 4, 7, 8, 9, 14, 20, 30, 45, 59] * 3]
    texts = []
    for k in range(240):
        w = items[k % len(items)].split()
        for _ in range(rng.randint(0, int(0.25 * len(w)))):
            at, kind = rng.randrange(len(w)), rng.random()
            if kind < 0.4:
                w[at] = rng.choice(vocabulary)
            elif kind < 0.7:
                w.insert(at, rng.choice(vocabulary))
            elif len(w) > 1:
                del w[at]
        texts.append(" ".join(rng.choices(vocabulary, k=rng.randint(0, 60)) + w + rng.choices(vocabulary, k=rng.randint(0, 60))))
    texts += [" ".join(rng.choices(vocabulary, k=80)) for _ in range(60)]
    docs = spark.createDataFrame(odd_rows() + [(2000 + i, t.upper() if i % 5 == 0 else t, "en", "s", 1) for i, t in enumerate(texts)], DOCS).withColumn("item_id", F.lit(1))
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)] + [(None, "v1 v2 v3", "x"), (99, None, "x"), (98, "", "x")], "item_id long, text string, doc_id string")
    want = set()
    for d, t in enumerate(texts):
        w = t.split()
        for i, item in enumerate(items):
            n = len(item.split())
            if n < decontaminate.EXACT_BELOW:
                if f" {item} " in f" {t} ":
                    want.add((2000 + d, i))
            elif word_distance(item.split(), w) <= int(0.2 * n):
                want.add((2000 + d, i))
    for words in (decontaminate.BLOCK_WORDS, 400):  # one block, and several
        got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench, block_words=words).collect()}
        assert got == want
    clean = decontaminate.keep_clean(docs, bench)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in docs.collect()} - {d for d, _ in want}
    assert decontaminate.contaminated(no_docs(spark), bench).collect() == []
    assert decontaminate.contaminated(docs, bench.limit(0)).collect() == []


def edited_texts(items, edits, rng, spread=None):
    """(words, offsets) of a text for each item, with that many edits: anywhere, "even" (as far apart as they go) or none ("exact")."""
    texts = []
    for item in items:
        w = item.split()
        at = np.linspace(0, len(w) - 1, edits + 2)[1:-1].astype(int) if spread == "even" else rng.choice(len(w), edits, replace=False)
        for p in sorted(at.tolist(), reverse=True) if spread != "exact" else []:
            kind = rng.integers(3)
            w[p:p + 1] = [["new"], [w[p], "new"], []][kind]
        texts.append(" ".join(["before"] * 3 + w + ["after"] * 3).encode())
    offsets = np.cumsum([0] + [len(t) for t in texts])
    return text_arrays.words(np.frombuffer(b"".join(texts), np.uint8), offsets), offsets


@pytest.mark.parametrize("n", [5, 6, 7, 8, 9, 10, 12, 15, 19, 20, 24, 25, 30, 45, 59])
def test_decontamination_finds_every_length_at_the_full_edit_bound(n):
    rng = np.random.default_rng(n)
    edits, trials = int(0.2 * n), 60
    items = [" ".join(f"i{k}x{j}" for j in range(n)) for k in range(trials)] + [" ".join(["same", "word"] * n)[:5 * n - 1]]
    index = decontaminate.index_items(list(enumerate(items)))
    for spread in (None, "even", "exact"):
        w, offsets = edited_texts(items, edits, rng, spread)
        got = {(d, t) for d, t, *_ in decontaminate.find(w, offsets, index)}
        assert got == {(k, k) for k in range(len(items))}, spread


@pytest.mark.parametrize("n", [5, 6, 7, 8, 9, 10, 11, 12, 14, 15, 16, 19, 20, 24, 25, 29, 30, 40, 59])
def test_walks_alone_reach_their_recall(n):
    rng = np.random.default_rng(100 + n)
    items = [" ".join(f"i{k}x{j}" for j in range(n)) for k in range(300)]
    index = decontaminate.index_items(list(enumerate(items)))._replace(parts={}, short={})
    w, offsets = edited_texts(items, int(0.2 * n), rng)
    got = {(d, t) for d, t, *_ in decontaminate.find(w, offsets, index)}
    assert got <= {(k, k) for k in range(300)} and len(got) >= 0.9 * 300


def test_walks_meet_again_after_an_edit():
    rng = np.random.default_rng(1)
    word = rng.integers(1, 1 << 62, 40, dtype=np.uint64)
    longer = np.insert(word, 20, np.uint64(5))
    pad = np.zeros(decontaminate.STEPS + 1, np.uint64)
    equal = sum(np.isin(*(decontaminate.walk_keys(np.concatenate([w, pad]), len(w), r)[0] for w in (word, longer))).sum() for r in range(4))
    assert equal >= 4 * 40 * 0.6
    distance = decontaminate.edit_distance_within(word, longer)
    assert distance == (1, 0, 41)


# --- classifiers ------------------------------------------------------------------------

def labelled(spark, n=700):
    rng = random.Random(4)
    common = [f"{a}{b}" for a in ("th", "er", "on", "le", "sh", "an") for b in ("in", "ou", "at", "es", "al", "ing")]
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(common) for _ in range(rng.randint(20, 80))]
        junk, toxic = rng.random() < 0.3, rng.random() < 0.25
        if toxic:
            for bad in rng.sample(["idiot", "scum", "moron", "trash"], 2):
                w.insert(rng.randrange(len(w)), bad)
        text = " ".join(x.upper() + "!!" for x in w) if junk else " ".join(w)
        rows.append((i, text, "en", "s", 1))
        labels.append((i, int(not junk), int(toxic)))
    labels += [(None, 1, 1), (3, None, None), (10**9, 0, 1)]
    return spark.createDataFrame(rows + odd_rows()[3:8], DOCS).withColumn("quality", F.lit(5)).withColumn("label", F.lit("z")), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("module,name,folds,held,most", [(quality, "quality", 5, 0, 0.3), (toxicity, "toxic", 3, 1, 0.7)])
def test_classifier_on_held_out_rows(spark, module, name, folds, held, most):
    docs, labels = labelled(spark)
    got = module.classify(docs, labels).collect()
    assert len(got) == docs.count()
    truth = {r["doc_id"]: r[name] for r in labels.collect() if r[name] is not None and r["doc_id"] is not None and r["doc_id"] < 700}
    right = []
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= most)
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == held)
            if r["held_out"] and r["doc_id"] in truth and len([x for x in got if x["doc_id"] == r["doc_id"]]) == 1:
                right.append(r["predicted"] == truth[r["doc_id"]])
    assert len(right) > 80 and np.mean(right) > 0.95


@pytest.mark.parametrize("module,name,folds,held", [(quality, "quality", 5, 0), (toxicity, "toxic", 3, 1)])
def test_classifier_never_reads_held_out_labels(spark, module, name, folds, held):
    docs, labels = labelled(spark, 150)
    held_out = F.crc32(F.col("doc_id").cast("string")) % folds == held
    turned = labels.withColumn(name, F.when(held_out, 1 - F.col(name)).otherwise(F.col(name)))
    assert rows_of(module.classify(docs, labels), "doc_id", "score") == rows_of(module.classify(docs, turned), "doc_id", "score")


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifier_without_labels_or_rows(spark, module):
    docs, labels = labelled(spark, 20)
    none = labels.limit(0)
    scores = {r["score"] for r in module.classify(docs, none).collect()}
    assert scores == {0.5} if module is quality else max(scores) < 1e-12
    assert module.classify(no_docs(spark), labels).collect() == []
    got = module.classify(odd_docs(spark), none)
    assert got.count() == len(odd_rows())


def test_marginals_are_those_of_all_taggings():
    rng = np.random.default_rng(3)
    doc = np.repeat([0, 1, 3], [5, 1, 4])
    emission, factor, start = np.exp(rng.normal(size=10)), np.exp(rng.normal(size=(2, 2))), 1.7
    _, _, p = toxicity.forward_backward(emission, doc, factor, start)
    for d in (0, 1, 3):
        at = np.flatnonzero(doc == d)
        total, hot = 0.0, np.zeros(len(at))
        for tags in np.ndindex(*[2] * len(at)):
            weight = start if tags[0] else 1.0
            weight *= math.prod(emission[i] for i, t in zip(at, tags, strict=True) if t)
            weight *= math.prod(factor[a, b] for a, b in zip(tags, tags[1:], strict=False))
            total += weight
            hot += weight * np.array(tags)
        np.testing.assert_allclose(p[at], hot / total, rtol=1e-9)


def test_toxic_spans_are_code_points(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels)
    text = "thin 中文 idiot erou, scum\nanat"
    row = toxicity.tag(table_of(spark, [text]), model).first()
    assert [text[s["start"]:s["stop"]] for s in row["spans"]] == ["idiot", "scum"]


# --- top k ------------------------------------------------------------------------------

def test_top_k_against_brute_force(spark):
    rng = random.Random(6)
    rows = [(i, [rng.choice([-1.0, 0.25, 0.5, 0.123]) for _ in range(6)]) for i in range(130)]
    rows += [(200, None), (220, [1.0, None]), (240, [float("nan")] * 6), (260, [float("inf")] * 6), (None, [1.0] * 6), (280, []), (300, [1.0]), (300, [1.0]), (20, [0.5] * 6), (41, [0.5] * 6)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).withColumn("rank", F.lit(1))
    good = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q in sorted({i for i, _ in good if i % 20 == 0}):
        mine = min(v for i, v in good if i == q)
        scored = sorted((-sum(a * b for a, b in zip(mine, v, strict=False)), i) for i, v in good if i != q)[:20]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    for blocks in ((1024, 4096), (3, 7)):
        exact_topk.QUERY_BLOCK, exact_topk.ROW_BLOCK = blocks
        try:
            assert rows_of(exact_topk.top_k(table)) == sorted(want, key=repr)
        finally:
            exact_topk.QUERY_BLOCK, exact_topk.ROW_BLOCK = 1024, 4096
    assert exact_topk.top_k(table.limit(0)).collect() == []


def test_partial_scores_are_exact_for_large_components():
    q, c = np.array([[2.0**40, 3.0]]), np.array([[2.0**20, -1.0], [1.0, 7.0]])
    assert sum(exact_topk.partial_scores(q, c, 2)).astype(np.int64).tolist() == [[2**60 - 3, 2**40 + 21]]


def test_exact_scores_are_few(monkeypatch):
    """Totals are added up at the heads of the lists and above the uniform threshold only, and nothing is missed."""
    rng = np.random.default_rng(8)
    k, n, n_q, width = 5, 3000, 40, 16
    c = np.floor(rng.normal(0, 64, (n, width))).astype(np.int64)
    scored = []
    plain = exact_topk.exact_scores
    monkeypatch.setattr(exact_topk, "exact_scores", lambda parts, i, at: scored.append(len(at)) or plain(parts, i, at))
    monkeypatch.setattr(exact_topk, "TILE", 7)

    def block(cutoff):
        rows = [(0, 0, True, i, int(t), c[i].tolist()) for i, t in enumerate(cutoff)] + [(0, 0, False, i, 0, c[i].tolist()) for i in range(n)]
        names = ["qb", "cb", "is_query", "vec_id", "cutoff", "v"]
        return pa.Table.from_pydict({name: [r[j] for r in rows] for j, name in enumerate(names)}).to_batches()

    heads = pa.Table.from_batches(exact_topk._heads(iter(block([0] * n_q)), k, 2)).to_pandas()
    assert sum(scored) <= n_q * 2 * (k + 1)
    cutoff = heads.groupby("query_id")["score"].nsmallest(1).to_numpy()
    scored.clear()
    found = pa.Table.from_batches(exact_topk._above(iter(block(cutoff)), k, 2)).to_pandas()
    assert sum(scored) < 0.2 * n_q * n
    for q in range(n_q):
        total = c @ c[q]
        want = sorted((-int(total[i]), i) for i in range(n) if i != q)[:k]
        assert sorted(zip(-found[found["query_id"] == q]["score"], found[found["query_id"] == q]["vec_id"], strict=True)) == want


def test_blocks_are_bounded_by_components(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "BLOCK_COMPONENTS", 12)
    table = spark.createDataFrame([(i, [float(i % 3), 0.5, -1.0, 0.25]) for i in range(60)], "vec_id long, embedding array<float>")
    got = rows_of(exact_topk.top_k(table, k=3))
    monkeypatch.undo()
    assert len(got) == 9 and got == rows_of(exact_topk.top_k(table, k=3))


def test_hash_of_ids(spark):
    coded = byte_bpe.encode_documents(table_of(spark, ["ab"]), PATH, public_tokenizers.PATTERN).select(F.sha2("ids", 256).alias("h"), F.length("ids").alias("n")).first()
    assert coded["n"] % 4 == 0 and len(coded["h"]) == len(hashlib.sha256(b"").hexdigest())
