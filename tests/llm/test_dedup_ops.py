"""Line dedup, similarity join, byte-string dedup and benchmark search against brute force."""

import collections
import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import rows
from tidemark.llm import decontaminate, line_dedup, ngram_join, suffix_dedup


def ordered(items):
    return sorted(items, key=lambda r: [(v is None, str(v)) for v in r])


def brute_lines(docs, width=3):
    key = lambda d: -(1 << 63) if d is None else d
    where = collections.defaultdict(list)
    cut = []
    for k, (doc, text) in enumerate(docs):
        lines = (text or "").split("\n")
        worded = [i for i, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0d]", x)]
        cut.append((lines, worded))
        for j in range(len(worded) - width + 1):
            where[tuple(lines[worded[j + n]] for n in range(width))].append((key(doc), k, j))
    gone = collections.defaultdict(set)
    for places in where.values():
        least = min(p[0] for p in places)
        for doc, k, j in places:
            earlier = any(o[1] == k and o[2] < j for o in places)
            if doc > least or earlier:
                gone[k] |= {j + n for n in range(width)}
    out = []
    for k, ((doc, text), (lines, worded)) in enumerate(zip(docs, cut)):
        lost = {worded[j] for j in gone[k]}
        runs = sum(1 for j in gone[k] if j - 1 not in gone[k])
        out.append((doc, "\n".join(x for i, x in enumerate(lines) if i not in lost), len(lines), len(lost), runs))
    return out


def test_line_dedup(spark):
    docs = rows.documents(spark)
    got = line_dedup.dedup_lines(docs).select("doc_id", "kept_text", "n_lines", "n_removed", "n_spans", "size").collect()
    want = brute_lines([(r.doc_id, r.text) for r in docs.collect()])
    assert ordered(tuple(r)[:5] for r in got) == ordered(want)
    assert any(r.n_removed for r in got) and all(r["size"].startswith("size") for r in got)
    assert line_dedup.dedup_lines(rows.empty(spark)).count() == 0


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(docs):
    sets = [shingles(t) for _, t in docs]
    label = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [a if x == b else x for x in label]
    least = {}
    for (doc, _), x in zip(docs, label):
        least[x] = min((v for v in (doc, least.get(x)) if v is not None), default=None)
    return [(doc, len(s), least[x] if s else doc) for (doc, _), s, x in zip(docs, sets, label)], label, sets


@pytest.mark.parametrize("crowd,hubs", [(4, 4), (1, 1), (1000, 1)])
def test_similarity_join(spark, monkeypatch, crowd, hubs):
    monkeypatch.setattr(ngram_join, "CROWD", crowd)
    monkeypatch.setattr(ngram_join, "FIRST_HUBS", hubs)
    docs = rows.documents(spark)
    want, _, _ = brute_components([(r.doc_id, r.text) for r in docs.collect()])
    assert ordered(tuple(r) for r in ngram_join.join_similar(docs).collect()) == ordered(want)
    assert ngram_join.join_similar(rows.empty(spark)).count() == 0


def boilerplate_rows(spark, n, own):
    """How many rows in buckets ``n`` texts make that share 84 words, each after words of its own."""
    passage = " ".join(f"p{i}" for i in range(84))
    texts = [" ".join(f"{k}u{i}" for i in range(own)) + " " + passage for k in range(n)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc long, text string")
    kinds = "doc bigint, doc_id bigint, text_key bigint, n_shingles bigint, set_id bigint"
    rows = docs.select("doc", F.col("doc").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    items = rows.mapInArrow(ngram_join._items(5), kinds)
    sets = ngram_join.similar_candidates(docs, items, 5)
    return ngram_join.buckets(sets).count(), sets.count()


def test_a_shared_passage_makes_no_pairs(spark):
    """Texts that share a passage but do not link meet in no bucket; those that link meet in few."""
    for n in (60, 240):
        found, spoken = boilerplate_rows(spark, n, 20)
        assert spoken == n and found == 0
        linked, _ = boilerplate_rows(spark, n, 8)
        assert n <= linked <= 40 * n


def test_sizes_around_the_bound_link(spark):
    """Every pair of sizes near 3/4 of each other, exactly similar enough or one shingle short of it."""
    texts = []
    for size in range(24, 44):
        common = [f"c{i}" for i in range(size)]
        for own in range(0, size // 3 + 1, 2):
            texts.append(" ".join([*common, *[f"{size}x{own}o{i}" for i in range(own)]]))
    docs = rows.documents(spark, texts)
    want, _, _ = brute_components([(r.doc_id, r.text) for r in docs.collect()])
    assert ordered(tuple(r) for r in ngram_join.join_similar(docs).collect()) == ordered(want)


def test_chain_and_hot_group(spark):
    """A chain whose ends do not link, and many near copies of one text."""
    words = [f"w{i}" for i in range(80)]
    chain = [" ".join(words[i * 4 : 40 + i * 4]) for i in range(10)]
    hot = [" ".join([*words[:60], f"own{i}", *words[60:]]) for i in range(60)]
    apart = [" ".join(f"{k}u{i}" for i in range(30)) + " " + " ".join(words[:12]) for k in range(40)]
    docs = rows.documents(spark, [*chain, *hot, *apart])
    want, _, _ = brute_components([(r.doc_id, r.text) for r in docs.collect()])
    assert ordered(tuple(r) for r in ngram_join.join_similar(docs).collect()) == ordered(want)
    assert len({w[2] for w in want}) < len(want)


def test_small_sets(spark):
    """Sets of a few shingles, which meet by pairs."""
    pool = "a b c d e f g h".split()
    texts = [" ".join(pool[i:] + pool[:i]) + tail for i in range(4) for tail in ("", " x", " x y", " z z z")]
    docs = rows.documents(spark, texts * 2)
    want, _, _ = brute_components([(r.doc_id, r.text) for r in docs.collect()])
    assert ordered(tuple(r) for r in ngram_join.join_similar(docs).collect()) == ordered(want)


def test_keep_one(spark):
    docs = rows.documents(spark)
    all_rows = [(r.doc_id, r.text) for r in docs.collect()]
    _, label, sets = brute_components(all_rows)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    got = collections.Counter((r.doc_id, r.text) for r in kept.collect())
    for x in set(label):
        group = [all_rows[i] for i in range(len(label)) if label[i] == x]
        if not sets[label.index(x)]:
            assert all(got[g] == all_rows.count(g) for g in group)
        else:
            low = min(group, key=lambda g: (g[0] is not None, g[0] or 0))[0]
            mine = [(g, got[g]) for g in set(group) if got[g]]
            assert [n for _, n in mine] == [1] and mine[0][0][0] == low
    assert ngram_join.keep_one(rows.empty(spark)).count() == 0


def brute_bytes(texts, width):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i : i + width] for b in data for i in range(len(b) - width + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if seen[b[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        runs = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("width,light", [(200, 2000), (40, 2000), (40, 2), (9, 5)])
def test_byte_strings(spark, monkeypatch, width, light):
    monkeypatch.setattr(suffix_dedup, "LIGHT", light)
    docs = rows.documents(spark)
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    want = [(d, t, *x) for (d, t), x in zip(plain, brute_bytes([t for _, t in plain], width))]
    got = [
        (r.doc_id, r.text, sum(b - a for a, b in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest())
        for r in suffix_dedup.remove_repeats(docs, width).collect()
    ]
    assert ordered(got) == ordered(want)
    assert suffix_dedup.remove_repeats(rows.empty(spark), width).count() == 0


def brute_windows(docs, items, width):
    words = lambda t: re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    wanted = collections.defaultdict(set)
    for item, text in items:
        if item is not None and text is not None and (w := words(text)):
            n = min(width, len(w))
            for i in range(len(w) - n + 1):
                wanted[tuple(w[i : i + n])].add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in wanted}:
            for i in range(len(w) - n + 1):
                if owners := wanted.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= owners
        ids = ",".join(sorted(found))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("block", [8 << 20, 150])
def test_benchmark_search(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "PATTERN_BYTES", block)
    docs = rows.documents(spark)
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    long = rows.texts()[14].split()
    items = [(i, " ".join(long[50 * i : 50 * i + 30])) for i in range(8)]
    items += [(8, "one"), (9, "Two  WORDS!"), (10, ""), (11, None), (None, "x"), (12, items[0][1]), (0, items[0][1]), (13, "!?"), (14, "日本語 テキスト")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for width in (13, 4):
        found = decontaminate.find_benchmark(docs, bench, width=width).select("doc_id", "n_words", *decontaminate.verdict())
        assert ordered(tuple(r) for r in found.collect()) == ordered(brute_windows(plain, items, width))
    assert decontaminate.find_benchmark(rows.empty(spark), bench).count() == 0
    none = decontaminate.find_benchmark(docs, bench.limit(0)).select("doc_id", "n_words", *decontaminate.verdict())
    assert ordered(tuple(r) for r in none.collect()) == ordered(brute_windows(plain, [], 13))


def test_signs_never_differ_more_than_the_sets():
    draw = np.random.default_rng(3)
    for size in (1, 2, 40, 700):
        both = draw.integers(0, 1 << 63, size, dtype=np.uint64)
        for apart in (0, 1, 9, 300):
            only = draw.integers(0, 1 << 63, apart, dtype=np.uint64)
            a, b = np.append(both, only[::2]), np.append(both, only[1::2])
            bits = np.bitwise_count(ngram_join.signs(a) ^ ngram_join.signs(b)).sum()
            assert bits <= apart
            assert apart or not bits
