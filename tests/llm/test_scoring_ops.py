"""Quality rules, sharding, language-model scores, BPE, URL filter and toxicity on awkward rows."""

import base64
import collections
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from llm import rows
from tidemark.llm import byte_bpe, lm_scoring, quality_rules, sharding, toxicity, url_filter

WORD = r"[^\x20\x09-\x0d]+"


def brute_measures(text):
    text = text or ""
    words = re.findall(WORD, text)
    times = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {i + k for i in range(len(words) - 2) if times[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


def test_quality_rules(spark):
    docs = rows.documents(spark)
    plain = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    measured = {}
    failures = collections.defaultdict(list)
    for doc, text, source in plain:
        m = brute_measures(text)
        failed = m[0] < 50 or 100 * m[4] > 50 * m[0]
        measured[(doc, text, source)] = (*m, failed)
        if source is not None:
            failures[source].append(failed)
    n, f = sum(map(len, failures.values())), sum(map(sum, failures.values()))
    mean = f / n
    between = sum(sum(x) ** 2 / len(x) for x in failures.values()) / n - mean**2 - mean * (1 - mean) * len(failures) / n
    strength = mean * (1 - mean) / between - 1 if between > 1e-12 else None
    rate = {s: mean if strength is None else (sum(x) + mean * max(strength, 0)) / (len(x) + max(strength, 0)) for s, x in failures.items()}
    want = []
    for (doc, text, source) in plain:
        *m, failed = measured[(doc, text, source)]
        own = rate.get(source)
        lost = own is not None and own > 0.5
        want.append((doc, source, *m, failed, None if own is None else round(own, 6), lost, not failed and not lost))
    got = quality_rules.judge(docs).select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "host_rate", "host_failed", "kept"
    )
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert quality_rules.judge(rows.empty(spark)).count() == 0


def test_hosts_differ(spark):
    """A host whose documents nearly all fail takes its good one along; a small one is pulled to the mean."""
    good = " ".join(f"w{i}" for i in range(60))
    data = [(i, "bad", "short" if i else good) for i in range(200)] + [(1000 + i, "fine", good) for i in range(800)] + [(5000, "new", "short"), (5001, "new", good)]
    got = {r.doc_id: r for r in quality_rules.judge(spark.createDataFrame(data, "doc_id long, source string, text string")).collect()}
    assert not got[0].base_failed and got[0].host_failed and not got[0].kept
    assert got[1000].kept and got[5001].kept and 0.2 < got[5001].host_rate < 0.5


@pytest.mark.parametrize("shards", [3, 24])
def test_shards(spark, shards):
    docs = rows.documents(spark)
    got = sharding.shard_by_bytes(docs, shards).collect()
    want = sorted((r.doc_id is not None, r.doc_id or 0, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == want
    total, largest = sum(r.size for r in got), max(r.size for r in got)
    place = sorted((r.shard, r.slot, r.doc_id is not None, r.doc_id or 0, r.size) for r in got)
    assert [p[2:4] for p in place] == sorted(p[2:4] for p in place)  # contiguous in key order
    before = 0
    for shard, slot, *_, size in place:
        assert shard == min(shards - 1, (2 * before + size) * shards // (2 * total))
        before += size
    for shard in range(shards):
        own = [p for p in place if p[0] == shard]
        assert [p[1] for p in own] == list(range(len(own)))
        assert abs(sum(p[4] for p in own) - total / shards) < largest
    assert sharding.shard_by_bytes(rows.empty(spark)).count() == 0


def brute_ppm(train, texts, order, nodes):
    """PPM with escape method C and symbol exclusion, by counting and by walking the contexts one by one."""
    edge = 255
    counts = [collections.defaultdict(collections.Counter) for _ in range(order + 1)]
    stream = lambda t: [edge] * lm_scoring.ORDER + list(t.encode()) + [edge]
    for text in train:
        s = stream(text)
        for i in range(lm_scoring.ORDER, len(s)):
            for k in range(order + 1):
                counts[k][tuple(s[i - k : i])][s[i]] += 1
    total = sum(counts[0][()].values())

    def known(context):
        if len(context) <= 2:
            return context in counts[len(context)]
        return edge not in context and sum(counts[len(context)][context].values()) * nodes > total

    out = []
    for text in texts:
        s, log = stream(text), 0.0
        for i in range(lm_scoring.ORDER, len(s)):
            k = max(k for k in range(order + 1) if all(known(tuple(s[i - j : i])) for j in range(k + 1)))
            excluded, chance = set(), 1.0
            while True:
                if k < 0:
                    chance /= 256 - len(excluded)
                    break
                free = {c: n for c, n in counts[k][tuple(s[i - k : i])].items() if c not in excluded}
                n, d = sum(free.values()), len(free)
                if s[i] in free:
                    chance *= free[s[i]] / (n + d)
                    break
                if free:
                    chance *= d / (n + d)
                excluded |= set(free)
                k -= 1
            log += math.log10(chance)
        out.append(log)
    return out


def brute_base(train, texts):
    words = lambda t: [*re.findall(rb"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t).encode()), None]
    c = collections.Counter(w for t in train for w in words(t))
    n, v = sum(c.values()), len(c)
    return [(len(words(t)), sum(c[w] > 0 for w in words(t)), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words(t))) for t in texts]


@pytest.mark.parametrize("head,nodes", [(1 << 21, 60_000), (20, 150)])
def test_lm_scores(spark, monkeypatch, head, nodes):
    monkeypatch.setattr(lm_scoring, "HEAD_WORDS", head)
    monkeypatch.setattr(lm_scoring, "NODES", nodes)
    docs = rows.documents(spark, rows.texts()[:14] + rows.texts()[17:]).withColumn("held_out", lm_scoring.held_out())
    plain = [(r.doc_id, r.text or "", r.held_out) for r in docs.collect()]
    assert all(h == (zlib.crc32(str(d).encode()) % 5 == 1) for d, _, h in plain)
    train = [t for _, t, h in plain if not h]
    model, words = lm_scoring.train(docs.filter("not held_out"))
    got = {r.doc_id: r for r in lm_scoring.score_texts(docs, model, words).collect()}
    base, ppm = brute_base(train, [t for _, t, _ in plain]), brute_ppm(train, [t for _, t, _ in plain], lm_scoring.ORDER, nodes)
    for (doc, _, held), want, score in zip(plain, base, ppm):
        r = got[doc]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, *want[:3])
        assert r.base_score == pytest.approx(want[3], rel=1e-9)
        assert r.score == pytest.approx(score, rel=1e-5, abs=1e-5)


@pytest.mark.parametrize("frequent", [1 << 22, 400, 0.1])
def test_lm_scores_without_a_cut(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm_scoring, "HEAD_GRAMS", frequent)
    monkeypatch.setattr(lm_scoring, "ASK_BYTES", 4000)
    docs = rows.documents(spark).withColumn("held_out", lm_scoring.held_out())
    plain = [(r.doc_id, r.text or "", r.held_out) for r in docs.collect()]
    train = [t for _, t, h in plain if not h]
    model, words = lm_scoring.train(docs.filter("not held_out"))
    assert (len(model.head.grams) == 0) == (frequent < 1)
    # by row, as ids repeat
    got = sorted((r.doc_id is None, r.doc_id or 0, r.score) for r in lm_scoring.score_texts(docs, model, words).collect())
    ppm = brute_ppm(train, [t for _, t, _ in plain], lm_scoring.ORDER, math.inf)
    want = sorted((d is None, d or 0, score) for (d, _, _), score in zip(plain, ppm))
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert [x[2] for x in got] == pytest.approx([x[2] for x in want], rel=1e-5, abs=1e-5)


def test_lm_rare_passage(spark):
    """A passage that is far below one in 60,000 positions keeps its contexts of six bytes."""
    draw = random.Random(3)
    text = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    passage = text(80)
    train = [text(9000) for _ in range(16)] + [passage]
    model, words = lm_scoring.train(rows.documents(spark, train))
    r = lm_scoring.score_texts(rows.documents(spark, [passage]), model, words).first()
    assert r.score == pytest.approx(brute_ppm(train, [passage], lm_scoring.ORDER, math.inf)[0], rel=1e-5)
    assert r.score > 0.6 * brute_ppm(train, [passage], lm_scoring.ORDER, 60_000)[0]


def test_lm_without_training(spark):
    docs = rows.documents(spark, ["abc", None])
    model, words = lm_scoring.train(docs.limit(0))
    got = lm_scoring.score_texts(docs, model, words).orderBy("doc_id").collect()
    assert [r.n_known for r in got] == [0, 0] and got[0].score == pytest.approx(4 * math.log10(1 / 256), rel=1e-5)
    assert lm_scoring.score_texts(rows.empty(spark), model, words).count() == 0


def small_vocabulary(seed=1):
    """Bytes and merges drawn at random, so that ranks come in no helpful order."""
    draw = random.Random(seed)
    tokens = [bytes([b]) for b in range(256)]
    letters = [t for t in tokens if t in b"abc "] + [b"a", b"b"]
    while len(tokens) < 400:
        new = draw.choice(letters) + draw.choice(letters)
        if new not in tokens and len(new) < 9:
            tokens.append(new)
            letters.append(new)
    made = tokens[256:]
    draw.shuffle(made)
    return {t: i for i, t in enumerate(tokens[:256] + made)}


def brute_bpe(ranks, piece):
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        pairs = [(ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        _, i = min(pairs)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@pytest.mark.parametrize("seed", range(4))
def test_bpe_pieces(seed):
    """The queue merges as the plain rule does, also where a merge makes a pair of a lower rank."""
    ranks = small_vocabulary(seed)
    encoder = byte_bpe.Encoder(ranks, r"\S+|\s+")
    draw = random.Random(seed)
    pieces = ["".join(draw.choice("abc ") for _ in range(n)).encode() for n in [*range(1, 40)] * 8 + [400, 700]] + [b"a" * 333, b"ab" * 200]
    assert encoder.encode_pieces(pieces) == [brute_bpe(ranks, p) for p in pieces]


def test_bpe_rows(spark):
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file)}
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = rows.documents(spark, [*rows.texts(), "<|endoftext|>", "don't 1234  \n\n x", "e" * 20000])
    for r in byte_bpe.encode_texts(docs, path, public_tokenizers.PATTERN).collect():
        want = theirs.encode_ordinary(r.text or "")
        assert r.ids == want and r.n_tokens == len(want) and bytes(r.decoded).decode() == (r.text or "")
        assert r.ids_text == " ".join(map(str, want))
    assert byte_bpe.encode_texts(rows.empty(spark), path, public_tokenizers.PATTERN).count() == 0


def brute_rule(url, rules):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_url_filter(spark):
    from tidemark.llm.queries import RULES

    urls = [
        None, "", "no scheme/en/", "http://", "http://Example.COM", "https://example.com/en/x?a://b", "http://www.example.com/en/1#t",
        "http://a.www.example.com/en/", "http://anexample.com/en/", "http://x.net/es/1", "http://net/fr/", "http://x.net/de/1", "ftp://casino-win.example.org/fr/3",
        "http://blog.theory.example.org/en/5", "http://É.Net/es/", "a\nhttp://x.com/\n", "http://x.com?/en/", "http://" + "y" * 5000 + ".org/" + "z" * 9000,
    ]
    pages = spark.createDataFrame([(i, u, "s", "h") for i, u in enumerate(urls + urls[5:7])], "page_id long, url string, score string, host string")
    got = url_filter.filter_urls(pages, RULES).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        host, path, rule, verdict = brute_rule(r.url, RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule), r.url
        assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))
    by = {r.url: r for r in got}
    assert by["ftp://casino-win.example.org/fr/3"].verdict == "block" and by["http://blog.theory.example.org/en/5"].verdict == "allow"
    assert url_filter.filter_urls(pages.limit(0), RULES).count() == 0


def test_url_model_on_new_names():
    """Names that no row of the labelled table has."""
    bad = ["mega-casino", "cheap-pills", "free-bets", "spam-farm", "ads-track", "xxx-adult-video"]
    good = ["winter-wheat", "adverbs", "spanish-lessons", "tracking-weather", "pillars", "carpenter"]
    import pyarrow as pa

    model = url_filter.UrlModel.fit(url_filter.labelled())
    z = model.logit(pa.array([f"{n}.example.org" for n in bad + good]), pa.array(["/en/5"] * 12))
    assert (z[:6] > 0).all() and (z[6:] < 0).sum() >= 5


def toxic_corpus(spark, n=900):
    draw = random.Random(2)
    words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7))) for _ in range(300)]
    data, labels = [], []
    for i in range(n):
        lang = "en" if i % 3 else "fr"
        text = [draw.choice(words) for _ in range(draw.randint(5, 80))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                text.insert(draw.randrange(len(text)), ("vilk" if lang == "en" else "zorp") + draw.choice(["", "a", "os", "ing"]))
        data.append((i, " ".join(text), lang))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def test_toxicity(spark):
    docs, labels, truth = toxic_corpus(spark)
    held = lambda d: zlib.crc32(str(d).encode()) % 3 == 1
    net = toxicity.train(docs, labels)
    got = toxicity.score_texts(docs, net).withColumn("held", toxicity.held_out()).collect()
    assert all(r.held == held(r.doc_id) for r in got)
    mine = [r for r in got if r.held]
    right = sum((r.score >= 0.7) == bool(truth[r.doc_id]) for r in mine) / len(mine)
    assert right > 0.95 and all(0 <= r.score <= 1 for r in got)
    assert all(r.rejected == (r.score >= r.threshold) for r in got)
    # labels of held-out rows, languages and ids leave the scores alone
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.score_texts(docs.withColumn("lang", F.lit(None).cast("string")), toxicity.train(docs, flipped))
    assert {r.doc_id: r.score for r in again.collect()} == {r.doc_id: r.score for r in got}


def test_toxicity_on_awkward_rows(spark):
    docs = rows.documents(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(45)] + [(None, 1), (3, None), (4, 1), (4, 0)], "doc_id long, toxic int")
    net = toxicity.train(docs, labels, toxicity.Settings(epochs=1))
    got = toxicity.score_texts(docs, net).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    blank = {r.score for r in got if not (r.text or "").strip()}
    assert len(blank) == 1
    assert toxicity.score_texts(rows.empty(spark), net).count() == 0
    bare = toxicity.train(rows.empty(spark), labels)
    assert len({r.score for r in toxicity.score_texts(docs, bare).collect()}) == 1


def test_gradient():
    """One step moves the loss the way that differences of it say."""
    settings = toxicity.Settings(bits=6, width=3, filters=2, rate=1e-3, shrink=0.0)
    draw = np.random.default_rng(0)
    texts = [draw.integers(0, 64, (n, 3)).astype(np.int32) for n in (1, 4, 9, 30)]
    labels = np.array([1, 0, 1, 0], np.float32)
    net = toxicity.Network.fresh(settings)

    def loss():
        ids, first = np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        z = net.logit(ids, first)
        return float(np.mean(np.log1p(np.exp(-z)) * labels + np.log1p(np.exp(z)) * (1 - labels)))

    start = loss()
    memory, seen = {"table": np.zeros(64, np.float32)}, np.zeros(64, dtype=bool)
    for _ in range(40):
        net.step(texts, labels, memory, seen)
    assert loss() < start




def test_salts_give_buckets_of_their_own():
    """A word and its heads of the same bytes, and n-grams of host and path, share hardly a bucket."""
    words = " ".join(f"w{i}"[:4] for i in range(300)).encode()
    ids, _ = toxicity.word_ids(np.frombuffer(words, np.uint8), np.array([0, len(words)]), 18)
    for a, b in ((0, 1), (0, 2), (1, 2)):
        assert (ids[:, a] == ids[:, b]).mean() < 0.05
    column = pa.array([f"/casino/{i}" for i in range(300)])
    host, path = (url_filter.grams(column, salt, 16, (3, 4, 5))[0] for salt in (1, 2))
    assert (host == path).mean() < 0.01


def test_toxic_sample_goes_on_after_a_long_text(spark):
    """A text that takes most of the room comes last; a key with many rows counts once; null keys have a fold."""
    texts = [(i, "word " * 20, "en") for i in range(60)] + [(3, "x" * 2900, "en")] + [(4, f"other {i}", "en") for i in range(50)] + [(None, "n", "en")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    learned = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows_, share = toxicity.sample(docs, labels, toxicity.Settings(sample_bytes=3000))
    sizes = [len(r.text) for r in rows_.collect()]
    assert len(sizes) >= 28 and sum(sizes) <= 3000 and share == sum(i % 2 for i in learned) / len(learned)
    everything, _ = toxicity.sample(docs, labels, toxicity.Settings())
    assert everything.count() == len(learned)
    assert docs.filter("doc_id is null").select(toxicity.held_out().alias("h")).first().h is False


@pytest.mark.parametrize("folder,least", [("sf0.1", 0.94)])
def test_held_out_toxicity(folder, least):
    """Area under the curve on the held-out fold of the given labels."""
    tables = [pq.read_table(f"/root/testdata/{folder}/{name}.parquet").to_pandas() for name in ("documents", "labels")]
    told = tables[0].merge(tables[1], on="doc_id")
    told["text"] = told["text"].fillna("")
    texts = [np.frombuffer(t.encode(), np.uint8) for t in told["text"]]
    ids = [toxicity.word_ids(t, np.array([0, len(t)]), 18)[0] for t in texts]
    out = np.array([zlib.crc32(str(d).encode()) % 3 == 1 for d in told["doc_id"]])
    y = told["toxic"].to_numpy()
    learn, ask = np.flatnonzero(~out), np.flatnonzero(out)
    net = toxicity.fit([ids[i] for i in learn], y[learn], [told["lang"][i] for i in learn], y[learn].mean(), toxicity.Settings())
    score = np.array([net.score(ids[i], np.array([0, len(ids[i])]))[0] for i in ask])
    toxic, clean = score[y[ask] > 0], score[y[ask] == 0]
    assert (toxic[:, None] > clean).mean() + (toxic[:, None] == clean).mean() / 2 >= least


def test_toxicity_learns_from_all_labelled_rows(spark, monkeypatch):
    """Rows beyond the bounds of the trial set count, in one shard and in several, whatever the partitioning."""
    docs, labels, truth = toxic_corpus(spark)
    monkeypatch.setattr(toxicity, "sample", None)
    for more in ({}, {"least_steps": 30, "epochs": 12}):
        settings = toxicity.Settings(toxic_docs=2, other_docs=2, sample_bytes=100, **more)
        found = []
        for rows_ in (docs, docs.union(docs.limit(5)).repartition(7)):
            net = toxicity.train(rows_, labels, settings)
            scores = {r.doc_id: r.score for r in toxicity.score_texts(docs, net).withColumn("held", toxicity.held_out()).filter("held").collect()}
            found.append(scores)
        assert found[0] == found[1]
        assert sum((s >= 0.5) == bool(truth[d]) for d, s in found[0].items()) / len(scores) > 0.9


def test_moves_are_means_over_the_shards_that_moved(spark):
    settings = toxicity.Settings(bits=6, width=3, filters=2)
    a = np.array([3, 5]), np.array([[2, 4], [6, 8]]), np.array([1, 1])
    b = np.array([5, 9]), np.array([[10, 2], [1, 1]]), np.array([1, 1])
    places, sums, shards = toxicity._plus(a, b)
    assert places.tolist() == [3, 5, 9] and sums.tolist() == [[2, 4], [16, 10], [1, 1]] and shards.tolist() == [1, 2, 1]
    net = toxicity.Network.fresh(settings)
    assert list(toxicity._learn(iter([]), net, net.memory(), 1, [1])) == []


def test_bpe_memory():
    """Many new pieces at once do not swell a worker: what they need beside their codes is that of a small queue."""
    ranks = {bytes([b]): b for b in range(256)}
    for token in (b"ab", b"cd", b"abcd", b"ef", b"gh", b"efgh"):
        ranks[token] = len(ranks)
    encoder = byte_bpe.Encoder(ranks, r"\S+|\s+")
    text = " ".join(f"abcdefgh{i:x}" for i in range(100_000))
    tracemalloc.start()
    try:
        encoder.encode_all([text])
        left, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert peak - left < 60 << 20
