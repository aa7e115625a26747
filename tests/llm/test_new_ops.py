"""Nearest vectors, conversation repair and token alignment against brute force, on awkward rows."""

import collections
import functools
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import compare
from llm import rows
from tidemark.llm import conversations, nearest_vectors, oracle, queries, token_alignment


def ordered(values):
    return sorted(map(str, values))


def write(tmp_path, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


# Nearest vectors

VECTORS = "label int, embedding array<float>, vec_id long, row long, v string, score string, rank string, usable string"


def vector_rows(n=150, dim=5, seed=2):
    draw = random.Random(seed)
    point = lambda: [draw.gauss(0, 1) for _ in range(dim)]
    out = [[i, point()] for i in range(n)]
    for i in (3, 40, 41, 42, 43, 100):
        out[i][1] = list(out[50][1])  # ties
    out += [[50, out[50][1]], [100, out[7][1]], [100, out[7][1]], [None, out[50][1]], [None, point()], [-100, point()]]
    out += [[200, None], [300, [0.0] * dim], [400, [1.0, None, 0.0, 0.0, 0.0]], [500, [float("nan")] * dim], [600, [math.inf, 0.0, 0.0, 0.0, 0.0]], [700, []]]
    out += [[800, [1.0, 2.0]], [801, [1.0, 3.0]], [802, [5.0, 2.0]], [900, [3e38, -3e38, 1e-40, 0.0, 1.0]]]
    return [(i % 2, e, v, i, "v", "s", "r", "u") for i, (v, e) in enumerate(out)]


def brute_nearest(plain, k):
    single = [(v, np.array(e, np.float32).astype(float)) for v, e in plain if e and None not in e]
    single = [(v, e) for v, e in single if np.isfinite(e).all() and e.any()]
    out = []
    for i, (q, x) in enumerate(single):
        if q is not None and q % 100 == 0:
            near = [(math.sqrt(np.cumsum((x - y) ** 2)[-1]), v is None, v or 0, v) for j, (v, y) in enumerate(single) if j != i and len(y) == len(x)]
            out += [(q, n + 1, v, d) for n, (d, _, _, v) in enumerate(sorted(near, key=lambda t: t[:3])[:k])]
    return out


@pytest.mark.parametrize("candidate_bytes", [1 << 20, 600])
@pytest.mark.parametrize("first", [2, 10**9])
def test_nearest(spark, monkeypatch, first, candidate_bytes):
    monkeypatch.setattr(nearest_vectors, "FIRST_PARTS", first)
    monkeypatch.setattr(nearest_vectors, "BLOCK", 16)
    plain = vector_rows()
    table = spark.createDataFrame(plain, VECTORS).repartition(3)
    for k in (3, 400):
        found = nearest_vectors.nearest(nearest_vectors.clean_vectors(table), "vec_id % 100 = 0", k, candidate_bytes, 100)
        got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()]
        assert ordered(got) == ordered(brute_nearest([(p[2], p[1]) for p in plain], k))


def test_nearest_query_and_empty_tables(spark, tmp_path):
    folder = write(tmp_path, embeddings=spark.createDataFrame(vector_rows(), VECTORS))
    got = queries.op11_nearest_vectors(spark, folder)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert ordered(map(tuple, got.collect())) == ordered(brute_nearest([(p[2], p[1]) for p in vector_rows()], 10))
    empty = nearest_vectors.clean_vectors(spark.createDataFrame([], VECTORS))
    assert nearest_vectors.nearest(empty, "vec_id % 100 = 0").count() == 0
    alone = nearest_vectors.clean_vectors(spark.createDataFrame([(0, [1.0], 100, 0, "", "", "", "")], VECTORS))
    assert nearest_vectors.nearest(alone, "vec_id % 100 = 0").count() == 0


def test_quantisation_bounds_hold():
    """The true distance lies within the sum of the errors, also where components are huge, tiny or many."""
    draw = np.random.default_rng(4)
    for dim, scale in ((3, 1.0), (64, 1e-300), (64, 1e150), (2500, 1.0)):
        x = draw.normal(size=(40, dim)) * scale
        codes, s, error = nearest_vectors.quantise(x)
        kept = s[:, None] * codes
        exact = np.sqrt((((x[:, None] - x) / scale) ** 2).sum(-1)) * scale
        close = np.sqrt((((kept[:, None] - kept) / scale) ** 2).sum(-1)) * scale
        assert (np.abs(exact - close) <= error[:, None] + error).all()
        products = nearest_vectors._products(codes, codes)
        assert (products == codes.astype(np.int64) @ codes.astype(np.int64).T).all()


# Conversations

CHATS = "text string, conv_id long, role string, turn long, block string, place string, edits string, audit string, cost string"


def chat_rows(seed=1, long=90):
    draw = random.Random(seed)
    said = ["Yes.", "No", "Why?  ", "", " \t", "Go! on", "Same.", "Ünd. ", "end.\n\n", ".", "a.b\x0b", None]
    roles = ["user", "assistant", "system", "tool", "", "User", None]
    out = []
    for conv in [*range(40), None]:
        for turn in range(draw.randint(1, 9)):
            usual = ["system"] * (draw.random() < 0.2) + ["user", "assistant"] * 9
            role = usual[turn] if draw.random() < 0.7 else draw.choice(roles)
            number = None if draw.random() < 0.05 else turn + 3 * (draw.random() < 0.1)
            out.append((draw.choice(said) if draw.random() < 0.5 else f"word {draw.random()}.", conv, role, number))
    for turn in range(long):
        out.append((draw.choice(["Fine.", f"t {turn}.", f"x {turn}", ""]), 77, draw.choice(roles), turn))
    out += [("only", 900, "user", None), ("only", 900, "user", None), ("b.", 901, "assistant", 5)]
    out += [(f"gone {i}", i, "user", i) for i in range(1000, 1040)]
    return [(*r, "b", "p", "e", "a", "c") for r in out]


def brute_damage(plain):
    out = []
    for text, conv, role, turn in plain:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        how = zlib.crc32(key.encode()) % 20
        text, role = " " if text is None else text, " " if role is None else role
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        role = "user" if how == 4 else role
        out += [(conv, turn, role, text)] * (0 if how == 0 else 2 if how == 3 else 1)
    return out


def brute_repair(turns):
    """Cost, audit and lines by trying every edit from every place, best first by (cost, audit)."""
    seen, faults = set(), []
    for role, text in turns:
        blank = not re.search(r"[^\x20\x09-\x0d]", text)
        last = re.sub(r"[\x20\x09-\x0d]+\Z", "", text)[-1:]
        faults.append("b" if blank else "d" if (role, text) in seen else "t" if last not in (".", "!", "?") else "")
        seen.add((role, text))

    @functools.cache
    def best(i, state, put):
        found = []
        if i == len(turns) and state in ("", "a"):
            found.append((0, "", ()))
        other = "assistant" if state == "u" else "user"
        if put < 3:
            c, a, lines = best(i, other[0], put + 1)
            found.append((c + 3, "I" + a, (f"{other}:", *lines)))
        if i < len(turns):
            (role, text), extra = turns[i], 3 if faults[i] == "t" else 0
            c, a, lines = best(i + 1, state, 0)
            found.append((c + 4, "D" + a, lines))
            if faults[i] not in ("b", "d"):
                c, a, lines = best(i + 1, other[0], 0)
                found.append((c + 3 + extra, "R" + a, (f"{other}:{text}", *lines)))
                first = role[:1]
                if first == other[0] or first == "s" and state == "":
                    c, a, lines = best(i + 1, first, 0)
                    found.append((c + extra, "K" + a, (f"{role}:{text}", *lines)))
        return min(found, default=(10**9, "", ()))

    cost, audit, lines = best(0, "", 0)
    pairs = zip((t[0][:1] for t in turns), (t[0][:1] for t in turns[1:]))
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in pairs)
    return (*[faults.count(f) for f in "bdt"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute_report(plain):
    chats = collections.defaultdict(list)
    for conv, turn, role, text in brute_damage(plain):
        chats[conv].append((turn, role, text))
    out = []
    for conv in {p[1] for p in plain}:
        own = chats[conv]
        own.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).hexdigest()))
        known = [t[0] for t in own if t[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        out.append((conv, gaps, *brute_repair(tuple(t[1:] for t in own))))
    return out


@pytest.mark.parametrize("least", [1, 3, 64])
def test_conversation_repair(spark, least):
    plain = chat_rows()
    chats = spark.createDataFrame(plain, CHATS).repartition(3)
    got = conversations.repair_report(chats, conversations.repair(conversations.damage(chats), least))
    assert ordered(map(tuple, got.collect())) == ordered(brute_report([p[:4] for p in plain]))


def test_conversation_query_and_sql(spark, tmp_path):
    plain = chat_rows(seed=8)
    folder = write(tmp_path, conversations=spark.createDataFrame(plain, CHATS))
    got = queries.op12_conversation_repair(spark, folder)
    assert ordered(map(tuple, got.collect())) == ordered(brute_report([p[:4] for p in plain]))
    con = compare.duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{folder}/conversations.parquet/*.parquet')")
    assert compare.frame_rows(got) == compare.sql_rows(con, oracle.CONVERSATION_REPAIR)


def test_repaired_turns_are_rows(spark):
    told = [("Hello", 1, "user", 0), ("Hi.", 1, "assistant", 1), ("Bye.", 1, "user", 2)]
    chats = spark.createDataFrame(told, "text string, conv_id long, role string, turn long")
    fixed = conversations.repair(chats)
    turns = fixed.turns().orderBy(F.col("place").asc_nulls_last()).select(F.explode("turns").alias("t")).select("t.*")
    assert [tuple(r) for r in turns.collect()] == [("K", "user", "Hello"), ("K", "assistant", "Hi."), ("K", "user", "Bye."), ("I", "assistant", "")]
    assert conversations.repair(chats.limit(0)).summary.count() == 0
    assert conversations.repair_report(chats.limit(0), conversations.repair(chats.limit(0))).count() == 0


def test_one_conversation_with_most_rows(spark):
    """Its blocks hold about the square root of its rows each."""
    chats = spark.range(9000).selectExpr("1L conv_id", "id turn", "if(id % 2 = 0, 'user', 'assistant') role", "concat('t ', id, '.') text")
    fixed = conversations.repair(chats)
    sizes = fixed.blocks.agg(F.max(F.size("places")), F.count("*")).first()
    assert sizes[0] == 95 and sizes[1] == 95
    assert fixed.summary.select("cost", "audit").first() == (0, "K" * 9000)


# Token alignment

LEFT, RIGHT = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["<|endoftext|> and <s> </s> <unk> <0x41>", "▁under ▁", "a\0b", "tab\tnew\n\n  line ", "  two blanks", "naïve café 日本語 😀👩‍👩‍👧", "ﬁne ½ Å", "x" * 300, "﻿bom sep"]


def byte_level():
    plain = [b for b in range(256) if chr(b).isprintable() and 0x20 < b < 0x7F or 0xA1 <= b and b != 0xAD]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def brute_alignment(texts):
    """Links by comparing all byte ranges of a text, counts over all texts."""
    a_model = Tokenizer.from_file(LEFT)
    a_model.encode_special_tokens = True
    b_model, stands = sentencepiece.SentencePieceProcessor(model_file=RIGHT), byte_level()
    documents = []
    for text in texts:
        sides = [[], []]
        if text:
            sides[0] = [(i, bytes(stands[c] for c in a_model.id_to_token(i))) for i in a_model.encode(" " + text, add_special_tokens=False).ids]
            for i in b_model.encode(text):
                piece = b_model.id_to_piece(i)
                byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
                sides[1].append((i, bytes.fromhex(byte[1]) if byte and b_model.is_byte(i) else piece.replace("▁", " ").encode()))
            if any(b"".join(t[1] for t in side) != (" " + text).encode() for side in sides):
                sides = [[], []]
        spans = []
        for side in sides:
            ends = np.cumsum([len(t[1]) for t in side]).tolist()
            spans.append([(i, end - len(b), end) for (i, b), end in zip(side, ends)])
        links, first = [], 0
        for i, start, end in spans[0]:
            while first < len(spans[1]) and spans[1][first][2] <= start:
                first += 1
            for j, s, e in spans[1][first:]:
                if s >= end:
                    break
                if max(s, start) < min(e, end):
                    links.append((i, j))
        both = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        parts = []
        for low, high in zip([0, *both], both):
            parts.append("|".join(",".join(str(i) for i, s, e in side if low <= s and e <= high) for side in spans))
        documents.append((len(spans[0]), len(spans[1]), len(both), links, ";".join(parts)))
    held = collections.Counter(pair for *_, links, _ in documents for pair in set(links))
    most = collections.defaultdict(int)
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    out = []
    for n_a, n_b, n_groups, links, groups in documents:
        best = sum(held[p] == most[p[0]] for p in links)
        out.append((n_a, n_b, n_groups, len(links), hashlib.sha256(groups.encode()).hexdigest() if n_a else "", best, sum(held[p] for p in links)))
    return out


@pytest.mark.parametrize("head", [0, 40, 1 << 20])
def test_alignment(spark, tmp_path, monkeypatch, head):
    docs = rows.documents(spark, [*rows.texts()[:14], *ODD, *rows.texts()[16:24], "again", "again"]).cache()
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    want = [(doc, *row) for (doc, _), row in zip(plain, brute_alignment([t for _, t in plain]))]
    assert any(w[1] == 0 for w in want) and any(w[1] for w in want)
    monkeypatch.setattr(token_alignment, "TEXT_BYTES", 500)
    monkeypatch.setattr(token_alignment.with_link_counts, "__defaults__", (head,))
    got = queries.op13_token_alignment(spark, write(tmp_path, documents=docs))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    assert ordered(map(tuple, got.collect())) == ordered(want)


def test_alignment_keeps_columns_and_takes_empty_tables(spark):
    docs = rows.documents(spark, [None, "", "two words"])
    aligned = token_alignment.align_tokens(docs, LEFT, RIGHT, public_tokenizers.PATTERN)
    results = ["n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]
    assert aligned.columns == [*docs.columns, *results]
    nothing, empty, some = aligned.orderBy("doc_id").select("n_a", "groups", "pairs").collect()
    assert tuple(nothing) == tuple(empty) == (0, "", []) and some.n_a == 2
    none = token_alignment.align_tokens(rows.empty(spark), LEFT, RIGHT, public_tokenizers.PATTERN)
    assert token_alignment.with_link_counts(none, token_alignment.piece_count(RIGHT)).count() == 0


def test_a_vocabulary_out_of_order_is_refused():
    data = open(LEFT, "rb").read().replace(b'"\xc4\xa0t": 256', b'"\xc4\xa0t": 99999').replace(b'"\xc4\xa0t":256', b'"\xc4\xa0t":99999')
    with pytest.raises(ValueError):
        token_alignment.ByteTokens(data, public_tokenizers.PATTERN)
