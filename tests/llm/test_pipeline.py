"""The stages of the pipeline, the whole of it, and queries without SQL, on small Parquet tables with awkward rows."""

import base64
import collections
import hashlib
import zlib

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from llm import rows
from llm.test_dedup_ops import brute_components, brute_lines, brute_windows
from tidemark.llm import queries


def ordered(items):
    return sorted(map(str, items))


def benchmark_items():
    long = rows.texts()[14].split()
    return [(i, " ".join(long[40 * i : 40 * i + 20])) for i in range(6)] + [(6, "two words"), (7, None), (8, "")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows.documents(spark).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, i % 2) for i in range(45)] + [(None, 1, 1), (3, 0, None), (4, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(benchmark_items(), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="module")
def codec():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_toxicity_stage(spark, docs, folder):
    """It keeps whole rows of its input, and works without any label."""
    kept = pipeline.drop_toxic(spark, docs, folder)
    assert kept.columns == docs.columns
    assert not collections.Counter(map(str, kept.collect())) - collections.Counter(map(str, docs.collect()))


def test_line_stage(spark, docs, folder):
    kept = pipeline.drop_repeated_lines(spark, docs, folder)
    assert kept.columns == docs.columns
    told = docs.collect()
    want = []
    for row, (_, text, _, lost, _) in zip(told, brute_lines([(r.doc_id, r.text) for r in told])):
        if not lost:
            want.append((row.doc_id, row.text, row.n_chars, row.lang, row.score))
        elif text.strip(" \t\n\x0b\x0c\r"):
            want.append((row.doc_id, text, len(text), row.lang, row.score))
    assert ordered((r.doc_id, r.text, r.n_chars, r.lang, r.score) for r in kept.collect()) == ordered(want)


def test_copy_stage(spark, docs, folder):
    kept = pipeline.drop_near_copies(spark, docs, folder)
    assert kept.columns == docs.columns
    told = [(r.doc_id, r.text) for r in docs.collect()]
    _, label, sets = brute_components(told)
    first = {}
    for (doc, _), group, own in zip(told, label, sets):
        if own:
            first[group] = min(first.get(group, doc), doc, key=lambda d: -1 if d is None else d) if group in first else doc
    want = [d for d in first.values()] + [doc for (doc, _), own in zip(told, sets) if not own]
    assert ordered(r.doc_id for r in kept.collect()) == ordered(want)


def test_benchmark_stage(spark, docs, folder):
    kept = pipeline.drop_benchmark(spark, docs, folder)
    assert kept.columns == docs.columns
    told = docs.collect()
    found = brute_windows([(r.doc_id, r.text) for r in told], benchmark_items(), 13)
    want = [str(tuple(r)) for r, f in zip(told, found) if not f[-1]]
    assert len(want) < len(told)
    assert ordered(tuple(r) for r in kept.collect()) == sorted(want)


def encoded(codec, text):
    ids = codec.encode_ordinary(text or "")
    sha = lambda data: hashlib.sha256(data).hexdigest()
    return len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode())


def test_encoding_stage_and_query(spark, docs, folder, codec):
    want = [(r.doc_id, *encoded(codec, r.text)) for r in docs.collect()]
    made = pipeline.encode(spark, docs, folder)
    assert ordered((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in made.collect()) == ordered(want)
    assert made.columns[:3] == ["doc_id", "lang", "source"]
    assert ordered(map(tuple, queries.op6_byte_bpe(spark, folder).collect())) == ordered(want)


def test_run_is_its_stages_in_turn(spark, docs, folder):
    now = docs
    for _, stage in pipeline.STAGES:
        now = stage(spark, now, folder)
    got = pipeline.run(spark, folder)
    assert got.columns == now.columns and got.count() > 0
    assert ordered(map(tuple, got.collect())) == ordered(map(tuple, now.collect()))


def test_run_on_empty_tables(spark, tmp_path):
    rows.empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_shard_query(spark, docs, folder):
    got = queries.op2_sharding(spark, folder).collect()
    want = [(r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs.collect()]
    assert ordered((r.doc_id, r.size, r.text_crc32) for r in got) == ordered(want)
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_byte_string_query(spark, docs, folder):
    """Each byte of a 200-byte string that starts twice goes."""
    told = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    starts = collections.Counter(text[i : i + 200] for _, text in told for i in range(len(text) - 199))
    want = []
    for doc, text in told:
        gone = bytearray(len(text))
        for i in range(len(text) - 199):
            if starts[text[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(text, gone) if not g)
        want.append((doc, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    assert ordered(map(tuple, queries.op7_suffix_dedup(spark, folder).collect())) == ordered(want)
