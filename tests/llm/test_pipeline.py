"""Packing against plain encoding by the library, and the whole pipeline against brute force."""

import itertools
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import packing, pseudonyms, quality
from tidemark.llm.queries import BYTE_BPE, PII_KEY
from tidemark.llm.ranks import encoder

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    lib.encode_special_tokens = True
    return lambda t: np.array(lib.encode(t or "", add_special_tokens=False).ids + [1], "<u4")


def tiled(rows, ids_of, window):
    """Every id in exactly one piece, pieces gapless in their sequences, checksums of the plain encoding."""
    start, seq = {}, {}
    for r in rows:
        ids = ids_of[r.doc_id]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
        start.setdefault(r.doc_id, []).append((r.start, r.length))
        seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces, ends in ((start, {d: len(x) for d, x in ids_of.items()}), (seq, None)):
        for k, parts in pieces.items():
            at = 0
            for o, n in sorted(parts):
                assert o == at and n > 0
                at += n
            assert at <= window if ends is None else at == ends[k]
    assert set(start) == set(ids_of)
    return len(seq)


def test_rank_encoder_equals_the_library(spark, library):
    enc = encoder(BYTE_BPE)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").limit(300).collect()]
    texts += ["", " ", "a  b", "\n\n x", "<|endoftext|>", "x" * 5000, "日本語 text", "a\x00b", "é" * 500, "tab\tand nbsp\xa0"]
    for t in texts:
        assert enc.ids(t or "") == library(t)[:-1].tobytes()


def test_packing_against_plain_encoding(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(10_000, None), (10_001, ""), (10_002, "z" * 30_000), (10_003, "only  one \t odd text")], "doc_id long, text string")
    docs = docs.unionByName(odd)
    ids_of = {r.doc_id: library(r.text) for r in docs.collect()}
    rows = packing.op8(docs, BYTE_BPE).collect()
    sequences = tiled(rows, ids_of, 2048)
    total = sum(map(len, ids_of.values()))
    assert sequences <= -(-total // 2048) * 1.02 + 2
    assert packing.op8(docs.where("false"), BYTE_BPE).collect() == []


def shingles(text):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_run_equals_brute_force(spark, library):
    """Kept rows by the quality query, one document per near-duplicate group by all pairs, pseudonyms by the operator's own texts,
    packing by plain encoding."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in quality.op9(docs).collect() if r.kept}
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if r.doc_id in kept)
    sets = {i: shingles(t) for i, t in rows}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    one = [i for i in sets if find(i) == i]
    assert len(one) < len(rows)
    clean = pseudonyms.pseudonymize(docs.where(F.col("doc_id").isin(one)), PII_KEY, docs.columns, found=None)
    ids_of = {r.doc_id: library(r.text) for r in clean.select("doc_id", "text").collect()}
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    assert tiled(out.withColumn("ids_crc32", F.crc32("ids")).collect(), ids_of, 2048) > 10
