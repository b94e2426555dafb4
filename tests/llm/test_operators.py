"""The operators on awkward rows: nulls, empty and repeated rows, empty tables, extra columns with clashing names."""

import math
import zlib
from collections import Counter

import public_tokenizers
import pytest

import corpus_pipeline
from tidemark.llm import maxscore, mincut, neardup, orcids, packing, pitmanyor, pseudonyms, quality, viterbi, wordpiece

BASE = "one two three four five six seven eight nine ten eleven twelve " * 1
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, chunk int, word string"
ROWS = [(1, BASE, "en", "s", 5, "x", 1, "w"), (2, BASE, "en", "s", 5, None, 1, "w"), (2, BASE, "en", "s", 5, None, 1, "w"),
        (3, "", "en", None, 0, None, None, None), (4, None, None, None, None, None, None, None),
        (None, "mail a.b@c.org now " + BASE, "en", "s", 5, None, 1, "w"), (6, "x " * 5000, "en", "t", 9, None, 1, None)]
WORDS, BYTES, PIECES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
OPS = {
    "op3": lambda d: orcids.op3(d, WORDS), "op4": lambda d: wordpiece.op4(d, PIECES), "op5": lambda d: pseudonyms.op5(d, "k"),
    "op6": neardup.op6, "op7": lambda d: viterbi.op7(d, PIECES), "op9": quality.op9, "op10": pitmanyor.op10}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.mark.parametrize("name", OPS)
def test_one_row_per_document_and_empty_tables(spark, docs, name):
    out = OPS[name](docs).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in ROWS)
    assert OPS[name](docs.where("false")).collect() == []


def test_near_duplicates_and_pipeline(spark, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.op6(docs).collect() if r.doc_id}
    assert got == {1: (8, 1), 2: (8, 1), 3: (0, 3), 4: (0, 4), 6: (1, 6)}
    kept = neardup.distinct_documents(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "6", "None"]


def test_packing_covers_every_id(spark, docs):
    rows = packing.pack(docs, BYTES, window=16).collect()
    assert sum(r.length for r in rows) == sum(packing.cut(docs, BYTES, 1, 16).toPandas().length)
    seq = {}
    for r in rows:
        assert len(r.ids) == 4 * r.length
        seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seq.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 16


def test_vectors_and_pages(spark):
    v = spark.createDataFrame([(0, [1.0, 0.5]), (1, [0.5, None]), (2, None), (3, [2.0, float("nan")]), (4, []), (5, [1.0]), (20, [0.25, 1.0])],
                              "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in maxscore.op2(v).collect())
    assert got == [(0, 1, 5, 4096), (0, 2, 20, 3072), (0, 3, 4, 0), (20, 1, 0, 3072), (20, 2, 5, 1024), (20, 3, 4, 0)]
    p = spark.createDataFrame([(1, "u", None), (None, None, "<article><p>Hello, there.</p></article>")], "page_id long, url string, html string")
    assert sorted((r.text, r.n_chars) for r in mincut.op1(p).collect()) == [("", 0), ("Hello, there.", 13)]


def test_pipeline_stages(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "pii", "pack"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, d, "/root/testdata/sf0.001")
        assert out.columns == d.columns and out.dtypes == d.dtypes


def test_language_model_counts_and_probabilities(spark):
    """Counts and base score by brute force; a word seen after a long word scores higher after it than one that was not."""
    train = [(i, t) for i, t in enumerate(["certainly alpha", "certainly alpha", "certainly beta gamma", "delta certainly alpha", "otherwise beta"] * 9)
             if zlib.crc32(str(i).encode()) % 5 != 1]
    count = Counter(w for _, t in train for w in [*t.split(), ""])
    total, types = sum(count.values()), len(count)
    held = [i for i in range(1000, 3000) if zlib.crc32(str(i).encode()) % 5 == 1]
    asked = dict(zip(held, [f"certainly {w}" for w in [*sorted(w for w in count if w), "unseen"]] + ["certainly", "alpha", "beta", "gamma", "delta", "otherwise"]))
    rows = train + list(asked.items())
    got = {r.doc_id: r for r in pitmanyor.op10(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        w = [*t.split(), ""]
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i in asked, len(w), sum(x in count for x in w), total)
        assert math.isclose(r.base_score, sum(math.log10((count[x] + 0.5) / (total + 0.5 * (types + 1))) for x in w), rel_tol=1e-9)

    like = {t: got[i].score for i, t in asked.items()}
    assert like["certainly alpha"] > like["certainly beta"] > like["certainly unseen"]
    assert like["certainly alpha"] - like["alpha"] > like["certainly gamma"] - like["gamma"]
