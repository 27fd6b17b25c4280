"""SentencePiece ids and texts against the library, whole tables and texts made to be awkward."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vigil.llm import pieces

LONG = " ".join(f"word{i}" for i in range(20000))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))


def same(library, texts):
    ids, counts = pieces.pieces(pieces.MODEL).encode(texts)
    cuts = np.concatenate(([0], np.cumsum(counts)))
    want = [library.encode(t or "", add_eos=True) for t in texts]
    assert [ids[lo:hi].tolist() for lo, hi in zip(cuts, cuts[1:])] == want
    assert pieces.pieces(pieces.MODEL).decode(ids, counts) == [library.decode(w) for w in want]


def test_awkward_texts(library):
    same(library, ["", None, " ", "  ", "   a", "a ", "a" + " " * 3000 + "b", "\n\n \t\r\n", "▁x▁ ▁", "é😀漢", "\0", "x" * 5000, "ﬁ﻿", "<s> </s> <0x0A>",
                   "hello  world\n\tx", "aaaaaaaaabbbbab" * 300, LONG, "=" * 999, "-" * 65, "\t" * 100])
    same(library, [])
    same(library, [None, ""])


def test_random_texts(library):
    rng = random.Random(1)
    vocabulary = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    for letters, most in ((" ab\n ,.the1▁é😀\t", 60), (vocabulary, 30), (["th", "e", "re", "==", "--", "//", "**", " ", "  ", "in", "g"], 200)):
        same(library, ["".join(rng.choice(letters) for _ in range(rng.randint(0, most))) for _ in range(3000)])


def test_long_words_one_merge_at_a_time(library, monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(pieces, "LONG", 0)
    same(library, ["".join(rng.choice("ab  e▁th") for _ in range(rng.randint(0, 300))) for _ in range(1000)])


def test_decode_of_any_ids(library):
    rng = random.Random(3)
    rows = [[rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(259) for _ in range(rng.randint(0, 12))] for _ in range(3000)] + [[1, 264], [2, 2]]
    got = pieces.pieces(pieces.MODEL).decode(np.array([x for r in rows for x in r], dtype=np.int32), np.array([len(r) for r in rows]))
    assert got == [library.decode(r) for r in rows]


def test_query_on_the_whole_table(spark, library):
    got = {r.doc_id: tuple(r)[1:] for r in pieces.query(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {r.doc_id: library.encode(r.text or "", add_eos=True) for r in docs}
    assert got == {d: (len(i), sha(" ".join(map(str, i))), sha(library.decode(i))) for d, i in want.items()}


def test_frames_keep_columns_and_edge_rows(spark, library):
    rows = [(1, None, 5, "a"), (None, "  x", 6, "b"), (1, LONG, 7, "c"), (2, "", 8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, decoded string")
    got = pieces.decode(pieces.encode(docs)).collect()
    assert [(r.doc_id, r.text, r.decoded) for r in got] == [(a, t, t or "") for a, t, *_ in rows]
    assert [r.ids for r in got] == [library.encode(t or "", add_eos=True) for _, t, *_ in rows]
    assert pieces.decode(pieces.encode(docs.limit(0))).collect() == []
    assert pieces.decode(docs.select(F.lit(None).cast("array<int>").alias("ids"))).collect()[0].decoded is None
