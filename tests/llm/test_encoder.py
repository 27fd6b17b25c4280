"""Ids of the remembering encoder against the library's own, also when its table of pieces is cut again and again."""

import random

import numpy as np
import pytest

from vigil.llm import token_files as T


@pytest.mark.parametrize("limit", [1, 40, 300, 800_000])
def test_ids_equal_the_librarys(limit, monkeypatch):
    monkeypatch.setattr(T, "LEARN", 17)
    rng = random.Random(7)
    signs = ["a", "b", "Q", "é", "語", "9", ".", "'s", "\n", "\t", " ", "\0", "-"]
    words = ["".join(rng.choices(signs, k=rng.randint(1, 6))) for _ in range(400)]
    texts = [None, "", " ", "  ", " a", "a ", "<|endoftext|>"] + [rng.choice([" ", " ", "  "]).join(rng.choices(words, k=rng.randint(1, 40))) for _ in range(120)]
    encoder, library = T.Encoder(T.TOKENIZER, limit), T.tokenizer(T.TOKENIZER)
    want = [np.array([*library.encode(t or "", add_special_tokens=False).ids, T.END], dtype="<u4").tobytes() for t in texts]
    got = [ids for lo in range(0, len(texts), 9) for ids in encoder.encode_all(texts[lo: lo + 9])]
    assert got == want
    assert encoder.encode_all(texts) == want
