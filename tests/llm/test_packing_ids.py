"""Ids of the two encoders are the same, and the faster one is taken only where that is certain."""

import json
import random

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from starloom.llm import packing as K  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["the", " The", "'s", "'LL", " 12345", "été", "ß÷×", "\t", " ", "  ", "\r\n", "\n\n\n", "#$%", "<|", "<|endoftext|>", "ǆ", "中文", "😀", "\xa0",
         "\x85", "\x1f", " ", "é", "x" * 700, " " * 40, "Wörter", "don't", "_a_", "-", "\x7f", "²", "ªº"]


@pytest.fixture(scope="module")
def ids():
    return K.Ids(PATH)


def texts(n, parts):
    rnd = random.Random(5)
    return ["".join(rnd.choice(parts) for _ in range(rnd.randrange(30))) for _ in range(n)]


def plainly(t):
    return np.array(Tokenizer.from_file(PATH).encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_whole_texts_and_chunks_equal_the_tokenizer(ids):
    encoder = Tokenizer.from_file(PATH)
    every = texts(1_500, PARTS) + texts(1_500, PARTS[:13])
    want = [np.array(e.ids, "<u4").tobytes() for e in encoder.encode_batch(every, add_special_tokens=False)]
    assert ids.fast is not None
    assert ids.texts(every) == want and [ids.long_text(t) for t in every[:200]] == want[:200]
    whole = [ids.whole(t) for t in every]
    assert all(w is None or w == x for w, x in zip(whole, want)) and sum(w is not None for w in whole) > 500
    assert ids.whole("") == b"" and ids.whole("a<|endoftext|>") is None and ids.whole("中") is None


def test_every_token_and_random_bytes_of_the_alphabet(ids):
    rnd = random.Random(8)
    vocab = [t for t in json.load(open(PATH, encoding="utf-8"))["model"]["vocab"] if t.isascii()]
    lines = [" ".join(rnd.choices(vocab, k=40)).replace("<|", "< |") for _ in range(300)]
    lines += ["".join(rnd.choices("aAeEtThnsio", k=200)) for _ in range(300)]
    encoder = Tokenizer.from_file(PATH)
    for t, e in zip(lines, encoder.encode_batch(lines, add_special_tokens=False)):
        assert ids.whole(t) == np.array(e.ids, "<u4").tobytes()


@pytest.mark.parametrize("change", ["order", "unreachable", "prefix"])
def test_other_vocabularies_keep_their_tokenizer(tmp_path, change):
    spec = json.load(open(PATH, encoding="utf-8"))
    pairs = spec["model"]["merges"]
    if change == "order":
        pairs[10], pairs[900] = pairs[900], pairs[10]
    elif change == "unreachable":  # "bc" is merged first, so "ab" + "c" never meet, while "a" + "bc" are neighbours
        byte = list(K._byte_of())
        spec["model"] = {**spec["model"], "vocab": {**{c: i for i, c in enumerate(byte)}, "bc": 256, "ab": 257, "abc": 258},
                         "merges": [["b", "c"], ["a", "b"], ["ab", "c"]]}
    else:
        spec["pre_tokenizer"]["add_prefix_space"] = True
    path = str(tmp_path / "t.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(spec, f)
    assert K.same_ranks(path, Tokenizer.from_file(path)) is None
    if change != "prefix":  # no line feed is a token of its own there
        assert K.Ids(path).whole("abc") is None
