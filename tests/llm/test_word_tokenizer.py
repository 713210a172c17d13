"""The tokenizer of operator 6: what a worker remembers never changes ids."""

import random

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from storkline.llm import packing
from storkline.llm.queries import tokenizer_path

ODD = ["don't", "\u0130stanbul", "e\u0301t\u00e9", "\u00c9T\u00c9", "x\u00a0y", "a<|endoftext|>b", "<", "\u65e5\u672c", "12ab!!", "A'S", "\x1cq", "\u01c5", "\u00aa"]


def test_frequent_words_stay_known(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED_WORDS", 60)
    monkeypatch.setattr(packing, "REMEMBERED_PIECES", 40)
    words, whole = packing.WordTokenizer(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    draw, letters = random.Random(3), "abcdefgh\u00e9\u00d8"
    for _ in range(30):
        rare = ["".join(draw.choices(letters, k=6)) + draw.choice(["", "&&", "'s"]) for _ in range(20)]
        text = " ".join(["The", "cat", "The", "cat", *ODD, *rare, *ODD])
        ids, begins = words.encode(pa.array([text, None, "The  cat\n"]))
        parts = [ids[a : z - 1].tolist() for a, z in zip(begins, begins[1:])]
        assert parts == [whole.encode(t, add_special_tokens=False).ids for t in (text, "", "The cat")]
        assert begins[-1] == len(ids) and not ids[begins[1:] - 1].any()
    assert len(words.known) < 130 and len(words.pieces) + len(words.older_pieces) < 200
    # the words of every text are known through it all, and their ids still stand where they should
    words.forget()
    assert {b"The", b"cat"} <= set(words.known) and len(words.known) <= 30
    n = words.known[b"cat"]
    assert words.ids[words.begins[n] : words.begins[n + 1]].tolist() == whole.encode("cat", add_special_tokens=False).ids


def test_new_pieces_reach_the_model_in_one_call(monkeypatch):
    words, calls = packing.WordTokenizer(tokenizer_path()), []

    class Counted:
        def encode_batch_fast(self, texts, **more):
            calls.append(texts)
            return bare.encode_batch_fast(texts, **more)

    bare, words.bare = words.bare, Counted()
    text = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}x!" for i in range(400))
    ids, _ = words.encode(pa.array([text]))
    assert len(calls) == 1 and ids[:-1].tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids
    # a model that marks no last token gets its pieces one by one, to the same ids
    plain = packing.WordTokenizer(tokenizer_path())
    plain.closes[:] = False
    assert np.array_equal(plain.encode(pa.array([text]))[0], ids)


def test_words_share_the_pieces_they_have_in_common():
    words = packing.WordTokenizer(tokenizer_path())
    texts = ["cat, (cat) cat's\t'cat' dog!cat", "Cat'S caf\u00e9\u00d7caf\u00e9 12", "a<cat \u65e5cat \u0130's cat"]
    ids, begins = words.encode(pa.array(texts))
    assert [ids[a : z - 1].tolist() for a, z in zip(begins, begins[1:])] == [
        words.tokenizer.encode(t, add_special_tokens=False).ids for t in texts
    ]
    whole = {w.encode() for w in ("a<cat", "\u65e5cat", "\u0130's")}
    assert set(words.known) == whole | {w.encode() for w in (
        "cat", ",", "(", ")", "'s", "'", "dog", "!", "Cat", "'S", "caf\u00e9", "\u00d7", "1", "2"
    )}


def test_cut_on_bytes_is_the_tokenizers():
    words, other = packing.WordTokenizer(tokenizer_path()), packing.WordTokenizer(tokenizer_path())
    other.learn_kinds(".")  # not the usual expression: words stay whole
    draw, latin = random.Random(7), "".join(map(chr, range(0x20, 0x250)))
    pools = ["'sSmtdreEvl'' 1!\n", latin, "\u00b2\u00aa\u00d7\u00c9'12 ab!", "".join(ODD) + " '\x0b\x1c"]
    for _ in range(60):
        texts = ["".join(draw.choices(draw.choice(pools), k=draw.randrange(40))) for _ in range(8)]
        # endings do not reach into the next text
        texts += [draw.choice(["x'", "'r", "'"]), draw.choice(["s", "e", "ll"]), None]
        wanted = [words.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
        for tokenizer in (words, other):
            ids, begins = tokenizer.encode(pa.array(["", *texts]).slice(1))
            assert [ids[a : z - 1].tolist() for a, z in zip(begins, begins[1:])] == wanted
