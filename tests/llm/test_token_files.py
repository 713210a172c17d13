"""Token files against the whole tokenizer, and their layout."""

import random
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from storkline.llm import token_files
from storkline.llm.queries import QUERIES, tokenizer_path
from test_operators import CLASHES, TYPE, some_rows

BYTE_BPE = tokenizer_path("byte_bpe_50k.json")
ODD = [
    "it's 3² ½ cafés'll  \t\n x", "<|endoftext|> in a text", "你好 \U0001f600 mixed", "a b\x0b\x1cc", "   ", "\n\n x\n", "<| no token |>",
    "don't DON'T 're 'VE", "1234567890 12a34", "İstanbul æøå ¿qué?",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(BYTE_BPE)


def test_ids_of_texts(tokenizer, monkeypatch):
    found = token_files.PieceTokenizer(BYTE_BPE)
    rng = random.Random(3)
    texts = [r[1] for r in some_rows()] + ODD
    texts += ["".join(rng.choice(" \n'aeslltdvr12é²-_.ß") for _ in range(rng.randint(0, 300))) for _ in range(300)]
    for size in (token_files.SLICE_CHARS, 7):
        monkeypatch.setattr(token_files, "SLICE_CHARS", size)
        for text in texts:
            assert found.encode(text).tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids, text
    monkeypatch.setattr(token_files, "REMEMBERED_PIECES", 10)
    assert all(found.encode(t).tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts[:60])


def test_ids_of_batches(tokenizer, monkeypatch):
    rng = random.Random(8)
    letters = ["  \n\t\r'''aeslltdvrem12.,!-", " \n'aeslltdvr12é²-_.ß", " 'slA\x0b\x1c\x7f\u00a0\u2003é你\U0001f600.\u00ad ȿ", "ab "]
    texts = [None, "", *ODD, *("".join(rng.choice(letters[i % 4]) for _ in range(rng.randint(0, 40))) for i in range(4000)), "a" * 3000]
    texts[::50] = [f"{t}<|endoftext|>x" for t in texts[::50]]
    expected = [tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]
    for size, remembered in [(token_files.SLICE_CHARS, 1000), (50, 1000), (1000, 20)]:
        monkeypatch.setattr(token_files, "SLICE_CHARS", size)
        monkeypatch.setattr(token_files, "REMEMBERED_PIECES", remembered)
        found = token_files.PieceTokenizer(BYTE_BPE)
        for rows in (slice(0, 0), slice(0, 1), slice(0, None), slice(7, 900), slice(900, None)):
            ids, counts = found.encode_all(pa.array(texts, pa.string())[rows])
            assert counts.tolist() == [len(e) for e in expected[rows]] and ids.tolist() == sum(expected[rows], [])


def test_pieces_are_worked_out_once(monkeypatch):
    """All new pieces of a slice at once, each once, and the frequent ones not again after a full memory."""
    found, learned = token_files.PieceTokenizer(BYTE_BPE), []
    learn = found.learn
    monkeypatch.setattr(found, "learn", lambda fresh: learned.append(sorted(fresh)) or learn(fresh))
    monkeypatch.setattr(token_files, "REMEMBERED_PIECES", 40)
    often = [f"some words, and: don't stop {i % 3}" for i in range(300)]
    pieces = sorted([b"some", b" words", b",", b" and", b":", b" don", b"'t", b" stop", b" 0", b" 1", b" 2"])
    found.encode_all(pa.array(often))
    assert learned == [pieces]
    found.encode_all(pa.array([*often, " rare" + "!" * 3]))
    found.encode_all(pa.array([" ".join(chr(0x41 + i) * 3 for i in range(26)) + " x" * 9 + " y z" + "".join(f" a{i}" for i in range(9))]))
    assert len(found.known) > 40
    learned.clear()
    found.encode_all(pa.array(often))
    assert len(found.known) < 40 and not learned
    found.encode_all(pa.array(["b" * 100, "b" * 100]))
    assert learned == [[b"b" * 100]] and b"b" * 100 not in found.known


@pytest.mark.parametrize("planes", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 64, 65, 1000])
def test_planes_of_blocks(tmp_path, planes, n):
    ids = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32) >> np.uint32(n % 29)
    store = fs.LocalFileSystem()
    writer = token_files.PlaneWriter(store.open_output_stream(str(tmp_path / "x")), 64, planes)
    cut = n // 3
    for at, (a, z) in enumerate([(0, cut), (cut, n)]):
        writer.add(np.array([at - 5]), np.array([False]), np.array([z - a]), ids[a:z])
    assert writer.close() == (2, n)
    reader = token_files.PlaneReader(store, str(tmp_path / "x"))
    assert len(reader.index) == -(-n // 64) and reader.planes == token_files.PLANES[planes]
    assert [x.tolist() for x in reader.documents()] == [[-5, -4], [0, 0], [cut, n - cut]]
    for a, z in [(0, n), (0, 1), (63, 66), (n // 2, n), (5, 5), (n, n + 9)]:
        assert reader.ids(a, z).tolist() == ids[a:z].tolist()


def expected_rows(tokenizer, rows):
    out, start = [], 0
    for doc, _, ids in sorted(((r[0], r[1], [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0]) for r in rows),
                              key=lambda x: (x[0] is not None, x[0] or 0)):
        out.append((doc, len(ids), crc32(np.array(ids, "<u4").tobytes())))
    return out


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_round_trip(spark, tokenizer, tmp_path, planes):
    rows = some_rows() + [(1000 + i, t, "en", "s", 1) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, TYPE).repartition(5).withColumns({c: F.lit("clash") for c in CLASHES})
    folder = str(tmp_path / "ids")
    token_files.write_ids(docs, folder, BYTE_BPE, planes=planes, block_ids=500)
    found = token_files.read_ids(spark, folder, keep_ids=True).orderBy("start").collect()
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in found), key=repr) == sorted(expected_rows(tokenizer, rows), key=repr)
    ids = [r.doc_id for r in found]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    whole, upto = b"".join(r.ids for r in found), 0
    for r in found:
        assert r.start == upto and crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.n_tokens
        upto += r.n_tokens
    values = np.frombuffer(whole, "<u4")
    for a, z in [(0, upto), (499, 1501), (upto - 3, upto + 5), (10, 10)]:
        assert token_files.ids_between(spark, folder, a, z).tolist() == values[a:z].tolist()


def test_no_documents(spark, tmp_path):
    folder = str(tmp_path / "none")
    token_files.write_ids(spark.createDataFrame([], TYPE), folder, BYTE_BPE)
    assert token_files.read_ids(spark, folder).isEmpty()


def test_query(spark, tokenizer, tmp_path):
    rows = [r for r in some_rows() if r[0] is not None][:50]
    rows = list({r[0]: r for r in rows}.values())
    spark.createDataFrame(rows, TYPE).write.parquet(str(tmp_path / "documents.parquet"))
    expected, start = [], 0
    for doc, n, crc in expected_rows(tokenizer, rows):
        expected.append((doc, start, n, crc))
        start += n
    found = QUERIES["op11_token_files"](spark, str(tmp_path)).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(tuple(r) for r in found.collect()) == expected
