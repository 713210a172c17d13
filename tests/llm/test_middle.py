"""Fill-in-the-middle against a plain version; the offset set against a list."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from storkline.llm import middle
from test_operators import CLASHES, TYPE, some_rows


def plain(doc, text):
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(tokens)
    a, z = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(tokens[i:j]) for i, j in ((0, a), (a, z), (z, n)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc, n, "plain", None, None, text, text
    form = "spm" if h[3] % 100 < 20 else "psm"
    return doc, n, form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}", text


@pytest.mark.parametrize("values", [
    [0], [65535], [3, 70_000, 70_001], list(range(200_000)), list(range(0, 200_000, 2)), list(range(0, 200_000, 17)),
    [*range(5, 900), *range(65_530, 65_540), *range(140_000, 210_000, 3)],
])
def test_offset_set(values):
    array = np.array(values, np.int64)
    for parts in ([array], [p for p in np.array_split(array, 7) if len(p)]):
        held = middle.OffsetSet(iter(parts))
        assert len(held) == len(values)
        assert [held.select(k) for k in range(0, len(values), max(1, len(values) // 997))] == values[:: max(1, len(values) // 997)]
        assert held.select(len(values) - 1) == values[-1]


def test_kinds_of_containers():
    kinds = [type(middle.container(np.array(v))).__name__ for v in (range(60_000), range(0, 60_000, 2), range(0, 60_000, 20), range(3))]
    assert kinds == ["RunContainer", "BitmapContainer", "ArrayContainer", "RunContainer"]


def test_forms(spark, monkeypatch):
    rng = random.Random(8)
    rows = some_rows() + [(2000 + i, t, "en", "s", 1) for i, t in enumerate(["<P> held", "a<S>b", "x <M>", "é\U0001f600a你b", "<P", "ab<", "\x00a\x00"])]
    rows += [(3000 + i, "".join(rng.choice("ab \n<>PSMé你\U0001f600") for _ in range(rng.randint(1, 90))), "en", "s", 1) for i in range(200)]
    rows += [(5000, "word é " * 40_000, "en", "s", 1), (5001, "x" * 300_000, "en", "s", 1)]
    docs = spark.createDataFrame(rows, TYPE).repartition(3).withColumns({c: F.lit("clash") for c in CLASHES})
    found = middle.fill_in_middle(docs).withColumn("restored", middle.restored(F.col("output"), F.col("form")))
    expected = sorted((plain(r[0], r[1]) for r in rows), key=repr)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected
    assert {e[2] for e in expected} == {"plain", "psm", "spm"}
    assert middle.fill_in_middle(spark.createDataFrame([], TYPE)).isEmpty()


def test_slices_of_one_text(monkeypatch):
    text = "".join(random.Random(1).choice("abé你 \U0001f600") for _ in range(500))
    starts = [m.start() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text)] + [len(text)]
    for size in (1, 2, 3, 64, 10_000):
        monkeypatch.setattr(middle, "SLICE_BYTES", size)
        data = np.frombuffer(text.encode(), np.uint8)
        assert np.concatenate(list(middle.token_starts(data))).tolist() == starts
