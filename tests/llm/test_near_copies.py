"""Near copies against all pairs of texts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import jaccard_components
from storkline.llm import near_copies, substring_dedup, words
from test_operators import CLASHES, TYPE, some_rows


def vocabulary(rng, n=900):
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def edited(rng, text, edits, words_):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = rng.choice(words_)
    return " ".join(w)


def groups(found):
    """Ids that share a component, as a set of sets of rows' numbers."""
    out = {}
    for r in found.select("n", "component_id").collect():
        out.setdefault(r.component_id, set()).add(r.n)
    return {frozenset(x) for x in out.values()}


def expected(texts):
    out = {}
    for i, c in enumerate(jaccard_components(texts)):
        out.setdefault(c, set()).add(i)
    return {frozenset(x) for x in out.values()}


def marked(spark, texts):
    frame = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, n int").repartition(4)
    return near_copies.mark_near_copies(frame)


@pytest.mark.parametrize("tile", [40, 2048])
def test_groups_against_all_pairs(spark, monkeypatch, tile):
    """A large group around one text, chains, a passage that many share, and prose."""
    monkeypatch.setattr(near_copies, "TILE_ROWS", tile)
    rng = random.Random(11)
    known = vocabulary(rng)
    prose = lambda n: " ".join(rng.choice(known) for _ in range(n))
    base, passage = prose(150), prose(120)
    texts = [edited(rng, base, rng.randint(0, 4), known) for _ in range(150)]
    texts += [f"{passage} {prose(rng.randint(5, 60))}" for _ in range(60)]
    for _ in range(20):
        chain = [prose(90)]
        for _ in range(6):
            chain.append(edited(rng, chain[-1], 1, known))
        texts += chain
    texts += [prose(rng.randint(1, 80)) for _ in range(150)]
    rng.shuffle(texts)
    assert groups(marked(spark, texts)) == expected(texts)


def test_messy_rows(spark):
    rows = some_rows() + [(7000, "word " * 100_000, "en", "s", 1), (7001, "x" * 300_000, "en", "s", 1)]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], TYPE + ", n int").repartition(3)
    clashes = [c for c in (*CLASHES, "bands", "sketch", "leader", "label", "a", "b") if c != "n"]
    found = near_copies.mark_near_copies(docs.withColumns({c: F.lit("clash") for c in clashes}), prefix="_c_")
    names = {}
    label = jaccard_components([r[1] for r in rows])
    for i, c in enumerate(label):
        names.setdefault(c, []).append(rows[i][0])
    least = {c: min((x for x in ids if x is not None), default=None) for c, ids in names.items()}
    got = {r.n: r._c_component_id for r in found.select("n", "_c_component_id").collect()}
    assert got == {i: least[c] for i, c in enumerate(label)}
    first = [r.n for r in found.filter("_c_first").select("n").collect()]
    assert sorted(label[i] for i in first) == sorted(set(label))
    assert set(clashes) <= set(found.columns)
    assert near_copies.mark_near_copies(spark.createDataFrame([], TYPE)).isEmpty()


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") & 1] for i in range(n))


@pytest.mark.parametrize("n", [1024, 512, 4096])
def test_words_that_polynomials_confuse(spark, n):
    one = thue_morse(n)
    other = one.translate(str.maketrans("ab", "ba"))
    rest = " ".join(f"w{i}" for i in range(19))
    docs = spark.createDataFrame([(1, f"{one} {rest}"), (2, f"{other} {rest}")], "doc_id long, text string")
    assert [r.n_removed for r in substring_dedup.remove_repeats(docs).collect()] == [0, 0]
    short = spark.createDataFrame([(1, one, 0), (2, other, 1)], "doc_id long, text string, n int")
    assert len(groups(near_copies.mark_near_copies(short))) == 2


def test_word_hashes():
    rng = random.Random(2)
    held = ["a", "aa", "a\0", "\0", "é", "abcdefgh", "abcdefghi", "x" * 1024, "x" * 1025, "x" * 5000]
    held += ["".join(rng.choice("ab") for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    held = list(dict.fromkeys(held))
    data = np.frombuffer(" ".join(held).encode(), np.uint8)
    starts, ends, _ = words.word_spans(data, np.array([0, len(data)]))
    hashes = words.word_hashes(data, starts, ends)
    assert len(starts) == len(held) == len(set(hashes.tolist()))
    again = np.frombuffer(("z " + " ".join(held[::-1])).encode(), np.uint8)
    starts, ends, _ = words.word_spans(again, np.array([0, len(again)]))
    assert words.word_hashes(again, starts, ends)[1:][::-1].tolist() == hashes.tolist()


def test_fingerprint_trees_give_candidates(spark, monkeypatch):
    """Without a bucket of the bands, texts with fingerprints within the trees' reach are still compared; others are not."""
    plain = near_copies.signatures

    def apart(hashes, begins):
        keys, buckets, sketch = plain(hashes, begins)
        return keys, keys[:, None] + np.arange(buckets.shape[1], dtype=np.uint64), sketch

    monkeypatch.setattr(near_copies, "signatures", apart)
    draw = random.Random(7)
    long = [f"w{draw.randrange(10_000)}" for _ in range(4000)]
    near, other = [*long[:-1], "changed"], [f"v{draw.randrange(10_000)}" for _ in range(4000)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate([long, other, near])], "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in near_copies.mark_near_copies(docs).collect()}
    assert found == {0: 0, 1: 1, 2: 0}


def test_no_link_depends_on_rounds_and_partners(spark, monkeypatch):
    """Many texts around the similarity, where the closest by their minima are not those that are similar."""
    monkeypatch.setattr(near_copies, "PARTNERS", 1)
    monkeypatch.setattr(near_copies, "MAX_ROUNDS", 1)
    monkeypatch.setattr(near_copies, "TILE_ROWS", 16)
    rng = random.Random(3)
    known, texts = vocabulary(rng), []
    base = [rng.choice(known) for _ in range(200)]
    for _ in range(60):
        w = list(base)
        for at in rng.sample(range(4, 196, 5), 3):
            w[at] = f"other{rng.randrange(6)}x{at}"
        texts.append(" ".join(w))
    assert groups(marked(spark, texts)) == expected(texts)


def test_links_beyond_the_closest(spark, monkeypatch):
    """Two similar texts of one bucket, each with more other texts closer to it by their minima than a round compares."""
    plain = near_copies.signatures

    def decoyed(hashes, begins):
        keys, buckets, sketch = plain(hashes, begins)
        buckets = keys[:, None] + np.arange(buckets.shape[1], dtype=np.uint64)
        buckets[:, 0] = 1
        sketch = np.zeros_like(sketch)
        sketch[np.diff(begins) == 47, 115:] = 1
        return keys, buckets, sketch

    monkeypatch.setattr(near_copies, "signatures", decoyed)
    rng = random.Random(5)
    prose = lambda n: [f"w{rng.randrange(10_000)}" for _ in range(n)]
    one = prose(50)
    other = [*one[:2], "changed", *one[3:], "more"]
    texts = [one, other, *(prose(50) for _ in range(6)), *(prose(51) for _ in range(6))]
    found = groups(marked(spark, [" ".join(w) for w in texts]))
    assert found == {frozenset((0, 1)), *(frozenset((i,)) for i in range(2, 14))}
