"""The pipeline's stages on small documents, and the registered names."""

import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from brute import jaccard_components, lines_removed, words
from storkline.llm import mixing, quality_classifier
from storkline.llm.queries import QUERIES, tokenizer_path


def test_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} and {*QUERIES, "pipeline"} <= names
    assert set(entry.oracle_sql()) <= names


def test_stages(spark, tmp_path):
    rng = random.Random(2)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)) + "."
    rows = [(i, prose(80), "en", f"s{i % 2}", 1) for i in range(120)]
    rows += [(200 + i, rows[i][1] + " extra", "en", "s0", 1) for i in range(10)]
    rows += [(300 + i, "THE!! $$$ ### " * 20 + str(i), "en", "s1", 1) for i in range(60)]
    rows += [(400, None, None, None, None), (401, "", "en", "s1", 0), (402, prose(80), "en", None, 9)]
    rows += [rows[5]] * 2
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("row", F.lit(1))
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(r[0], int(not 300 <= r[0] < 400)) for r in rows if r[0] < 400]
    spark.createDataFrame(labels, "doc_id long, quality int").distinct().write.parquet(str(tmp_path / "labels.parquet"))

    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.columns
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs
        assert name == "pack" or docs.columns == before
    ids = {name: {r[0] for r in df.select("doc_id").collect()} for name, df in seen.items()}
    assert not any(300 <= i < 400 for i in ids["quality"]) and set(range(120)) <= ids["quality"]
    assert seen["lines"].count() == seen["quality"].count()
    groups = len(set(jaccard_components([r.text for r in seen["lines"].collect()])))
    assert seen["near_copies"].count() == groups and set(range(120)) <= ids["near_copies"]
    assert seen["mix"].groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    assert ids["pack"] == ids["mix"]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == seen["pack"].count()


def test_stages_against_plain_versions(spark, tmp_path):
    """Each stage's rows worked out from its own input.

    The classifier's training and features and the sources' targets are the operators' own; they have tests in
    ``test_operators.py``.
    """
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    line = lambda: " ".join(rng.choice(vocabulary) for _ in range(9))
    shared = [line() for _ in range(15)]
    texts = ["\n".join([line() for _ in range(rng.randint(3, 14))]) for _ in range(90)]
    texts += ["\n".join([line(), *shared, line(), line()]) for _ in range(6)]
    texts += [texts[0], texts[1] + " end", texts[2].upper(), texts[2], "\n".join(line() for _ in range(400)), None, ""]
    junk = ["BUY!! $$$ ### " * rng.randint(5, 40) + str(i) for i in range(40)]
    rows = [(i, t, "en", rng.choice(["a", "b", None]), 7) for i, t in enumerate(texts + junk)]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i < len(texts))) for i, t, *_ in rows if t]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    held, kept = spark.read.parquet(f"{folder}/documents.parquet"), [spark.read.parquet(f"{folder}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, held, folder).write.parquet(f"{folder}/{name}")
        held = spark.read.parquet(f"{folder}/{name}")
        kept.append(held)
    whole, good, lined, single, mixed = ([tuple(r) for r in df.collect()] for df in kept[:5])
    packed = kept[5].collect()

    # quality: log odds of a text are the mean of its features' numbers, one text after the other
    sample = sorted((i, t or "") for i, t, *_ in rows if t and crc32(str(i).encode()) % 5)
    part, constant = quality_classifier.train([t for _, t in sample], [int(i < len(texts)) for i, _ in sample])

    def accepted(text):
        buckets, _ = quality_classifier.text_features(quality_classifier.pa.array([text or ""]))
        odds = part[buckets].mean(dtype=np.float64) + constant if len(buckets) else constant
        return 1 / (1 + np.exp(-odds)) >= 0.3

    assert sorted(good, key=repr) == sorted((r for r in whole if accepted(r[1])), key=repr)
    assert {i for i, *_ in good} >= {i for i, t in enumerate(texts) if t} and all(i < len(texts) for i, *_ in good)

    # lines: repeated chunks go, later ones by id; the count of characters follows
    cut = {doc: (gone, text) for doc, _, _, gone, text in lines_removed([(r[0], r[1], r[3]) for r in good])}
    expected = [(d, cut[d][1], la, so, len(cut[d][1]) if cut[d][0] else n) for d, _, la, so, n in good]
    assert sorted(lined, key=repr) == sorted(expected, key=repr) and any(gone for gone, _ in cut.values())

    # near copies: the smallest id of every component, whole row
    label = jaccard_components([r[1] for r in lined])
    first = {c: min(r[0] for r, x in zip(lined, label) if x == c) for c in label}
    assert sorted(single, key=repr) == sorted((r for r in lined if r[0] in set(first.values())), key=repr)
    assert len(single) < len(lined)

    # mix: whole rows at most twice, every source near its target
    size, taken, copies = Counter(), Counter(), Counter(mixed)
    for r in single:
        size[r[3]] += len(words(r[1]))
    for r in mixed:
        taken[r[3]] += len(words(r[1]))
    longest = max(len(words(r[1])) for r in single)
    assert set(copies) <= set(single) and max(copies.values()) <= 2
    for source, target in mixing.source_targets(dict(size)).items():
        assert taken[source] == pytest.approx(target, abs=longest)

    # pack: every token of every copy once, sequences gapless and within their length
    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = {r[0]: [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0] for r in mixed}
    pieces = Counter()
    for r in mixed:
        for at in range(0, len(ids[r[0]]), 2048):
            values = ids[r[0]][at : at + 2048]
            pieces[r[0], at // 2048, at, len(values), crc32(np.array(values, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == pieces
    places = {}
    for r in packed:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held_places in places.values():
        upto = 0
        for offset, length in sorted(held_places):
            assert offset == upto
            upto += length
        assert upto <= 2048


def test_no_documents(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).isEmpty()
