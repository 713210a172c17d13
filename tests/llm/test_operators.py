"""Every operator on messy rows: nulls, empty and very long texts, ties, repeated rows, clashing names."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from storkline.llm import (
    components, exact_dedup, line_dedup, mixing, packing, quality_classifier, quality_rules, sharding, simhash,
    substring_dedup, warc,
)
from storkline.llm.queries import tokenizer_path
from brute import (
    BLANKS, base_features, components as plain_components, digest32, fingerprint, fold, lines_removed, repeats_removed, sha, words,
)

CLASHES = (
    "size target source_size copies taken row key fp at n kept shard bytes depth score predicted held_out first component_id "
    "fingerprint words hashes bucket _id _text _h _row _key _lines _ends doc id runs start mask length piece n_lines n_words kept_text"
).split()
TYPE = "doc_id long, text string, lang string, source string, n_chars long"


def some_rows():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeéßñ") for _ in range(rng.randint(1, 8))) for _ in range(400)]

    def prose(n):
        out = []
        for i in range(n):
            word = rng.choice(vocabulary)
            out.append((word.title() if rng.random() < 0.1 else word) + rng.choice(["", "", "", ".", ",", "\n"]))
        return rng.choice([" ", "  ", "\t"]).join(out)

    passage = prose(60)
    lines = [prose(8).replace("\n", " ") for _ in range(12)]
    texts = [prose(rng.randint(1, 150)) for _ in range(40)]
    texts += [f"{prose(30)} {passage} {prose(30)}" for _ in range(6)]
    texts += ["\n".join([prose(4), *lines[i : i + 8], prose(4)]) for i in range(5)]
    texts += [texts[0], texts[0].replace(" ", "\t\n"), texts[41], passage, passage + " end", "a", "A", "  ", "\n\n", ""]
    texts += ["THE!! " * 30, "x*** y### z%%% " * 20, (prose(9) + "\n") * 30, "one two three four"]
    texts += [prose(3000).replace("\n", " "), prose(20_000)]
    rows = [(i, t, "en", f"s{i % 3}" if i % 5 else "hot", len(t)) for i, t in enumerate(texts)]
    rows += [(900, None, None, None, None), (901, None, "en", "s1", 0), (None, texts[3], "en", None, 1), (None, "no id", "en", "hot", 1)]
    return rows + [rows[2]] * 3 + [rows[45]] * 2 + [(902, "same text here", "de", "s2", 3)] * 4


@pytest.fixture(scope="module")
def rows():
    return some_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    frame = spark.createDataFrame(rows, TYPE).repartition(3)
    return frame.withColumns({c: F.lit("clash") for c in CLASHES})


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], TYPE)


def plain(rows):
    return [(r[0], r[1], r[3]) for r in rows]


def sorted_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_base_of_quality_rules(docs, rows, no_docs):
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    found = quality_rules.score_documents(docs)
    assert sorted_rows(found, *columns) == sorted(((r[0], *base_features(r[1])) for r in rows), key=repr)
    assert found.filter("kept and base_failed").isEmpty() and found.filter("probability is null").isEmpty()
    assert quality_rules.score_documents(no_docs).isEmpty()


def test_quality_rules_by_accuracy(spark):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(500)]
    sentence = lambda: " ".join(rng.choice(vocabulary) for _ in range(12)).capitalize() + "."
    rows = [(i, " ".join(sentence() for _ in range(2 + i % 6))) for i in range(200)]
    rows += [(1000 + i, " | ".join(f"menu{i}x{j}" for j in range(40))) for i in range(20)]
    kept = dict(quality_rules.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "kept").collect())
    assert all(not kept[1000 + i] for i in range(20))
    assert sum(kept[i] for i in range(200)) >= 190


def test_substrings(docs, rows, no_docs):
    found = substring_dedup.remove_repeats(docs)
    assert sorted_rows(found, "doc_id", "n_words", "n_removed", "kept_text") == sorted(repeats_removed(plain(rows)), key=repr)
    assert substring_dedup.remove_repeats(no_docs).isEmpty()


def test_substrings_with_hot_anchors_and_a_full_sketch(docs, rows, monkeypatch):
    """Every window passes the sketch or is reduced in parts first; the result is the same."""
    expected = sorted(repeats_removed(plain(rows)), key=repr)
    monkeypatch.setattr(substring_dedup, "HOT_ROWS", 2)
    assert sorted_rows(substring_dedup.remove_repeats(docs), "doc_id", "n_words", "n_removed", "kept_text") == expected
    monkeypatch.setattr(substring_dedup, "HOT_CELLS", 1)
    monkeypatch.setattr(substring_dedup, "MAX_BITS", 16)
    assert sorted_rows(substring_dedup.remove_repeats(docs), "doc_id", "n_words", "n_removed", "kept_text") == expected


def test_lines(docs, rows, no_docs):
    found = line_dedup.remove_repeated_chunks(docs, prefix="new_")
    columns = ["doc_id", "new_n_lines", "new_n_chunks", "new_n_removed", "new_kept_text"]
    assert sorted_rows(found, *columns) == sorted(lines_removed(plain(rows)), key=repr)
    assert found.select(*docs.columns).schema.names == docs.columns
    assert line_dedup.remove_repeated_chunks(no_docs).isEmpty()


def test_line_boundaries_resist_shifts(spark):
    lines = [f"line number {i} of a long page" for i in range(200)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(["something new", *lines[:90], "inserted", *lines[90:]]))]
    found = line_dedup.remove_repeated_chunks(spark.createDataFrame(rows, "doc_id long, text string"))
    # what meets the new lines at the start and inside grows on from the chunks beside them
    kept = {r.doc_id: r.kept_text for r in found.collect()}
    assert kept == {1: "\n".join(lines), 2: "something new\ninserted"}


def test_copies_lose_all_lines_but_the_first(spark):
    rng = random.Random(9)
    pages = [[f"{rng.random()} words of line {i}" for i in range(n)] for n in (1, 2, 3, 4, 7, 30) for _ in range(4)]
    rows = [(100 * copy + i, "\n".join(page)) for copy in range(3) for i, page in enumerate(pages)]
    found = line_dedup.remove_repeated_chunks(spark.createDataFrame(rows, "doc_id long, text string"))
    size = {i: len(page) for i, page in enumerate(pages)}
    expected = {d: size[d % 100] if d >= 100 and size[d % 100] > 1 else 0 for d, _ in rows}
    assert dict(found.select("doc_id", "n_removed").collect()) == expected
    # without a repeated chunk of so many lines nothing goes
    wide = line_dedup.remove_repeated_chunks(spark.createDataFrame(rows, "doc_id long, text string"), min_lines=5)
    assert dict(wide.select("doc_id", "n_removed").collect()) == {d: n if size[d % 100] >= 5 else 0 for d, n in expected.items()}


def test_losing_texts_travel_once_and_by_key(spark):
    """Not by a broadcast of what goes from them while that is small, which hides what larger tables move."""
    lines = [f"line number {i} of a long page" for i in range(40)]
    docs = spark.createDataFrame([(i, "\n".join(lines[i:]), i % 3) for i in range(9)], "doc_id long, text string, n int")
    found = line_dedup.remove_repeated_chunks(docs)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") == 2
    rows = re.findall(r"struct\(([^()]*)\) AS _row#", found._jdf.queryExecution().analyzed().toString())
    assert rows and all("text" not in r and "doc_id" not in r for r in rows)
    assert [r.n for r in found.orderBy("doc_id").collect()] == [i % 3 for i in range(9)]


def test_exact(docs, rows, no_docs):
    norm = [(r[0], BLANKS.sub(" ", r[1] or "")) for r in rows]
    groups = defaultdict(list)
    for doc, text in norm:
        groups[text].append(doc)
    found = exact_dedup.exact_duplicates(docs, digest_all=True)
    expected = [(d, min((x for x in groups[t] if x is not None), default=None), len(groups[t]), sha(t)) for d, t in norm]
    assert sorted_rows(found, "doc_id", "keep_id", "group_size", "text_sha256") == sorted(expected, key=repr)
    kept = [tuple(r) for r in found.filter("kept").select("doc_id", "text_sha256").collect()]
    assert Counter(t for _, t in kept) == Counter({sha(t): 1 for t in groups})
    assert exact_dedup.exact_duplicates(docs).filter("group_size > 1 and text_sha256 is null").isEmpty()
    assert exact_dedup.exact_duplicates(no_docs).isEmpty()


def test_near_duplicates(docs, rows, no_docs):
    prints = [fingerprint(r[1]) for r in rows]
    label = plain_components(prints)
    least = {c: min((r[0] for r, x in zip(rows, label) if x == c and r[0] is not None), default=None) for c in set(label)}
    found = simhash.near_duplicates(docs)
    expected = [(r[0], f"{p:016x}", least[c]) for r, p, c in zip(rows, prints, label)]
    assert sorted_rows(found, "doc_id", "fingerprint", "component_id") == sorted(expected, key=repr)
    marked = simhash.near_duplicates(docs, keep_columns=True, prefix="_c_")
    assert marked.filter("_c_first").count() == len(set(label))
    assert set(docs.columns) <= set(marked.columns)
    assert simhash.near_duplicates(no_docs).isEmpty()


@pytest.mark.parametrize("tile", [8, 1 << 14])
def test_links_of_fingerprints(spark, monkeypatch, tile):
    """A dense ball, a chain and noise, with shards cut into tiles and whole."""
    rng = np.random.default_rng(3)
    ball = [0x0123456789ABCDEF ^ int(sum(1 << int(b) for b in rng.choice(64, 2, replace=False))) for _ in range(60)]
    chain = [((1 << (3 * i)) - 1) << 1 for i in range(20)]
    noise = rng.integers(0, 1 << 63, 300).tolist()
    prints = sorted({*ball, *chain, *noise, 0, (1 << 64) - 1})
    monkeypatch.setattr(simhash, "TILE_ROWS", tile)
    monkeypatch.setattr(simhash, "LEAF_ROWS", 8)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), 4)
    found = dict(components.connected_components(links).collect())
    groups = defaultdict(set)
    for (s,), c in zip(signed, plain_components(prints)):
        groups[c].add(s)
    named = defaultdict(set)
    for (s,) in signed:
        named[found.get(s, s)].add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, named.values()))


def test_mixing(docs, rows, no_docs):
    found = [r.asDict() for r in mixing.mix_sources(docs, keep_columns=True, prefix="_m_").collect()]
    size = Counter()
    for r in rows:
        size[r[3]] += len(words(r[1]))
    targets = mixing.source_targets(dict(size))
    taken = Counter()
    for r in found:
        assert r["_m_size"] == len(words(r["text"])) and r["_m_taken"] == r["_m_copies"] * r["_m_size"] <= 2 * r["_m_size"]
        assert r["_m_source_size"] == size[r["source"]] and r["_m_target"] == targets[r["source"]]
        taken[r["source"]] += r["_m_taken"]
    assert len(found) == len(rows)
    assert sum(targets.values()) == pytest.approx(1.5 * sum(size.values()))
    longest = {s: max(len(words(r[1])) for r in rows if r[3] == s) for s in size}
    for s, t in targets.items():
        assert t <= 2 * size[s] and abs(taken[s] - t) <= longest[s]
    once, again = mixing.mix_sources(docs).collect(), mixing.mix_sources(docs).collect()
    assert sorted(map(tuple, once), key=repr) == sorted(map(tuple, again), key=repr)
    assert mixing.mix_sources(no_docs).isEmpty()


def test_targets_share_what_full_sources_cannot_take():
    # 150 % of 140 = 210 by 3, 1, 2: 105, 35, 70; a stops at 20, then c at 40, and b gets the rest
    assert mixing.source_targets({"a": 10, "b": 110, "c": 20}) == {"a": 20.0, "b": 150.0, "c": 40.0}
    assert mixing.source_targets({}) == {} and mixing.source_targets({None: 0, "z": 10}) == {"z": 15.0, None: 0.0}


@pytest.mark.parametrize("seed", range(5))
def test_budgets_against_all_sums(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 40): rng.randint(1, 3) for _ in range(5)}
    sums = {0}
    for s, n in counts.items():
        sums = {x + s * k for x in sums for k in range(n + 1)}
    budget = rng.randint(0, sum(s * n for s, n in counts.items()))
    best = mixing.knapsack(list(counts.items()), budget)
    assert sum(s * n for s, n in best.items()) == max(x for x in sums if x <= budget)
    assert all(n <= counts[s] for s, n in best.items())
    fitted = mixing.fit_budget(counts, budget)
    assert all(n <= counts[s] for s, n in fitted.items())
    assert abs(sum(s * n for s, n in fitted.items()) - budget) == min(abs(x - budget) for x in sums)


def test_large_budgets():
    def miss(counts, budget):
        fitted = mixing.fit_budget(counts, budget)
        assert all(0 < n <= counts[s] for s, n in fitted.items())
        return abs(budget - sum(s * n for s, n in fitted.items()))

    # few long documents: the longest first would take 350,000 and nothing else
    assert miss({350_000: 1, 300_000: 1, 290_000: 1}, 590_000) == 0
    assert mixing.fit_budget({100: 1}, 90) == {100: 1} and mixing.fit_budget({100: 1}, 40) == {}
    rng = random.Random(3)
    many = {rng.randint(1, 10**6): rng.randint(1, 50) for _ in range(5000)}
    assert all(miss(many, int(part * sum(s * n for s, n in many.items()))) == 0 for part in (0.01, 0.1, 0.5, 0.93, 1))
    long = {rng.randint(10**6, 10**7): 1 for _ in range(30)}
    assert miss(long, sum(long) // 2) < 10_000


def test_targets_of_a_table_of_sources(spark):
    rng = random.Random(5)
    sizes = {f"{rng.random()}": rng.choice([0, 3, 10, 500, 10**5, 10**7]) for _ in range(300)} | {None: 77, "": 5, "\U0001f600": 9, "\uffff": 8}
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long").repartition(7)
    found = mixing.target_table(table).collect()
    assert {r.source: r.target for r in found} == mixing.source_targets(sizes) and len(found) == len(sizes)
    assert all(r.full == (r.target // r.source_size if r.source_size else 0) for r in found)
    assert mixing.target_table(table.limit(0)).isEmpty()


def test_packing(docs, rows, no_docs):
    from tokenizers import Tokenizer

    found = packing.pack_documents(docs, tokenizer_path(), 128, keep_ids=True).collect()
    whole = Tokenizer.from_file(tokenizer_path())
    expected = Counter((r[0], tuple([*whole.encode(r[1] or "", add_special_tokens=False).ids, 0])) for r in rows)
    texts, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        texts[r.row].append(r)
        sequences[r.sequence_id].append(r)
    built = Counter()
    for parts in texts.values():
        parts.sort(key=lambda r: r.piece)
        assert [r.start for r in parts] == [128 * r.piece for r in parts] and all(r.length == 128 for r in parts[:-1])
        built[parts[0].doc_id, tuple(np.frombuffer(b"".join(r.ids for r in parts), "<u4").tolist())] += 1
    assert built == expected
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 128
    total = sum(r.length for r in found)
    assert len(sequences) <= 1.02 * -(-total // 128) + 1
    assert packing.pack_documents(no_docs, tokenizer_path()).isEmpty()


@pytest.mark.parametrize("seed", range(3))
def test_plans_use_the_histogram(seed):
    rng = np.random.default_rng(seed)
    histogram = rng.integers(0, 40, 101)
    histogram[0] = 0
    plan = packing.packing_plan(histogram, 100)
    used = Counter()
    for n, content in plan:
        assert sum(content) <= 100
        for x in content:
            used[x] += n
    assert used == Counter({x: int(n) for x, n in enumerate(histogram) if n})
    assert any(len(c) == 2 and sum(c) == 100 and n > 1 for n, c in plan)


def test_sharding(docs, rows, no_docs):
    limit = 3000
    found = sharding.extendible_shards(docs, limit).collect()
    size = Counter()
    for r in found:
        size[r.shard] += r.bytes
    alone = Counter(r.shard for r in found)
    assert sorted((r.doc_id, r.bytes) for r in found if r.doc_id is not None) == sorted((r[0], len((r[1] or "").encode())) for r in rows if r[0] is not None)
    assert all(n <= limit or alone[s] == 1 for s, n in size.items())
    prefixes = sorted({r.shard.partition(".")[0] for r in found})
    assert not any(b.startswith(a) for a, b in zip(prefixes, prefixes[1:]))
    parents = Counter()
    for r in found:
        parents[r.shard.partition(".")[0][:-1]] += r.bytes
    whole = {r.shard[:-1] for r in found if r.depth and "." not in r.shard}
    for parent in whole:
        inside = sum(r.bytes for r in found if r.shard.startswith(parent))
        assert inside > limit
    assert sharding.extendible_shards(no_docs, limit).isEmpty()


@pytest.mark.parametrize("compress", [False, True])
def test_archives(spark, tmp_path, compress):
    pages = [(i, f"http://x/{i}", t) for i, t in enumerate(["a", "b", "a", "", None, "é\r\n\r\nWARC/1.1\r\n", "a", "x" * 300_000])]
    pages += [(None, None, "a"), (50, None, "b"), (50, None, "b"), (3, "http://x/3", "")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"id": F.lit(1), "payload": F.lit("x")})
    path = str(tmp_path / f"archive{compress}")
    warc.write_archive(frame, path, compress=compress)
    archive = warc.read_archive(spark, path)
    found = archive.select(warc.record_number("record_id").alias("i"), "*").collect()
    first = {}
    for i, _, h in pages:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    expected = []
    for i, url, h in pages:
        data = (h or "").encode()
        refers = first[h or ""] if i is not None and first[h or ""] < i else None
        expected.append((i, url, len(data), "sha1:" + digest32(data), refers))
    got = [(r.i, r.uri, r.payload_length, r.payload_digest, None if r.refers_to is None else int(r.refers_to[14:-1])) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    for r in found:
        assert (r.payload is None) == (r.record_type == "revisit")
        if r.payload is not None:
            assert len(r.payload) == r.payload_length and "sha1:" + r.payload_sha1 == r.payload_digest
    heads = warc.read_archive(spark, path, payload=False).filter((F.col("record_type") == "response") & (F.col("payload_length") >= 2))
    assert sorted(r.payload_length for r in heads.collect()) == [16, 300_000] and heads.filter("payload is not null").isEmpty()
    plan = archive.filter(F.col("record_type") == "revisit")._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.split("BatchScan")[0]
    assert archive.filter(F.col("uri").isNull()).count() == 3


def test_archive_without_records(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archive(empty, str(tmp_path / "none"))
    assert warc.read_archive(spark, str(tmp_path / "none")).isEmpty()


def test_small_payloads_are_all_responses(spark, tmp_path):
    frame = spark.createDataFrame([(1, None, "ab"), (2, None, "ab"), (3, None, "abcd"), (4, None, "abcd")], "page_id long, url string, html string")
    warc.write_archive(frame, str(tmp_path / "small"), min_bytes=3)
    kinds = warc.read_archive(spark, str(tmp_path / "small")).groupBy("record_type").count().collect()
    assert dict(kinds) == {"response": 3, "revisit": 1}


def test_classifier(spark, docs, rows, no_docs):
    good = ["A calm sentence about rivers and hills number {}.", "Another quiet text on gardens, trees and rain {}."]
    texts = [(5000 + i, (good[i % 2].format(i) if i % 4 else f"BUY!! NOW!! $$$ {i} ### CLICK!!") * (1 + i % 3)) for i in range(300)]
    frame = spark.createDataFrame([(i, t, "clash", "clash") for i, t in texts], "doc_id long, text string, score string, row string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i, _ in texts] + [(None, 1), (5001, None)], "doc_id long, quality int")
    found = quality_classifier.score_quality(frame, labels).collect()
    held = [r for r in found if r.held_out]
    assert len(found) == 300 and {r.doc_id for r in held} == {i for i, _ in texts if fold(i) == 0}
    assert np.mean([r.predicted == int(r.doc_id % 4 != 0) for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    messy = quality_classifier.score_quality(docs, labels, prefix="_q_")
    assert messy.count() == len(rows) and messy.filter("_q_score is null or _q_held_out is null").isEmpty()
    assert quality_classifier.score_quality(no_docs, labels).isEmpty()
    unlabelled = quality_classifier.score_quality(docs, labels.limit(0))
    assert {r[0] for r in unlabelled.select("score").distinct().collect()} == {0.5}
