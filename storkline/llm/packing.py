"""Best-fit packing of tokenised documents into sequences of fixed length.

Documents longer than a sequence are cut into pieces; nothing else is. Which lengths share a sequence is
decided on the histogram of piece lengths alone, which has one entry per token count. Patterns of up to
three lengths that fill a sequence exactly get repeat counts by non-negative least squares against the
histogram; the counts are rounded, and lengths left over are packed best-fit. Pieces then take the
places of the plan by their position among pieces of the same length.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storkline.llm.ranks import ranked, slots_for
from storkline.llm.words import BLANK_BYTES, pieces, text_bytes
from storkline.llm.workers import held_by_worker, no_collection
from storkline.session import stored

MAX_TOKENS = 2048
END = 0
# pieces as they stand in the texts (or whole words), and normalised ones, a worker remembers the ids of before it forgets the rarer ones
REMEMBERED_WORDS = 250_000
REMEMBERED_PIECES = 130_000
# bytes of texts that are looked up together
SLICE_BYTES = 1 << 20
# the expression whose pieces are cut on bytes, and the kinds of characters it tells apart
EXPRESSION = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LETTER, NUMBER, OTHER, BLANK, STRANGE = range(5)
ROUNDS = 300
# patterns of three lengths for each shortest length; many more would share the histogram out so thinly
# that every count rounds to 0
TRIPLES = 12


class WordTokenizer:
    """Ids of whole texts by a tokenizer that never joins words across blanks.

    Such a tokenizer gives a text the ids of its words one after the other, and a word those of its pieces, so a
    piece's ids are worked out once and remembered. Texts are cut on their bytes, and equal pieces of a slice are
    looked up together. New ones are normalised together, and the model sees them in one call; words with characters
    beyond the common Latin ones, or with a ``<``, which may begin a special token, stay whole and go through the whole
    tokenizer one by one. Under an expression or a normaliser other than the usual all words stay whole and are cut
    by the tokenizer's own expression.
    """

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        config = json.loads(self.tokenizer.to_str())
        split = [p for p in config["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        if config["model"]["type"] != "BPE" or len(split) != 1 or not split[0]["invert"]:
            raise ValueError("not a tokenizer of separate words")
        self.piece = regex.compile(split[0]["pattern"]["Regex"])
        letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: letters.pre_tokenize_str(chr(c))[0][0] for c in range(0x21, 0x250)}
        self.common = re.compile("[!-;=-~\u00a1-\u024f]+").fullmatch
        self.all_common = re.compile("[ !-;=-~\u00a1-\u024f]*").fullmatch
        # a normaliser that composes, joins blanks and lowers does nothing to an ASCII word but lower it
        steps = (config["normalizer"] or {}).get("normalizers", [config["normalizer"]])
        blanks = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
        self.lowers = {"type": "Lowercase"} in steps and all(s in ({"type": "Lowercase"}, {"type": "NFC"}, blanks) for s in steps)
        # the model alone, for pieces between blanks; where it marks the last token of a piece, that tells them apart
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        suffix, vocabulary = config["model"].get("end_of_word_suffix"), config["model"]["vocab"]
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.learn_kinds(split[0]["pattern"]["Regex"])
        self.known: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 20, np.uint32)
        self.begins = np.zeros(1 << 18, np.int64)
        self.uses = np.zeros(1 << 18, np.int64)
        self.pieces: dict[str, bytes] = {}
        self.older_pieces: dict[str, bytes] = {}

    def learn_kinds(self, expression: str) -> None:
        """The kinds of characters of one and two bytes.

        Characters that the normaliser makes into anything but one of the same kind are strange, and so are all visible
        ones under an expression or a normaliser other than the usual.
        """
        self.kinds, self.pair_kinds = np.full(256, STRANGE, np.uint8), np.full(1 << 16, STRANGE, np.uint8)
        self.kinds[BLANK_BYTES] = BLANK
        # simple characters as the model knows them, normalised
        self.shown: dict[int, str] = {0x20: " "}
        self.all_simple = re.compile("").fullmatch
        if expression != EXPRESSION or not self.lowers:
            return
        by_category = {"L": LETTER, "N": NUMBER}
        common = [c for c in range(0x21, 0x250) if self.common(chr(c))]
        kind_of = {c: by_category.get(unicodedata.category(chr(c))[0], OTHER) for c in common}
        for c, kind in kind_of.items():
            normal, raw = self.tokenizer.normalizer.normalize_str(chr(c)), chr(c).encode()
            if len(normal) == 1 and kind_of.get(ord(normal)) == kind:
                (self.kinds if len(raw) == 1 else self.pair_kinds)[int.from_bytes(raw, "big")] = kind
                self.shown[c] = normal.translate(self.letters)
        self.all_simple = re.compile(f"[{re.escape(''.join(map(chr, self.shown)))}]*").fullmatch

    def forget(self) -> None:
        """Forgets the words met once and, beyond half of what may be remembered, those met least."""
        uses, half = self.uses[: len(self.known)], REMEMBERED_WORDS // 2
        keep = np.flatnonzero(uses > 1)
        if len(keep) > half:
            keep = np.sort(keep[np.argsort(-uses[keep], kind="stable")[:half]])
        begin, length = self.begins[keep], self.begins[keep + 1] - self.begins[keep]
        upto = np.concatenate([[0], np.cumsum(length)])
        self.ids[: upto[-1]] = self.ids[np.arange(upto[-1]) + np.repeat(begin - upto[:-1], length)]
        self.begins[: len(upto)] = upto
        kept = uses[keep] // 2
        self.uses[:] = 0
        self.uses[: len(keep)] = kept
        words = list(self.known)  # in the order of their numbers
        self.known = {words[i]: n for n, i in enumerate(keep.tolist())}

    def learn_pieces(self, pieces: Iterable[str]) -> None:
        if len(self.pieces) >= REMEMBERED_PIECES // 2:
            self.older_pieces, self.pieces = self.pieces, {}
        fresh = []
        for piece in dict.fromkeys(pieces):
            if piece not in self.pieces:
                if piece in self.older_pieces:
                    self.pieces[piece] = self.older_pieces[piece]
                else:
                    fresh.append(piece)
        if not fresh:
            return
        text = " ".join(fresh).translate(self.letters)
        ids = np.array(self.bare.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) == len(fresh):
            raw, at = ids.tobytes(), [0, *(4 * ends).tolist()]
            found = [raw[a:z] for a, z in itertools.pairwise(at)]
        else:
            found = [array("I", [t.id for t in self.tokenizer.model.tokenize(p)]).tobytes() for p in text.split(" ")]
        self.pieces.update(zip(fresh, found))

    def common_or_empty(self, words: list[str]) -> list[str]:
        """The words, with an empty one for each that has characters beyond the common ones."""
        if self.all_common(" ".join(words)):
            return words
        return [w if self.common(w) else "" for w in words]

    def normalized(self, words: list[str]) -> list[str]:
        """The words normalised, with an empty one for each that is not common, before or after it."""
        plain = self.common_or_empty(words)
        easy = [self.lowers and w.isascii() or not w for w in plain]
        others = [w for w, is_easy in zip(plain, easy) if not is_easy]
        found = iter(self.common_or_empty(self.tokenizer.normalizer.normalize_str(" ".join(others)).split(" ")))
        return [w.lower() if is_easy else next(found) for w, is_easy in zip(plain, easy)]

    def word_ids(self, words: list[str]) -> list[bytes]:
        """Ids as 32-bit numbers, which take a fraction of the room of lists."""
        norms = self.normalized(words)
        cuts = {norm: self.piece.findall(norm) for norm in norms if not norm.isalpha()}
        self.learn_pieces(itertools.chain((n for n in norms if n.isalpha()), itertools.chain.from_iterable(cuts.values())))
        ids_of = self.pieces.__getitem__
        return [
            ids_of(norm) if norm.isalpha() else b"".join(map(ids_of, cuts[norm])) if norm
            else array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
            for word, norm in zip(words, norms)
        ]

    def simple_ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces without strange characters, end to end, and how many each has."""
        shown = " ".join(pieces).translate(self.shown)
        ids = np.array(self.bare.encode_batch_fast([shown], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) == len(pieces):
            return ids, np.diff(ends, prepend=0)
        found = [[t.id for t in self.tokenizer.model.tokenize(p)] for p in shown.split(" ")]
        return np.array(list(itertools.chain.from_iterable(found)), np.uint32), np.fromiter(map(len, found), np.int64, len(found))

    def learn(self, words: list[bytes]) -> np.ndarray:
        """The numbers of new words or pieces, those without strange characters first."""
        texts, order = b" ".join(words).decode().split(" "), np.arange(len(words))
        simple, others = texts, []
        if not self.all_simple(" ".join(texts)):
            is_simple = np.fromiter((self.all_simple(t) is not None for t in texts), bool, len(texts))
            order = np.concatenate([np.flatnonzero(is_simple), np.flatnonzero(~is_simple)])
            ordered, cut = [texts[i] for i in order.tolist()], int(is_simple.sum())
            simple, others = ordered[:cut], ordered[cut:]
        flat, length = self.simple_ids(simple) if simple else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        if others:
            found = self.word_ids(others)
            flat = np.concatenate([flat, np.frombuffer(b"".join(found), np.uint32)])
            length = np.concatenate([length, np.fromiter(map(len, found), np.int64, len(found)) // 4])
        n, at = len(self.known), int(self.begins[len(self.known)])
        while at + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(words) >= len(self.begins):
            self.begins = np.concatenate([self.begins, np.zeros_like(self.begins)])
            self.uses = np.concatenate([self.uses, np.zeros_like(self.uses)])
        self.ids[at : at + len(flat)] = flat
        self.begins[n + 1 : n + 1 + len(words)] = at + np.cumsum(length)
        self.known.update(zip((words[i] for i in order.tolist()) if others else words, range(n, n + len(words))))
        numbers = np.empty(len(words), np.int64)
        numbers[order] = np.arange(n, n + len(words))
        return numbers

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by the end id, and where each text begins."""
        with no_collection():
            return self.encode_words(column)

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all texts without blanks, those of each piece counted, and the first piece of each text.

        Pieces are what the tokenizer's expression cuts from the normalised text: runs of letters or of other visible
        characters, single numbers, endings like ``'s``. Words with a character that is not cut on its bytes stay whole.
        The first pieces have one more entry than there are texts.
        """
        kind, first = self.kinds[data], np.zeros(len(data) + 1, bool)
        first[offsets] = True
        lead = np.flatnonzero((data[:-1] >= 0xC2) & (data[:-1] <= 0xC9))
        pair = self.pair_kinds[data[lead].astype(np.int64) << 8 | data[lead + 1]]
        lead, pair = lead[pair != STRANGE], pair[pair != STRANGE]
        kind[lead] = kind[lead + 1] = pair
        edge = first[:-1] | (kind == NUMBER)
        edge[1:] |= kind[1:] != kind[:-1]
        edge[lead + 1] = False
        spots = np.flatnonzero(edge & (data == ord("'")))
        # letters in lower case; nothing else becomes one of the letters below
        one, two = (data.take(spots + n, mode="clip").astype(np.int64) | 0x20 for n in (1, 2))
        short = np.isin(one, list(b"stmd"))
        long = np.isin(one << 8 | two, [int.from_bytes(e, "big") for e in (b"re", b"ve", b"ll")]) & ~first.take(spots + 2, mode="clip")
        ending = (short | long) & ~first[spots + 1]
        spots, size = spots[ending], np.where(short, 2, 3)[ending]
        edge[spots + 1] = False
        edge[(spots + size)[spots + size < len(data)]] = True
        visible, strange = kind != BLANK, kind == STRANGE
        if strange.any():
            begins = visible.copy()
            begins[1:] &= ~visible[:-1] | first[1:-1]
            words = np.flatnonzero(begins)
            whole = np.zeros(len(data), bool)
            whole[words[0] :] = np.repeat(np.logical_or.reduceat(strange, words), np.diff(words, append=len(data)))
            edge &= ~(whole & visible)
            edge[words] = True
        at = np.flatnonzero(edge)
        shown = visible[at]
        return data[visible], np.diff(at, append=len(data))[shown], np.searchsorted(at[shown], offsets)

    def encode_words(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, sizes, firsts = self.cut(*text_bytes(column))
        places = [None, pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)])), pa.py_buffer(data)]
        met = pa.Array.from_buffers(pa.large_binary(), len(sizes), places).dictionary_encode()
        words, at = met.dictionary.to_numpy(zero_copy_only=False).tolist(), met.indices.to_numpy()
        if len(self.known) > REMEMBERED_WORDS:
            self.forget()
        number = np.fromiter(map(self.known.get, words, itertools.repeat(-1)), np.int64, len(words))
        fresh = np.flatnonzero(number < 0)
        if len(fresh):
            number[fresh] = self.learn([words[i] for i in fresh.tolist()])
        self.uses[number] += np.bincount(at, minlength=len(words))
        begin, length = self.begins[number][at], (self.begins[number + 1] - self.begins[number])[at]
        upto = np.concatenate([[0], np.cumsum(length)])
        flat = self.ids[np.arange(upto[-1]) + np.repeat(begin - upto[:-1], length)]
        begins = upto[firsts]
        return np.insert(flat, begins[1:], END), begins + np.arange(len(begins))


def token_pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int, id_col: str, text_col: str, keep_ids: bool) -> DataFrame:
    """``(doc_id, row, piece, start, length, ids_crc32, ids)``; ids are little-endian 32-bit numbers.

    ``row`` tells input rows apart, also where they repeat an id.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = held_by_worker(WordTokenizer, tokenizer_path)
        for batch in batches:
            for part in pieces(batch, "text", SLICE_BYTES):
                ids, begins = tokenizer.encode(part.column("text"))
                counts = -(-np.diff(begins) // max_tokens)
                owner = np.repeat(np.arange(part.num_rows), counts)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = piece * max_tokens
                length = np.minimum(max_tokens, np.diff(begins)[owner] - start)
                raw = ids.astype("<u4").tobytes()
                at = 4 * (begins[owner] + start)
                values = [raw[a : a + n] for a, n in zip(at.tolist(), (4 * length).tolist())]
                take = pa.array(owner)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(take), part.column("row").take(take), pa.array(piece.astype(np.int32)),
                    pa.array(start), pa.array(length), pa.array([zlib.crc32(v) for v in values], pa.int64()),
                    pa.array(values if keep_ids else [None] * len(values), pa.binary()),
                ], ["doc_id", "row", "piece", "start", "length", "ids_crc32", "ids"])

    return rows.mapInArrow(
        scan, f"doc_id {kind}, row long, piece int, start long, length long, ids_crc32 long, ids binary"
    )


def fill_patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Patterns (a >= b >= c, 0 for none) of up to three of the ``lengths`` that fill a sequence exactly.

    All patterns of one and two lengths, and for every shortest length ``TRIPLES`` of three, evenly spread.
    """
    present = np.zeros(capacity + 1, bool)
    present[lengths] = True
    low = np.sort(lengths)
    found = [np.array([[capacity, 0, 0]])] if present[capacity] else []
    second = low[low <= capacity // 2]
    second = second[present[capacity - second]]
    found.append(np.stack([capacity - second, second, np.zeros_like(second)], axis=1))
    for c in low[low <= capacity // 3]:
        b = low[(low >= c) & (low <= (capacity - c) // 2)]
        b = b[present[capacity - c - b]]
        b = b[np.unique(np.linspace(0, len(b) - 1, min(len(b), TRIPLES)).astype(np.int64))]
        found.append(np.stack([capacity - c - b, b, np.full_like(b, c)], axis=1))
    return np.concatenate(found).astype(np.int64) if found else np.zeros((0, 3), np.int64)


def repeat_counts(patterns: np.ndarray, histogram: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative counts whose patterns use about as many of each length as there are.

    Accelerated projected gradient on the squared differences; a step is a gather and a bincount.
    """
    weight = (patterns > 0).astype(np.float64)
    goal = histogram.astype(np.float64).copy()
    goal[0] = 0.0

    def used(x: np.ndarray) -> np.ndarray:
        return np.bincount(patterns.ravel(), (weight * x[:, None]).ravel(), len(goal))

    # the largest curvature is at most the largest row sum of the matrix times its transpose
    share = used(weight.sum(axis=1))
    pace = 1.0 / max(share.max(), 1.0)
    x = np.zeros(len(patterns))
    y, t = x, 1.0
    for _ in range(rounds):
        slope = used(y) - goal
        slope[0] = 0.0
        nxt = np.maximum(0.0, y - pace * (slope[patterns] * weight).sum(axis=1))
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        y = nxt + (last - 1) / t * (nxt - x)
        x = nxt
    return x


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[int, list[int]]]:
    """(repeats, lengths) for the lengths left over, longest first into the fullest sequence with room.

    Sequences alike in content are one entry, so work follows the number of lengths, not of pieces.
    """
    open_: dict[int, list[tuple[int, list[int]]]] = {}
    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            room = next((r for r in range(length, capacity) if open_.get(r)), capacity)
            if room == capacity:
                # as many of this length as fit go together
                per = capacity // length
                if n >= per:
                    open_.setdefault(capacity - per * length, []).append((n // per, [length] * per))
                    n %= per
                else:
                    open_.setdefault(capacity - n * length, []).append((1, [length] * n))
                    n = 0
                continue
            repeats, content = open_[room].pop()
            taken = min(repeats, n)
            if taken < repeats:
                open_[room].append((repeats - taken, content))
            open_.setdefault(room - length, []).append((taken, [*content, length]))
            n -= taken
    return [entry for entries in open_.values() for entry in entries]


def packing_plan(histogram: np.ndarray, capacity: int) -> list[tuple[int, list[int]]]:
    """(repeats, lengths) of all sequences for a histogram by length."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    plan = []
    lengths = np.flatnonzero(left)
    if len(lengths):
        patterns = fill_patterns(lengths, capacity)
        wanted = np.rint(repeat_counts(patterns, left)).astype(np.int64) if len(patterns) else np.zeros(0, np.int64)
        for p in np.argsort(-wanted, kind="stable")[: int((wanted > 0).sum())]:
            content = [int(x) for x in patterns[p] if x]
            need = {x: content.count(x) for x in content}
            n = min(int(wanted[p]), *(int(left[x]) // m for x, m in need.items()))
            if n:
                plan.append((n, content))
                for x, m in need.items():
                    left[x] -= n * m
    return plan + best_fit(left, capacity)


def places(plan: list[tuple[int, list[int]]], capacity: int) -> dict[str, np.ndarray]:
    """The plan as ranges of positions among pieces of one length.

    Ranges are ordered by (length, first position); a range gives its pieces consecutive sequences from
    ``sequence`` on, at ``offset``.
    """
    length, size, sequence, offset, base = [], [], [], [], 0
    for repeats, content in plan:
        at = 0
        for x in content:
            length.append(x)
            size.append(repeats)
            sequence.append(base)
            offset.append(at)
            at += x
        base += repeats
    length, size = np.array(length, np.int64), np.array(size, np.int64)
    order = np.argsort(length, kind="stable")
    length, size = length[order], size[order]
    upto = np.cumsum(size) - size
    starts = np.searchsorted(length, np.arange(capacity + 2))
    first = upto - upto[np.minimum(starts[length], max(len(upto) - 1, 0))] if len(length) else upto
    return {
        "starts": starts, "first": first, "sequence": np.array(sequence, np.int64)[order], "offset": np.array(offset, np.int64)[order],
    }


def pack_documents(
    docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS, id_col: str = "doc_id", text_col: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """``(doc_id, row, piece, start, length, ids_crc32, ids, sequence_id, offset)``, one row per piece.

    A document's tokens are the ids of its text and then id 0; null and empty texts have that one token.
    Documents above ``max_tokens`` are cut into pieces of that length, the last may be shorter. The pieces
    of a sequence lie gapless from offset 0 and never exceed it. ``ids`` holds the piece's ids as
    little-endian 32-bit numbers if ``keep_ids``, else null. Rows that repeat an id are packed each on
    their own, told apart by ``row``. An empty table gives an empty result; other columns are ignored.

    The tokenizer must not join words across blanks, as those with word ends do not. Only the histogram, at
    most one number per length, reaches the driver; positions among equal lengths are found in parts.
    """
    found = stored(token_pieces(docs, tokenizer_path, max_tokens, id_col, text_col, keep_ids), "pieces")
    histogram = np.zeros(max_tokens + 1, np.int64)
    for row in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():
        histogram[row["length"]] = row["n"]
    table = places(packing_plan(histogram, max_tokens), max_tokens)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    narrow = found.withColumn("_h", F.xxhash64("row", "piece"))
    placed = ranked(narrow, ["length"], "_h", ["row", "piece"], slots_for(int(histogram.max())), "_place").drop("_h")
    names = found.columns

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        for batch in batches:
            length, place = (batch.column(c).to_numpy() for c in ("length", "_place"))
            at = np.zeros(len(length), np.int64)
            for x in np.unique(length):
                of = length == x
                a, z = t["starts"][x], t["starts"][x + 1]
                at[of] = a + np.searchsorted(t["first"][a:z], place[of], side="right") - 1
            sequence = t["sequence"][at] + place - t["first"][at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence), pa.array(t["offset"][at])], [*names, "sequence_id", "offset"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return placed.mapInArrow(
        assign, f"doc_id {kind}, row long, piece int, start long, length long, ids_crc32 long, ids binary, "
        "sequence_id long, offset long"
    )
