"""Plain versions of the operators, for small data. Rows are (doc_id, text, source)."""

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = re.compile(r"[\x20\x09-\x0D]+")
LAST = (1 << 63) - 1


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def base_features(text):
    w = words(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    covered = {i + j for i, x in enumerate(windows) if often[x] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
        len(w) < 10 or 100 * len(covered) > 20 * len(w),
    )


def repeats_removed(rows, window=20):
    """(doc_id, n_words, n_removed, kept text), rows with one id as one document."""
    first = {}
    for doc, text, _ in rows:
        w = words(text)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            at = (LAST if doc is None else doc, i)
            first[key] = min(first.get(key, at), at)
    out = []
    for doc, text, _ in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] != (LAST if doc is None else doc, i):
                gone |= set(range(i, i + window))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def line_chunks(text):
    """Lists of at least two lines, but for a text of one line."""
    lines = (text or "").split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    roll = [(h[i - 1] if i else 0) * 31 + x for i, x in enumerate(h)]
    chunks, held = [], []
    for i, line in enumerate(lines):
        held.append(line)
        inner = 1 <= i <= len(lines) - 3
        if i == len(lines) - 1 or inner and roll[i] < roll[i - 1] and roll[i] <= roll[i + 1]:
            chunks.append(held)
            held = []
    return chunks


def shared(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def lines_removed(rows, min_lines=2):
    """(doc_id, n_lines, n_chunks, n_removed, kept text), for chunks of two lines and more."""
    first, read = {}, []
    for doc, text, _ in rows:
        lines, start, chunks = (text or "").split("\n"), 0, line_chunks(text)
        placed = []
        for k, chunk in enumerate(chunks):
            end = start + len(chunk)
            top = max(0, start - (len(chunks[k - 1]) + min_lines if k else 0))
            bottom = end + (len(chunks[k + 1]) + min_lines if k + 1 < len(chunks) else 0)
            if len(chunk) >= min_lines:
                at, place = (doc is None, doc or 0, k), (lines[top:start][::-1], lines[end:bottom])
                placed.append((tuple(chunk), at, place, start))
                if tuple(chunk) not in first or at < first[tuple(chunk)][0]:
                    first[tuple(chunk)] = at, place
            start = end
        read.append((doc, text, lines, len(chunks), placed))
    out = []
    for doc, text, lines, n_chunks, placed in read:
        gone = set()
        for chunk, at, (before, after), start in placed:
            earliest, (above, below) = first[chunk]
            if earliest != at:
                gone |= set(range(start - shared(before, above), start + len(chunk) + shared(after, below)))
        kept = "\n".join(line for i, line in enumerate(lines) if i not in gone)
        out.append((doc, len(lines), n_chunks, len(gone), None if text is None else kept))
    return out


def fingerprint(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = words((text or "").translate(lower))
    if not w:
        return 0
    k = min(4, len(w))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(len(w) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, distance=4):
    """Number of the component of each fingerprint."""
    label = list(range(len(prints)))
    a = np.array(prints, np.uint64)
    changed = True
    while changed:
        changed = False
        for i in range(len(a)):
            near = np.flatnonzero(np.bitwise_count(a ^ a[i]) <= distance)
            least = min(label[j] for j in near)
            for j in near:
                changed |= label[j] != least
                label[j] = least
    return label


def shingle_set(text, k=5):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = words((text or "").translate(lower))
    k = min(k, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def jaccard_links(sets, similarity=0.8):
    """Pairs of positions at or above the similarity; sets without members link to each other."""
    places = {}
    for i, held in enumerate(sets):
        for x in held or {None}:
            places.setdefault(x, []).append(i)
    out = []
    for i, held in enumerate(sets):
        both = Counter(j for x in held or {None} for j in places[x] if j < i)
        out += [(j, i) for j, n in both.items() if not held or n >= similarity * (len(held) + len(sets[j]) - n)]
    return out


def jaccard_components(texts, similarity=0.8):
    """Number of the component of each text."""
    label = list(range(len(texts)))

    def top(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for i, j in jaccard_links([shingle_set(t) for t in texts], similarity):
        a, z = sorted((top(i), top(j)))
        label[z] = a
    return [top(i) for i in range(len(texts))]


def digest32(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def fold(doc):
    return zlib.crc32(b"" if doc is None else str(doc).encode()) % 5
