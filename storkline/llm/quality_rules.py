"""Quality rules under weak supervision, in DataFrame operations only.

Every rule votes good, votes bad or abstains. Expectation-maximisation estimates how often each rule is
right on good and on bad documents, without labels, and a document is kept by its posterior probability.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storkline.llm.words import BLANKS
from storkline.session import stored

WINDOW = 5
SYMBOLS = "[#*$%&|<>]"

# name: (bad when, good when), over the features below; a rule abstains in between
RULES: dict[str, tuple[str, str]] = {
    "length": ("n_words < 20", "n_words >= 50"),
    "word_length": ("word_chars < 2 * n_words or word_chars > 12 * n_words", "word_chars between 3 * n_words and 9 * n_words"),
    "symbols": ("10 * n_symbols > n_words", "50 * n_symbols < n_words"),
    "dup_lines": ("10 * n_dup_lines > 3 * n_lines", "n_dup_lines = 0"),
    "repeat_words": ("10 * n_repeat_words > n_words", "50 * n_repeat_words < n_words"),
    "capitals": ("10 * n_capitals > 3 * word_chars", "10 * n_capitals < word_chars"),
    "other_chars": ("5 * n_other > word_chars and n_words >= 20", "10 * n_other < word_chars"),
    "shouting": ("20 * n_shouts > n_words", "n_shouts = 0"),
    "sentences": ("n_words > 100 * n_ends", "n_words <= 50 * n_ends"),
}
# accuracies before any data, as pseudo-counts of right and wrong votes: on good documents a rule mostly
# votes good, on bad ones most rules see nothing wrong
GOOD_COUNTS, BAD_COUNTS = (19.0, 1.0), (3.0, 7.0)
PRIOR = 0.8


def repeated_words(words: Column, hashes: Column, n: Column) -> tuple[Column, Column]:
    """Arrays for the words in windows that occur twice: hashes of all windows, and a builder's input."""
    starts = F.when(n >= WINDOW, F.sequence(F.lit(0), n - WINDOW)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(WINDOW)])), starts


def base_features(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Counts per document, each from its whole text; see ``score_documents``.

    Window hashes only decide whether a text can hold a repeated window at all; if so, the windows
    themselves are sorted with their positions and compared with their neighbours.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"))
    df = df.withColumn("_words", F.array_remove(F.split("_text", BLANKS), ""))
    df = df.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = df.withColumns({"_h": F.transform("_words", lambda w: F.xxhash64(w)), "n_words": F.size("_words")})
    windows, starts = repeated_words(F.col("_words"), F.col("_h"), F.col("n_words"))
    df = df.withColumns({"_windows": windows, "_starts": starts})
    may_repeat = F.size(F.array_distinct("_windows")) < F.size("_windows")
    texts = F.transform("_starts", lambda i: F.struct(
        F.array_join(F.slice("_words", i + 1, F.lit(WINDOW)), " ").alias("w"), i.alias("i")))
    df = df.withColumn("_sorted", F.when(may_repeat, F.sort_array(texts)))

    def same(i: Column, j: Column) -> Column:
        return F.coalesce(F.get("_sorted", i)["w"] == F.get("_sorted", j)["w"], F.lit(False))

    places = F.filter(F.sequence(F.lit(0), F.size("_sorted") - 1), lambda i: ((i > 0) & same(i, i - 1)) | same(i, i + 1))
    df = df.withColumn("_places", F.when(F.col("_sorted").isNotNull(), places))
    df = df.withColumn("_at", F.sort_array(F.transform("_places", lambda i: F.get("_sorted", i)["i"])))
    covered = F.transform("_at", lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_at", k + 1) - x, F.lit(WINDOW))))
    df = df.withColumn("_covered", covered)
    return df.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.aggregate("_covered", F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").alias("n_lines"),
        F.regexp_count("_text", F.lit(r"\p{Lu}")).alias("n_capitals"),
        F.regexp_count("_text", F.lit(r"[^\p{L}\p{M}\x20\x09-\x0D]")).alias("n_other"),
        F.regexp_count("_text", F.lit("!!")).alias("n_shouts"),
        F.regexp_count("_text", F.lit(r"[.!?]+(?=[\x20\x09-\x0D]|$)")).alias("n_ends"),
    )


def votes(features: DataFrame) -> DataFrame:
    """Adds ``_votes``, one per rule: 1 good, -1 bad, 0 abstains."""
    cast = [F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0) for bad, good in RULES.values()]
    return features.withColumn("_votes", F.array(*cast))


def probability(prior: float, good: list[float], bad: list[float]) -> Column:
    """Posterior of a good document given its votes, rules taken as independent."""
    parts = [x for g, b in zip(good, bad) for x in (math.log((1 - g) / b), 0.0, math.log(g / (1 - b)))]
    weights = F.lit(parts)
    shares = F.transform("_votes", lambda v, rule: F.get(weights, rule * 3 + v + 1))
    odds = F.aggregate(shares, F.lit(math.log(prior / (1 - prior))), lambda total, x: total + x)
    return 1 / (1 + F.exp(-odds))


def estimate(patterns: DataFrame, rounds: int, settled: float = 1e-6) -> tuple[float, list[float], list[float]]:
    """Prior and the rules' accuracies on good and on bad documents, from counted vote patterns.

    Each round gives every pattern its posterior and takes accuracies from the votes so weighted; at most
    three rows per rule come back. Ends when no number moves by more than ``settled``.
    """
    n = len(RULES)
    prior = PRIOR
    good, bad = [GOOD_COUNTS[0] / sum(GOOD_COUNTS)] * n, [BAD_COUNTS[0] / sum(BAD_COUNTS)] * n
    for _ in range(rounds):
        weighed = patterns.withColumn("_p", probability(prior, good, bad))
        votes_of = weighed.select("_n", "_p", F.posexplode("_votes").alias("rule", "vote")).groupBy("rule", "vote")
        sums = votes_of.agg(F.sum(F.col("_n") * F.col("_p")).alias("g"), F.sum(F.col("_n") * (1 - F.col("_p"))).alias("b"))
        seen = {(r["rule"], r["vote"]): (r["g"], r["b"]) for r in sums.collect()}

        def total(rule: int, of: int, kinds: tuple[int, ...]) -> float:
            return sum(seen.get((rule, v), (0.0, 0.0))[of] for v in kinds)

        last = [prior, *good, *bad]
        all_good, all_bad = (total(0, of, (-1, 0, 1)) for of in (0, 1))
        prior = (all_good + 1) / (all_good + all_bad + 2)
        good = [(total(i, 0, (1,)) + GOOD_COUNTS[0]) / (total(i, 0, (-1, 1)) + sum(GOOD_COUNTS)) for i in range(n)]
        bad = [(total(i, 1, (-1,)) + BAD_COUNTS[0]) / (total(i, 1, (-1, 1)) + sum(BAD_COUNTS)) for i in range(n)]
        if max(abs(x - y) for x, y in zip(last, [prior, *good, *bad])) <= settled:
            break
    return prior, good, bad


def score_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, rounds: int = 30
) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, probability, kept)``.

    One row per input row, repeated rows included. Words are runs of non-blank characters of the whole
    text. ``n_dup_lines`` counts lines with a word that equal an earlier line, ``n_repeat_words`` the words
    within windows of five that occur at least twice. A text of under ten words, or with over a fifth of
    its words in repeated windows, fails the base; null and empty texts have no words and fail. Others are
    kept when the posterior probability of a good document reaches ``threshold``. An empty table gives an
    empty result; other columns are ignored.

    Accuracies are estimated on the documents that pass the base, as the others are settled. Features are
    computed once and written without the text; the driver sees three sums per rule.
    """
    rows = stored(votes(base_features(docs, id_col, text_col)), "rule-votes")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    patterns = rows.filter(~failed).groupBy("_votes").agg(F.count(F.lit(1)).cast("double").alias("_n"))
    posterior = F.round(probability(*estimate(stored(patterns, "vote-patterns"), rounds)), 9)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), posterior.alias("probability"), (~failed & (posterior >= threshold)).alias("kept"),
    )
