"""Mixing sources to target weights by subset-sum budget fitting.

A source takes its documents whole: so many full repeats, then a seeded choice of documents whose
sizes fill the rest of its target. The choice is made by counts of equal sizes: a proportional share of
every size, and bounded knapsacks over the sizes for what is left. Documents of one size are
interchangeable for the budget, so the seed picks which of them are taken.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storkline.llm.ranks import ranked, slots_for
from storkline.llm.words import WORD
from storkline.session import stored

WEIGHTS = (3.0, 1.0, 2.0)
# the knapsack tells so many sums apart; for larger budgets sizes are first counted in a coarser unit, then finer ones
KNAPSACK_SUMS = 1 << 17


def source_targets(
    sizes: dict[str | None, int], weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0
) -> dict[str | None, float]:
    """Target words per source: ``share`` of all words by weight, at most ``most`` times a source.

    Sources take the weights in turn, ordered by code point with null last. What a full source cannot
    take is shared among the others by weight, until none is above its limit.
    """
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    targets: dict[str | None, float] = {}
    budget = share * sum(sizes.values())
    while open_ := [s for s in names if s not in targets]:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if budget * weight[s] / total > most * sizes[s]]
        if not full:
            targets.update({s: budget * weight[s] / total for s in open_})
            break
        targets.update({s: most * sizes[s] for s in full})
        budget -= sum(targets[s] for s in full)
    return targets


def target_table(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``source_targets`` for a table of ``(source, source_size)``: adds ``target`` and ``full``, the full repeats.

    Only sums reach the driver. Ranges of the ordered sources and their numbers of rows give the place of a source
    in the order. A source that is full stays so when the others' shares grow, so a round needs but the words and
    weights of the sources below their limits.
    """
    place = [F.col("source").isNull(), F.col("source")]
    ordered = stored(
        sizes.repartitionByRange(*place).sortWithinPartitions(*place)
        .withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "sources",
    )
    parts = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = parts.select(F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    turn = F.pmod(F.col("_at") + F.col("_offset"), F.lit(len(weights))).cast("int")
    listed = F.array(*[F.lit(float(w)) for w in weights])
    known = ordered.join(F.broadcast(offsets), F.col("_part") == F.col("_p")).select("source", "source_size", F.get(listed, turn).alias("weight"))

    limit, weight = F.col("source_size") * F.lit(float(most)), F.col("weight")
    level = (0.0, 1.0)  # words and weights of the sources below their limits

    def is_full() -> Column:
        return F.lit(level[0]) * weight / F.lit(level[1]) > limit

    whole, total = known.agg(F.sum("source_size"), F.sum("weight")).first()
    budget, n_full = share * (whole or 0), 0
    level = (budget, total or 1.0)
    while True:
        n, words, left = known.agg(
            F.count_if(is_full()), F.sum(F.when(is_full(), limit)), F.sum(F.when(~is_full(), weight))
        ).first()
        if n == n_full or left is None:
            break
        n_full, level = n, (budget - words, left)
    target = F.when(is_full(), limit).otherwise(F.lit(level[0]) * weight / F.lit(level[1]))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    return known.withColumn("target", target).withColumn("full", full).drop("weight")


def knapsack(items: Sequence[tuple[int, int]], budget: int, above: int = 0) -> dict[int, int]:
    """How many of each size to take so that the sum is as near to ``budget`` as can be.

    ``items`` are (size, available); the sum may pass ``budget`` by ``above``, of two sums equally near the
    smaller is taken. Reachable sums are the bits of an integer; a count is split into powers of two, so a size
    costs log2(available) shifts.
    """
    most = budget + above
    full = (1 << (most + 1)) - 1
    reach, steps = 1, []
    for size, available in items:
        part = 1
        while available > 0 and size * part <= most and not reach >> budget & 1:
            part = min(part, available)
            wider = reach | reach << (size * part) & full
            if wider != reach:
                steps.append((size, part, reach))
            reach = wider
            available -= part
            part *= 2
    at, beyond = (reach & ((1 << (budget + 1)) - 1)).bit_length() - 1, reach >> (budget + 1)
    if beyond:
        over = budget + (beyond & -beyond).bit_length()
        at = over if over - budget < budget - at else at
    taken = {}
    for size, part, before in reversed(steps):
        if not before >> at & 1:
            taken[size] = taken.get(size, 0) + part
            at -= size * part
    return taken


def fill(counts: dict[int, int], taken: dict[int, int], budget: int) -> dict[int, int]:
    """``taken`` with documents added, or given back, until its words are as near to ``budget`` as rounds bring them.

    A round makes up the difference by one knapsack over the documents not taken (over those taken where the words
    are too many), in a unit that tells ``KNAPSACK_SUMS`` sums apart. A difference below that many words is made up
    in single words; a larger one leaves the error of the unit to the next round. Rounds end when none comes nearer.
    """
    rest = budget - sum(s * n for s, n in taken.items())
    while rest:
        sign = 1 if rest > 0 else -1
        free = {s: n - taken.get(s, 0) if rest > 0 else taken.get(s, 0) for s, n in counts.items()}
        unit = -(-2 * abs(rest) // KNAPSACK_SUMS)
        scaled: dict[int, list[int]] = {}
        for s in sorted(free, reverse=True):
            if free[s] and s < 2 * abs(rest) and (2 * s + unit) // (2 * unit):
                scaled.setdefault((2 * s + unit) // (2 * unit), []).append(s)
        items = [(q, sum(free[s] for s in same)) for q, same in scaled.items()]
        goal = (2 * abs(rest) + unit) // (2 * unit)
        change: dict[int, int] = {}
        for q, n in knapsack(items, goal, goal).items():
            for s in scaled[q]:
                change[s] = min(n, free[s])
                n -= change[s]
        left = rest - sign * sum(s * n for s, n in change.items())
        if abs(left) >= abs(rest):
            break
        taken = {s: taken.get(s, 0) + sign * change.get(s, 0) for s in counts}
        rest = left
    return taken


def fit_budget(counts: dict[int, int], budget: int) -> dict[int, int]:
    """Documents to take of each size, at most ``counts``, so that their words are near to ``budget``.

    A proportional share of every size comes first, so that the choice has sizes of all kinds, and ``fill`` makes up
    the rest. Where that misses the budget, ``fill`` may come nearer once the shortest documents taken have been given
    back, or from nothing.
    """
    counts = {s: n for s, n in counts.items() if s > 0}
    whole = sum(s * n for s, n in counts.items())
    if budget <= 0 or not whole:
        return {}

    def missing(taken: dict[int, int]) -> int:
        return abs(budget - sum(s * n for s, n in taken.items()))

    taken = fill(counts, {s: min(n, n * budget // whole) for s, n in counts.items()}, budget)
    if missing(taken):
        shorter, back = dict(taken), 0
        for s in sorted(s for s, n in taken.items() if n):
            n = min(taken[s], max(0, KNAPSACK_SUMS // 4 - back) // s)
            shorter[s] -= n
            back += s * n
        taken = min(taken, fill(counts, shorter, budget), fill(counts, {}, budget), key=missing)
    return {s: n for s, n in taken.items() if n}


def mix_sources(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 42,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep_columns: bool = False, prefix: str = "",
) -> DataFrame:
    """``(doc_id, size, source_size, target, copies, taken)``, one row per document.

    ``copies`` is how many times the mix holds the document, ``taken`` its words times that. The seeded
    choice goes by a hash of id, source and text; rows alike in all of them are interchangeable. Null and empty texts have size 0 and are taken as often as their source repeats in
    full. A null source is a source of its own, the last. An empty table gives an empty result.
    ``keep_columns`` puts all columns of ``docs`` in place of ``doc_id``; the others then begin with
    ``prefix``, and an input column of the same name is replaced.

    Only sums reach the driver, and the knapsack of a source sees one row per size.
    """
    new = {c: f"{prefix}{c}" for c in ("size", "source_size", "target", "copies", "taken")}
    columns = [c for c in docs.columns if c not in new.values()] if keep_columns else [id_col]
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored(docs.select(
        F.struct(*columns).alias("doc"), F.monotonically_increasing_id().alias("at"), F.col(source_col).alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col), F.col(source_col), text).alias("seeded"),
    ), "sizes")
    histogram = stored(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "size-counts")
    sizes = histogram.groupBy("source").agg(F.coalesce(F.sum(F.col("size") * F.col("n")), F.lit(0)).alias("source_size"))
    about = stored(target_table(sizes, weights, share, most), "targets").withColumnRenamed("source", "s")

    def choose(table: pa.Table) -> pa.Table:
        size, n = table["size"].to_pylist(), table["n"].to_pylist()
        source_size, target, full = (table[c][0].as_py() for c in ("source_size", "target", "full"))
        extra = fit_budget(dict(zip(size, n)), round(target - full * source_size))
        return table.append_column("extra", pa.array([extra.get(s, 0) for s in size], pa.int64()))

    known = histogram.join(about, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    chosen = known.groupBy("source").applyInArrow(
        choose, "source string, size long, n long, source_size long, target double, full int, extra long"
    )
    largest = histogram.agg(F.max("n")).first()[0] or 0
    choice = stored(chosen.drop("n"), "choice")
    placed = ranked(rows.drop("doc"), ["source", "size"], "seeded", ["at"], slots_for(largest), "_rank", choice)
    placed = placed.withColumn("copies", F.col("full") + (F.col("_rank") < F.col("extra")).cast("int"))
    numbers = placed.select(F.col("at").alias("_at"), "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))
    found = rows.select("doc", "at").join(numbers, F.col("at") == F.col("_at"))
    return found.select(
        *[F.col("doc")[c].alias(c if keep_columns else "doc_id") for c in columns], *[F.col(c).alias(n) for c, n in new.items()]
    )
