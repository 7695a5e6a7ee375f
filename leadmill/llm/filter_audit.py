"""What filters remove in every order of application, from one pass over the documents.

Each document becomes a mask: bit i is set if filter i fails it. Documents are counted by part and
mask, so a part has at most 32 cells, whatever its size. A walk through all subsets of filters in
Gray-code order toggles one filter at a time: each cell's counter of active failures goes up or down
by one, and the survivors change by the cells whose counter leaves or reaches 0. The 32 states stored
on the way answer every order: a step's survivors are the state of the filters up to it, what it
removes is the difference of two states, and a filter's Shapley figure is the sum of these
differences over all orders.

The filters, over words (what ASCII white space separates) and code points:
A fewer than 100 words; B fewer than 80 different words in 100; C more than 10 letters A-Z in 100 code
points; D any of ``#$%&*|``; E the text of a smaller id, wherever that is and whether removed or not.

Copies are found by two 64-bit hashes of the text. Rows are first counted by text, part and id, then
by text and part, with partial counts before each shuffle, so that a text that a third of all rows
have is a few rows afterwards.

A null text is an empty one, a null part the empty string. A row with a null id has no smaller one and
is smaller than none. Rows that repeat an id with the same text are all first or all copies. A label
counts if any of the id's label rows has it; labels of other ids do nothing. Empty tables give empty
results; columns other than the named ones do not matter, whatever their names.
"""

from __future__ import annotations

from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadmill.llm.shared import pick

FILTERS = "ABCDE"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Labels that may be broadcast: an id and two flags each.
BROADCAST_LABELS = 1_000_000
COUNTS = ("n", "good", "toxic")


def own_failures(text: str, words: str) -> Column:
    """Bits of the filters that look at a text alone."""
    n, different, points = F.size(words), F.size(F.array_distinct(words)), F.length(text)
    capitals = points - F.length(F.translate(text, UPPER, ""))
    fails = [n < 100, 100 * different < 80 * n, 100 * capitals > 10 * points, F.col(text).rlike(r"[#$%&*|]")]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def labelled(rows: DataFrame, labels: DataFrame, id_column: str) -> DataFrame:
    """The rows with ``good`` and ``toxic``, 1 or 0, by any label row of their id."""
    known = pick(labels, id_column, "quality", "toxic").groupBy(id_column).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    known = known.filter("good = 1 OR toxic = 1")
    few = known.count() <= BROADCAST_LABELS
    return rows.join(F.broadcast(known) if few else known, id_column, "left").fillna(0, ["good", "toxic"])


def failure_cells(df: DataFrame, labels: DataFrame, part: str = "lang", id_column: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """``part``, ``mask``, and how many documents have it: ``n``, of them ``good`` and ``toxic``."""
    rows = pick(df, id_column, part, text).toDF(id_column, "part", "_text").fillna("", ["part", "_text"])
    words = F.filter(F.split("_text", r"[ \t-\r]+"), lambda w: w != "")
    judged = rows.withColumn("_words", words).select(
        id_column, "part", own_failures("_text", "_words").alias("mask"),
        F.xxhash64("_text").alias("text1"), F.xxhash64(F.lit(1), "_text").alias("text2"))
    same = ["text1", "text2"]
    counted = labelled(judged, labels, id_column).groupBy(*same, "part", "mask", id_column).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in COUNTS[1:]])
    nameless = F.col(id_column).isNull()
    of_text = counted.groupBy(*same, "part", "mask").agg(
        *[F.sum(c).alias(c) for c in COUNTS], *[F.sum(F.when(nameless, F.col(c)).otherwise(0)).alias(f"_{c}") for c in COUNTS],
        F.min(id_column).alias("least"), F.min_by(F.struct(*COUNTS), id_column).alias("at_least"))
    of_text = of_text.withColumn("first", F.col("least") == F.min("least").over(Window.partitionBy(*same)))
    here = {c: F.col(f"_{c}") + F.when(F.col("first"), F.col(f"at_least.{c}")).otherwise(0) for c in COUNTS}
    copies = F.col("mask").bitwiseOR(1 << FILTERS.index("E"))
    split = of_text.select("part", F.explode(F.array(
        F.struct(F.col("mask"), *[here[c].alias(c) for c in COUNTS]),
        F.struct(copies.alias("mask"), *[(F.col(c) - here[c]).alias(c) for c in COUNTS]))).alias("cell"))
    return split.select("part", "cell.*").filter("n > 0").groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in COUNTS])


def subset_states(cells: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Per part the survivors of every subset of filters, by its number: arrays ``n``, ``good`` and ``toxic``;
    and by filter ``fails`` and ``unique``, the documents that fail it, and those that fail no other."""
    def walk(found: pd.DataFrame) -> pd.DataFrame:
        masks, counts = found["mask"].to_numpy(), found[list(COUNTS)].to_numpy()  # at most 2 ** len(filters) rows
        active = [0] * len(masks)  # failures of each cell under the filters that are on
        alive = counts.sum(0)
        states = [None] * (1 << len(filters))
        subset = 0
        states[0] = alive.tolist()
        for step in range(1, len(states)):
            bit = step & -step  # the one filter that a Gray code toggles here
            subset ^= bit
            change = 1 if subset & bit else -1
            for cell, mask in enumerate(masks):
                if mask & bit:
                    active[cell] += change
                    if change > 0 and active[cell] == 1:
                        alive = alive - counts[cell]
                    elif change < 0 and active[cell] == 0:
                        alive = alive + counts[cell]
            states[subset] = alive.tolist()
        fails = [int(counts[(masks >> i) & 1 == 1, 0].sum()) for i in range(len(filters))]
        unique = [int(counts[masks == 1 << i, 0].sum()) for i in range(len(filters))]
        made = {"part": found["part"].iloc[0], **dict(zip(COUNTS, zip(*states, strict=True), strict=True))}
        return pd.DataFrame([made | {"fails": fails, "unique": unique}])

    arrays = ", ".join(f"{c} array<bigint>" for c in (*COUNTS, "fails", "unique"))
    return cells.groupBy("part").applyInPandas(walk, f"part string, {arrays}")


def order_steps(states: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step of it."""
    def subset(names: str) -> int:
        return sum(1 << filters.index(f) for f in names)

    steps = [(order, k + 1, filters.index(order[k]), subset(order[:k]), subset(order[:k + 1]))
             for order in map("".join, permutations(filters)) for k in range(len(filters))]
    names = ("filter_order", "step", "filter", "before", "after")
    listed = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, s, strict=True)]) for s in steps])
    rows = states.withColumn("s", F.explode(listed)).select("*", "s.*").drop("s")

    def lost(count: str) -> Column:
        return F.get(count, F.col("before")) - F.get(count, F.col("after"))

    each = rows.select("part", "filter_order", "step", "filter", F.get("n", F.col("after")).alias("kept"), lost("n").alias("removed"),
                       F.get("fails", F.col("filter")).alias("fails"), F.get("unique", F.col("filter")).alias("unique_fails"),
                       lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"))
    shares = F.sum("removed").over(Window.partitionBy("part", "filter"))  # as many rows as there are orders
    return each.select("part", "filter_order", "step", "kept", "removed", (F.col("fails") - F.col("removed")).alias("redundant"),
                       "unique_fails", "good_lost", "toxic_lost", shares.alias("shapley"))


def audit_filters(df: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """``kept``, ``removed``, ``redundant``, ``unique_fails``, ``good_lost``, ``toxic_lost`` and ``shapley`` for every
    part, order of the five filters and step."""
    return order_steps(subset_states(failure_cells(df, labels, part)))
