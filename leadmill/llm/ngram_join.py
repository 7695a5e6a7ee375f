"""Exact Jaccard join of word n-gram sets, size-aware: small sets by subsets, large ones by lists.

All sets put their elements in one order: first by how frequent they are among documents (only
the frequent ones need to be known), then by hash. Two sets of which the smaller or equal one has
``a`` elements can only reach the similarity if they share ``least_shared(a)`` of them, so that
of the first ``a - least_shared(a) + k`` elements of either, k are common.

- Small sets (fewer elements than a boundary) are keyed by all two-element subsets of their first
  elements, k = 2: two small sets that link have a key in common.
- Large sets, and the small ones near enough to the boundary to link with them, are entered in the
  inverted lists of their first elements, k = 1.
- The boundary is the one with the least estimated number of rows written and compared.

Sets with the same elements are one set from the start. Pairs are first compared by sketches, which
show without loss that most are too different; only the others' sets are made from their whole
texts and compared. Within a key, members are compared with
one centre, not with each other: links to it make components, and what links to the centre can link to
others only if the triangle inequality of the Jaccard distance allows it. What a centre does not
settle goes through ROUNDS of that, and what is then left is compared in pairs of different
components. So no link between components is lost, and a group of copies costs as many comparisons as
it has members. Links and similarities are exact but for equal 64-bit hashes of different shingles.

Texts that are null or without words have no set and link with nothing. Rows with a null id are
returned, without a component. Repeated rows are all returned; rows that repeat an id with another
text are each linked by their own text. Empty tables give empty results, other columns do not
matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadmill.llm.components import components
from leadmill.llm.shared import BROADCAST_IDS, HASHED_BYTES, pick, pieces, staged, unstage
from leadmill.llm.words import mix, shingle_hashes, shingle_sets, word_hashes

# Shingles that come late in the order, at most: the most frequent ones, which are broadcast with their counts. A bound by
# share of documents instead would leave lists that grow with the table, and pairs that grow with their square.
FREQUENT = 500_000
# A batch sends on the shingles that so many of its documents have.
OFTEN = 3
# Candidates for the size from which sets are large; 0 means that all sets are.
BOUNDARIES = [0, 8, 12, 16, 24, 32, 48, 64, 96]
# One in so many list elements enters the estimate of costs, which changes no result.
COST_SAMPLE = 16
# Shingles that a task counts at a time to find frequent ones.
COUNTED_TOGETHER = 500_000
# Rounds of comparing with centres before what is left is compared in pairs.
ROUNDS = 2


def least_shared(size: int | np.ndarray, percent: int) -> int | np.ndarray:
    """How many elements a set of this size shares at least with any set it links to."""
    return -(-size * percent // 100)


def sketch_bits(size: int) -> int:
    """Classes of hashes in a set's sketch: a power of two, at least twice the set's size."""
    return max(64, 1 << (2 * size - 1).bit_length())


def frequent_shingles(rows: DataFrame, text: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (ascending) and counts of shingles that many documents have.

    Batches send on only what several of their own documents have, so a count may be low. Any
    counts give right results; good ones keep frequent passages out of the lists.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for piece in chain(pieces(batches, text, HASHED_BYTES), [None]):
            if piece is not None:
                sets = shingle_sets(piece.column(text), width)
                held += sets
                size += sum(map(len, sets))
            if held and (piece is None or size >= COUNTED_TOGETHER):
                found, n = np.unique(np.concatenate(held), return_counts=True)
                often = n >= OFTEN
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[often].view(np.int64)), pa.array(n[often].astype(np.int64))], names=["shingle", "n"])
                held, size = [], 0

    counts = staged(rows.select(text).mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")))
    table = _most_frequent(counts, FREQUENT).toArrow()
    unstage(counts)
    keys, n = table.column("shingle").to_numpy().view(np.uint64), table.column("n").to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order]


def _most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """At most so many rows, those of the greatest ``n``; of rows within a sixteenth of a power of two all or none."""
    step = F.floor(16 * F.log2("n"))
    held, least = 0, None
    for of_step, many in sorted(map(tuple, counts.groupBy(step).count().collect()), reverse=True):  # some hundred rows
        held += many
        if held > most:
            break
        least = of_step
    return counts.filter(F.lit(False) if least is None else step >= least)


def document_sets(rows: DataFrame, id_column: str, text: str, width: int, percent: int,
                  frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Per row: set size, two hashes that name the set, its first elements for k = 2, in order, and a
    sketch: which classes of hashes the set has elements of."""
    sent = rows.sparkSession.sparkContext.broadcast(frequent)  # at most FREQUENT
    schema = T.StructType([rows.schema[id_column], *[T.StructField(c, T.LongType()) for c in ("n_shingles", "name1", "name2")],
                           T.StructField("first", T.ArrayType(T.LongType())), T.StructField("sketch", T.ArrayType(T.LongType()))])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = sent.value
        for piece in pieces(batches, text, HASHED_BYTES):
            sizes, names, first, ends, sketches = [], [], [], [0], []
            for s in shingle_sets(piece.column(text), width):
                sizes.append(len(s))
                names.append((mix(s).sum(dtype=np.uint64), mix(s ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64)))
                wanted = min(len(s), len(s) - least_shared(len(s), percent) + 2)
                # Sets that can only link with the same set need no candidates.
                if len(s) * (100 - percent) >= percent:
                    often = np.zeros(len(s), np.int64)
                    if len(keys):
                        at = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
                        often = np.where(keys[at] == s, counts[at], 0)
                    # Ascending hashes and a stable sort make the order complete.
                    first.append(s[np.argsort(often, kind="stable")[:wanted]])
                    ends.append(ends[-1] + wanted)
                    bits = np.zeros(sketch_bits(len(s)), np.uint8)
                    bits[s & np.uint64(len(bits) - 1)] = 1
                    sketches.append(np.packbits(bits).view(np.int64).tolist())
                else:
                    ends.append(ends[-1])
                    sketches.append([])
            elements = np.concatenate(first) if first else np.empty(0, np.uint64)
            named = np.array(names, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [piece.column(id_column), pa.array(np.array(sizes, np.int64)), pa.array(named[:, 0].copy()),
                 pa.array(named[:, 1].copy()),
                 pa.ListArray.from_arrays(pa.array(np.array(ends, np.int32)), pa.array(elements.view(np.int64))),
                 pa.array(sketches, pa.list_(pa.int64()))],
                names=schema.names)

    return rows.mapInArrow(make, schema)


def choose_boundary(sets: DataFrame, percent: int) -> int:
    """The boundary of least cost: keys written for small sets, lists written and scanned for large ones."""
    subsets = F.size("first") * (F.size("first") - 1) / 2
    near = {b: F.col("n") >= b * percent / 100 for b in BOUNDARIES}
    written = sets.agg(*[F.sum(F.when(F.col("n") < b, subsets).otherwise(0)
                               + F.when(near[b], F.size("first") - 1).otherwise(0)).alias(str(b)) for b in BOUNDARIES]).first()
    elements = sets.select("n", F.explode(F.slice("first", 1, F.greatest(F.size("first") - 1, F.lit(0)))).alias("e"))
    lists = (elements.filter(F.pmod(F.xxhash64("e"), F.lit(COST_SAMPLE)) == 0).groupBy("e")
             .agg(*[F.count_if(near[b]).alias(str(b)) for b in BOUNDARIES]))
    scanned = lists.agg(*[F.sum(F.col(str(b)) * (F.col(str(b)) - 1.0)).alias(str(b)) for b in BOUNDARIES]).first()
    return min(BOUNDARIES, key=lambda b: (written[str(b)] or 0) + COST_SAMPLE * (scanned[str(b)] or 0))


def keys_of(sets: DataFrame, boundary: int, percent: int) -> DataFrame:
    """``node``, ``n`` and ``keys``: subsets of small sets, list elements of large and nearly large ones.

    A key's ``pos`` is the place of its last element in the order, less the elements before it in the key.
    """
    pairs = F.expr("flatten(transform(first, (x, i) -> transform(slice(first, i + 2, size(first)), "
                   "(y, j) -> struct(xxhash64(x, y) AS key, i + j AS pos))))")
    singles = F.expr("transform(slice(first, 1, greatest(size(first) - 1, 0)), (x, i) -> struct(x AS key, i AS pos))")
    none = F.array().cast("array<struct<key: bigint, pos: int>>")
    made = F.concat(F.when(F.col("n") < boundary, pairs).otherwise(none) if boundary else none,
                    F.when(F.col("n") >= boundary * percent / 100, singles).otherwise(none))
    return sets.select("node", "n", made.alias("keys"))


def _may_link(a: Column | str, b: Column | str, percent: int) -> Column:
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def maybe_similar(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches allow the similarity: an element in a class that the other set lacks is
    not shared, so a set shares at most its size less the number of such classes. Sizes of a pair are
    within a factor of two."""
    mine = sketches.select("node", F.col("sketch").alias("_mine"))
    theirs = sketches.select(F.col("node").alias("other"), F.col("sketch").alias("_theirs"))

    def folded(a: str, b: str) -> Column:
        """A sketch of twice as many classes as the other brought to as many."""
        half = F.size(b)
        halves = F.zip_with(F.slice(a, 1, half), F.slice(a, half + 1, half), lambda x, y: x.bitwiseOR(y))
        return F.when(F.size(a) > half, halves).otherwise(F.col(a))

    def lacking(a: str, b: str) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y)))),
                           F.lit(0), lambda total, n: total + n)

    most = F.least(F.col("n") - lacking("_mine", "_theirs"), F.col("other_n") - lacking("_theirs", "_mine"))
    both = pairs.join(mine, "node").join(theirs, "other").withColumns(
        {"_mine": folded("_mine", "_theirs"), "_theirs": folded("_theirs", "_mine")})
    return both.filter((100 + percent) * most >= percent * (F.col("n") + F.col("other_n"))).select(pairs.columns)


def text_sets(nodes: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """``elements`` of the sets of some nodes, from their whole texts."""
    few = nodes.count() <= BROADCAST_IDS
    chosen = texts.filter("node IS NOT NULL").join(F.broadcast(nodes) if few else nodes, "node", "left_semi")

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "_text", HASHED_BYTES):
            sets = shingle_sets(piece.column("_text"), width)
            ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [piece.column("node"), pa.ListArray.from_arrays(
                    pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))], names=["node", "elements"])

    return chosen.mapInArrow(elements, T.StructType(
        [chosen.schema["node"], T.StructField("elements", T.ArrayType(T.LongType()))]))


def similarities(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``shared`` elements of the sets of ``node`` and ``other``, and the elements of their ``union``."""
    mine = sets.select("node", F.col("elements").alias("_mine"))
    theirs = sets.select(F.col("node").alias("other"), F.col("elements").alias("_theirs"))
    both = pairs.join(mine, "node").join(theirs, "other")
    return both.select(*pairs.columns, F.size(F.array_intersect("_mine", "_theirs")).cast("long").alias("shared")).withColumn(
        "union", F.col("n") + F.col("other_n") - F.col("shared"))


def near_duplicates(df: DataFrame, width: int = 4, percent: int = 85, id_column: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Per row: the id, ``n_shingles`` and ``component_id``, the smallest id reachable by links.

    Documents link if 100 * shared shingles >= ``percent`` * all shingles of both.
    """
    rows = pick(df, id_column, text)
    frequent = frequent_shingles(rows, text, width)
    made = document_sets(rows, id_column, text, width, percent, frequent).withColumnRenamed(id_column, "_id")
    made = staged(made)
    name = ["n_shingles", "name1", "name2"]
    ids = made.drop("first", "sketch").filter("_id IS NOT NULL AND n_shingles > 0")
    same = ids.groupBy(name).agg(F.min("_id").alias("node"))
    members = staged(made.join(same, name, "left").select(
        "_id", "n_shingles", "node",
        *[F.when(F.col("_id") == F.col("node"), F.col(c)).alias(c) for c in ("first", "sketch")]))
    unstage(made)
    sets = members.filter("size(first) > 0").select("node", F.col("n_shingles").alias("n"), "first")
    keyed = keys_of(sets, choose_boundary(sets, percent), percent)
    keys = keyed.select("node", "n", F.explode("keys").alias("k")).select("node", "n", "k.key", "k.pos")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("key")
    active = staged(keys.join(shared, "key"))
    # A set few of whose keys are its own is near the middle of a group of near copies.
    own = active.groupBy("node").agg(F.count(F.lit(1)).alias("common")).join(
        keyed.select("node", F.size("keys").alias("all")), "node").select("node", (F.col("all") - F.col("common")).alias("own"))
    active = staged(_different_keys(active).join(own, "node"))
    sketches = members.filter("size(sketch) > 0").select("node", "sketch")
    texts = rows.withColumnsRenamed({id_column: "node", text: "_text"})
    links = _linked(active, sketches, texts, width, percent)
    found = components(links, "node", "other")
    return members.join(found, "node", "left").select(
        F.col("_id").alias(id_column), "n_shingles",
        F.when(F.col("_id").isNotNull(), F.coalesce("component", "node", "_id")).alias("component_id"))


def _different_keys(active: DataFrame) -> DataFrame:
    """Of keys with the same members only one, with each member's first place among them."""
    members = active.groupBy("key").agg(*[
        F.sum(F.xxhash64("node", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(2)])
    chosen = members.join(members.groupBy("s0", "s1").agg(F.min("key").alias("chosen")), ["s0", "s1"]).select("key", "chosen")
    return active.join(chosen, "key").groupBy(F.col("chosen").alias("key"), "node", "n").agg(F.min("pos").alias("pos"))


def _linked(active: DataFrame, sketches: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (node, other) that connect whatever the members of common keys connect."""
    def compare(pairs: DataFrame, least: int) -> DataFrame:
        """Exact numbers for the pairs that can have a similarity of ``least`` percent."""
        maybe = staged(maybe_similar(pairs, sketches, least))
        nodes = staged(maybe.select("node").unionByName(maybe.select(F.col("other").alias("node"))).distinct())
        sets = staged(text_sets(nodes, texts, width))
        compared = staged(similarities(maybe, sets))
        for done in (sets, nodes, maybe):
            unstage(done)
        return compared

    loose = 2 * percent - 100
    is_link = 100 * F.col("shared") >= percent * F.col("union")
    # Farther from a centre than twice the greatest distance of a link: no link to what links to the centre.
    within = 100 * F.col("shared") >= loose * F.col("union")
    links = None
    for _ in range(ROUNDS):
        centres = active.groupBy("key").agg(F.min(F.struct("own", "node", "n")).alias("c")).select(
            "key", F.col("c.node").alias("other"), F.col("c.n").alias("other_n"))
        with_centre = staged(active.join(centres, "key").filter("node != other"))
        compared = compare(with_centre.filter(_may_link("n", "other_n", loose)).select(
            "node", "n", "other", "other_n").distinct(), loose)
        more = compared.filter(is_link).select("node", "other")
        links = more if links is None else staged(links.unionByName(more))
        judged = with_centre.join(compared.select("node", "other", is_link.alias("links"), within.alias("within")),
                                  ["node", "other"], "left")
        judged = staged(judged.select("key", "node", "n", "pos", "own", F.coalesce("links", F.lit(False)).alias("links"),
                                      F.coalesce("within", F.lit(False)).alias("within")))
        far = ~F.col("links")
        state = judged.groupBy("key").agg(F.max(F.col("within") & far).alias("between"), F.count_if(far).alias("left"))
        # Members that link to the centre matter only to those within reach of it.
        state = state.filter("between OR left > 1").select("key", "between")
        active = staged(judged.join(state, "key").filter(F.col("between") | far).select("key", "node", "n", "pos", "own"))
        if active.isEmpty():
            return links
    # What is left matters where a key's members are in different components.
    labelled = staged(active.join(components(links, "node", "other"), "node", "left").select(
        "key", "node", "n", "pos", F.coalesce("component", "node").alias("component")))
    several = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low != high")
    one = labelled.join(several.select("key"), "key", "left_semi")
    two = one.select("key", *[F.col(c).alias("other" if c == "node" else f"other_{c}") for c in ("node", "n", "pos", "component")])
    # The sizes of a pair say how much it must share, and so how early one of its common keys must come.
    least = F.ceil(percent * (F.col("n") + F.col("other_n")) / (100 + percent))
    early = (F.col("pos") <= F.col("n") - least) & (F.col("other_pos") <= F.col("other_n") - least)
    pairs = one.join(two, "key").filter((F.col("node") < F.col("other")) & (F.col("component") != F.col("other_component"))
                                        & early & _may_link("n", "other_n", percent))
    compared = compare(pairs.select("node", "n", "other", "other_n").distinct(), percent)
    return links.unionByName(compared.filter(is_link).select("node", "other"))
