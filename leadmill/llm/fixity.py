"""Merkle fixity audit of WARC records: find where a replica differs without comparing every record.

A record's place is its id. Leaves hash the records of one place; a node hashes up to FANOUT
children with their places and lengths, so every level covers ordered, ever longer ranges of
offsets; the nodes of level FILE_LEVEL are files. Roots are compared first, and only children of
nodes that differ are looked at, down to the leaves.

Leaf hashes add up the hashes of the records with one id, so records may repeat ids, in any number
and order. Records without an id are in the place -1. Null addresses and texts count as empty.
Empty tables have no nodes: against them, every record is missing or extra. Other columns do not
matter, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadmill.llm.shared import pick, staged

FANOUT, FILE_LEVEL = 16, 3
NO_PLACE = -1


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """A response record as it is in a WARC file."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def _above(node: Column | str, levels: int = 1) -> Column:
    return F.floor((F.col(node) if isinstance(node, str) else node) / FANOUT ** levels).cast("long")


@dataclass
class MerkleTree:
    """Levels from leaves to roots: ``node``, ``hash``, ``n_records`` and ``n_bytes``."""

    levels: list[DataFrame]


def leaves(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One leaf for each id, from records that are hashed where they are."""
    rows = pick(pages, page_id, url, html)
    record = warc_record(F.col(page_id), F.col(url), F.col(html))
    hashed = rows.select(F.coalesce(F.col(page_id).cast("long"), F.lit(NO_PLACE)).alias("node"),
                         F.sha2(record, 256).alias("h"), F.octet_length(record).cast("long").alias("length"))
    # Sums of the four 64-bit parts do not depend on order and can be added up before the shuffle.
    parts = [F.sum(F.conv(F.substring("h", 16 * i + 1, 16), 16, 10).cast("decimal(20,0)")).alias(f"p{i}") for i in range(4)]
    added = hashed.groupBy("node").agg(F.count(F.lit(1)).alias("n_records"), F.sum("length").alias("n_bytes"), *parts)
    whole = F.concat_ws(":", "node", "n_records", "n_bytes", "p0", "p1", "p2", "p3")
    return added.select("node", F.sha2(whole, 256).alias("hash"), "n_records", "n_bytes")


def merkle_tree(first: DataFrame, height: int) -> MerkleTree:
    """The tree over leaves; every level is written once and read by what compares it."""
    levels = [staged(first)]
    for _ in range(height):
        children = F.array_sort(F.collect_list(F.struct("node", "n_bytes", "hash")))  # at most FANOUT
        text = F.array_join(F.transform(children, lambda c: F.concat_ws(":", c["node"], c["n_bytes"], c["hash"])), "|")
        levels.append(staged(levels[-1].groupBy(_above("node").alias("node")).agg(
            F.sha2(text, 256).alias("hash"), F.sum("n_records").alias("n_records"), F.sum("n_bytes").alias("n_bytes"))))
    return MerkleTree(levels)


def _height(*firsts: DataFrame) -> int:
    """Levels above the leaves, so that all places from 0 have one root; files are a level anyhow."""
    most = max((df.agg(F.max("node")).first()[0] or 0) for df in firsts)
    height = FILE_LEVEL
    while most >= FANOUT ** height:
        height += 1
    return height


def audit(original: DataFrame, replica: DataFrame, page_id: str = "page_id", url: str = "url",
          html: str = "html") -> DataFrame:
    """One row for each place where a replica differs: ``page_id`` (null for records without one),
    ``file`` and ``first_byte`` of the place in the original's files, ``n_bytes`` and
    ``replica_bytes`` of its records (0 if there are none) and ``state``: missing, extra or changed.
    """
    mine, theirs = staged(leaves(original, page_id, url, html)), staged(leaves(replica, page_id, url, html))
    height = _height(mine, theirs)
    a, b = merkle_tree(mine, height).levels, merkle_tree(theirs, height).levels
    differing = None
    for level in range(height, -1, -1):
        x, y = a[level], b[level]
        if differing is not None:  # only children of nodes that differ
            parents = differing.select(F.col("node").alias("_parent"))
            x = x.join(parents, _above("node") == F.col("_parent"), "left_semi")
            y = y.join(parents, _above("node") == F.col("_parent"), "left_semi")
        both = x.select("node", "hash", "n_bytes").join(
            y.select("node", F.col("hash").alias("_hash"), F.col("n_bytes").alias("replica_bytes")), "node", "full")
        differing = staged(both.filter(~F.col("hash").eqNullSafe(F.col("_hash"))))
    # Offsets of all places of the original; a file has a bounded number of places.
    file = _above("node", FILE_LEVEL)
    places = a[0].select("node", (F.sum("n_bytes").over(
        Window.partitionBy(file).orderBy("node")) - F.col("n_bytes")).alias("first_byte"))
    state = F.when(F.col("_hash").isNull(), "missing").when(F.col("hash").isNull(), "extra").otherwise("changed")
    return differing.join(places, "node", "left").select(
        F.when(F.col("node") != NO_PLACE, F.col("node")).alias(page_id), file.alias("file"), "first_byte",
        F.coalesce("n_bytes", F.lit(0)).alias("n_bytes"),
        F.coalesce("replica_bytes", F.lit(0)).alias("replica_bytes"), state.alias("state"))
