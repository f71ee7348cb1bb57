"""Sharding by a hierarchical weighted hash tree, in DataFrame functions only.

A row descends the levels region, rack and shard. At each node every child draws an
exponential variate from the hash of (level, child, key), divided by the summed weight below
the child; the least draw wins, so a child wins in proportion to its weight. A row draws only
among the children on its own path: the sum of the levels' widths, not the number of leaves.
A changed weight alters the draws of the nodes above it alone, so a row that moves leaves or
enters a subtree whose weight changed; rows elsewhere keep their shards.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.words import unused


@dataclass(frozen=True)
class Shard:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def grid(shards: int, per_rack: int = 4, racks_per_region: int = 3) -> list[Shard]:
    """Equal shards 0..n-1, filled rack by rack; growing only appends leaves."""
    per_region = per_rack * racks_per_region
    return [Shard(i // per_region, i // per_rack, i) for i in range(shards)]


def grown(tree: list[Shard]) -> list[Shard]:
    """The tree and one shard more, numbered after the last, in a region and rack of its own.

    No other node's weight changes, so rows move only into the new shard. `grid` of one shard
    more is the same tree where all regions are full (24 shards); elsewhere it fills a rack,
    and that rack takes rows into its older shards too.
    """
    last = max(tree, key=lambda s: s.shard)
    region, rack = max(s.region for s in tree) + 1, max(s.rack for s in tree) + 1
    return [*tree, Shard(region, rack, last.shard + 1)]


LEVELS = ("region", "rack", "shard")


def _winner(level: int, weights: dict[int, float], key: str) -> Column:
    """The child with the least draw, the lesser number on a tie; a single child draws nothing."""
    if len(weights) == 1:
        return F.lit(next(iter(weights)))
    draws = []
    for child, weight in sorted(weights.items()):
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(level), F.lit(child), F.col(f"`{key}`")), 11)
        uniform = (bits.cast("double") + 0.5) / F.lit(float(2**53))
        draws.append(F.struct((-F.log(uniform) / F.lit(weight)).alias("draw"), F.lit(child).alias("child")))
    return F.array_min(F.array(*draws))["child"]


def place(df: DataFrame, tree: list[Shard], key: str, out: str = "shard") -> DataFrame:
    """Add column ``out``: the shard that the key descends to; a column of that name is replaced.

    A null key is a key. Numbers of racks and shards must be unique in the whole tree.
    """
    if not tree or any(s.weight <= 0 for s in tree):
        raise ValueError("a tree needs shards with positive weights")
    # node -> its children's summed weights, the root being None
    below: list[dict[int | None, dict[int, float]]] = [{}, {}, {}]
    for s in tree:
        for level, (node, child) in enumerate(((None, s.region), (s.region, s.rack), (s.rack, s.shard))):
            children = below[level].setdefault(node, {})
            children[child] = children.get(child, 0.0) + s.weight
    if len({s.shard for s in tree}) < len(tree) or len({(s.region, s.rack) for s in tree}) > len(below[2]):
        raise ValueError("a number of a rack or shard occurs twice")
    columns = [c for c in df.columns if c.lower() != out.lower()]
    names = [unused(df, f"_{name}") for name in LEVELS]
    at = _winner(0, below[0][None], key)
    for level, name in enumerate(names):
        df = df.withColumn(name, at)
        if level + 1 < len(names):
            choices = [(node, _winner(level + 1, w, key)) for node, w in below[level + 1].items()]
            at = choices[-1][1]
            for node, winner in reversed(choices[:-1]):
                at = F.when(F.col(name) == node, winner).otherwise(at)
    return df.select(*(F.col(f"`{c}`") for c in columns), F.col(names[-1]).cast("int").alias(out))


def number_slots(df: DataFrame, shard: str, order: list[str], out: str = "slot") -> DataFrame:
    """Add column ``out``: 0, 1, 2, ... without gaps in each shard.

    Rows of a shard are dealt by hash of ``order`` into about sqrt(rows) buckets; a running
    sum over the buckets' counts gives each its first slot and a row number the rest. So no
    task holds a shard: a bucket has about sqrt(rows) rows, a shard about sqrt(rows) counts.
    """
    buckets = F.lit(max(1, int(df.count() ** 0.5)))
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), buckets))
    counts = dealt.groupBy(F.col(shard).alias("_s"), F.col("_bucket").alias("_b")).count()
    before = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("_s", "_b", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy(shard, "_bucket").orderBy(*order)
    return (
        dealt.withColumn("_row", F.row_number().over(inside))
        .join(first, F.col(shard).eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
        .withColumn(out, F.col("_first") + F.col("_row") - 1)
        .drop("_bucket", "_s", "_b", "_first", "_row")
    )


def shard_documents(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Assign every document by its id: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the text's UTF-8 bytes (a null text has none) plus 8. A null id is placed
    like any key. Rows that share an id share a shard; each row has its own slot. Other
    columns of the table are not read.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(content) + 8).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
    )
    placed = place(rows, grid(shards), "doc_id", "shard")
    placed = place(placed, grown(grid(shards)), "doc_id", "grown_shard")
    numbered = number_slots(placed, "shard", ["doc_id", "size", "text_crc32"])
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
