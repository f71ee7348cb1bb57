"""Connected components of links, and a cheap cut before a large semi-join."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.sources.paths import stage

# A filter by residue knows so many residues, as bits of words: at most 2**20 words are broadcast.
RESIDUES, WORD = 1 << 26, 64


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every linked node; a component is named by its least node.

    Labels spread along links and then jump to their label's label, until nothing changes:
    about log(diameter) rounds. Every round is two equi-joins of written tables, whose
    crowded keys AQE can split, and one grouping combined map-side.
    """
    ends = links.select(F.col(a).alias("src"), F.col(b).alias("dst")).filter("src <> dst")
    both = stage(ends.union(ends.select("dst", "src")).distinct())
    labels = stage(
        both.groupBy("src").agg(F.min("dst").alias("dst")).select(
            F.col("src").alias("node"), F.least("src", "dst").alias("component")
        )
    )
    while True:
        seen = (
            both.join(labels, F.col("dst") == F.col("node"))
            .groupBy("src")
            .agg(F.min("component").alias("seen"))
        )
        pulled = labels.join(seen, F.col("node") == F.col("src")).select(
            "node", F.col("component").alias("old"), F.least("component", "seen").alias("component")
        )
        up = labels.select(F.col("node").alias("up"), F.col("component").alias("higher"))
        jumped = stage(
            pulled.join(up, F.col("component") == F.col("up")).select(
                "node", "old", F.least("component", "higher").alias("component")
            )
        )
        labels = jumped.select("node", "component")
        if jumped.filter("old <> component").isEmpty():
            return labels


def thin_out(df: DataFrame, key: str, wanted: DataFrame, wanted_key: str) -> DataFrame:
    """Rows of ``df`` that may have their key in ``wanted`` (written); all that have it stay.

    It spares the shuffle of a wide table when few keys are wanted; the exact join follows. The residues of
    the wanted keys' hashes are the bits of a bitmap, whose words are broadcast. Where so many keys are
    wanted that the bitmap would let most rows through, ``df`` comes back as it is.
    """
    if wanted.count() > RESIDUES // 4:
        return df
    residue = lambda c: F.pmod(F.xxhash64(c), F.lit(RESIDUES))
    bit = lambda r: F.call_function("shiftleft", F.lit(1).cast("long"), (r % WORD).cast("int"))
    listed = wanted.select(residue(F.col(wanted_key)).alias("_residue"))
    words = listed.groupBy((F.col("_residue") / WORD).cast("int").alias("_word")).agg(
        F.bit_or(bit(F.col("_residue"))).alias("_bits")
    )
    here = residue(F.col(key))
    known = ((here / WORD).cast("int") == F.col("_word")) & (F.col("_bits").bitwiseAND(bit(here)) != 0)
    return df.join(F.broadcast(words), known, "left_semi")
