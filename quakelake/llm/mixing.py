"""Mixing sources to target weights, in DataFrame expressions only.

Tokens are counted per source; a source's rate is its target over its tokens. Each document is
emitted floor(rate) times, and once more when a hash of its key, read as a number in [0, 1), falls
below the fraction of the rate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quakelake.llm.support import WORD, numbered, pick, stored, text_of

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = "mix"
_HEX_DIGITS = 13


def size_of(text: Column) -> Column:
    """Words of a text. A word starts wherever a word character follows none."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def chance(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the key and the seed alone."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))), 1, _HEX_DIGITS)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(16**_HEX_DIGITS))


def _ranked(sources: DataFrame) -> DataFrame:
    """Rank of each source by code point, null last, with no global sort in one task.

    Range partitions are numbered in order; a source's rank is its place within its partition plus
    the sources of all partitions before. Only partition totals meet in one task.
    """
    dealt = sources.repartitionByRange(F.col("source").asc_nulls_last())
    dealt = stored(dealt.withColumn("part", F.spark_partition_id()), "mix-sources")
    totals = dealt.groupBy("part").agg(F.count("*").alias("n"))
    before = totals.select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")
    )
    inside = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    return dealt.withColumn("place", F.row_number().over(inside)).join(before, "part").select(
        "source", "source_size", (F.col("before") + F.col("place") - 1).alias("rank")
    )


def targets(
    sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(source, source_size, target) for each (source, source_size).

    A target is the weight times a common level, but no more than ``most`` times the source's size.
    What a source cannot take raises the level for the others: the level is found by one small
    aggregate per round, until no source changes sides. Weights repeat in order of the sources.
    """
    repeating = F.array(*(F.lit(float(w)) for w in weights))
    ranked = _ranked(sources).select(
        "source",
        "source_size",
        F.element_at(repeating, (F.pmod("rank", F.lit(len(weights))) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * float(most)).alias("bound"),
    )
    ranked = stored(ranked, "mix-weights")
    total, weight = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    wanted = share * (total or 0)
    level, full_before = (wanted / weight if weight else 0.0), 0
    while weight:
        full = F.col("bound") <= F.col("weight") * F.lit(level)
        held, n_full, open_weight = ranked.agg(
            F.sum(F.when(full, F.col("bound"))), F.count_if(full), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if n_full == full_before or not open_weight:
            break
        level, full_before = (wanted - (held or 0.0)) / open_weight, n_full
    target = F.least(F.col("bound"), F.col("weight") * F.lit(level))
    return ranked.select("source", "source_size", target.alias("target"))


def _planned(sized: DataFrame, key: str, source: str, settings: dict) -> DataFrame:
    """Rows with a column ``size``, with source_size, target and copies added."""
    seed = settings.pop("seed", SEED)
    sources = sized.groupBy(F.col(source).alias("source")).agg(F.sum("size").alias("source_size"))
    aimed = stored(targets(sources, **settings), "mix-targets").withColumnRenamed("source", "of_source")
    rows = sized.join(aimed, F.col(source).eqNullSafe(F.col("of_source"))).drop("of_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = rows.withColumn("rate", rate)
    more = chance(F.col(key), seed) < F.col("rate") - F.floor("rate")
    return rows.withColumn("copies", F.floor("rate").cast("long") + more.cast("long"))


def plan(docs: DataFrame, **settings) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) of every row.

    Settings: weights, share and most of ``targets``, and seed. A null source is a source of its
    own, last in order. A null or empty text has size 0. A source of size 0 has target 0 and no
    copies. Repeated rows, and all rows of null doc_id, are decided alike. An empty table gives no
    rows. The aggregate of sources combines before its shuffle; the sources are joined back from a
    stored table, so adaptive execution can split a source with many rows.
    """
    sized = pick(docs, "doc_id", "text", "source").withColumn("size", size_of(text_of())).drop("text")
    planned = _planned(sized, "doc_id", "source", settings)
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return planned.select("doc_id", "size", "source_size", "target", "copies", taken)


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The rows of the mix, with the columns of ``docs``: each document as often as planned."""
    rows, at = numbered(docs)
    sized = rows.withColumn("size", size_of(text_of(at["text"])))
    planned = _planned(sized, at["doc_id"], at["source"], settings)
    chosen = planned.where("copies > 0").select(*rows.columns, "copies")
    copies = chosen.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return copies.select(*rows.columns).toDF(*docs.columns)
