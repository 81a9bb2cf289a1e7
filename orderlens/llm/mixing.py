"""Mixing sources to target weights by a low-discrepancy schedule of equal word blocks.

Slot i of the mix takes the golden-ratio point frac((i + 1) * phi) and goes to the source
in whose share of [0, 1) the point lies, so every stretch of the mix has the sources in
about their shares. The r-th slot of a source takes the r-th block of `block` words of
its documents, laid end to end in an order shuffled by a hash of the id; after the last
block the source starts over. A source stops at its target exactly: its last slot is cut.

Positions are sums in two levels (per source and hash bucket, then inside a bucket), so
neither a source with a third of all rows nor the run of slots passes through one task.
All sums are integers and the shuffle is a hash, so reruns agree.

Defined results: null text has size 0; documents of size 0 are never taken; a null source
is a source of its own, last in order; a source of size 0 has target 0. Rows with the same
doc_id are told apart by their size and otherwise share alike. Empty in, empty out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.session import cut_lineage

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2
BLOCK = 1024
PHI = 0.6180339887498949
#: Points per slot of quota. Three gaps of the golden sequence cover any interval as long as
#: one slot's share, so four points a slot reach every quota.
POINTS = 4
CHUNK = 4096
BUCKET_DIGITS = 3
WORD = r"[^\x20\x09-\x0D]+"


def words_in(text: Column) -> Column:
    """Number of words. Everything but a word's last character goes, then the rest is counted."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """One narrow row per document; `mix_bucket` and `mix_order` are its place in the shuffle."""
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source"),
        words_in(F.col("text")).alias("size"),
        F.substring(order, 1, BUCKET_DIGITS).alias("mix_bucket"),
        order.alias("mix_order"),
    )


def targets(sizes: DataFrame) -> DataFrame:
    """Source, size, target in words. `sizes` has one row per document.

    Capped sources are those with the least size per weight; so after sorting by it, the
    final level follows from running sums, without repeating the resharing. The table has
    one row per source, which is why its windows need no key.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (turn + 1).cast("int"))
    cap = F.col("source_size") * MOST
    ratio = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    leveled = (
        per.withColumn("weight", weight)
        .withColumn("cap", cap)
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(SHARE))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn(
            "level",
            (F.col("total") - F.col("cap_before")) / (F.col("weights") - F.col("weight_before")),
        )
        .withColumn("fits", F.col("cap") >= F.col("level") * F.col("weight"))
    )
    # the first source below its cap fixes the level for itself and all after it
    level = F.min_by("level", F.when(F.col("fits"), F.struct("cap_before", "level"))).over(everything)
    return leveled.withColumn("level", level).select(
        "source",
        "source_size",
        F.coalesce(
            F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")),
            F.col("cap").cast("double"),
        ).alias("target"),
    )


def quotas(target: DataFrame, block: int) -> DataFrame:
    """Slots per source, and the source's part [low, high) of the unit interval."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    return (
        target.where("source_size > 0")
        .withColumn("words", F.least(F.round("target"), F.col("source_size") * MOST).cast("long"))
        .withColumn("blocks", F.ceil(F.col("source_size") / block))
        .withColumn("passes", F.floor(F.col("words") / F.col("source_size")))
        .withColumn("rest", F.col("words") - F.col("passes") * F.col("source_size"))
        .withColumn("quota", F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / block))
        .withColumn("all", F.sum("quota").over(Window.partitionBy()))
        .withColumn("to", F.sum("quota").over(upto))
        .where("quota > 0")
        .select(
            "source",
            "source_size",
            "words",
            "quota",
            ((F.col("to") - F.col("quota")) / F.col("all")).alias("low"),
            (F.col("to") / F.col("all")).alias("high"),
        )
    )


def schedule(quota: DataFrame) -> DataFrame:
    """Slot, source, and the slot's rank in its source, for slots within the source's quota."""
    spark = quota.sparkSession
    slots = int(quota.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0])
    points = spark.range(slots * POINTS).withColumnRenamed("id", "slot")
    phase = F.expr(f"(slot + 1) * {PHI}D")
    points = points.withColumn("point", phase - F.floor(phase)).withColumn(
        "chunk", F.floor(F.col("slot") / CHUNK)
    )
    # one row per source: as small as the list of sources
    parts = F.broadcast(quota.select("source", "quota", "low", "high"))
    dealt = points.join(parts, (F.col("point") >= F.col("low")) & (F.col("point") < F.col("high")))
    counts = dealt.groupBy("source", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = (
        Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    base = counts.select(
        F.col("source").alias("_source"),
        F.col("chunk").alias("_chunk"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"),
    )
    inside = Window.partitionBy("source", "chunk").orderBy("slot")
    return (
        dealt.withColumn("inner", F.row_number().over(inside) - 1)
        .join(base, F.col("source").eqNullSafe(F.col("_source")) & (F.col("chunk") == F.col("_chunk")))
        .withColumn("rank", F.col("base") + F.col("inner"))
        .where("rank < quota")
        .select("slot", "source", "rank")
    )


def laid_out(sizes: DataFrame) -> DataFrame:
    """Each document's first position among its source's words."""
    per = sizes.groupBy("source", "mix_bucket").agg(F.sum("size").alias("n"))
    earlier = (
        Window.partitionBy("source")
        .orderBy("mix_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    base = per.select(
        F.col("source").alias("_source"),
        F.col("mix_bucket").alias("_bucket"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"),
    )
    inside = (
        Window.partitionBy("source", "mix_bucket")
        .orderBy("mix_order", F.col("doc_id").asc_nulls_last(), "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        sizes.where("size > 0")
        .withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(
            base,
            F.col("source").eqNullSafe(F.col("_source"))
            & (F.col("mix_bucket") == F.col("_bucket")),
        )
        .select("doc_id", "source", "size", (F.col("base") + F.col("inner")).alias("start"))
    )


def mix(sizes: DataFrame, target: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix as pieces: slot, doc_id, source, piece_start (word in the document), piece_words.

    The slots give the order; pieces of one slot follow in the order of `piece_at`.
    """
    quota = quotas(target, block)
    need = quota.select(
        F.col("source").alias("_source"), "source_size", F.col("words").alias("words")
    )
    slots = (
        schedule(quota)
        .join(F.broadcast(need), F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("blocks", F.ceil(F.col("source_size") / block))
        # words of the source that all slots before this one have taken
        .withColumn("pass", F.floor(F.col("rank") / F.col("blocks")))
        .withColumn("block", F.col("rank") % F.col("blocks"))
        .withColumn("from", F.col("block") * block)
        .withColumn("before", F.col("pass") * F.col("source_size") + F.col("from"))
        .withColumn(
            "upto",
            F.least(
                F.col("from") + block,
                F.col("source_size"),
                F.col("from") + F.col("words") - F.col("before"),
            ),
        )
        .where(F.col("upto") > F.col("from"))
        .select(F.col("source").alias("_source"), F.col("block").alias("_block"), "slot", "from", "upto")
    )
    pieces = laid_out(sizes).withColumn(
        "block",
        F.explode(
            F.sequence(
                F.floor(F.col("start") / block),
                F.floor((F.col("start") + F.col("size") - 1) / block),
            )
        ),
    )
    first = F.greatest("start", "from")
    return (
        pieces.join(
            slots,
            F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block")),
        )
        .withColumn("piece_at", first)
        .withColumn("piece_words", F.least(F.col("start") + F.col("size"), F.col("upto")) - first)
        .where("piece_words > 0")
        .select(
            "slot",
            "doc_id",
            "source",
            "size",
            (F.col("piece_at") - F.col("start")).alias("piece_start"),
            "piece_words",
            "piece_at",
        )
    )


def taken(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per document: its size, its source's size and target, the words the mix takes."""
    sizes = cut_lineage(sized(docs))
    target = cut_lineage(targets(sizes))
    # rows that share an id and a size are alike to the mix and share what it takes
    alike = ["doc_id", "source", "size"]
    took = (
        mix(sizes, target, block)
        .groupBy(*alike)
        .agg(F.sum("piece_words").alias("taken_all"))
        .select(*(F.col(c).alias(f"_{c}") for c in alike), "taken_all")
    )
    twin = Window.partitionBy(*alike)
    nth = Window.partitionBy(*alike).orderBy("mix_order")
    rows = (
        sizes.withColumn("twins", F.count(F.lit(1)).over(twin))
        .withColumn("nth", F.row_number().over(nth))
        .join(
            took,
            F.col("doc_id").eqNullSafe(F.col("_doc_id"))
            & F.col("source").eqNullSafe(F.col("_source"))
            & (F.col("size") == F.col("_size")),
            "left",
        )
        .withColumn("all", F.coalesce("taken_all", F.lit(0)))
    )
    own = F.floor(F.col("all") / F.col("twins")) + (
        F.col("nth") <= F.col("all") % F.col("twins")
    ).cast("long")
    of = F.broadcast(  # one row per source
        target.select(F.col("source").alias("of_source"), "source_size", "target")
    )
    return rows.join(of, F.col("source").eqNullSafe(F.col("of_source"))).select(
        "doc_id", "size", "source_size", "target", own.cast("long").alias("taken"), "source"
    )
