"""Mixing sources to target weights by capped water-filling.

Every source wants its weight's share of the mix, but none more than ``max_epochs`` times its
size. Water-filling clamps the sources above that cap and shares their excess among the others by
weight, again until none is above: the target is ``min(cap, weight * level)`` at the level that
spends the whole mix. Then each source's rows are repeated ``target div size`` times whole, and
the rest is a fractional repetition: the rows that come first in a seeded order, up to the
remaining number of words; the row on that border gives its first words only.

The border is found without sorting a source: the seeded numbers fall into 4096 bins, the bins
are summed (partial sums before the shuffle), and only the rows in the one border bin of each
source are ordered. All work is DataFrame operations; only three sums a round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import global_index
from .common import WS, n_words, scratch_columns, stored
from .sharding import seeded


def water_fill(sources: DataFrame, total: float, max_epochs: float) -> DataFrame:
    """``sources(source, weight, size)`` with ``target``: capped shares of ``total`` words.

    Where the caps together are below ``total``, every source is at its cap.
    """
    cap = F.lit(float(max_epochs)) * F.col("size")
    level = None
    while True:
        over = F.lit(False) if level is None else F.col("weight") * F.lit(level) > cap
        spent, free, n = sources.agg(F.sum(F.when(over, cap).otherwise(0.0)), F.sum(F.when(over, 0.0).otherwise(F.col("weight"))),
                                     F.sum(over.cast("long"))).first()
        if level is not None and n == clamped or not free:
            break
        clamped, level = (n if level is not None else 0), (total - spent) / free
    wanted = cap if level is None or not free else F.least(cap, F.col("weight") * F.lit(level))
    return sources.withColumn("target", F.greatest(wanted, F.lit(0.0)))


def cyclic_weights(sizes: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """``sizes(source, size)`` with ``weight``: the given weights, repeating over the sources in
    code point order, null last."""
    ranked = global_index(sizes, [F.col("source").asc_nulls_last()], "_rank")
    chosen = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights)).cast("int") + 1)
    return ranked.withColumn("weight", chosen).drop("_rank")


def _bin(draw: Column) -> Column:
    return F.shiftrightunsigned(draw, 48).cast("int")      # draws have 60 bits


def plan_sources(rows: DataFrame, weights: tuple[int, ...], share: float, max_epochs: int) -> DataFrame:
    """A row per source of ``rows(source, size, draw)``: its size, target, whole repetitions, and
    the bin and the words in it (``border``, ``room``) where its fractional repetition ends."""
    sizes = stored(rows.groupBy("source").agg(F.sum("size").alias("size")), "source-sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    plan = water_fill(cyclic_weights(sizes, weights), share * total, max_epochs).withColumn("words", F.floor("target"))
    plan = stored(plan.select(F.col("source").alias("_source"), F.col("size").alias("source_size"), "target",
                              F.when(F.col("size") > 0, F.expr("words div size")).otherwise(0).cast("long").alias("whole"),
                              F.when(F.col("size") > 0, F.expr("words % size")).otherwise(0).cast("long").alias("rest")), "mix-plan")
    bins = rows.groupBy("source", _bin(F.col("draw")).alias("bin")).agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # 4096 rows at most
    before = bins.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0)))
    # the bin in which a source's remaining words run out
    border = (before.join(plan.select("_source", "rest"), F.col("source").eqNullSafe(F.col("_source")))
                    .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")))
                    .select(F.col("source").alias("_b"), F.col("bin").alias("border"), (F.col("rest") - F.col("before")).alias("room")))
    return stored(plan.join(border, F.col("_source").eqNullSafe(F.col("_b")), "left").drop("_b", "rest"), "mix-border")


def _in_border(rows: DataFrame) -> DataFrame:
    """The rows of the border bins with their ``part``, in the seeded order."""
    order = (Window.partitionBy("source").orderBy("draw", F.col("doc_id").asc_nulls_last(), "size")
                   .rowsBetween(Window.unboundedPreceding, -1))
    return (rows.where(_bin(F.col("draw")) == F.col("border"))
                .withColumn("_before", F.coalesce(F.sum("size").over(order), F.lit(0)))
                .withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("room") - F.col("_before"))).cast("long"))
                .drop("_before"))


def mix(rows: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_epochs: int = 2) -> DataFrame:
    """``rows(doc_id, source, size, draw)`` with ``source_size``, ``target``, ``whole`` (times the
    row is repeated whole) and ``part`` (words of one more, fractional repetition).

    The result depends on the rows only, so reruns agree. Rows without words take nothing;
    a null source is one; rows that are equal in ``draw`` and ``doc_id`` share a fraction in any
    order; an empty table gives no rows.
    """
    plan = plan_sources(rows, weights, share, max_epochs)
    planned = rows.join(plan, F.col("source").eqNullSafe(F.col("_source")))
    at = _bin(F.col("draw"))
    clear = (planned.where(F.col("border").isNull() | (at != F.col("border")))
                    .withColumn("part", F.when(at < F.col("border"), F.col("size")).otherwise(0).cast("long")))
    return clear.unionByName(_in_border(planned)).select(*rows.columns, "source_size", "target", "whole", "part")


def sized(docs: DataFrame, seed: int = 6, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(doc_id, source, size, draw)`` of documents, stored: size is the number of words."""
    return stored(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                              n_words(F.col(text_col)).alias("size"), seeded(seed, F.col(id_col)).alias("draw")), "sized")


def mixture(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_epochs: int = 2, seed: int = 6,
            id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", whole_documents: bool = False) -> DataFrame:
    """The mixed rows themselves, with the columns of ``docs``: every row as often as the mix
    repeats it whole, and one text cut to its first words (joined by single spaces) where a
    fractional repetition ends. With ``whole_documents`` no text is cut: that row is repeated once
    more, or not, whichever comes nearer to its source's target. Rows without words are not in the mix; rows without an id are
    drawn by their text's hash; rows with equal ids are drawn together but counted one by one.
    """
    names = ("_key", "_draw", "_size", "_part", "_no", "_rep", "_source", "border", "room", "whole", "source_size", "target")
    c = dict(zip(names, scratch_columns(docs, *names)))
    key = F.coalesce(F.col(id_col).cast("string"),
                     F.concat(F.lit("text:"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))))
    keyed = docs.withColumn(c["_key"], key).withColumn(c["_draw"], seeded(seed, key)).withColumn(c["_size"], n_words(F.col(text_col)))
    rows = stored(keyed.select(F.col(c["_key"]).alias("doc_id"), F.col(source_col).alias("source"), F.col(c["_size"]).alias("size"),
                               F.col(c["_draw"]).alias("draw")), "sized")
    plan = plan_sources(rows, weights, share, max_epochs)
    # the few rows in border bins are told apart by a number among those with their key
    planned = rows.join(plan, F.col("source").eqNullSafe(F.col("_source")))
    number = F.row_number().over(Window.partitionBy("doc_id", "source").orderBy("size", F.desc("part")))
    tight = stored(_in_border(planned).withColumn("no", number).select(
        F.col("doc_id").alias("t_key"), F.col("source").alias("t_source"), F.col("no").alias("t_no"), F.col("part").alias("t_part")), "mix-tight")
    plan = plan.select(*[F.col(n).alias(c[n]) for n in ("_source", "border", "room", "whole", "source_size", "target")])
    wide = keyed.join(plan, F.col(source_col).eqNullSafe(F.col(c["_source"])))
    at, border = _bin(F.col(c["_draw"])), F.col(c["border"])
    clear = (wide.where(border.isNull() | (at != border))
                 .withColumn(c["_part"], F.when(at < border, F.col(c["_size"])).otherwise(0).cast("long")))
    again = F.row_number().over(Window.partitionBy(c["_key"], source_col).orderBy(c["_size"]))
    tight = tight.select(F.col("t_key").alias(c["room"] + "k"), F.col("t_source").alias(c["room"] + "s"), F.col("t_no").alias(c["room"] + "n"),
                         F.col("t_part").alias(c["_part"]))
    edge = wide.where(at == border).withColumn(c["_no"], again)
    edge = edge.join(tight, (F.col(c["_key"]) == F.col(c["room"] + "k")) & F.col(source_col).eqNullSafe(F.col(c["room"] + "s"))
                     & (F.col(c["_no"]) == F.col(c["room"] + "n")))
    part, size, whole = F.col(c["_part"]), F.col(c["_size"]), F.col(c["whole"]).cast("int")
    taken = clear.select(*docs.columns, c["whole"], c["_size"], c["_part"]).unionByName(
        edge.select(*docs.columns, c["whole"], c["_size"], c["_part"]))
    if whole_documents:
        part = F.when(2 * part >= size, size).otherwise(0).cast("long")
    times = F.concat(F.array_repeat(size, whole), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>")))
    out = taken.where(size > 0).withColumn(c["_rep"], F.explode(times))
    first = F.array_join(F.slice(F.split(F.btrim(F.col(text_col), F.lit(" \t\n\x0b\f\r")), WS, -1), 1, F.col(c["_rep"]).cast("int")), " ")
    cut = F.when(F.col(c["_rep"]) < size, first).otherwise(F.col(text_col))
    return out.select(*[cut.alias(n) if n == text_col else F.col(n) for n in docs.columns])
