"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from carelake.llm.prefix_sums import running_totals

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
EPOCHS = 3
SEED = "mix"


def word_count(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size) -> with weight, rank, target.

    Sources in code-point order, null last, take the weights in turn and share
    the total size by weight. A target stops at ``epochs`` times its source's
    size; what is over is shared again by weight. In the order of limit / weight
    the sources that stop are a prefix: each of them would get its limit or more
    from what those before it leave. One row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    ahead = (Window.orderBy(F.col("limit") / F.col("weight"), "rank")
             .rowsBetween(Window.unboundedPreceding, -1))
    none = F.lit(0).cast("long")
    ranked = (sizes.withColumn("rank", F.row_number().over(by_name))
              .withColumn("weight", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]),
                                                 (F.col("rank") - 1) % len(weights) + 1))
              .withColumn("limit", F.col("source_size") * epochs))
    shared = (ranked.withColumn("left_size", F.sum("source_size").over(everything)
                                - F.coalesce(F.sum("limit").over(ahead), none))
              .withColumn("left_weight", F.sum("weight").over(everything)
                          - F.coalesce(F.sum("weight").over(ahead), none))
              .withColumn("stops", F.col("left_size") * F.col("weight") > F.col("limit") * F.col("left_weight")))
    stopped = F.col("stops")
    open_size = (F.sum("source_size").over(everything)
                 - F.coalesce(F.sum(F.when(stopped, F.col("limit"))).over(everything), none))
    open_weight = F.sum(F.when(~stopped, F.col("weight"))).over(everything)
    target = F.when(stopped, F.col("limit").cast("double")).otherwise(
        (open_size * F.col("weight")).cast("double") / open_weight.cast("double"))
    return shared.withColumn("target", target).select("source", "rank", "weight", "source_size", "target")


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, seed: str = SEED,
        carry: tuple[str, ...] = ()) -> DataFrame:
    """Columns (doc_id, source, text) -> one row per document: doc_id, source, size, source_size, target, taken, times.

    Every source is shuffled by a seeded digest and repeated up to ``epochs``
    times. An item's virtual finish time is the source's tokens up to its end
    over the source's target. Items of all sources are sorted by finish time by
    range, and taken while their running total stays within the total size.
    Sizes are words, so empty and null texts have size 0 and are taken 0 times.
    A null source is a source of its own. Columns in ``carry`` are kept, and order rows
    that tie in source, doc_id and size. Repeated rows are separate documents.
    Two range sorts of narrow rows; no source is gathered in one task. Extra
    columns are ignored. An empty table gives an empty table.
    """
    size = word_count(F.col("text"))
    rows = documents.select(
        "doc_id", "source", *carry, size.alias("size"),
        F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("shuffle"))
    by_source = [F.col("source").asc_nulls_last(), F.col("shuffle"), F.col("doc_id"), F.col("size"), *map(F.col, carry)]
    rows = running_totals(rows, by_source, "size", "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ahead = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    targets = source_targets(sizes, weights, epochs).withColumn(
        "source_start", F.coalesce(F.sum("source_size").over(ahead), F.lit(0).cast("long")))
    known = rows.join(targets.withColumnRenamed("source", "of_source"),
                      F.col("source").eqNullSafe(F.col("of_source")), "left").drop("of_source")
    laps = F.ceil(F.col("target") / F.col("source_size")).cast("int")
    items = (known.where((F.col("size") > 0) & (F.col("target") > 0))
             .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.least(laps, F.lit(epochs)) - 1)))
             .select("part", "place", "size", "rank", "epoch",
                     ((F.col("epoch") * F.col("source_size") + F.col("before") - F.col("source_start") + F.col("size"))
                      .cast("double") / F.col("target")).alias("finish"))
             .withColumnsRenamed({"part": "row_part", "place": "row_place"}))
    # Equal finish times within a source belong to one running total, so epoch and size decide nothing further.
    queue = running_totals(items, [F.col("finish"), F.col("rank"), F.col("epoch"), F.col("row_part"), F.col("row_place")],
                           "size", "mix-queue")
    budget = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    taken = (queue.where(F.col("before") + F.col("size") <= budget)
             .groupBy("row_part", "row_place").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("count")))
    return (known.join(taken, (F.col("part") == F.col("row_part")) & (F.col("place") == F.col("row_place")), "left")
            .select("doc_id", "source", *carry, "size", "source_size", "target",
                    F.coalesce("words", F.lit(0)).cast("long").alias("taken"),
                    F.coalesce("count", F.lit(0)).cast("long").alias("times")))
