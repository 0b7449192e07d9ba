"""Document fingerprints: all shingle hashes below a fixed fraction of the hash range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from carelake.llm.prefix_sums import shuffle_partitions

SPACE = r"[\x20\x09-\x0D]+"
SHINGLE = 5
FRACTION = 8
HEX = 16


def shingle_hashes(df: DataFrame, text: str, out: str, k: int = SHINGLE) -> DataFrame:
    """Adds the hashes of all k-word shingles of a text, whole texts of fewer words as one.

    Words are hashed once; then neighbours are joined by doubling, so a window
    of five takes three passes. Every step is a column of its own, so none is
    computed twice.
    """
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), SPACE), lambda w: w != "")
    df = df.withColumn(out, F.transform(words, lambda w: F.xxhash64(w)))
    df = df.withColumn("_short", F.when((F.size(out) < k) & (F.size(out) > 0), F.xxhash64(F.col(out))))
    for step in _steps(k):
        df = _joined(df, out, step)
    return df.withColumn(out, F.when(F.col("_short").isNotNull(), F.array("_short")).otherwise(F.col(out))).drop("_short")


def _steps(k: int) -> list[int]:
    """By how much each pass widens the window: 1, 2, 4 and the rest; their sum is k - 1."""
    steps, width = [], 1
    while width < k:
        steps.append(min(width, k - width))
        width += steps[-1]
    return steps


def _joined(df: DataFrame, column: str, by: int) -> DataFrame:
    """Each hash joined with the one ``by`` places on; the last ``by`` go."""
    n = F.greatest(F.size(column) - by, F.lit(0))
    return df.withColumn(column, F.zip_with(F.slice(column, F.lit(1), n), F.slice(column, F.lit(by + 1), n),
                                            lambda a, b: F.xxhash64(a, b)))


def sketch(df: DataFrame, text: str, out: str, k: int = SHINGLE, fraction: int = FRACTION) -> DataFrame:
    """Adds the sketch of a text: its distinct shingle hashes in the lowest 1/fraction of the range, in order.

    The threshold is the same for all texts, so the sketch of a union is the
    union of sketches, and shares of two sketches estimate the shares of two
    texts of very unequal lengths. Null and empty texts have an empty sketch.
    """
    bound = -(1 << 63) + (1 << 64) // fraction
    df = shingle_hashes(df, text, out, k)
    return df.withColumn(out, F.array_sort(F.array_distinct(F.filter(out, lambda h: h < F.lit(bound)))))


def fingerprint(values: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits a hash."""
    return F.array_join(F.transform(values, lambda h: F.lpad(F.hex(h), HEX, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated resemblance of two sketches: shared over all hashes; 1 for two empty ones."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(
        shared.cast("double") / (F.size(a) + F.size(b) - shared))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; 1 for an empty a."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)).cast("double") / F.size(a))


def with_next(rows: DataFrame, *columns: str) -> DataFrame:
    """Adds next_<column> of each document's successor in descending doc_id order; the last one's is the first.

    Ids are cut into ranges at some of the ids themselves, as many as shuffle
    partitions. The largest row of a range also goes to the range above, where
    it follows the last row; so each range is looked through on its own and
    every text is shuffled once. A null doc_id comes after all others. Rows with
    one doc_id follow one another in descending order of the first column.
    """
    n = shuffle_partitions(rows)
    known = rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [1.0], 10 * n).alias("cuts"),
                     F.max("doc_id").alias("top")).first()
    # At most one number for each shuffle partition.
    cuts = sorted({*(known["cuts"] or []), *([] if known["top"] is None else [known["top"]])})
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts])
    own = F.coalesce(F.size(F.filter(bounds, lambda c: c < F.col("doc_id"))), F.lit(0)) if cuts else F.lit(0)
    guest = F.lit(None).cast("int")
    if cuts:
        guest = F.when(F.col("doc_id").isin(cuts), (F.col("_range") + 1) % len(cuts))
    placed = (rows.withColumn("_range", own)
              .withColumn("_seat", F.explode(F.filter(F.array(F.struct(F.col("_range").alias("at"), F.lit(0).alias("guest")),
                                                              F.struct(guest.alias("at"), F.lit(1).alias("guest"))),
                                                      lambda s: s["at"].isNotNull())))
              .withColumn("_range", F.col("_seat.at")).withColumn("_guest", F.col("_seat.guest")).drop("_seat"))
    order = Window.partitionBy("_range").orderBy("_guest", F.col("doc_id").desc_nulls_last(), F.col(columns[0]).desc_nulls_last())
    first = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.lead(F.struct(*columns)).over(order)
    if not cuts:  # no row has an id
        following = F.coalesce(following, F.first(F.struct(*columns)).over(first))
    return (placed.withColumn("_next", following).where("_guest = 0")
            .select(*rows.columns, *[F.col(f"_next.{c}").alias(f"next_{c}") for c in columns]))


def compare_edited(documents: DataFrame, k: int = SHINGLE, fraction: int = FRACTION) -> DataFrame:
    """Columns (doc_id, text) -> doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last half of the code points, rounded down, replaced
    by as many of the next document's first ones, or all of them. A null text is
    empty. Rows are neither added nor lost; extra columns are ignored.
    """
    rows = documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(sketch(rows, "text", "sketch", k, fraction), "text", "sketch")
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.left("text", F.char_length("text") - half), F.left("next_text", half))
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long")).withColumn("edited", edited).drop("text", "next_text")
    rows = sketch(rows, "edited", "edited_sketch", k, fraction)
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("sketch")).alias("fingerprint"),
        fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
