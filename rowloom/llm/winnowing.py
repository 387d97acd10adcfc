"""Document fingerprints by winnowing, in column expressions only.

Every ``K`` code points are hashed; of every ``WINDOW`` hashes in a row the smallest is chosen, the
rightmost of equal ones, and kept with its position. Two texts that share ``K + WINDOW - 1`` code points
in a row therefore share a fingerprint. A text shorter than K is one gram; fewer grams than a window are
one window; an empty text has no fingerprint.

Hashes roll by doubling: runs of 8 code points are hashed once, and a gram of 16 follows from two of them
by one multiplication and one addition. Window minima come in two steps of six. All cost is in
proportion to the text's length, and no text is cut.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import parts

K = 16
WINDOW = 36
#: Hash and position share a long; a text of more than 2**29 code points does not fit into UTF-32.
_BITS = 29
_TOP = (1 << _BITS) - 1
_HASH = (1 << 31) - 1
_BASE = 1_000_003


def _none() -> Column:
    return F.array().cast("array<long>")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often ``body`` reads it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _grams(text: Column) -> Column:
    """Packed (hash, last - position) of every gram; the order of equal hashes puts the rightmost first."""
    def pack(code: Column, i: Column) -> Column:
        return code * F.lit(1 << _BITS) + (F.lit(_TOP) - i)

    def eights(binary: Column, n: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), n - 8),
            lambda i: F.xxhash64(F.substring(binary, i * 4 + 1, F.lit(32))).bitwiseAND(F.lit(_HASH)),
        )

    def long_text(binary: Column, n: Column) -> Column:
        return let(eights(binary, n), lambda b: F.transform(
            F.slice(b, 1, n - (K - 1)), lambda x, i: pack((x * F.lit(_BASE) + F.get(b, i + 8)).bitwiseAND(F.lit(_HASH)), i),
        ))

    def any_text(binary: Column) -> Column:
        n = (F.octet_length(binary) / 4).cast("int")
        short = F.array(pack(F.xxhash64(binary).bitwiseAND(F.lit(_HASH)), F.lit(0)))
        return F.when(n >= K, long_text(binary, n)).when(n > 0, short).otherwise(_none())

    return let(F.encode(text, "UTF-32"), any_text)


def _minima(grams: Column) -> Column:
    """The smallest packed gram of every window."""
    def six(values: Column, step: int) -> Column:
        return F.transform(values, lambda x, i: F.least(x, *(F.get(values, i + step * j) for j in range(1, 6))))

    return let(grams, lambda g: let(six(g, 1), lambda m: F.slice(
        six(m, 6), 1, F.greatest(F.size(g) - (WINDOW - 1), F.least(F.size(g), F.lit(1))),
    )))


def minima(text: Column) -> Column:
    """The chosen gram of every window of a text, in order, repeats included."""
    return _minima(_grams(text))


def as_text(chosen: Column) -> Column:
    """Chosen grams as ``hash:position``, by position."""
    return F.array_join(F.transform(chosen, lambda x: F.concat(
        F.lower(F.hex(F.shiftright(x, _BITS))), F.lit(":"), (F.lit(_TOP) - x.bitwiseAND(F.lit(_TOP))).cast("string"),
    )), " ")


def hashes(chosen: Column) -> Column:
    return F.array_distinct(F.transform(chosen, lambda x: F.shiftright(x, _BITS)))


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes by all hashes of two sets; 1 for two empty ones."""
    def share(common: Column) -> Column:
        every = F.size(a) + F.size(b) - common
        return F.when(every == 0, F.lit(1.0)).otherwise(common / every)

    return let(F.size(F.array_intersect(a, b)), share)


def with_next(documents: DataFrame) -> DataFrame:
    """doc_id, text, _bucket, _tie, _last and ``_next``: the text of the next document, after the last the first.

    Buckets are ranges of doc_id (nulls first, ties by a hash of the text). Within a bucket the next row
    is a window's; a bucket's last row gets the first row of the next one, of which there is one per bucket.
    """
    spark = documents.sparkSession
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("_tie", F.xxhash64("text"))
    n = 4 * parts(spark)
    cuts = documents.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 20 * n).alias("c")).first()["c"] or []
    cuts = sorted(set(cuts))
    edges = F.lit(cuts) if cuts else _none()
    bucket = F.size(F.filter(edges, lambda c: c < F.col("doc_id")))
    rows = rows.withColumn("_bucket", bucket)

    order = [F.col("doc_id").asc_nulls_first(), F.col("_tie").asc()]
    smallest = (
        documents.select("doc_id").withColumn("_bucket", bucket).groupBy("_bucket")
        .agg(F.when(F.count("doc_id") == F.count(F.lit(1)), F.min("doc_id")).alias("_least"))
    )
    firsts = (
        rows.join(F.broadcast(smallest.withColumnRenamed("_bucket", "_b")), (F.col("_bucket") == F.col("_b")) & F.col("doc_id").eqNullSafe(F.col("_least")))
        .groupBy("_bucket").agg(F.min_by("text", "_tie").alias("_first"))
    )
    among = W.orderBy("_bucket")
    nexts = firsts.select(
        F.col("_bucket").alias("_b"),
        F.coalesce(F.lead("_first").over(among), F.first("_first").over(among.rowsBetween(W.unboundedPreceding, W.currentRow))).alias("_head"),
    )
    within = W.partitionBy("_bucket").orderBy(*order)
    led = rows.withColumn("_following", F.lead("text").over(within)).withColumn("_last", F.col("_following").isNull())
    return (
        led.join(nexts.hint("shuffle_hash"), (F.col("_bucket") == F.col("_b")) & F.col("_last"), "left")
        .select("doc_id", "text", "_bucket", "_tie", "_last", F.coalesce("_following", "_head").alias("_next"))
    )


def compare(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next document's are.

    The edited text has its last quarter (rounded down) replaced by as many first code points of the next
    document in ascending order of doc_id, or all of them; the first follows the last. A null text is
    empty, null doc_ids come first, rows with the same doc_id are ordered by a hash of their text, equal
    rows are all kept, an empty table gives an empty one, and further columns are not read. Two empty
    texts are alike by 1, an empty and another one by 0.

    The edited text shares all but its end with the text, so only windows that reach into the end are
    computed for it. Texts are shuffled once.
    """
    n, cut = F.col("n_chars"), F.col("_cut")
    back = K + WINDOW - 2
    fp = with_next(documents).withColumn("n_chars", F.char_length("text"))
    fp = fp.withColumn("_cut", n - F.floor(n / 4).cast("int"))
    fp = fp.withColumn("edited", F.concat(F.substring("text", F.lit(1), cut), F.substring("_next", F.lit(1), n - cut)))
    fp = fp.withColumn("_own", minima(F.col("text")))
    start = F.greatest(cut - back, F.lit(0))
    # A tail without a whole window adds none, unless it is all of the text.
    tail = let(start, lambda s: F.when((s == 0) | (F.char_length("edited") > s + back), F.transform(
        minima(F.substring(F.col("edited"), s + 1, F.char_length("edited"))), lambda x: x - s,
    )).otherwise(_none()))
    fp = fp.select(
        "doc_id", "_bucket", "_tie", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.array_distinct("_own").alias("_chosen"),
        F.array_distinct(F.concat(F.slice(F.col("_own"), F.lit(1), start), tail)).alias("_edited"),
        F.when(F.col("_last"), hashes(minima(F.col("_next")))).alias("_head"),
    )
    fp = fp.select(
        "doc_id", "_bucket", "_tie", "n_chars", "edited_sha256", as_text(F.col("_chosen")).alias("fingerprint"),
        as_text(F.col("_edited")).alias("edited_fingerprint"), hashes(F.col("_chosen")).alias("_own"),
        hashes(F.col("_edited")).alias("_changed"), "_head",
    )
    within = W.partitionBy("_bucket").orderBy(F.col("doc_id").asc_nulls_first(), F.col("_tie").asc())
    return fp.withColumn("_after", F.coalesce("_head", F.lead("_own").over(within))).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("_own"), F.col("_changed")).alias("near_edited"), likeness(F.col("_own"), F.col("_after")).alias("near_next"),
    )
