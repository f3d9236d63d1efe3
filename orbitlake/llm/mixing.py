"""Mix sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbitlake.llm.tables import fresh, running_total, staged

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
SEED = 17
#: Expected copies are whole multiples of one part in so many: their sums are exact in any order.
UNIT_BITS = 24
UNIT = 1 << UNIT_BITS


def size_of(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST_COPIES,
) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    The sources, by code point and null last, take the weights in turn and share ``share`` of all
    sizes by weight. A target stops at ``most`` times its source's size; what is left over is shared
    again by weight, until no target is above. A source of size 0 gets 0.
    """
    ranked = sizes.withColumn("_null", F.col("source").isNull()).withColumn("_one", F.lit(1).cast("long"))
    ranked = running_total(ranked, [], ["_null", "source"], "_one")
    turn = F.pmod(F.col("before"), F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    table = staged(
        ranked.select(
            "source", "source_size", weight.alias("weight"), (F.col("source_size") * float(most)).alias("cap")
        ),
        "sources",
    )
    wanted = float(share) * (table.agg(F.sum("source_size")).first()[0] or 0)
    rate = 0.0
    while True:
        # Rounds of resharing: the rate only rises, so a source once at its cap stays there.
        full = F.col("weight") * F.lit(rate) >= F.col("cap")
        capped, free = table.agg(
            F.sum(F.when(full, F.col("cap")).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))),
        ).first()
        if not free:
            break
        higher = (wanted - capped) / free
        if higher <= rate:
            break
        rate = higher
    return table.select(
        "source", "source_size", F.least("cap", F.col("weight") * F.lit(rate)).alias("target")
    )


def with_copies(
    docs: DataFrame, keys: Sequence[str] = ("doc_id",), seed: int = SEED, **options
) -> DataFrame:
    """(keys, source, size, source_size, target, copies) of every document.

    A source expects target / size copies of each of its documents. The expected copies are summed
    along the source, a random offset of the source is added, and a document is taken once for
    each whole number its interval crosses. Documents stand in the order of their size: every
    stretch of the order is taken at the same rate, so the words taken come within about one
    document of the target. Null and empty texts have size 0 and are taken like any other; a
    source of size 0 is not taken. Rows that repeat keys and size are alike: which of them is taken
    makes no difference to the result.
    """
    slim = docs.select(*keys, "source", size_of(F.col("text")).alias("size"))
    slim = staged(slim, "sizes")
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = staged(source_targets(sizes, **options), "targets")
    targets = targets.withColumnRenamed("source", "_source")
    rated = slim.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
    rated = rated.withColumn("_expected", F.round(F.coalesce(share, F.lit(0.0)) * UNIT).cast("long"))
    summed = running_total(rated, ["source"], ["size", *keys], "_expected")
    name = F.coalesce(F.concat(F.lit("source "), "source"), F.lit(""))
    draw = F.pmod(F.xxhash64(F.lit(seed), name), F.lit(UNIT))
    begin = F.col("before") + draw
    crossed = F.shiftright(begin + F.col("_expected"), UNIT_BITS) - F.shiftright(begin, UNIT_BITS)
    return summed.select(
        *keys, "source", "size", "source_size", "target", crossed.alias("copies")
    )


def mixture(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document."""
    return with_copies(docs).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix: one row per copy, with all columns of ``docs`` and ``copy``.

    ``copy`` counts the copies of a document from 1. The documents are written once with a row
    number, so that rows that repeat an id are sampled and emitted on their own.
    """
    row, copy = fresh("_row", docs), fresh("copy", docs)
    taken, copies = fresh("_taken", docs), fresh("_copies", docs)
    marked = staged(docs.withColumn(row, F.monotonically_increasing_id()), "mixdocs")
    slim = marked.select("doc_id", "source", "text", F.col(row).alias("_row"))
    counted = with_copies(slim, ["doc_id", "_row"]).where("copies > 0")
    counted = staged(counted.select(F.col("_row").alias(taken), F.col("copies").alias(copies)), "copies")
    emitted = marked.join(counted, F.col(row) == F.col(taken))
    numbers = F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))
    return emitted.select(*[F.col(f"`{c}`") for c in docs.columns], numbers.alias(copy))
