"""Reproducible samples that lose no member when records are added (problem 5).

Frozen batch bottom-k: records arrive in immutable batches; of each batch exactly
``ceil(rate * size)`` records with the smallest salted hashes are kept. A batch's choice depends on
that batch alone, so the union over batches only grows.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.operators.ranking import class_sizes, spread_rank

RATE = "1/20"
SALT = "foliant-sample-1"


def normal_id(c: Column) -> Column:
    """Document id without notation: outer blanks, letter case, ``_`` for ``-``."""
    return F.upper(F.translate(F.regexp_replace(c, r"^\s+|\s+$", ""), "_", "-"))


def normal_digest(c: Column) -> Column:
    """The 64 lower-case hexadecimal digits of a digest in any notation, else null.

    Taken off: blanks, letter case, a ``sha256:`` or ``0x`` mark, and the signs ``- : _`` between
    digits. Cut, pending, empty and null digests give null.
    """
    bare = F.lower(F.regexp_replace(c, r"\s+", ""))
    bare = F.regexp_replace(bare, r"^(sha-?256[:=]?)?(0x)?", "")
    bare = F.regexp_replace(bare, "[-:_]", "")
    return F.when(bare.rlike("^[0-9a-f]{64}$"), bare)


def rate_bound(rate: str) -> str:
    """The largest 256-bit number, in hexadecimal, that lies in the lowest ``rate`` of all."""
    share = Fraction(rate)
    whole = (share.numerator << 256) // share.denominator
    exact = share.numerator << 256 == whole * share.denominator
    return f"{whole - 1 if exact else whole:064x}"


def frozen_batch_sample(
    df: DataFrame,
    id_col: str,
    batch_col: str,
    digest: Column | None = None,
    rate: str = RATE,
    salt: str = SALT,
) -> DataFrame:
    """One row per distinct id: (id, batch, digest, batch_rank, batch_size, quota, selected, below_rate).

    ``digest`` is the salted hash, 64 hexadecimal digits; without it SHA-256 of salt and id.
    ``selected`` marks the frozen batch bottom-k; ``below_rate`` that the digest itself lies in the
    lowest ``rate`` of all 256-bit numbers, the rule that depends on no other record at all.

    An id that was delivered several times belongs to the first of its batches (nulls last), so a
    later delivery changes nothing. Null ids and null digests have no row. Records without batch
    form one batch of their own. Equal digests are told apart by id. A batch may hold any share of
    the records: ranks are taken over ranges of the digest. Empty input gives no rows.
    """
    key = digest if digest is not None else F.sha2(F.concat_ws("|", F.lit(salt), F.col(id_col).cast("string")), 256)
    own = (
        df.select(F.col(id_col).alias("id"), F.col(batch_col).alias("batch"), key.alias("digest"))
        .filter("id is not null and digest is not null")
        .groupBy("id")
        .agg(F.min("batch").alias("batch"), F.min("digest").alias("digest"))
    )
    ranked = spread_rank(own, ["batch"], F.substring("digest", 1, 2), [F.col("digest"), F.col("id")], "batch_rank")
    sized = class_sizes(ranked, ["batch"], "batch_size")
    share = Fraction(rate)
    quota = F.ceil(F.col("batch_size") * F.lit(share.numerator) / F.lit(share.denominator)).cast("long")
    return (
        sized.withColumn("quota", quota)
        .withColumn("selected", F.col("batch_rank") < F.col("quota"))
        .withColumn("below_rate", F.col("digest") <= F.lit(rate_bound(rate)))
    )


def document_sample(records: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """The sample of report files: arrival batch is the month of the first ingestion.

    A month may still grow, so batches are frozen by the load: ``earlier`` is the whole result of the
    run before, whose rows stay as they are; only documents it lacks are drawn, in batches of their
    own. Without ``earlier`` this is the first load, which by itself keeps no member of another run.
    """
    first = records.select(
        normal_id(F.col("document_id")).alias("document_id"),
        F.date_format("ingested_at", "yyyy-MM").alias("batch"),
    )
    if earlier is None:
        return frozen_batch_sample(first, "document_id", "batch")
    known = earlier.select(F.col("id").alias("document_id"))
    return earlier.unionByName(frozen_batch_sample(first.join(known, "document_id", "left_anti"), "document_id", "batch"))


def selection_cases(records: DataFrame, selections: DataFrame) -> DataFrame:
    """(document_id) of the selected documents whose whole digest lies in the lowest twentieth."""
    given = selections.select(
        normal_id(F.col("document_id")).alias("document_id"),
        F.date_format("selected_at", "yyyy-MM").alias("batch"),
        normal_digest(F.col("digest_hex")).alias("given"),
    )
    chosen = frozen_batch_sample(given, "document_id", "batch", F.col("given")).filter("below_rate")
    known = records.select("document_id", normal_id(F.col("document_id")).alias("id")).dropna().distinct()
    return known.join(chosen.select("id"), "id", "left_semi").select("document_id").distinct()
