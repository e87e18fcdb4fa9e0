"""Texts as rows: lines, paragraphs and windows in order."""

from __future__ import annotations

from foliant.functions import text as T
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_START, _NUMBER = "\ufdd0", "\ufdd1"


def to_lines(df: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """(keys, line_no, line) of every line, split at \\n or \\r\\n; null texts have none."""
    lines = F.posexplode(F.split(text_col, "\r?\n")).alias("line_no", "line")
    return df.filter(F.col(text_col).isNotNull()).select(*keys, lines)


def paragraph_array(text: Column) -> Column:
    """array<struct<first_line, paragraph>>: lines joined up to a blank line or a sentence's end, in the text's own row.

    Starts are marked with the number of their line by two signs that no text holds (non-characters
    of Unicode), the lines run together and are cut at the marks: linear in the text, without a
    shuffle. Null and blank texts have none.
    """
    lines = F.transform(F.split(text, "\r?\n"), lambda x: F.trim(F.regexp_replace(x, r"[\s]+", " ")))

    def marked(own: Column) -> Column:
        def mark(x: Column, i: Column) -> Column:
            before = F.get(own, i - 1)
            starts = (i == 0) | (before == "") | before.rlike(T.SENTENCE_END)
            return F.when(x == "", "").when(starts, F.concat(F.lit(_START), i.cast("string"), F.lit(_NUMBER), x)).otherwise(F.concat(F.lit(" "), x))

        return F.array_join(F.transform(own, mark), "")

    parts = F.filter(F.split(T.once(lines, marked), _START), lambda p: p != "")
    return F.transform(
        F.coalesce(parts, F.array().cast("array<string>")),
        lambda p: F.struct(F.substring_index(p, _NUMBER, 1).cast("int").alias("first_line"), F.substring_index(p, _NUMBER, -1).alias("paragraph")),
    )


def paragraphs(df: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """(keys, para_no, first_line, paragraph) of each text, para_no from 1."""
    each = df.select(*keys, F.posexplode(paragraph_array(F.col(text_col))).alias("n", "p"))
    return each.select(*keys, (F.col("n") + 1).cast("long").alias("para_no"), "p.first_line", "p.paragraph")


def order_flags(paras: Column) -> Column:
    """array<struct<orphan, dangling>> of an array of paragraphs in order.

    An orphan begins mid-sentence after a finished paragraph or a heading; a dangling one stops
    mid-phrase and is not continued.
    """

    def look(p: Column, prev: Column, after: Column) -> Column:
        starts = ~p.rlike(T.LIST_MARKER) & p.rlike(r"^[a-z,)\]}]")
        ends = (T.word_count(p) >= 4) & ~p.rlike("[:;]\\s*$") & p.rlike(r"(?:^| )[\"'(\[]*[a-z][^ ]*\s*$")
        tail = p.rlike(rf"(?:^| )(?:{T.TAIL_WORDS})[\"')\].,;:]*\s*$")
        orphan = F.coalesce(starts & (prev.rlike(T.SENTENCE_END) | T.heading_shape(prev)), F.lit(False))
        whole = ~p.rlike(T.SENTENCE_END) & ~T.heading_shape(p) & ~after.rlike("^[a-z0-9]")
        return F.struct(orphan.alias("orphan"), F.coalesce(ends & ~tail & whole, F.lit(False)).alias("dangling"))

    return T.once(paras, lambda own: F.transform(own, lambda p, i: look(p, F.get(own, i - 1), F.get(own, i + 1))))


def longest_run(values: Column) -> Column:
    """Length of the longest run of equal neighbours in an array of texts; null for an empty one."""

    def step(a: Column, x: Column) -> Column:
        n = F.when(x == a["last"], a["n"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("last"), n.cast("long").alias("n"), F.greatest(a["best"], n.cast("long")).alias("best"))

    zero = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("best"))
    return T.once(values, lambda own: F.when(F.size(own) > 0, F.aggregate(own, zero, step)["best"]))


def true_runs(flags: Column) -> Column:
    """array<struct<first, length>> of the runs of true in an array of booleans, first from 1; linear."""

    def marked(own: Column) -> Column:
        def mark(x: Column, i: Column) -> Column:
            start = (i == 0) | ~F.get(own, i - 1)
            return F.when(~x, "").when(start, F.concat(F.lit(_START), (i + 1).cast("string"), F.lit(_NUMBER + "1"))).otherwise("1")

        return F.array_join(F.transform(own, mark), "")

    parts = F.filter(F.split(T.once(flags, marked), _START), lambda p: p != "")
    return F.transform(
        parts,
        lambda p: F.struct(
            F.substring_index(p, _NUMBER, 1).cast("int").alias("first"), F.length(F.substring_index(p, _NUMBER, -1)).cast("long").alias("length")
        ),
    )


def runs(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """(keys, value, first, length) of maximal runs of equal values in order (gaps and islands)."""
    w = Window.partitionBy(*keys).orderBy(order)
    change = F.coalesce((F.col(value) != F.lag(value).over(w)).cast("int"), F.lit(1))
    return (
        df.withColumn("__change", change)
        .withColumn("__island", F.sum("__change").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "__island", value)
        .agg(F.min(order).alias("first"), F.count("*").alias("length"))
        .drop("__island")
    )


def text_windows(df: DataFrame, keys: list[str], size: int, text_col: str = "text") -> DataFrame:
    """(keys, start, chunk): consecutive windows of ``size`` characters over the whole text."""
    n = F.length(text_col)
    at = F.explode(F.sequence(F.lit(0), n - 1, F.lit(size))).alias("start")
    return df.filter(n > 0).select(*keys, text_col, at).select(
        *keys, "start", F.substring(F.col(text_col), F.col("start") + 1, F.lit(size)).alias("chunk")
    )
