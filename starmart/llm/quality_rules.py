"""Quality rules: base measures, and the likelihood ratio of hashed n-grams between trusted and raw text.

Only DataFrame functions. Every document's one- and two-word grams are hashed into a fixed number of buckets. Two
multinomials over the buckets are counted from all documents: one from those that look trusted on the surface, one
from the whole corpus. A document's score is the mean logarithm of their ratio over its grams, so long and short texts
compare; a fixed threshold decides every document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import GAP, GAP_CHARACTERS, cut, let, text_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class RatioParams:
    """``buckets`` bounds what the driver gets and every task holds, a byte each. Every bucket gets ``least``
    grams and an even part of ``smoothing`` times the counted grams besides its own, so that a bar means the same on small
    and large tables."""

    buckets: int = 1 << 20
    smoothing: float = 0.5
    least: float = 2.0
    least_words: int = 20
    repeat_percent: int = 30
    trusted_upper_percent: int = 25
    trusted_distinct_percent: int = 40
    threshold: float = -0.4
    #: A gram's vote is limited: its logarithm is kept as one ASCII sign, in this many steps per unit with 0 at ``zero``,
    #: so from -4 to 1.29.
    steps: int = 24
    zero: int = 96


def bucket_of(gram: Column, params: RatioParams) -> Column:
    return F.pmod(gram, F.lit(params.buckets)).cast("int")


def beside(hashes: Column, distance: int) -> Column:
    """A number for every element and the one ``distance`` further on, as long as there is one."""
    n = F.greatest(F.size(hashes) - distance, F.lit(0))
    return F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, 1 + distance, n), lambda a, b: F.xxhash64(a, b))


def repeated_words(pairs: Column) -> Column:
    """Words in windows of eight that occur twice or more; ``pairs`` has one number per two neighbouring words."""

    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))

        def starts(rows: Column) -> Column:
            last = F.size(rows) - 1
            near = lambda i, j: (j >= 0) & (j <= last) & (rows[i]["h"] == F.get(rows, j)["h"])
            return F.sort_array(
                F.filter(
                    F.transform(F.sequence(F.lit(0), last), lambda i: F.when(near(i, i - 1) | near(i, i + 1), rows[i]["p"])),
                    lambda p: p.isNotNull(),
                )
            )

        grow = lambda acc, p: F.struct(
            (acc["n"] + (p + WINDOW) - F.greatest(acc["end"], p)).alias("n"), (p + WINDOW).alias("end")
        )
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(let(placed, starts), zero, grow, lambda acc: acc["n"])

    def unless_distinct(numbers: Column, then) -> Column:
        return let(numbers, lambda x: F.when(F.size(F.array_distinct(x)) == F.size(x), F.lit(0)).otherwise(then(x)))

    # two pairs make four words, two fours a window; where no four words come twice, no window does
    repeated = unless_distinct(beside(pairs, 2), lambda fours: unless_distinct(beside(fours, 4), covered))
    return F.when(F.size(pairs) < WINDOW, F.lit(0)).otherwise(repeated).cast("long")


def duplicate_lines() -> Column:
    lines = F.filter(F.split("_text", "\n"), lambda line: F.btrim(line, F.lit(GAP_CHARACTERS)) != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def symbols() -> Column:
    return F.regexp_count("_text", F.lit(f"[{SYMBOLS}]"))


def prepared(docs: DataFrame) -> DataFrame:
    """doc_id, text, code points in words, a number per word and one per two neighbouring words."""
    rows = docs.select("doc_id", text_of().alias("_text"))
    # without outer gaps no word is empty, so none has to be filtered out
    inner = F.btrim("_text", F.lit(GAP_CHARACTERS))
    rows = rows.withColumn("_words", F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, GAP)))
    rows = rows.select("doc_id", "_text", F.length(F.array_join("_words", "")).alias("_chars"), F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"))
    return rows.withColumn("_pairs", beside(F.col("_hashes"), 1))


def trusted(params: RatioParams) -> Column:
    """Looks clean on the surface: long enough, no symbols, no repeated line, few capitals, varied words."""
    n, varied = F.size("_hashes"), F.size(F.array_distinct("_hashes"))
    return (
        (n >= params.least_words)
        & ~F.col("_text").rlike(f"[{SYMBOLS}]")
        & (100 * varied >= params.trusted_distinct_percent * n)
        & (100 * F.regexp_count("_text", F.lit("[A-Z]")) <= params.trusted_upper_percent * F.col("_chars"))
        & (duplicate_lines() == 0)
    )


def ratios(rows: DataFrame, params: RatioParams) -> bytes:
    """Per bucket the logarithm of trusted against raw share, from all documents, as one byte below 128.

    The signs are strung together on the executors, 4,096 buckets to a row; the driver gets a few hundred rows.
    """
    counted = cut(
        # judged before the rows multiply
        rows.select("_hashes", "_pairs", trusted(params).alias("t"))
        .select("t", F.explode(F.concat("_hashes", "_pairs")).alias("gram"))
        .select("t", bucket_of(F.col("gram"), params).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.count_if("t").alias("target"))
    )
    totals = counted.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("raw"), F.coalesce(F.sum("target"), F.lit(0)).alias("target")).first()

    def share(name: str) -> Column:
        even = params.smoothing * totals[name] / params.buckets + params.least
        return F.log((F.coalesce(F.col(name), F.lit(0)) + even) / (totals[name] + even * params.buckets))

    every = rows.sparkSession.range(params.buckets).select(F.col("id").cast("int").alias("bucket"))
    block = F.floor(F.col("bucket") / 4096)
    # without any trusted text every ratio is one
    target = share("target" if totals["target"] else "raw")
    sign = F.greatest(F.lit(0), F.least(F.lit(127), F.round((target - share("raw")) * params.steps) + params.zero))
    signs = every.join(counted, "bucket", "left").select("bucket", F.char(sign.cast("int")).alias("sign"))
    strung = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("bucket", "sign"))), lambda r: r["sign"]), "")
    blocks = signs.groupBy(F.floor(F.col("bucket") / 4096).alias("block")).agg(strung.alias("signs")).collect()
    return "".join(r["signs"] for r in sorted(blocks, key=lambda r: r["block"])).encode()


def judge(docs: DataFrame, params: RatioParams = RatioParams()) -> DataFrame:
    """doc_id, the measures, base_failed, ``log_ratio`` and kept, one row per row of ``docs``.

    Null text: no words, so base_failed. Texts without words have the ratio 0. Only doc_id and text are read. The
    counting scans the texts once, the verdict once more; nothing but the bucket counts is shuffled.
    """
    rows = prepared(docs)
    table = F.lit(ratios(rows, params))
    sign = lambda gram: F.ascii(F.substring(table, bucket_of(gram, params) + 1, F.lit(1)).cast("string"))
    signs = F.lit(0).cast("long")
    for grams in ("_hashes", "_pairs"):
        signs = F.aggregate(grams, signs, lambda acc, gram: acc + sign(gram))
    n_grams = F.size("_hashes") + F.size("_pairs")
    total = (signs - params.zero * n_grams) / params.steps
    measured = rows.select(
        "doc_id",
        F.size("_hashes").cast("long").alias("n_words"),
        F.col("_chars").cast("long").alias("word_chars"),
        symbols().cast("long").alias("n_symbols"),
        duplicate_lines().alias("n_dup_lines"),
        repeated_words(F.col("_pairs")).alias("n_repeat_words"),
        (total / F.greatest(n_grams, F.lit(1))).alias("log_ratio"),
    )
    failed = (F.col("n_words") < params.least_words) | (100 * F.col("n_repeat_words") > params.repeat_percent * F.col("n_words"))
    judged = measured.withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("log_ratio") >= params.threshold))
