"""What the operators share: reading tables, words, folds, checkpoints, bounded samples of labelled rows.

Everywhere: a null text is an empty text; repeated rows are rows of their own, each with its own result; columns
that an operator does not name pass through or are left out, as its docstring says, and may have any name.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from starmart.session import shared_folder

#: What separates words: the six ASCII white space characters.
GAP = r"[\x20\x09-\x0D]+"
GAP_CHARACTERS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = str.maketrans(UPPER, LOWER)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def lowered(column: Column) -> Column:
    """Only A-Z change."""
    return F.translate(column, UPPER, LOWER)


def words_of(column: Column) -> Column:
    return F.filter(F.split(column, GAP), lambda word: word != "")


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % folds


def let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, also where ``then`` names it inside other lambdas."""
    return F.transform(F.array(value), then)[0]


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors see."""
    return f"{shared_folder(spark, fallback='/tmp/checkpoints')}/llm-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the folder the cluster names; in a session that names none, a folder is set first."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession, fallback="/tmp/checkpoints"))
    return df.checkpoint()


def labelled(labels: DataFrame, label: str) -> DataFrame:
    """One row per labelled id outside the held-out fold: (doc_id, label). Rows that disagree count as 1."""
    return (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold("doc_id", 4) != 2))
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("label"))
    )


def least_hashes(rows: DataFrame, order: list, wanted: int, known: int) -> DataFrame:
    """The ``wanted`` rows of the smallest hashes out of ``known``; ``order`` begins with a 64-bit hash.

    Nearly all other rows go by a bound on the hash, which so many rows pass with near certainty, so tasks hand on a few
    rows each however many tasks there are. If the bound lets too few pass, it does not count.
    """
    share = (wanted + 10 * wanted**0.5 + 100) / max(1, known)
    if share < 1:
        below = rows.filter(order[0] < F.lit(int(-(2**63) + share * 2**64)))
        if below.count() >= wanted:
            rows = below
    return rows.orderBy(*order).limit(wanted)


def labelled_sample(labels: DataFrame, docs: DataFrame, label: str, per_class: int) -> tuple[DataFrame, float]:
    """(doc_id, label, text) of at most ``per_class`` ids of each class, and the share of class 1 among all labels.

    The ids with the smallest hashes are taken, so the sample does not depend on how rows are spread. Only ids are
    broadcast, ``2 * per_class`` at most; the texts stay distributed.
    """
    rows = labelled(labels, label)
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    order = [F.xxhash64("doc_id"), "doc_id"]
    sample = None
    for value in (0, 1):
        part = least_hashes(rows.filter(F.col("label") == value), order, per_class, counts.get(value, 0))
        sample = part if sample is None else sample.union(part)
    texts = docs.select("doc_id", text_of().alias("text"))
    return texts.join(F.broadcast(sample), "doc_id"), share


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or it with as many ``_`` as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_lists(df: DataFrame, make, schema: str, rows: int = 1024) -> DataFrame:
    """``make`` maps the columns of some rows, as lists, to a list of result rows.

    Through Arrow and plain Python values, so that a null makes no whole number a float.
    """
    kind = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                made = make(*[c.to_pylist() for c in batch.slice(start, rows).columns])
                columns = list(zip(*made)) or [()] * len(arrow)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return df.mapInArrow(run, kind)


def with_text_value(docs: DataFrame, value, kind: T.DataType, name: str, rows: int = 256) -> DataFrame:
    """``docs`` with a column ``name``; ``value`` maps a list of texts to a list, a few hundred rows at a time.

    All columns of ``docs`` pass through untouched, whatever their names, so the rows need no join.
    """
    schema = T.StructType([*docs.schema.fields, T.StructField(name, kind)])
    arrow = pa.float64() if isinstance(kind, T.DoubleType) else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                texts = ["" if t is None else t for t in part.column(part.schema.get_field_index("text")).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(value(texts), arrow)], [*part.schema.names, name])

    return docs.mapInArrow(run, schema)


def with_score(docs: DataFrame, score, name: str) -> DataFrame:
    """``score`` maps texts to numbers."""
    return with_text_value(docs, lambda texts: [float(x) for x in score(texts)], T.DoubleType(), name)
