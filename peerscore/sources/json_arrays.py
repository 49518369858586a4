"""Split scan of large JSON arrays (S8): one file is read by as many tasks as it has splits.

A JSON array has no line ends to split at. The text source is read with ``}`` as its separator instead, which works from
any offset, so every split gives *pieces* that each end at a closing brace. Whether such a brace ends a record depends on
what came before it: the brace depth, and whether the piece begins inside a string. Both are found without reading the
file in one task:

* a piece is summed up for either beginning (outside or inside a string): quotes, opened and closed braces;
* a running sum inside each split gives the state relative to the split's beginning;
* the splits of a file, one row each, are added up in order, which fixes every split's beginning.

A record of one piece is parsed where it is; pieces of longer records (nested objects, or records over a split's end) are
joined by record, so the largest group is one record. A split is never more than ``spark.sql.files.maxPartitionBytes``.

Contract: uncompressed files in UTF-8, each one array of objects (or one object). A record that cannot be parsed, and an end
of file inside a record, give one row of NULLs and leave the other records alone; an empty file or array gives no row.
Partition columns of the folder are kept, unless the schema names a column alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerscore.session import stored

_SPLIT = ["__file", "__block"]


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Pieces of the files with their split, their order in it, and the size of their file."""
    text = spark.read.option("lineSep", "}").text(path)
    kept = [c for c in text.columns if c != "value"]
    return text.select(
        *(F.col(f"`{c}`") for c in kept), F.col("value").alias("__text"),
        F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"),
        F.col("_metadata.file_size").alias("__size"), F.monotonically_increasing_id().alias("__at"),
    )


def _opened(parts: Column, odd: int) -> Column:
    """Opening braces in every second part of a text cut at its quotes."""
    some = F.array_join(F.filter(parts, lambda _, i: i % 2 == odd), "")
    return F.length(some) - F.length(F.replace(some, F.lit("{"), F.lit("")))


def _summed(pieces: DataFrame) -> DataFrame:
    """Either beginning's change of depth in each piece, and the running state since the split began."""
    bare = F.regexp_replace("__text", r"(?s)\\.", "")  # an escape never holds the separator, so none is cut in two
    pieces = pieces.withColumn("__parts", F.split(bare, '"', -1)).withColumn("__flip", (F.size("__parts") - 1) % 2)
    pieces = pieces.withColumn("__outside", _opened(F.col("__parts"), 0) - (1 - F.col("__flip")))
    pieces = pieces.withColumn("__inside", _opened(F.col("__parts"), 1) - F.col("__flip")).drop("__parts")
    until = Window.partitionBy(*_SPLIT).orderBy("__at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = pieces.withColumn("__turned", (F.sum("__flip").over(until) - F.col("__flip")) % 2)
    for h in (0, 1):  # the split begins outside (0) or inside (1) a string
        step = F.when(F.col("__turned") == h, F.col("__outside")).otherwise(F.col("__inside"))
        pieces = pieces.withColumn(f"__step{h}", step).withColumn(f"__sum{h}", F.sum(step).over(until))
    return pieces.drop("__outside", "__inside")


def _beginnings(pieces: DataFrame) -> DataFrame:
    """One row per split: its state at the beginning, the file's last piece, and whether the file ends after a brace."""
    splits = pieces.groupBy(*_SPLIT).agg(
        (F.sum("__flip") % 2).alias("flip"), F.sum("__step0").alias("step0"), F.sum("__step1").alias("step1"),
        F.sum(F.octet_length("__text") + 1).alias("bytes"), F.first("__size").alias("size"), F.max("__at").alias("last"),
    )
    before = Window.partitionBy("__file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("__file")
    zero = F.lit(0).cast("long")
    splits = splits.withColumn("__string", F.coalesce(F.sum("flip").over(before), zero) % 2)
    step = F.when(F.col("__string") == 0, F.col("step0")).otherwise(F.col("step1"))
    splits = splits.withColumn("step", step).withColumn("__depth", F.coalesce(F.sum("step").over(before), zero))
    left = F.col("size") - F.sum("bytes").over(whole)  # the reader drops a byte order mark of three bytes
    splits = splits.withColumn("__braced", ~left.isin(-1, 2))
    last = F.when(F.col("__block") == F.max("__block").over(whole), F.col("last"))
    return splits.select(*_SPLIT, "__string", "__depth", "__braced", last.alias("__last"))


def scan_json_array(spark: SparkSession, path: str, schema: T.StructType, options: dict[str, str] | None = None) -> DataFrame:
    """Records of the JSON arrays under ``path``, read with a declared schema by one task a split (see the module's text).

    ``options`` go to ``from_json``. The rows are those of ``read_json_array``, but for malformed files, where that reader
    gives up the whole file and this one only the record.
    """
    pieces = stored(_summed(_pieces(spark, path)))
    states = pieces.join(stored(_beginnings(pieces)), _SPLIT)
    chosen = lambda name: F.when(F.col("__string") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))
    states = states.withColumn("__after", F.col("__depth") + chosen("__sum")).withColumn("__before", F.col("__after") - chosen("__step"))
    states = states.withColumn("__starts_in", (F.col("__string") + F.col("__turned")) % 2)
    states = states.withColumn("__ends_in", (F.col("__starts_in") + F.col("__flip")) % 2)
    final = F.coalesce(F.col("__at") == F.col("__last"), F.lit(False))
    states = states.withColumn("__cut", final & ~F.col("__braced"))  # the text ends here without a brace
    ends = (F.col("__ends_in") == 0) & (F.col("__after") == 0) & ~F.col("__cut")
    states = states.withColumn("__ends", ends.cast("long"))
    # what is left at the end of the file must hold no open record or string
    open_end = F.when(F.col("__cut"), (F.col("__ends_in") == 1) | (F.col("__after") != -1)).otherwise(F.col("__ends") == 0)
    broken = states.where(final & open_end)

    counts = states.groupBy(*_SPLIT).agg(F.sum("__ends").alias("n"))
    before = Window.partitionBy("__file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__earlier", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")))
    counts = counts.withColumn("__records", F.sum("n").over(Window.partitionBy("__file"))).drop("n")
    until = Window.partitionBy(*_SPLIT).orderBy("__at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = states.withColumn("__number", F.sum("__ends").over(until) - F.col("__ends")).join(stored(counts), _SPLIT)
    numbered = numbered.withColumn("__number", F.col("__earlier") + F.col("__number")).where("__number < __records")

    kept = [c for c in pieces.columns if not c.startswith("__")]
    closed = F.concat("__text", F.lit("}"))
    alone = (F.col("__ends") == 1) & (F.col("__before") == 0) & (F.col("__starts_in") == 0)
    short = numbered.where(alone).select(*(F.col(f"`{c}`") for c in kept), closed.alias("__text"))
    parts = F.sort_array(F.collect_list(F.struct("__block", "__at", closed.alias("text"))))
    joined = numbered.where(~alone).groupBy("__file", "__number", *(F.col(f"`{c}`") for c in kept)).agg(F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("__text"))
    unfinished = broken.select(*(F.col(f"`{c}`") for c in kept), F.lit("{").alias("__text"))
    records = short.unionByName(joined.drop("__file", "__number")).unionByName(unfinished)
    record = F.from_json(F.regexp_replace("__text", r"(?s)\A[^{]*", ""), schema, options or {})
    records = records.withColumn("__record", record)
    own = [F.col("__record").getField(f.name).alias(f.name) for f in schema.fields]
    return records.select(*own, *(F.col(f"`{c}`") for c in kept if c not in schema.fieldNames()))
