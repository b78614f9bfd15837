"""Helpers the operators share: reading tables, words, checkpoints, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import assay
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Functions go to the executors by value: they need no copy of this package there.
cloudpickle.register_pickle_by_value(assay)

#: A-Z become a-z; every other ASCII character that isn't a letter or digit parts words.
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def plain_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words of letters, digits and non-ASCII characters."""
    return text.translate(_PLAIN).split() if text else []


def space_words(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space (bytes.split() knows just that)."""
    return text.split() if text else []


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def identified(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns doc_id and text only, so that no other column can clash."""
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def arrow_schema(schema: str) -> pa.Schema:
    """The Arrow schema of a DDL string."""
    return to_arrow_schema(StructType.fromDDL(schema))


def map_batches(
    df: DataFrame, per_batch: Callable[[pa.RecordBatch], dict[str, list]], schema: str
) -> DataFrame:
    """Apply per_batch to each Arrow batch; it returns the output columns."""
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = per_batch(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow
            )

    return df.mapInArrow(run, schema)


def filter_batches(df: DataFrame, per_batch: Callable[[pa.RecordBatch], pa.RecordBatch]) -> DataFrame:
    """Apply per_batch, which drops rows or replaces values but keeps the columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(per_batch, batches)

    return df.mapInArrow(run, df.schema)


def replaced(batch: pa.RecordBatch, name: str, column: list) -> pa.RecordBatch:
    """The batch with other values in one column."""
    i = batch.schema.get_field_index(name)
    return batch.set_column(i, batch.schema.field(i), pa.array(column, type=batch.schema.field(i).type))


def text_bytes(batch: pa.RecordBatch | pa.Table, name: str = "text") -> list[bytes | None]:
    """Texts as UTF-8 bytes, without decoding them."""
    column = batch.column(batch.schema.get_field_index(name))
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def values(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def crc_mod(id_col: str, by: int) -> Column:
    """crc32 of the id as text, modulo by; null ids count as remainder 0 of the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % by


def row_hash(*columns: str | Column) -> Column:
    """128 bits that tell rows apart by these columns, as 16 bytes."""
    return F.unhex(F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(seed), *columns)), 16, "0") for seed in (1, 2)]))


def unused(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column of df has it, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Words of 64 bits in the bitmap that perhaps_among() broadcasts: 2 MB of numbers however many keys there are.
BITMAP_WORDS = 1 << 18
#: Words in a row of the bitmap: a row has a key and an entry in a hash table besides, which the driver builds.
ROW_WORDS = 8


def _placed(column: str) -> tuple[Column, Column, Column]:
    """Where a value stands in the bitmap: the row, the word in it, that word's bit."""
    digest = f"xxhash64(`{column}`)"
    word = f"pmod(shiftrightunsigned({digest}, 6), {BITMAP_WORDS}L)"
    return F.expr(f"{word} div {ROW_WORDS}"), F.expr(f"CAST({word} % {ROW_WORDS} AS INT)"), F.expr(f"shiftleft(1L, CAST(pmod({digest}, 64) AS INT))")


def bitmap(keys: DataFrame, key: str) -> DataFrame:
    """(row, words): a bitmap of fixed size, BITMAP_WORDS / ROW_WORDS rows at most; a word without a bit is null."""
    row, place, bit = _placed(key)
    words = [F.bit_or(F.when(F.col("place") == i, F.col("bit"))).alias(f"w{i}") for i in range(ROW_WORDS)]
    rows = keys.select(row.alias("row"), place.alias("place"), bit.alias("bit")).groupBy("row").agg(*words)
    return rows.select("row", F.array(*[f"w{i}" for i in range(ROW_WORDS)]).alias("words"))


def perhaps_among(df: DataFrame, column: str, keys: DataFrame, key: str, name: str) -> DataFrame:
    """df with a boolean column `name`: false if the column's value surely isn't among the keys.

    The keys become a bitmap of fixed size, so it can be broadcast; the more keys, the more
    values are true for nothing. It only spares shuffling rows that a join would drop.
    """
    at, words = unused(df, "__at"), unused(df, "__words")
    row, place, bit = _placed(column)
    bits = bitmap(keys, key).withColumnsRenamed({"row": at, "words": words})
    met = F.get(words, place).bitwiseAND(bit) != 0
    joined = df.join(F.broadcast(bits), F.col(at) == row, "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(met, F.lit(False)).alias(name))


def shared_folder(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; a local folder of our own only where it is unset on one machine."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not given:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir is unset: intermediate tables need a folder that all executors share")
        given = "file://" + tempfile.mkdtemp(prefix="assay-")
        spark.conf.set("spark.checkpoint.dir", given)
    return given.rstrip("/")


def saved(df: DataFrame) -> DataFrame:
    """Cut the lineage: df written once as Parquet in the shared folder, and read again.

    checkpoint() would run the last stage twice (once to count, once to write).
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/assay-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that saved() made and nothing needs any more."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
