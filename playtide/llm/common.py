"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_libc = ctypes.CDLL(None)
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def new_folder(spark: SparkSession) -> str:
    """A new folder in ``spark.checkpoint.dir``; only a local session may do without."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="playtide-llm-")
    return f"{shared.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared folder and read from there.

    It cuts the lineage: a lost executor costs its running tasks only, and values that
    depend on the partitioning (run numbers, row numbers) stay as they were written.
    """
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a stored table that no later result reads."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z, and only those, in lower case; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.length(text)  # lower() touches other letters too
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(modulus)


def apart(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """_own (the id), _words (the text) and _rest (all other columns in one): names of the documents clash with none."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    return docs.select(F.col(doc_id).alias("_own"), F.col(text).alias("_words"), F.struct(*rest).alias("_rest"))


def whole(rows: DataFrame, columns: list[str], text: str, words: Column | str = "_words") -> DataFrame:
    """The documents' columns again from those of ``apart``, with ``words`` as the text."""
    words = F.col(words) if isinstance(words, str) else words
    return rows.select(*[words.alias(c) if c == text else F.col("_rest").getField(c).alias(c) for c in columns])


def released() -> None:
    """Give freed memory back to the machine: a worker that waits for its next task holds none of the last one's."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(_libc, "malloc_trim", None):  # the GNU library only
        trim(0)


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sliced(batches: Iterable[pa.RecordBatch], rows: int, chars: int, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows and about ``chars`` bytes of text each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        per_row = max(1, column.nbytes // batch.num_rows)
        step = max(1, min(rows, chars // per_row))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)
    released()


def each_group(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of equal ``key`` from batches that are sorted by it (nulls apart)."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = [0, *((keys[1:] != keys[:-1]).nonzero()[0] + 1).tolist(), len(keys)]
        for start, end in zip(cuts[:-1], cuts[1:]):
            if held and keys[start] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = keys[start]
    if held:
        yield pa.Table.from_batches(held)
    held = []
    released()


def taken(values: np.ndarray, sizes: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``values``, each of its size, picked by number: the runs one after the other, and their sizes."""
    starts, own = np.cumsum(sizes) - sizes, sizes[index]
    ends = np.cumsum(own)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(starts[index] - (ends - own), own)], own


def summed(sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of ``sizes`` over neighbours, ``counts`` of them each."""
    ends = np.append(0, np.cumsum(sizes))
    last = np.cumsum(counts)
    return ends[last] - ends[last - counts]


def coded(words: pa.Array) -> tuple[np.ndarray, list[str]]:
    """The number of each word and the different words."""
    found = words.dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary.to_numpy(zero_copy_only=False).tolist()


class Memo:
    """Values by text in two generations of at most ``limit`` entries each.

    ``fill`` computes the values of texts that are not held; what was not asked for since
    the last turn of generations goes. It only saves time: every value can be made anew.
    """

    def __init__(self, limit: int, fill: Callable[[list[str]], Iterable]):
        self.limit, self.fill = limit, fill
        self.held: dict = {}
        self.before: dict = {}

    def get(self, wanted: set[str]) -> dict:
        """A mapping that holds at least the ``wanted`` texts."""
        if len(self.held) > self.limit:
            self.before, self.held = self.held, {}
        new = []
        for text in wanted.difference(self.held):
            if text in self.before:
                self.held[text] = self.before[text]
            else:
                new.append(text)
        if new:
            self.held.update(zip(new, self.fill(new)))
        return self.held
