"""What the corpus operators share: scratch tables, words, byte views of Arrow strings."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the space and the ASCII controls \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SHINGLE_WORDS = 5
SIMILARITY = 0.75

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER_TABLE = str.maketrans(_UPPER, _UPPER.lower())
_SPLIT = re.compile(WORD)


def words_of(text: str | None) -> list[str]:
    """Words of a text with A-Z lower-cased; other letters keep their case."""
    return _SPLIT.findall(text.translate(_LOWER_TABLE)) if text else []


def lower_ascii(c: Column) -> Column:
    return F.translate(c, _UPPER, _UPPER.lower())


def words_col(c: Column) -> Column:
    """array<string> of the words of ``c``, A-Z lower-cased; empty for null or blank text."""
    parts = F.split(lower_ascii(F.coalesce(c, F.lit(""))), SPACE)
    return F.filter(parts, lambda w: w != "")


def n_words_col(c: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(c, F.lit("")), SPACE), lambda w: w != "")).cast("long")


_OWN_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``. Where that is unset: a temporary folder in local mode, the warehouse on a cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN_ROOTS:
        local = spark.sparkContext.master.startswith("local")
        _OWN_ROOTS[app] = tempfile.mkdtemp(prefix="scratch-") if local else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch-{app}"
    return _OWN_ROOTS[app]


def prepare(spark: SparkSession) -> SparkSession:
    """Arrow batches bounded in bytes and rows, as one row may hold a very long text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 22))
    return spark


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Writes ``df`` to the shared folder and reads it again: lineage ends here and survives lost executors.

    The shuffle files of the write go as soon as it is done, as nothing can read them again.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(df: DataFrame | None) -> None:
    """Deletes a table that materialize() wrote, once nothing reads it any more."""
    path = getattr(df, "_scratch_path", None)
    if path:
        spark = df.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


#: Keys that hold more than one HOT-th of all rows; there are fewer than HOT of them, whatever the input.
HOT = 1000


def attach(rows: DataFrame, side: DataFrame, key: str, total: int, n: str = "n") -> DataFrame:
    """``rows`` joined (inner) to ``side``, which has one row a key and in ``n`` how many of ``rows`` have it; ``n`` stays a column.

    ``total`` is the number of rows, or more. Rows of a hot key stay where they are, as the side's hot rows, HOT at most, are broadcast;
    all other keys meet by a shuffle in which none of them fills a task. Both tables are read more than once, so they should be written ones.
    """
    limit = max(total // HOT, 1)
    hot = side.filter(F.col(n) > limit)
    if hot.isEmpty():
        return rows.join(side.hint("merge"), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(side.filter(F.col(n) <= limit).hint("merge"), key)
    return rows.join(F.broadcast(hot), key).unionByName(rest)


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of plans that nothing refers to any more."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def string_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary array, nulls as empty texts; no copy of the bytes."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer over uint64 arrays."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_ODD = [np.uint64(2 * (0x9E3779B97F4A7C15 * (i + 1) % (1 << 63)) + 1 & (1 << 64) - 1) for i in range(64)]


_IS_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            x = np.full(max(n, 1 << 16), base, np.uint64)
            x[0] = 1
            _POWERS[i] = np.multiply.accumulate(x)
    return _POWERS[0], _POWERS[1]


def hashed_words(raw: np.ndarray, offs: np.ndarray, piece: int = 1 << 19) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of all words, first word of each document and the number of words) of texts in one buffer.

    Words are those of words_of(): UTF-8 has no space or capital inside another character. The hash of a word is a
    polynomial in its bytes modulo 2**64, finished by a mixer.
    """
    lo, hi = int(offs[0]), int(offs[-1])
    raw, offs = raw[lo:hi], offs - lo
    word = ~_IS_SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offs] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | edge[1:-1]
    end = word
    end[:-1] &= ~np.logical_and(word[1:], ~edge[1:-1])
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    out = np.empty(len(s), np.uint64)
    i = 0
    while i < len(s):  # as many whole words as a piece holds, one at least
        j = max(i + 1, int(np.searchsorted(e, s[i] + piece, side="right")))
        part = raw[s[i] : e[j - 1]]
        up, down = _powers(len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * up[: len(part)], out=total[1:])
        a, b = s[i:j] - s[i], e[i:j] - s[i]
        out[i:j] = mix64((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64))
        i = j
    return out, np.searchsorted(s, offs)


def shingle_hashes(hashes: np.ndarray, n: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of the n-word shingles in order; fewer words than n make one shingle."""
    if not len(hashes):
        return hashes
    k = min(n, len(hashes))
    acc = np.full(len(hashes) - k + 1, k, np.uint64)
    for i in range(k):
        acc += mix64(hashes[i : len(hashes) - k + 1 + i] * _ODD[i])
    return mix64(acc)


def shingle_sets(column, n: int = SHINGLE_WORDS):
    """For each text of an Arrow column: the sorted distinct hashes of its n-word shingles."""
    raw, offs = string_buffer(column)
    words, first = hashed_words(raw, offs)
    every = shingle_hashes(words, n)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        yield np.unique(every[a : b - n + 1] if b - a >= n else shingle_hashes(words[a:b], n))


def give_back() -> None:
    """Returns freed memory to the system: a Python worker lives on between tasks beside its executor's heap."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not a GNU system
        pass


def text_chunks(batches, size: int = 1 << 20, columns: tuple[str, ...] = ("text",)):
    """Slices Arrow batches so that each slice holds about ``size`` bytes in the text columns, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = sum(string_buffer(batch.column(batch.schema.get_field_index(c)))[1] for c in columns)
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(ends, ends[start] + size, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end
    give_back()


def runs(batches, keys: list[str]):
    """From batches sorted by ``keys``: record batches of whole groups, as many groups together as come in a batch.

    A group is held until it ends, so groups must be bounded.
    """
    import pyarrow as pa

    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        cols = [batch.column(batch.schema.get_field_index(k)) for k in keys]
        last = np.ones(batch.num_rows, bool)
        for c in cols:
            x = c.to_numpy(zero_copy_only=False)
            last &= x == x[-1]
        cut = batch.num_rows - int(np.argmin(last[::-1])) if not last.all() else 0
        if cut:
            held[-1] = batch.slice(0, cut)
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    give_back()
