"""Best-fit packing of tokenized documents into sequences of LIMIT tokens, in bulk-synchronous rounds.

A document is its token ids and one end id. Longer ones are cut into pieces of LIMIT ids, of which the first may be shorter, so that all others fill a
sequence each. The rest is packed in rounds. Pieces are sorted by length and sequences by their gap; as both are whole numbers up to
LIMIT, a row's place in that order is its class (the number) and its rank among the rows of its class. A round sweeps over the classes upwards, and each gap
takes the longest piece below it that no smaller gap took, as often as it fits; of the pieces and gaps of a class, those of least rank go first. Then the gaps
are what is left, and the sweep is repeated until nothing fits. Pieces that are left open as many new sequences as their tokens need, the
longest first. Rounds run over bands of lengths, the longest first, as a long piece has fewer gaps to go to; a band of its own for each length
is best-fit decreasing. The schedule that needs the fewest sequences is taken.

What a round moves are runs of equal rows, at most some thousand a sweep whatever the corpus: the counts of LIMIT classes are all that the driver sees, and
its plan grows with LIMIT and no faster than the logarithm of the number of documents (tested: 15,427 runs for 5 billion). The rows move once, when each finds its run by its rank. Ranks are given in buckets of some RANKED
rows of one length, so a length that all documents share fills no task.
"""

from __future__ import annotations

import json
import zlib
from collections import deque
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, prepare, text_chunks

LIMIT, END, RANKED = 2048, 0, 512
#: Lower ends of the bands of lengths in parts of LIMIT: one schedule by thirds and halves, one by quotients, one with a band a length.
SCHEDULES = ((2, 3, 4, 8, 16), (2, 3, 4, 5, 6, 7, 8, 16, 32, 64), None)


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def encoder(path: str):
    """A function from text to ids (uint32) that equals ``tokenizers`` on the byte-level BPE file at ``path``, without special tokens added.

    The merges run in ``tiktoken``, over ranks read from the same file, at four times the speed; texts that hold the string of an
    added token, which the file's own library takes as one id, go to that library.
    """
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    # Byte-level files write a byte that doesn't print as the next free code point from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    added = [t["content"] for t in model["added_tokens"]]
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in added}
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""  # the byte-level pre-tokenizer's
    fast = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if any(t in text for t in added):
            return np.array(whole.encode(text, add_special_tokens=False).ids, np.uint32)
        return fast.encode_to_numpy(text, disallowed_special=())

    return encode


def _cut(path: str, limit: int, end: int, with_ids: bool):
    def run(batches):
        import pyarrow as pa

        encode = encoder(path)
        for batch in text_chunks(batches):
            out = [[] for _ in range(6)]
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.append(encode(text or ""), np.uint32(end)).astype("<u4")
                first = (len(ids) - 1) % limit + 1
                starts = [0, *range(first, len(ids), limit)]
                for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                    data = ids[a:b].tobytes()
                    for column, value in zip(out, (doc, i, a, b - a, zlib.crc32(data), ids[a:b] if with_ids else None), strict=True):
                        column.append(value)
            names, kinds = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"], [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            n = len(names) - (not with_ids)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out[:n], kinds[:n], strict=True)], names[:n])

    return run


def pieces(docs: DataFrame, limit: int = LIMIT, end: int = END, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """A row for each piece of each row of ``docs``: doc_id, piece, start, length, ids_crc32 and, if asked for, ids."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_cut(path or tokenizer_file(), limit, end, with_ids), "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


class Rounds:
    """The rounds over classes. ``counts[l]`` is the number of pieces of length l; ``runs`` says which sequences they go to.

    A run is (length, first rank, pieces, first sequence, pieces a sequence, tokens in the sequence before).
    """

    def __init__(self, counts: np.ndarray, limit: int):
        self.limit, self.left, self.taken, self.sequences, self.runs = limit, counts.astype(np.int64), np.zeros(len(counts), np.int64), 0, []
        self.gaps: list[deque] = [deque() for _ in range(limit + 1)]  # runs of sequences (first, number) by gap
        self.fresh: list[tuple[int, tuple[int, int]]] = []

    def _put(self, length: int, first: int, n: int, each: int, gap: int) -> None:
        """n sequences from ``first`` on, all of this gap, take ``each`` pieces of a length."""
        self.runs.append((length, int(self.taken[length]), n * each, first, each, self.limit - gap))
        self.taken[length] += n * each
        self.left[length] -= n * each
        self.fresh.append((gap - each * length, (first, n)))

    def _fill(self, length: int, gap: int, queue: deque) -> None:
        """Sequences of ``queue`` take pieces of a length until either ends."""
        while queue and self.left[length]:
            first, n = queue.popleft()
            each = min(gap // length, int(self.left[length]))
            use = min(n, int(self.left[length]) // each)
            self._put(length, first, use, each, gap)
            if use < n:
                queue.appendleft((first + use, n - use))

    def sweep(self, low: int, high: int) -> bool:
        """One round over the pieces of low < length <= high; whether any found a gap."""
        for gap, run in self.fresh:  # gaps that a round makes wait for the next
            self.gaps[gap].append(run)
        self.fresh, open_, moved = [], [], False
        for size in range(low + 1, self.limit + 1):
            if size <= high and self.left[size]:
                open_.append(size)
            queue = self.gaps[size]
            while queue and open_:
                moved = True
                self._fill(open_[-1], size, queue)
                if not self.left[open_[-1]]:
                    open_.pop()
        return moved

    def open(self, low: int, high: int) -> None:
        """The longest pieces left in the band open as many sequences as the band's tokens need; those above half the limit one each."""
        lengths = np.arange(low + 1, high + 1)
        left = self.left[low + 1 : high + 1]
        need = int(left.sum()) if 2 * low >= self.limit else -(-int(left @ lengths) // self.limit)
        for length in lengths[::-1].tolist():
            n = min(need, int(self.left[length]))
            if n:
                self._put(length, self.sequences, n, 1, self.limit)
                self.sequences += n
                need -= n

    def band(self, low: int, high: int) -> None:
        while self.left[low + 1 : high + 1].any():
            while self.sweep(low, high):
                pass
            if self.left[low + 1 : high + 1].any():
                self.open(low, high)


def plan(counts: np.ndarray, limit: int = LIMIT) -> Rounds:
    """The schedule of fewest sequences."""
    best = None
    for schedule in SCHEDULES:
        lows = [limit // k for k in schedule] + [0] if schedule else [int(x) - 1 for x in np.flatnonzero(counts)[::-1]]
        rounds, high = Rounds(counts, limit), limit
        for low in dict.fromkeys(lows):
            rounds.band(low, high)
            high = low
        if best is None or rounds.sequences < best.sequences:
            best = rounds
    return best


def _place(shared):
    def run(batches):
        import pyarrow as pa

        cuts, firsts, sequence, each, before = shared.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "rank"))
            at = np.searchsorted(firsts, length << 44 | rank, side="right") - 1  # runs are sorted by length and first rank
            nth = rank - cuts[at]
            keep = [batch.column(c) for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(sequence[at] + nth // each[at]), pa.array(before[at] + nth % each[at] * length)], [c for c in batch.schema.names if c != "rank"] + ["sequence_id", "offset"])

    return run


def pack(docs: DataFrame, limit: int = LIMIT, end: int = END, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset and, if asked for, ids.

    docs needs doc_id and text, of which nothing else is read; a null or empty text is its end id alone. Rows of a repeated or null doc_id are
    documents of their own. Sequences hold at most ``limit`` ids and have no holes. The number of sequences depends on the lengths alone; which of several pieces of one length
    goes where is settled by hashes of what they are. An empty table gives no rows.
    """
    spark = docs.sparkSession
    cut = materialize(pieces(docs, limit, end, path, with_ids), "pieces")
    known = cut.groupBy("length").agg(F.count("*").alias("n"))
    counts = np.zeros(limit + 1, np.int64)
    for r in known.collect():  # a row for each length there is, so limit at most
        counts[r.length] = r.n
    rounds = plan(counts, limit)

    buckets = F.broadcast(spark.createDataFrame([(int(i), int(counts[i]) // RANKED + 1) for i in np.flatnonzero(counts)], "length long, buckets int"))
    order = [F.xxhash64("ids_crc32", "doc_id", "piece"), F.col("doc_id"), F.col("piece")]
    dealt = cut.join(buckets, "length").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", F.col("start")), F.col("buckets"))).drop("buckets")
    sizes = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    # Numbers of a length's buckets: as many as it has rows by RANKED, so they are summed in steps of RANKED buckets.
    step = F.col("bucket").cast("long") / RANKED
    sizes = materialize(sizes.withColumn("step", F.floor(step)), "buckets")
    steps = sizes.groupBy("length", "step").agg(F.sum("n").alias("all"))
    steps = steps.withColumn("past", F.sum("all").over(Window.partitionBy("length").orderBy("step")) - F.col("all")).drop("all")
    here = F.sum("n").over(Window.partitionBy("length", "step").orderBy("bucket")) - F.col("n")
    before = sizes.withColumn("here", here).join(steps, ["length", "step"]).select("length", "bucket", (F.col("past") + F.col("here")).alias("before"))
    nth = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*order)) - 1
    ranked = dealt.withColumn("nth", nth).join(before, ["length", "bucket"])
    ranked = ranked.select(*cut.columns, (F.col("before") + F.col("nth")).alias("rank"))

    runs = np.array(sorted(rounds.runs), np.int64).reshape(-1, 6)
    shared = spark.sparkContext.broadcast((runs[:, 1], runs[:, 0] << 44 | runs[:, 1], runs[:, 3], runs[:, 4], runs[:, 5]))  # bounded by the limit: see the module's text
    kinds = ", ".join(f"{c} {t}" for c, t in cut.dtypes)
    return ranked.mapInArrow(_place(shared), f"{kinds}, sequence_id long, offset long")


def sequences(docs: DataFrame, limit: int = LIMIT, end: int = END, path: str | None = None) -> DataFrame:
    """The packed sequences: sequence_id, ids and, in the order of the ids, parts (doc_id, piece, start, length). A sequence has ``limit`` ids at most, so one row holds it."""
    packed = pack(docs, limit, end, path, with_ids=True)
    part = F.struct("offset", F.col("ids_crc32").alias("crc"), "doc_id", "piece", "start", "length", "ids")
    rows = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    kept = F.transform("parts", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["piece"].alias("piece"), p["start"].alias("start"), p["length"].alias("length")))
    return rows.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"), kept.alias("parts"))
