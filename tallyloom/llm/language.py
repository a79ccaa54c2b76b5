"""Language-model scoring by a probabilistic suffix tree over words."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.counting import Tally
from tallyloom.llm.storage import written as written_plainly

# The longest context, in words.
DEPTH = 2
# Sequences are in the tree if they occur this often; a share of all training tokens that
# they must have as well can be asked for.
LEAST = 2
SHARE = 0.0
# Sequences of at least this share of all training tokens are broadcast, no more than
# 1 / COMMON of a length. All others lie in tables and are joined.
COMMON = 2e-7
# Bits for each sequence in the filters of the others, and the most bits of a filter. A filter
# only spares rows that the join would drop.
FILTER_BITS = 16
MOST_BITS = 1 << 30
# Bits of a filter that a row brings to the driver.
SLICE_BITS = 1 << 20
# Training tokens for each bucket by which sequences are dealt; a task holds one bucket at a time.
BUCKET_TOKENS = 1 << 20
# Sequences that a task holds before it deals them, and about how many it hands on at once.
MOST_PACKED = 300_000
PACKED_AT_ONCE = 50_000
# Sequences that a task holds and counts before it deals them.
MOST_HELD = 1_000_000
# Removes a query's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# What each sequence's count gives to the words not seen after its context.
DISCOUNT = 0.75
# Nats a symbol by which a context's distribution must differ from that of its suffix.
DIVERGENCE = 0.01
# Documents with this remainder are held out.
PARTS, HELD_OUT = 7, 2
SEED = 12
# Ends a document; no word has a space.
END = b" "
# Bytes of text that a task takes apart at once.
SLICE_BYTES = 2 * 1024 * 1024

# White space becomes a space, A-Z lower case.
_FOLD = bytes(32 if 9 <= c <= 13 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows, stored; what was shuffled for them goes at once."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return written_plainly(df, purpose)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def held_out(doc_id: Column) -> Column:
    """Whether a document is held out; a null id counts as an empty one."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % PARTS == HELD_OUT


@dataclass
class Tokens:
    """The tokens of some texts: `words` are distinct keys, `codes` their places, text after text."""

    words: np.ndarray
    codes: np.ndarray
    starts: np.ndarray


def tokenized(texts: pa.Array) -> Tokens:
    """Words between white space and an end after each text; null is empty."""
    texts = texts.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    data = texts.buffers()[2]
    data = data[offsets[0] : offsets[-1]].to_pybytes() if data else b""
    data = np.frombuffer(data.translate(_FOLD), np.uint8)
    offsets = offsets - offsets[0]
    black = data != 32
    first = black.copy()
    first[1:] &= ~black[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first[heads] = black[heads]  # a text's first byte starts a word of its own
    word_at = np.flatnonzero(first)
    before = np.searchsorted(word_at, offsets)
    last = black.copy()
    last[:-1] &= ~black[1:]
    last[heads[heads > 0] - 1] = black[heads[heads > 0] - 1]
    bounds = np.concatenate(([0], np.cumsum(np.flatnonzero(last) + 1 - word_at)))
    packed = pa.Array.from_buffers(
        pa.large_binary(), len(word_at), [None, pa.py_buffer(bounds), pa.py_buffer(data[black])]
    ).dictionary_encode()
    of_texts = np.diff(before)
    starts = before + np.arange(len(before))
    codes = np.empty(len(word_at) + len(of_texts), dtype=np.int64)
    ends = starts[1:] - 1
    inside = np.ones(len(codes), bool)
    inside[ends] = False
    codes[inside] = packed.indices.to_numpy()
    codes[ends] = len(packed.dictionary)
    digest, found = xxhash.xxh3_64_intdigest, packed.dictionary
    bounds = np.frombuffer(found.buffers()[1], np.int64, len(found) + 1, 8 * found.offset).tolist()
    data = found.buffers()[2].to_pybytes() if len(found) else b""
    words = [digest(data[start:stop], SEED) for start, stop in pairwise(bounds)] + [digest(END, SEED)]
    return Tokens(np.array(words, dtype=np.uint64).view(np.int64), codes, starts)


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Stretches of a batch of about `SLICE_BYTES` of text."""
    sizes = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy())
    start = 0
    while start < batch.num_rows:
        done = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, done + SLICE_BYTES, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def _place(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each wanted key stands among the sorted ones, -1 where it doesn't."""
    if not len(keys):
        return np.full(len(wanted), -1, dtype=np.int64)
    place = np.searchsorted(keys, wanted)
    place[place == len(keys)] = 0
    return np.where(keys[place] == wanted, place, -1)


NONE = -1
_SIGN = np.int64(-(1 << 63))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def hashed(context: np.ndarray, suffix: np.ndarray, length: int) -> np.ndarray:
    """A negative number for a sequence that isn't common, from those of its two parts.

    Parts of either length may have the same number, so the length, that of the parts, counts as well.
    """
    salt = np.uint64(length * 0x9E3779B97F4A7C15 % (1 << 64))
    first = _mixed(np.ascontiguousarray(context).view(np.uint64) + salt)
    return _mixed(first ^ np.ascontiguousarray(suffix).view(np.uint64)).view(np.int64) | _SIGN


def packed(buckets: int, numbers: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Columns of 8 bytes, put together for each bucket of the numbers that has any; some buckets at once.

    All first bytes of a column come first, then all second ones, which compresses well.
    """
    bucket = (_mixed(numbers.view(np.uint64)) >> np.uint64(32)) % np.uint64(buckets)
    bucket = bucket.astype(np.uint16 if buckets <= 1 << 16 else np.int64)
    order = np.argsort(bucket, kind="stable")
    bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
    found = np.flatnonzero(np.diff(bounds))
    for some in np.split(found, np.flatnonzero(np.diff(bounds[found] // PACKED_AT_ONCE)) + 1):
        if len(some):
            start, stop = bounds[some[0]], bounds[some[-1] + 1]
            table = np.stack([column.view(np.int64)[order[start:stop]] for column in columns]).view(np.uint8)
            table = table.reshape(len(columns), -1, 8)
            parts = [table[:, bounds[at] - start : bounds[at + 1] - start] for at in some]
            yield some, [part.transpose(0, 2, 1).tobytes() for part in parts]


def unpacked(data: pa.ChunkedArray, columns: int) -> np.ndarray:
    """The columns of what `packed` put together."""
    parts = [np.frombuffer(part, np.uint8).reshape(columns, 8, -1).transpose(0, 2, 1) for part in data.to_pylist()]
    whole = np.concatenate([np.zeros((columns, 0, 8), np.uint8), *parts], axis=1)
    return np.ascontiguousarray(whole).view(np.int64)[:, :, 0]


class Packer:
    """Collects numbers and their columns over the batches of a task and deals them to buckets."""

    def __init__(self, buckets: int) -> None:
        self.buckets, self.parts, self.size = buckets, [], 0

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)
        self.size += len(columns[0])

    def overflow(self) -> Iterator[tuple[np.ndarray, list[bytes]]]:
        """What must go now."""
        if self.size > MOST_PACKED:
            yield from self.rest()

    def rest(self) -> Iterator[tuple[np.ndarray, list[bytes]]]:
        """All that is held: buckets, and what each gets."""
        if self.size:
            columns = [np.concatenate(part) for part in zip(*self.parts, strict=True)]
            self.parts, self.size = [], 0
            yield from packed(self.buckets, columns[0], *columns)


def dealt(rows: DataFrame, buckets: int, name: str) -> DataFrame:
    """All columns of `rows`, of 8 bytes each, in `name` and dealt to buckets by the first one."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Packer(buckets)

        def parts(found: Iterator[tuple[np.ndarray, list[bytes]]]) -> Iterator[pa.RecordBatch]:
            for bucket, data in found:
                yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(data, pa.binary())], ["bucket", name])

        for batch in batches:
            held.add(*(column.to_numpy() for column in batch.columns))
            yield from parts(held.overflow())
        yield from parts(held.rest())

    return rows.mapInArrow(of_task, f"bucket bigint, {name} binary")


def meeting(
    wanted: DataFrame, known: DataFrame, columns: tuple[int, int], join: Callable[..., pa.Table], schema: str
) -> DataFrame:
    """What `join` makes of the columns in `wanted` and those in `known`, bucket by bucket."""

    def of_bucket(table: pa.Table) -> pa.Table:
        names = ("wanted", "known")
        return join(*(unpacked(table.column(n).drop_null(), k) for n, k in zip(names, columns, strict=True)))

    return wanted.unionByName(known, allowMissingColumns=True).groupBy("bucket").applyInArrow(of_bucket, schema)


class Shared:
    """Broadcast values and stored tables that go when they have been used."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.values, self.tables = spark, [], []

    def value(self, value: object) -> Broadcast:
        self.values.append(self.spark.sparkContext.broadcast(value))
        return self.values[-1]

    def table(self, df: DataFrame, purpose: str) -> DataFrame:
        self.tables.append(written(df, purpose))
        return self.tables[-1]

    def drop(self) -> None:
        for value in self.values:
            value.destroy()
        for table in self.tables:
            for file in table.inputFiles()[:1]:
                folder = self.spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
                folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        self.values, self.tables = [], []


class Filter:
    """Numbers of sequences that may be in a table; it never lacks one that is."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits

    def holds(self, numbers: np.ndarray) -> np.ndarray:
        at = numbers & (8 * len(self.bits) - 1)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def filter_of(numbers: DataFrame) -> Filter:
    """The filter of a column of numbers. Each of its slices is made by one task."""
    n = numbers.count()
    size = min(MOST_BITS, max(8, 1 << (FILTER_BITS * n).bit_length()))
    one = min(size, SLICE_BITS)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            at = np.unique(batch.column(0).to_numpy())
            which = at // one
            for number in np.unique(which):
                bits = held.setdefault(int(number), np.zeros(one, bool))
                bits[at[which == number] % one] = True
        for number, bits in held.items():
            packed = np.packbits(bits, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([packed])], ["slice", "bits"])

    place = F.col("id").bitwiseAND(F.lit(size - 1)).alias("at")
    slices_of = F.expr(f"at div {one}")
    tasks = min(size // one, numbers.sparkSession.sparkContext.defaultParallelism)
    found = numbers.toDF("id").select(place).repartition(tasks, slices_of)
    bits = np.zeros(size // 8, np.uint8)
    for row in found.mapInArrow(marked, "slice bigint, bits binary").toArrow().to_pylist():
        start = row["slice"] * one // 8
        bits[start : start + one // 8] |= np.frombuffer(row["bits"], np.uint8)
    return Filter(bits)


def chained(tokens: Tokens, levels: list[np.ndarray]) -> list[np.ndarray]:
    """For each length the number of the sequence that ends at a token.

    `levels` has the sorted keys of the common sequences of each length: of words, then of pairs of
    numbers of the length below, the sequence without its last and without its first word.
    Common ones are numbered from 0, all others have a negative number. Sequences don't
    reach over the start of a text; where there is none, the number is `NONE`.
    """
    place = _place(levels[0], tokens.words)
    found = [np.where(place >= 0, place, tokens.words | _SIGN)[tokens.codes]]
    for keys in levels[1:]:
        ready = inside(tokens, len(found))
        context, suffix = found[-1][ready - 1], found[-1][ready]
        numbers = np.full(len(tokens.codes), NONE, dtype=np.int64)
        numbers[ready] = numbered(context, suffix, keys, len(found))
        found.append(numbers)
    return found


def inside(tokens: Tokens, length: int) -> np.ndarray:
    """Where sequences one longer than `length` end."""
    ready = np.ones(len(tokens.codes), bool)
    for ahead in range(length):
        at = tokens.starts[:-1] + ahead
        ready[at[at < tokens.starts[1:]]] = False
    return np.flatnonzero(ready)


def numbered(context: np.ndarray, suffix: np.ndarray, keys: np.ndarray, length: int) -> np.ndarray:
    """Numbers of sequences from those of their two parts, which have this length."""
    numbers = hashed(context, suffix, length)
    both = np.flatnonzero((context >= 0) & (suffix >= 0))
    place = _place(keys, context[both] << 32 | suffix[both])
    numbers[both] = np.where(place >= 0, place, numbers[both])
    return numbers


@dataclass
class Tree:
    """Sequences by length, each with what its occurrence adds to the score of a text.

    keys: of the common sequences, sorted, for each length. weights: what each of them adds.
    base: log10 of the base probability of the common words. others: for each length id, known, base and model, what all others add to n_known and both scores.
    filter: of those others that aren't words. unseen: log10 of the base probability of a
    word never seen. buckets: by which the others are dealt to meet their occurrences.

    A token's probability is that of its longest sequence, so that
    log P = sum over the sequences that end at it, and over the contexts before it, of
    what each changes: a context's factor for what it leaves to its suffix, and for a
    sequence the ratio of its probability to what it would have by that factor. A word that
    isn't the end is the context of one token, so both belong to the sequence.
    """

    keys: list[np.ndarray]
    weights: list[np.ndarray]
    base: np.ndarray
    others: list[DataFrame]
    filter: Filter
    unseen: float
    buckets: int


def _word_counts(texts: DataFrame, buckets: int) -> DataFrame:
    """key and n of the words, dealt as in `_sequence_counts`."""

    def rows(held: Tally) -> Iterator[pa.RecordBatch]:
        if found := held.taken():
            for bucket, data in packed(buckets, found[0], *found):
                yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(data, pa.binary())], ["bucket", "data"])

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Tally()
        for whole in batches:
            for batch in slices(whole, 0):
                tokens = tokenized(batch.column(0))
                held.add(tokens.words, np.bincount(tokens.codes, minlength=len(tokens.words)))
                if held.crowded():
                    yield from rows(held)
        yield from rows(held)

    def added_up(table: pa.Table) -> pa.Table:
        keys, n = unpacked(table.column("data"), 2)
        held = Tally()
        held.add(keys, n)
        return pa.table(list(held.taken()), ["key", "n"])

    return (
        texts.mapInArrow(tally, "bucket bigint, data binary")
        .groupBy("bucket")
        .applyInArrow(added_up, "key bigint, n bigint")
        .where("n > 0")
    )


def _key(context: np.ndarray, suffix: np.ndarray, length: int) -> np.ndarray:
    """A number for a sequence, whether its two parts are common or not."""
    common = (context >= 0) & (suffix >= 0)
    return np.where(common, context << 32 | suffix, hashed(context, suffix, length))


def _sequence_counts(
    texts: DataFrame, levels: list[np.ndarray], shared: Broadcast, least: float, buckets: int
) -> DataFrame:
    """context, suffix and n of the sequences one longer than `levels` goes that occur `least` times.

    Only sequences whose two parts are in the tree, by the keys and the filter that are `shared`. A sequence is
    never more frequent than its parts, so none is missed. A task's sequences are counted
    first, and dealt by their number in a row for each bucket, where they are added up.
    """
    length = len(levels)

    def rows(held: Tally) -> Iterator[pa.RecordBatch]:
        if found := held.taken():
            keys, n, context, suffix = found
            for bucket, data in packed(buckets, keys, context, suffix, n):
                yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(data, pa.binary())], ["bucket", "data"])

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, (levels, alive) = Tally(MOST_HELD), shared.value
        for whole in batches:
            for batch in slices(whole, 0):
                tokens = tokenized(batch.column(0))
                numbers = chained(tokens, levels)[-1]
                live = numbers >= 0
                live[~live] = alive.holds(numbers[~live])
                ready = inside(tokens, length)
                ready = ready[live[ready] & live[ready - 1]]
                context, suffix = numbers[ready - 1], numbers[ready]
                held.add(_key(context, suffix, length), None, context, suffix)
                if held.crowded():
                    yield from rows(held)
        yield from rows(held)

    def added_up(table: pa.Table) -> pa.Table:
        context, suffix, n = unpacked(table.column("data"), 3)
        keys = _key(context, suffix, length)
        order = np.argsort(keys)
        keys = keys[order]
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        n = np.add.reduceat(n[order], starts)
        kept = n >= least
        first = order[starts[kept]]
        return pa.table({"context": context[first], "suffix": suffix[first], "n": n[kept]})

    return (
        texts.mapInArrow(tally, "bucket bigint, data binary")
        .groupBy("bucket")
        .applyInArrow(added_up, "context bigint, suffix bigint, n bigint")
    )


def _with_suffix(found: DataFrame, length: int, log_p: Broadcast, others: DataFrame, buckets: int) -> DataFrame:
    """Sequences one longer than `length` with their number and the log_p of their suffix.

    It is at hand for a common suffix; all others meet `others`.
    """
    names = ["id", "context", "n", "below"]
    schema = "id bigint, context bigint, n bigint, below double"

    def at_hand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            context, suffix, n = (column.to_numpy() for column in batch.columns)
            columns = [hashed(context, suffix, length), context, n, log_p.value[suffix]]
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in columns], names)

    def join(wanted: np.ndarray, known: np.ndarray) -> pa.Table:
        suffix, context, n = wanted
        order = np.argsort(known[0])
        place = _place(known[0][order], suffix)
        hit = place >= 0
        below = known[1].view(np.float64)[order][place[hit]]
        return pa.table([hashed(context, suffix, length)[hit], context[hit], n[hit], below], names)

    rows = found.select("context", "suffix", "n").where("suffix >= 0").mapInArrow(at_hand, schema)
    wanted = dealt(found.where("suffix < 0").select("suffix", "context", "n"), buckets, "wanted")
    return rows.unionByName(
        meeting(wanted, dealt(others.select("id", "log_p"), buckets, "known"), (3, 2), join, schema)
    )


def _by_context(rows: DataFrame, sums: dict[str, Column], size: int) -> list[np.ndarray]:
    """Sums for each of `size` common contexts, of the sequences that are joined."""
    table = rows.groupBy("context").agg(*(F.sum(x).alias(name) for name, x in sums.items())).toArrow()
    found = []
    for name in sums:
        found.append(np.zeros(size))
        found[-1][table.column("context").to_numpy()] = table.column(name).to_numpy()
    return found


def _after_common(rows: DataFrame, shared: Broadcast, *, finished: bool) -> DataFrame:
    """Of sequences after common contexts: context and gain, or with the factors that are `shared` the finished rows."""
    names = ["id", "n", "log_p", "delta"] if finished else ["context", "gain"]

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rest, factor = shared.value
        for batch in batches:
            number, context, n, below = (column.to_numpy() for column in batch.columns)
            p = (n - DISCOUNT) / counts[context] + rest[context] * 10**below
            if not finished:
                columns = [context, n * (np.log(p) - below * np.log(10))]
            else:
                state = factor[context] != 0
                log_p = np.where(state, np.log10(p), below)
                columns = [number, n, log_p, np.where(state, log_p - below - factor[context], 0.0)]
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in columns], names)

    kinds = {"gain": "double", "log_p": "double", "delta": "double"}
    schema = ", ".join(f"{name} {kinds.get(name, 'bigint')}" for name in names)
    return rows.select("id", "context", "n", "below").mapInArrow(own, schema)


def _after_others(rows: DataFrame, others: DataFrame, buckets: int) -> DataFrame:
    """Sequences after all other contexts, none of which has many, finished.

    One row of a state has its number and factor, too. Rows meet their context's count,
    and are added up there.
    """

    def join(wanted: np.ndarray, known: np.ndarray) -> pa.Table:
        order = np.argsort(known[0])
        wanted = wanted[:, np.argsort(wanted[0], kind="stable")]
        at = _place(known[0][order], wanted[0])
        context, number, n, below = wanted[:, at >= 0]
        below = below.view(np.float64)
        first = np.ones(len(context), bool)
        first[1:] = context[1:] != context[:-1]
        starts, of = np.flatnonzero(first), np.cumsum(first) - 1
        total = known[1][order][at[at >= 0][starts]]

        def added_up(x: np.ndarray) -> np.ndarray:
            return np.add.reduceat(x, starts) if len(x) else x

        rest = 1 - added_up(n - DISCOUNT) / total
        p = (n - DISCOUNT) / total[of] + rest[of] * 10**below
        gain = added_up(n * (np.log(p) - below * np.log(10))) + (total - added_up(n)) * np.log(rest)
        state = gain >= DIVERGENCE * total
        log_p = np.where(state[of], np.log10(p), below)
        no_state = ~(first & state[of])
        factor = np.log10(rest)[of]
        columns = [
            pa.array(number),
            pa.array(n),
            pa.array(log_p),
            pa.array(np.where(state[of], log_p - below - factor, 0.0)),
            pa.array(context, mask=no_state),
            pa.array(factor, mask=no_state),
        ]
        return pa.table(columns, ["id", "n", "log_p", "delta", "state_id", "factor"])

    wanted = dealt(rows.select("context", "id", "n", "below"), buckets, "wanted")
    known = dealt(others.select("id", "n"), buckets, "known")
    schema = "id bigint, n bigint, log_p double, delta double, state_id bigint, factor double"
    return meeting(wanted, known, (4, 2), join, schema)


def learn(
    texts: DataFrame, depth: int = DEPTH, share: float = SHARE, common: float = COMMON
) -> tuple[Tree, int]:
    """From a column of texts: the tree, and how many tokens they have.

    Length by length the sequences of the whole corpus are counted whose parts are in the
    tree, a task's before they are shuffled; those that occur often enough join it. A context's
    distribution gives each sequence in the tree its discounted share, and what is left to the
    distribution of its longest suffix that is a state. It is one if the mean log ratio of
    the two over the training tokens that follow it, those of rare words included, is at
    least `DIVERGENCE`.
    """
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = written(_word_counts(texts, 2 * partitions), "word-counts")
    distinct, total = words.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).collect()[0]
    least = max(LEAST, share * total)
    often = max(least, common * total)
    unseen = -np.log10(total + distinct + 1)
    buckets = max(2 * partitions, -(-total // BUCKET_TOKENS))
    # 1 / common rows at most, here and below
    table = words.where(F.col("n") >= often).orderBy("key").toArrow()
    keys, counts = [table.column("key").to_numpy()], table.column("n").to_numpy()
    log_p = np.log10(counts + 1) + unseen
    weights, base = [log_p], log_p
    rare = words.where(F.col("n") < often).select(
        F.col("key").bitwiseOR(F.lit(int(_SIGN))).alias("id"), "n", F.log10(F.col("n") + 1.0).alias("more")
    )
    # of each length, what is added by sequences that aren't common
    others = [rare.select("id", F.lit(1).cast("bigint").alias("known"), F.col("more").alias("base"), F.col("more").alias("model"))]
    rare = rare.where(F.col("n") >= least).select("id", "n", (F.col("more") + F.lit(float(unseen))).alias("log_p"))

    def adding(rows: DataFrame) -> DataFrame:
        return rows.select("id", F.lit(0).cast("bigint").alias("known"), F.lit(0.0).alias("base"), "model")

    for length in range(1, depth + 1):
        shared = Shared(texts.sparkSession)
        alive = shared.value((keys, filter_of(rare.select("id"))))
        found = shared.table(_sequence_counts(texts, keys, alive, least, buckets), "sequence-counts")
        key = F.shiftleft("context", 32).bitwiseOR(F.col("suffix")).alias("key")
        table = found.where(F.col("n") >= often).select(key, "n").orderBy("key").toArrow()
        keys.append(table.column("key").to_numpy())
        own = table.column("n").to_numpy()
        context, suffix, size = keys[-1] >> 32, keys[-1] & 0xFFFFFFFF, len(counts)
        joined = found.where(F.col("n") < often)
        rows = shared.table(_with_suffix(joined, length, shared.value(log_p), rare, buckets), "suffixes")
        after_common = rows.where("context >= 0")
        given, seen = _by_context(after_common, {"given": F.col("n") - DISCOUNT, "seen": F.col("n")}, size)
        given += np.bincount(context, weights=own - DISCOUNT, minlength=size)
        seen += np.bincount(context, weights=own, minlength=size)
        rest = 1 - given / counts
        below = log_p[suffix]
        p = (own - DISCOUNT) / counts[context] + rest[context] * 10**below
        gains = _after_common(after_common, shared.value((counts, rest, None)), finished=False)
        (gain,) = _by_context(gains, {"gain": F.col("gain")}, size)
        gain += np.bincount(context, weights=own * (np.log(p) - below * np.log(10)), minlength=size)
        state = (seen > 0) & (gain + (counts - seen) * np.log(rest) >= DIVERGENCE * counts)
        factor = np.where(state, np.log10(rest), 0.0)
        level = _after_others(rows.where("context < 0"), rare, buckets).unionByName(
            _after_common(after_common, shared.value((counts, rest, factor)), finished=True), allowMissingColumns=True
        )
        if length == depth:
            level = level.drop("n", "log_p")
        level = written(level, "sequences")
        shared.drop()
        weights[-1] = weights[-1] + factor
        log_p = np.where(state[context], np.log10(p), below)
        weights.append(np.where(state[context], log_p - below - factor[context], 0.0))
        counts = own
        states = level.where("state_id is not null").select(F.col("state_id").alias("id"), F.col("factor").alias("model"))
        others[-1] = others[-1].unionByName(adding(states))
        others.append(adding(level.where("delta != 0").select("id", F.col("delta").alias("model"))))
        if length < depth:
            rare = level.select("id", "n", "log_p")
    looked_for = [rows.select("id") for rows in others[1:]] or [rare.select("id").limit(0)]
    tree = Tree(
        keys,
        weights,
        base,
        others,
        filter_of(reduce(DataFrame.unionByName, looked_for)),
        float(unseen),
        buckets,
    )
    return tree, total


def _counted(ids: np.ndarray, row_no: np.ndarray, of_text: np.ndarray) -> tuple[np.ndarray, ...]:
    """Numbers of sequences, the rows they are in, and how often they are; told apart by a hash of both."""
    both = _mixed(ids.view(np.uint64) + _mixed(of_text.astype(np.uint64) + np.uint64(SEED)))
    order = np.argsort(both)
    both = both[order]
    first = np.ones(len(both), bool)
    first[1:] = both[1:] != both[:-1]
    starts = np.flatnonzero(first)
    times = np.diff(np.append(starts, len(both)))
    again = np.argsort(of_text[order[starts]].astype(np.int32), kind="stable")
    at, times = order[starts][again], times[again]
    return ids[at], row_no[of_text[at]], times


def _scored(docs: DataFrame, shared: Broadcast, buckets: int) -> DataFrame:
    """What the common sequences tell of each row.

    In rows with a `length` and a `bucket` its other sequences of that length with their counts.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"row_no bigint, doc_id {kind}, held_out boolean, n_tokens bigint, known bigint,"
        " base double, model double, length int, bucket bigint, wanted binary"
    )

    def of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, weights, base, others, unseen = shared.value
        found = [Packer(buckets) for _ in keys]
        names = [part.split()[0] for part in schema.split(", ")]
        id_type = pa.null()

        def rows(length: int, parts: Iterator[tuple[np.ndarray, list[bytes]]]) -> Iterator[pa.RecordBatch]:
            for bucket, data in parts:
                kinds = [pa.int64(), id_type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
                empty = [pa.nulls(len(bucket), t) for t in kinds]
                lengths = pa.array(np.full(len(bucket), length, np.int32))
                yield pa.RecordBatch.from_arrays([*empty, lengths, pa.array(bucket), pa.array(data, pa.binary())], names)

        for whole in batches:
            id_type = whole.column(1).type
            for batch in slices(whole, 3):
                tokens = tokenized(batch.column(3))
                numbers = chained(tokens, keys)
                frequent = numbers[0] >= 0
                n_tokens = np.diff(tokens.starts)
                of_text = np.repeat(np.arange(batch.num_rows), n_tokens)
                root, log_p = np.full(len(frequent), unseen), np.full(len(frequent), unseen)
                root[frequent] = base[numbers[0][frequent]]
                log_p[frequent] = weights[0][numbers[0][frequent]]
                row_no = batch.column(0).to_numpy()
                found[0].add(*_counted(numbers[0][~frequent], row_no, of_text[~frequent]))
                for length, (number, weight) in enumerate(zip(numbers[1:], weights[1:], strict=True), 1):
                    log_p[number >= 0] += weight[number[number >= 0]]
                    at = np.flatnonzero((number < 0) & (number != NONE))
                    at = at[others.holds(number[at])]
                    found[length].add(*_counted(number[at], row_no, of_text[at]))
                sums = [np.bincount(of_text, weights=x, minlength=batch.num_rows) for x in (root, log_p)]
                known = np.bincount(of_text[frequent], minlength=batch.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        batch.column(2),
                        pa.array(n_tokens),
                        pa.array(known.astype(np.int64)),
                        *map(pa.array, sums),
                        pa.nulls(batch.num_rows, pa.int32()),
                        pa.nulls(batch.num_rows, pa.int64()),
                        pa.nulls(batch.num_rows, pa.binary()),
                    ],
                    names,
                )
                for length, held in enumerate(found):
                    yield from rows(length, held.overflow())
        for length, held in enumerate(found):
            yield from rows(length, held.rest())

    numbered_rows = docs.select(
        F.monotonically_increasing_id().alias("row_no"), "doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"
    )
    return numbered_rows.mapInArrow(of_texts, schema)


def _added(occurrences: DataFrame, others: DataFrame, buckets: int) -> DataFrame:
    """For each row of texts what the other sequences of a length add, which they meet in their bucket."""

    def join(wanted: np.ndarray, entries: np.ndarray) -> pa.Table:
        order = np.argsort(entries[0])
        ids = entries[0][order]
        starts = np.flatnonzero(np.diff(ids, prepend=~ids[:1]))
        adds = [entries[1].astype(np.float64), entries[2].view(np.float64), entries[3].view(np.float64)]
        adds = [np.add.reduceat(x[order], starts) if len(ids) else x for x in adds]
        place = _place(ids[starts], wanted[0])
        hit = np.flatnonzero(place >= 0)
        found, at = np.unique(wanted[1][hit], return_inverse=True)
        sums = [np.bincount(at, weights=wanted[2][hit] * x[place[hit]], minlength=len(found)) for x in adds]
        kinds = [np.int64, np.float64, np.float64]
        sums = [x.astype(kind) for x, kind in zip(sums, kinds, strict=True)]
        return pa.table([found, *sums], ["row_no", "known", "base", "model"])

    entries = dealt(others.select("id", "known", "base", "model"), buckets, "known")
    schema = "row_no bigint, known bigint, base double, model double"
    return (
        meeting(occurrences.select("bucket", "wanted"), entries, (3, 4), join, schema)
        .groupBy("row_no")
        .agg(*(F.sum(name).alias(name) for name in ("known", "base", "model")))
    )


def score(
    docs: DataFrame, depth: int = DEPTH, share: float = SHARE, common: float = COMMON
) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are words, A-Z lower-cased, and an end, which counts as one; a null or empty
    text has only its end. Both scores are log10 probabilities of all tokens of the text:
    `base_score` by their counts in the documents that aren't held out, one added, `score`
    by the tree, whose root is that distribution. At each token the state is the longest
    run of words before it, within its text, that is retained. Repeated rows count as
    often as they occur and get a row each; an empty training set leaves every token unseen.

    What a common sequence adds to the scores is found in the task that has the text. All
    others are joined to what they add. Each of them has at most `common` of the training
    tokens, so none is a hot key.
    """
    training = docs.where(~held_out(F.col("doc_id"))).select("text")
    tree, total = learn(training, depth, share, common)
    shared = Shared(docs.sparkSession)
    values = shared.value((tree.keys, tree.weights, tree.base, tree.filter, tree.unseen))
    rows = written(_scored(docs, values, tree.buckets), "scored")
    shared.drop()
    added = [
        written(_added(rows.where(F.col("length") == length), others, tree.buckets), "added")
        for length, others in enumerate(tree.others)
    ]
    added = (
        reduce(DataFrame.unionByName, added)
        .groupBy("row_no")
        .agg(
            F.sum("known").alias("more_known"),
            F.sum("base").alias("more_base"),
            F.sum("model").alias("more_model"),
        )
    )
    rows = rows.where("bucket is null").drop("length", "bucket", "wanted")
    return rows.join(added, "row_no", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("model") + F.coalesce("more_model", F.lit(0.0))).alias("score"),
    )
