"""SimHash near-duplicates, compared over vertical bit planes."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm.frames import annotate, without, written
from recordlake.llm.graph import components

SEED = 42
WORDS = 3
RADIUS = 2
BLOCKS = 4  # of 16 bits; within 2 bits, at least two of four blocks are equal
CHUNK = 2048  # fingerprints of a hot bucket that are compared at once
PAIRS = 1 << 17  # (fingerprint, word of lanes) pairs held at once

ONE, ALL = np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The 64-bit SimHash of the word shingles of ``text``; 0 if it has no word.

    A bit is set if it is set in over half of the shingles' hashes; repeated
    shingles count each time.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    n = max(1, len(found) - words + 1)
    if n == 1:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = np.concatenate(([0], ends[: n - 1])).tolist()
    stops = (ends[words - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[i:j], SEED) for i, j in zip(starts, stops)], np.uint64)
    set_in = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        # unpacked bit i of the little-endian bytes is bit i of the hash
        bits = np.unpackbits(part, axis=1, bitorder="little")
        set_in += np.add.reduce(bits, axis=0, dtype=np.uint32)
    bits = np.packbits(2 * set_in > n, bitorder="little")
    return int(bits.view("<u8")[0])


def planes(values: np.ndarray) -> np.ndarray:
    """(64, words): word w of plane p holds bit p of fingerprints 64w to 64w+63."""
    width = -(-len(values) // 64)
    padded = np.zeros(width * 64, np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    # (lane, bit) to (bit, lane), 64 lanes to a word
    packed = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return packed.view(np.uint64).reshape(64, width)


def near_lanes(
    queries: np.ndarray, plane: np.ndarray, word_of: np.ndarray, lanes: np.ndarray, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """Which lanes of which words lie within ``radius`` (0 to 2) of their query.

    Entry i asks for query i against the 64 lanes ``plane[:, word_of[i]]``, of
    which the bits of ``lanes[i]`` are of interest. Bit plane by bit plane, the
    differing bits are added into two-bit counters by carry-save addition:
    ``ones`` and ``twos`` hold the count of every lane, ``over`` the lanes past
    three. After every eight planes the words all of whose lanes exceed the
    radius are abandoned. Returns the entries left, and their lanes.
    """
    entry = np.arange(len(queries))
    ones = np.zeros(len(queries), np.uint64)
    twos, over = ones.copy(), ~lanes
    for bit in range(64):
        # all ones where the query has the bit, so that equal lanes give 0
        flip = np.where((queries >> np.uint64(bit)) & ONE, ALL, np.uint64(0))
        differ = plane[bit, word_of] ^ flip
        carry = ones & differ
        ones ^= differ
        over |= twos & carry
        twos ^= carry
        if bit % 8 == 7:
            out = over | exceeds(ones, twos, radius)
            left = out != ALL
            if not left.all():
                entry, queries, word_of = entry[left], queries[left], word_of[left]
                ones, twos, over = ones[left], twos[left], over[left]
                if not len(entry):
                    break
    return entry, ~(over | exceeds(ones, twos, radius))


def exceeds(ones: np.ndarray, twos: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose count is over the radius."""
    if radius == 0:
        return ones | twos
    return twos if radius == 1 else ones & twos


def local_stars(values: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links that connect what is connected among ``values``: fewer than there are values.

    Every value is compared with all later ones. Of the links found, only
    those that join two parts not yet joined are kept.
    """
    n = len(values)
    plane = planes(values)
    width = plane.shape[1]
    parent = list(range(n))
    joined = [1 << i for i in range(n)]  # at a part's head: its members, one bit each
    links = []

    def head(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    rows = max(1, PAIRS // width)
    for first in range(0, n, rows):
        asked = np.arange(first, min(n, first + rows))
        low = first // 64  # words before hold only earlier values
        words = np.arange(low, width)
        query, word = np.repeat(asked, len(words)), np.tile(words, len(asked))
        # lanes of interest: later than the query, and not padding
        lanes = np.where(word > query // 64, ALL, np.uint64(0))
        own = word == query // 64
        shift = (query[own] % 64).astype(np.uint64)
        lanes[own] = (ALL << shift) & ~(ONE << shift)
        if n % 64:
            lanes[word == width - 1] &= (ONE << np.uint64(n % 64)) - ONE
        some = lanes != 0
        query, word, lanes = query[some], word[some], lanes[some]
        entry, hits = near_lanes(values[query], plane, word, lanes, radius)
        row = np.zeros((len(asked), width), np.uint64)
        row[query[entry] - first, word[entry]] = hits
        for i in asked[row.any(axis=1)].tolist():
            h = head(i)
            new = int.from_bytes(row[i - first].tobytes(), "little") & ~joined[h]
            while new:
                j = (new & -new).bit_length() - 1
                other = head(j)
                links.append((i, j))
                parent[other] = h
                joined[h] |= joined[other]
                joined[other] = 0
                new &= ~joined[h]
    return links


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def links_between(prints: DataFrame, *, chunk: int = CHUNK) -> DataFrame:
    """(a, b) links that connect the distinct fingerprints ``fp`` within two bits.

    Two fingerprints at most two bits apart agree on two of four 16-bit blocks,
    so each is put into six buckets, one for each pair of blocks. A bucket with
    more than ``chunk`` fingerprints is cut by hash into parts, and every two
    parts meet in a bucket of their own: still every pair is compared, and none
    is emitted but those that join what no other link of the bucket joins.
    """
    block = [F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(BLOCKS)]
    keys = [
        F.lit(t * (1 << 32)) + F.shiftleft(block[i], 16) + block[j]
        for t, (i, j) in enumerate(combinations(range(BLOCKS), 2))
    ]
    bands = prints.select("fp", F.explode(F.array(*keys)).alias("key"))
    hot = (
        bands.groupBy("key")
        .count()
        .where(F.col("count") > chunk)
        .select("key", F.ceil(F.col("count") / chunk).cast("bigint").alias("parts"))
    )
    hot = written(hot, "hot-buckets")
    plain = bands.join(hot, "key", "left_anti").select(
        "key", F.lit(0).cast("bigint").alias("i"), F.lit(0).cast("bigint").alias("j"), "fp"
    )
    part = F.pmod(F.xxhash64("fp"), F.col("parts"))
    split = (
        bands.join(hot, "key")
        .withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
        .select(
            "key",
            F.least("part", "other").alias("i"),
            F.greatest("part", "other").alias("j"),
            "fp",
        )
    )
    buckets = (
        plain.unionByName(split)
        .groupBy("key", "i", "j")
        .agg(F.collect_list("fp").alias("fps"))
        .where(F.size("fps") > 1)
        .select("fps")
    )

    def compare(batches):
        for batch in batches:
            a, b = [], []
            for fps in batch.column(0):
                values = np.array(fps.values.to_numpy()).view(np.uint64)
                for i, j in local_stars(values):
                    a.append(values[i])
                    b.append(values[j])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, b)], names=["a", "b"]
            )

    return buckets.mapInArrow(compare, "a bigint, b bigint")


def near_duplicates(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    *,
    chunk: int = CHUNK,
    keep: list[str] | None = None,
) -> DataFrame:
    """Add ``fingerprint`` (16 hex digits) and ``component_id`` to every row.

    A-Z are lower-cased, words split at ASCII blanks, and 3-word shingles
    hashed by XXH64. Rows whose fingerprints differ in at most two bits are
    linked; ``component_id`` is the smallest id reachable, the row's own
    included. Copies share one fingerprint, so groups of them cost one row in
    all comparisons.

    A null or empty text has fingerprint zero and is linked like any other. A
    null id never is a ``component_id`` unless all ids of the component are
    null. Repeated rows stay repeated. ``keep`` names the columns to carry
    (all if None); columns named like a result are replaced by it.
    """
    kept = df.columns if keep is None else keep
    own = without(df.select(*[f"`{c}`" for c in kept]), ["fingerprint", "component_id"]).columns
    marked = written(_marked(df, id_column, text, own), "prints")
    prints = written(marked.groupBy("fp").agg(F.min("__id").alias("first")), "fingerprints")
    rooted = _rooted(prints, chunk)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = written(rooted.join(least, "root").select("fp", "component_id"), "classes")
    joined = marked.join(classes, "fp")
    return joined.select(
        *[F.col("__row").getField(c).alias(c) for c in own],
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def _marked(df: DataFrame, id_column: str, text: str, own: list[str]) -> DataFrame:
    """Each row's columns ``own`` as ``__row``, its ``__id`` and fingerprint ``fp``."""

    def make():
        return lambda value: (_signed(fingerprint(value)),)

    sent = df.select(
        F.struct(*[F.col(f"`{c}`") for c in own]).alias("__row"),
        F.col(f"`{id_column}`").alias("__id"),
        F.col(f"`{text}`").alias("__text"),
    )
    return annotate(sent, make, {"fp": "bigint"}, ["__text"], ["__row", "__id"])


def _rooted(prints: DataFrame, chunk: int) -> DataFrame:
    """``prints`` with the ``root`` of each fingerprint: one of those its group holds."""
    roots = components(links_between(prints.select("fp"), chunk=chunk))
    return prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )


def first_of_group(
    df: DataFrame, id_column: str = "doc_id", text: str = "text", *, chunk: int = CHUNK
) -> DataFrame:
    """One row of each group of near-duplicates, with the columns of ``df``.

    Groups are those of ``near_duplicates``. The row with the smallest id stays;
    a null id comes after all others. Of rows that share that id, the one whose
    columns have the least hash stays; rows alike in every column count as one.
    Null and empty texts form one group (with fingerprint zero). An empty table
    gives no rows; columns may have any names, as none is added.

    Rows are ordered within their group by a few numbers, aggregated partially
    before the shuffle, so the size of a group does not matter. Whole rows move
    once, by their own number, which spreads the copies of a text; the heads,
    one for each group, grow with the rows, so they are never broadcast.
    """
    columns = df.columns
    # numbered as stored: reading it again gives the same numbers
    marked = _marked(df, id_column, text, columns)
    marked = written(marked.withColumn("number", F.monotonically_increasing_id()), "prints")
    # maps have no hash; rows that differ in nothing else count as alike
    hashed = [c for c in columns if "map<" not in df.schema[c].dataType.simpleString()]
    order = F.struct(
        F.col("__id").isNull().alias("none"),
        F.col("__id").alias("id"),
        F.xxhash64(*[F.col("__row").getField(c) for c in hashed]).alias("hash"),
        F.col("number"),
    )
    prints = written(marked.groupBy("fp").agg(F.min(order).alias("first")), "fingerprints")
    heads = _rooted(prints, chunk).groupBy("root").agg(F.min("first").alias("first"))
    heads = written(heads.select("first.number"), "heads")
    return marked.join(heads.hint("merge"), "number", "left_semi").select(
        *[F.col("__row").getField(c).alias(c) for c in columns]
    )
