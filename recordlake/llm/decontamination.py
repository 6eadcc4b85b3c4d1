"""Benchmark decontamination over a distributed positional inverted index."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm.frames import annotate, pieces_of, written

WINDOW = 10
SLACK = 2  # positions a term may be off in a proximity match
CHUNK_TOKENS, CHUNK_DOCS = 1 << 20, 1 << 17  # of an index chunk, the last text whole
BLOCK_WINDOWS = 1 << 14  # matched at once against a chunk

# ASCII letters in lower case, digits and all bytes of other characters make words
_KEPT = {*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)}
TABLE = bytes(b if b in _KEPT else 32 for b in bytes(range(256)).lower())


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TABLE).split()


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seven bits to a byte, low ones first, the top bit on all but a value's last; and ends."""
    values = values.astype(np.uint64)
    sizes = np.ones(len(values), np.int64)
    for bits in range(7, 64, 7):
        more = values >= np.uint64(1 << bits)
        if not more.any():
            break
        sizes += more
    ends = np.cumsum(sizes)
    out = np.zeros(ends[-1] if len(ends) else 0, np.uint8)
    for k in range(int(sizes.max(initial=0))):
        some = sizes > k
        part = (values[some] >> np.uint64(7 * k)) & np.uint64(127)
        part |= np.where(sizes[some] > k + 1, np.uint64(128), np.uint64(0))
        out[ends[some] - sizes[some] + k] = part
    return out, ends


def from_varints(raw: bytes) -> np.ndarray:
    data = np.frombuffer(raw, np.uint8)
    last = np.flatnonzero(data < 128)
    first = np.concatenate(([0], last[:-1] + 1))
    place = np.arange(len(data)) - np.repeat(first, last - first + 1)
    parts = (data & 127).astype(np.int64) << (7 * place)
    return np.add.reduceat(parts, first)


class ChunkIndex:
    """Postings of some whole texts: for each term the ascending positions it stands at.

    The texts' tokens are numbered in one row, with ``gap`` positions free
    between two texts, so that no match reaches from one into another.
    """

    def __init__(self, gap: int):
        self.gap = gap
        self.clear()

    def clear(self) -> None:
        self.terms: dict[bytes, int] = {}
        self.parts: list[np.ndarray] = []
        self.ids, self.words, self.starts = [], [], []
        self.held, self.next = 0, self.gap

    def add(self, doc_id, text: str | None) -> None:
        found, terms = words_of(text), self.terms
        numbers = [terms.setdefault(w, len(terms)) for w in found]
        self.parts.append(np.array(numbers, np.uint32))
        self.ids.append(doc_id)
        self.words.append(len(found))
        self.starts.append(self.next)
        self.held += len(found)
        self.next += len(found) + self.gap

    @property
    def full(self) -> bool:
        return self.held >= CHUNK_TOKENS or len(self.ids) >= CHUNK_DOCS

    def postings(self) -> tuple[pa.Array, pa.Array, pa.Array]:
        """Terms, how often each stands in the texts, and its positions as gaps."""
        numbers = np.concatenate(self.parts) if self.parts else np.zeros(0, np.uint32)
        sizes = np.array(self.words, np.int64)
        before = np.cumsum(sizes) - sizes
        places = np.arange(len(numbers)) + np.repeat(np.array(self.starts, np.int64) - before, sizes)
        order = np.argsort(numbers, kind="stable")
        counts = np.bincount(numbers, minlength=len(self.terms))
        places = places[order]
        steps = np.diff(places, prepend=0)
        firsts = np.cumsum(counts) - counts
        steps[firsts] = places[firsts]
        raw, ends = varints(steps)
        stops = ends[np.cumsum(counts) - 1] if len(counts) else ends
        offsets = np.concatenate(([0], stops)).astype(np.int32)
        packed = pa.Array.from_buffers(
            pa.binary(), len(counts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw.tobytes())]
        )
        return pa.array(list(self.terms), pa.binary()).cast(pa.string()), pa.array(counts), packed


def positional_index(
    df: DataFrame, id_column: str = "doc_id", text: str = "text", *, gap: int = WINDOW + 2 * SLACK + 1
) -> DataFrame:
    """The stored index of every token of every text: one row per chunk and term.

    Columns: ``chunk``, ``term``, ``n`` and ``postings``; and for each chunk
    one row without a term that lists its texts: ``ids``, ``words``, ``starts``.
    A chunk is some whole texts of one task, about a million tokens.
    """
    sent = df.select(
        F.col(f"`{id_column}`").alias("id"),
        F.spark_partition_id().cast("bigint").alias("task"),
        F.col(f"`{text}`").alias("text"),
    )
    kind = sent.schema["id"].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(sent.schema["id"].dataType)
    names = ["chunk", "term", "n", "postings", "ids", "words", "starts"]
    lists = [pa.list_(id_type), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def flush(chunk: int, index: ChunkIndex) -> Iterator[pa.RecordBatch]:
        head = [[chunk], [None], [None], [None], [index.ids], [index.words], [index.starts]]
        types = [pa.int64(), pa.string(), pa.int64(), pa.binary(), *lists]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, type=t) for v, t in zip(head, types)], names=names
        )
        terms, counts, packed = index.postings()
        own = pa.array(np.full(len(terms), chunk, np.int64))
        nulls = [pa.nulls(len(terms), t) for t in lists]
        yield pa.RecordBatch.from_arrays([own, terms, counts, packed, *nulls], names=names)
        index.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, chunk = ChunkIndex(gap), None
        for batch in pieces_of(batches):
            for doc_id, task, value in zip(*[c.to_pylist() for c in batch.columns]):
                chunk = task << 32 if chunk is None else chunk
                index.add(doc_id, value)
                if index.full:
                    yield from flush(chunk, index)
                    chunk += 1
        if index.ids:
            yield from flush(chunk, index)

    schema = (
        f"chunk bigint, term string, n bigint, postings binary, ids array<{kind}>, "
        "words array<bigint>, starts array<bigint>"
    )
    return written(sent.mapInArrow(run, schema), "index")


def windows_of(words: list[bytes], length: int) -> list[str]:
    """Windows of ``length`` words; fewer words are one window, none has none."""
    many = max(1, len(words) - length + 1) if words else 0
    return [b" ".join(words[i : i + length]).decode() for i in range(many)]


def item_windows(items: DataFrame, id_column: str, text: str, length: int) -> tuple[DataFrame, DataFrame]:
    """Stored (window, number, cls) of all distinct windows, and (cls, item_id) of each class.

    Windows that stand in the same items are one class, known by hashes of its
    items and named by its least number, so a passage's windows need not each
    carry their items, and no list of items is ever in one row.
    """
    sent = items.select(
        F.col(f"`{id_column}`").cast("string").alias("item_id"), F.col(f"`{text}`").alias("text")
    )

    def make():
        return lambda value: (windows_of(words_of(value), length),)

    found = annotate(sent, make, {"windows": "array<string>"}, ["text"], ["item_id"])
    pairs = written(
        found.select(F.explode("windows").alias("window"), "item_id").distinct(), "item-windows"
    )
    # two hashes of 64 bits, and the count: a null id counts as an item without a name
    own = pairs.groupBy("window").agg(
        F.bit_xor(F.xxhash64("item_id", F.lit(1))).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(2), "item_id")).alias("y"),
        F.count("*").alias("k"),
    )
    own = written(own.withColumn("number", F.monotonically_increasing_id()), "windows")
    classes = own.groupBy("x", "y", "k").agg(F.min("number").alias("cls"))
    windows = written(own.join(classes, ["x", "y", "k"]).select("window", "number", "cls"), "windows")
    heads = windows.where(F.col("number") == F.col("cls")).select("window", "cls")
    members = pairs.where(F.col("item_id").isNotNull()).join(heads, "window")
    return windows, written(members.select("cls", "item_id"), "members")


def rarest_first(windows: DataFrame, index: DataFrame) -> DataFrame:
    """Stored (number, cls, length, terms) of windows all of whose terms the texts hold.

    ``terms`` are (count over all texts, offset, term), the rarest first.
    """
    words = F.split("window", " ")
    spread = windows.select(
        "number", "cls", F.size(words).alias("length"), F.posexplode(words).alias("offset", "term")
    )
    wanted = spread.select("term").distinct()
    counts = (
        index.where(F.col("term").isNotNull())
        .select("term", "n")
        .join(wanted, "term", "left_semi")
        .groupBy("term")
        .agg(F.sum("n").alias("count"))
    )
    counts = written(counts, "term-counts")
    plan = (
        spread.join(counts, "term")
        .groupBy("number", "cls", "length")
        .agg(F.sort_array(F.collect_list(F.struct("count", "offset", "term"))).alias("terms"))
        .where(F.size("terms") == F.col("length"))
    )
    return written(plan, "window-terms")


def packed_blocks(plan: DataFrame, n_blocks: int) -> DataFrame:
    """(block, words, orders): the terms of a block, and its windows in numbers.

    A window is its class, its length, and for each of its terms, the rarest
    first, the term's place in ``words`` and its offset.
    """
    block = F.pmod(F.xxhash64("number"), F.lit(n_blocks))

    def pack(table: pa.Table) -> pa.Table:
        places: dict[str, int] = {}
        orders: list[int] = []
        for cls, terms in zip(table["cls"].to_pylist(), table["terms"].to_pylist()):
            orders += (cls, len(terms))
            for t in terms:
                orders += (places.setdefault(t["term"], len(places)), t["offset"])
        own = table["block"][0].as_py()
        raw = np.array(orders, np.int64).tobytes()
        return pa.table(
            {
                "block": pa.array([own], pa.int64()),
                "words": pa.array([list(places)], pa.list_(pa.string())),
                "orders": pa.array([raw], pa.binary()),
            }
        )

    dealt = plan.select(block.alias("block"), "cls", "terms")
    return dealt.groupBy("block").applyInArrow(
        pack, "block bigint, words array<string>, orders binary"
    )


class Block:
    """The windows of a block, to be matched against the postings of one chunk after another."""

    def __init__(self, words: list[str], orders: bytes):
        self.words = words
        values = np.frombuffer(orders, np.int64).tolist()
        self.windows, at = [], 0
        while at < len(values):
            cls, length = values[at : at + 2]
            flat = values[at + 2 : at + 2 + 2 * length]
            self.windows.append((cls, list(zip(flat[::2], flat[1::2]))))
            at += 2 + 2 * length

    def matches(self, postings: dict[str, bytes], slack: int):
        """(class, length, starts of exact matches, starts of proximity matches) of windows found.

        Lists are intersected from the rarest term on, each moved back by the
        term's offset. A proximity match is a start from which no term is more
        than ``slack`` positions off its place, and at least one is.
        """
        held: list = [postings.get(word) for word in self.words]
        lists: dict[int, np.ndarray] = {}

        def places(term: int) -> np.ndarray:
            if term not in lists:
                lists[term] = np.cumsum(from_varints(held[term]))
            return lists[term]

        for cls, terms in self.windows:
            if any(held[term] is None for term, _ in terms):
                continue
            first, offset = terms[0]
            near = places(first) - offset
            if slack:
                near = np.unique(np.add.outer(near, np.arange(-slack, slack + 1)))
            for term, offset in terms[1:]:
                near = near[within(places(term), near + offset, slack)]
                if not len(near):
                    break
            else:
                exact = np.ones(len(near), bool)
                for term, offset in terms:
                    exact &= within(places(term), near + offset, 0)
                yield cls, len(terms), near[exact], near[~exact]


def within(places: np.ndarray, wanted: np.ndarray, slack: int) -> np.ndarray:
    """Which of ``wanted`` have one of the ascending ``places`` at most ``slack`` away."""
    at = np.searchsorted(places, wanted - slack)
    found = places[np.minimum(at, len(places) - 1)]
    return (at < len(places)) & (found <= wanted + slack)


def chunk_hits(block: Block, postings: dict[str, bytes], starts: list[int], slack: int) -> list[tuple]:
    """(text's number, spans, classes, near classes) of each text of a chunk with a match.

    Spans are starts and ends of runs of hit words, in the text's own count.
    """
    firsts = np.array(starts, np.int64)
    edges: list[np.ndarray] = []
    sets: dict[int, tuple[set, set]] = {}
    for cls, length, exact, near in block.matches(postings, slack):
        if len(exact):
            edges.append(np.stack([exact, exact + length], axis=1))
        for kind, found in enumerate((exact, near)):
            # a near match starts in its text, or up to the slack before it
            for number in set((np.searchsorted(firsts, found + slack, side="right") - 1).tolist()):
                sets.setdefault(number, (set(), set()))[kind].add(cls)
    spans: dict[int, list[int]] = {}
    if edges:
        every = np.concatenate(edges)
        every = every[np.argsort(every[:, 0], kind="stable")]
        reach = np.maximum.accumulate(every[:, 1])
        new = np.concatenate(([True], every[1:, 0] > reach[:-1]))
        begin = every[new, 0]
        end = reach[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(every) - 1]))]
        numbers = np.searchsorted(firsts, begin, side="right") - 1
        for number, a, b in zip(numbers.tolist(), begin.tolist(), end.tolist()):
            spans.setdefault(number, []).extend((a - starts[number], b - starts[number]))
    return [
        (number, spans.get(number, []), sorted(exact), sorted(near - exact))
        for number, (exact, near) in sets.items()
    ]


def matched(index: DataFrame, plan: DataFrame, slack: int, block_windows: int) -> DataFrame:
    """Stored (chunk, number, spans, classes, near): hits of each text, by block of windows.

    Chunks are dealt out over as many shards as there are chunks. A shard gets
    each block once, then chunk by chunk the postings of the block's terms.
    """
    n_blocks = max(1, -(-plan.count() // block_windows))
    heads = index.where(F.col("term").isNull())
    n_shards = max(1, heads.count())
    shard = F.pmod(F.xxhash64("chunk"), F.lit(n_shards)).alias("shard")
    blocks = written(packed_blocks(plan, n_blocks), "blocks")
    every_block = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<bigint>")).alias("block")
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)).cast("array<bigint>")).alias("shard")
    none = F.lit(None)
    places = blocks.select(F.explode("words").alias("term"), "block")
    rows = (
        blocks.select(
            every_shard,
            "block",
            F.lit(-1).cast("bigint").alias("chunk"),
            none.cast("string").alias("term"),
            F.col("orders").alias("raw"),
            "words",
            none.cast("array<bigint>").alias("starts"),
        )
        .unionByName(
            heads.select(
                shard,
                every_block,
                "chunk",
                none.cast("string").alias("term"),
                none.cast("binary").alias("raw"),
                none.cast("array<string>").alias("words"),
                "starts",
            )
        )
        .unionByName(
            index.where(F.col("term").isNotNull())
            .join(places, "term")
            .select(
                shard,
                "block",
                "chunk",
                "term",
                F.col("postings").alias("raw"),
                none.cast("array<string>").alias("words"),
                none.cast("array<bigint>").alias("starts"),
            )
        )
    )
    names = ["chunk", "number", "spans", "classes", "near"]
    types = [pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3]

    def run(batches):
        def rows_of():
            for batch in pieces_of(batches):
                yield from zip(*[column.to_pylist() for column in batch.columns])

        block = None
        for (_, _, chunk), held in groupby(rows_of(), key=lambda row: row[:3]):
            head = next(held)
            if chunk == -1:
                block = Block(head[5], head[4])
                continue
            if block is None or head[6] is None:
                continue  # no windows at all: nothing to match
            postings = {row[3]: row[4] for row in held}
            found = [(chunk, *hit) for hit in chunk_hits(block, postings, head[6], slack)]
            columns = list(zip(*found)) if found else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), type=t) for c, t in zip(columns, types)], names=names
            )

    keys = ["shard", "block"]
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, "chunk", F.col("term").asc_nulls_first())
    dealt = dealt.select("shard", "block", "chunk", "term", "raw", "words", "starts")
    schema = (
        "chunk bigint, number bigint, spans array<bigint>, classes array<bigint>, near array<bigint>"
    )
    return written(dealt.mapInArrow(run, schema), "hits")


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_column: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    slack: int = SLACK,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Which words of every text stand in a window of test items, and of which items.

    Words are runs of ASCII letters (lower-cased), digits and characters beyond
    ASCII, of whole texts. A window is ``window`` consecutive words of an item;
    an item of fewer words is one window. Exact phrase matches come from the
    positional index: lists of postings, moved by each term's offset, are
    intersected from the rarest term of the window on. Proximity matches are
    those where every term is at most ``slack`` positions off its place.

    Returns the id column and ``n_words``; ``spans`` (start, end of runs of
    words in exact matches, in words; from several blocks of windows they may
    overlap); ``n_hit``, the words in them; ``items``, the ids as sorted
    strings of items with an exact match; and ``near_items``, of those with
    proximity matches alone. Other columns are not carried, so none can clash.

    A null or empty text has no words and no match, and such an item no window.
    A null item id marks words as hit, but is not listed; an id on several rows
    is listed once. Rows of one document id are matched one by one. No
    documents give no rows; no items match nothing.
    """
    index = positional_index(docs, id_column, text, gap=window + 2 * slack + 1)
    windows, members = item_windows(items, item_id, item_text, window)
    plan = rarest_first(windows, index)
    hits = matched(index, plan, slack, block_windows)

    runs = F.transform(
        F.sequence(F.lit(0), F.size("flat") - 2, F.lit(2)),
        lambda i: F.struct(
            F.get("flat", i).alias("start"), F.get("flat", i + 1).alias("end")
        ),
    )
    no_runs = F.array().cast("array<struct<start:bigint,end:bigint>>")
    # over sorted spans: how far they reach, and how many words they cover
    start = F.struct(F.lit(0).cast("bigint").alias("reach"), F.lit(0).cast("bigint").alias("words"))
    covered = F.aggregate(
        "spans",
        start,
        lambda a, s: F.struct(
            F.greatest(a["reach"], s["end"]).alias("reach"),
            (a["words"] + F.greatest(s["end"] - F.greatest(s["start"], a["reach"]), F.lit(0))).alias("words"),
        ),
        lambda a: a["words"],
    )
    spans = (
        hits.groupBy("chunk", "number")
        .agg(F.flatten(F.collect_list("spans")).alias("flat"))
        .select(
            "chunk",
            "number",
            F.sort_array(F.when(F.size("flat") > 0, runs).otherwise(no_runs)).alias("spans"),
        )
        .withColumn("n_hit", covered)
    )
    # many texts may hold one class; its items are few rows, joined as their size allows
    exact, near = (
        hits.select("chunk", "number", F.explode(c).alias("cls"), F.lit(c == "classes").alias("exact"))
        for c in ("classes", "near")
    )
    named = (
        exact.union(near)
        .join(members, "cls")
        .groupBy("chunk", "number", "item_id")
        .agg(F.max("exact").alias("exact"))
        .groupBy("chunk", "number")
        .agg(
            *[
                F.sort_array(F.collect_list(F.when(F.col("exact") == kind, F.col("item_id")))).alias(name)
                for kind, name in ((True, "items"), (False, "near_items"))
            ]
        )
    )
    texts = index.where(F.col("term").isNull()).select(
        "chunk", F.posexplode(F.arrays_zip("ids", "words")).alias("number", "held")
    )
    texts = texts.select("chunk", F.col("number").cast("bigint"), "held.ids", "held.words")
    nobody = F.array().cast("array<string>")
    return (
        texts.join(spans, ["chunk", "number"], "left")
        .join(named, ["chunk", "number"], "left")
        .select(
            F.col("ids").alias(id_column),
            F.col("words").alias("n_words"),
            F.coalesce("spans", no_runs).alias("spans"),
            F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
            F.coalesce("items", nobody).alias("items"),
            F.coalesce("near_items", nobody).alias("near_items"),
        )
    )
