"""A word bigram model by deleted interpolation, and the scores it gives."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.llm.frames import pieces_of, written

FOLDS = 10
HELD_OUT, DELETED = 0, 1  # folds: not learned from; learned from, but left out of the weights' counts
CHUNK_TOKENS = 3 << 19
STEP_TOKENS = 1 << 17  # tokens whose probabilities are held at once
SLICE_ENTRIES = 1 << 22
# slices that a chunk, or a node of merged chunks, is divided into at most: rows of some
# kilobytes, and few levels, as each one more takes half as much disk again
FAN = 1 << 11
GRID = 8  # steps to an octave, on which held-out probabilities are counted for the weights
ABSENT = -(1 << 20)
ROUNDS = 60
END, START = xxhash.xxh64_intdigest(b" end"), xxhash.xxh64_intdigest(b" start")
DEFAULT = (0.3, 0.6, 0.1)

CHUNK_FIELDS = (
    "chunk bigint, hashes binary, low binary, high binary, rids array<bigint>, "
    "lengths array<bigint>, before array<bigint>, folds array<int>"
)


def pack_array(values: np.ndarray) -> bytes:
    """Compressed byte plane by byte plane: those of small numbers are mostly zero."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack_array(raw: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).reshape(-1).view(kind)


class ChunkBuilder:
    """Gathers tokens until a chunk is full; words are numbered within the chunk."""

    def __init__(self, first: int, size: int):
        self.number, self.size = first, size
        self.clear()

    def clear(self) -> None:
        # the start is a context, never a token; the end is a token, never a context
        self.words: dict[bytes, int] = {b" end": 0, b" start": 1}
        self.parts: list[np.ndarray] = []
        self.held, self.docs = 0, []

    def add(self, rid, doc_id, fold: int, text: str):
        """Take one text's tokens; yields each chunk that gets full on the way."""
        found = text.encode("utf-8", "surrogatepass").lower().split()
        found.append(b" end")
        last = b" start"
        at = 0
        while at < len(found):
            part = found[at : at + max(1, self.size - self.held)]
            words = self.words
            before = words.setdefault(last, len(words))
            ids = [words.setdefault(w, len(words)) for w in part]
            self.parts.append(np.array(ids, np.uint32))
            self.docs.append((rid, doc_id, len(part), before, fold))
            self.held += len(part)
            last, at = part[-1], at + len(part)
            if self.held >= self.size:
                yield self.flush()

    def flush(self) -> tuple:
        """The chunk so far; words are renumbered by how often they stand in it."""
        ids = np.concatenate(self.parts)
        counts = np.bincount(ids, minlength=len(self.words))
        order = np.argsort(-counts, kind="stable")
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        words = list(self.words)
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(words[i]) for i in order], np.uint64)
        ids = place[ids]
        rids, doc_ids, lengths, before, folds = zip(*self.docs)
        row = (
            self.number,
            hashes.tobytes(),
            pack_array((ids & 0xFFFF).astype(np.uint16)),
            pack_array((ids >> 16).astype(np.uint16)),
            list(rids),
            list(lengths),
            place[list(before)].tolist(),
            list(folds),
            list(doc_ids),
        )
        self.number += 1
        self.clear()
        return row


def chunked(df: DataFrame, id_column: str, text: str, size: int) -> DataFrame:
    """The corpus as chunks of numbered tokens. A text may run over several chunks."""
    sent = df.select(
        F.monotonically_increasing_id().alias("rid"),
        F.pmod(
            F.crc32(F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")).cast("binary")),
            F.lit(FOLDS),
        )
        .cast("int")
        .alias("fold"),
        F.col(f"`{text}`").alias("text"),
        F.col(f"`{id_column}`").alias("id"),
    )
    schema = T._parse_datatype_string(CHUNK_FIELDS)
    schema.add("ids", T.ArrayType(sent.schema["id"].dataType))
    names = schema.names

    def run(batches):
        builder = None
        for batch in pieces_of(batches):
            kinds = [pa.int64(), *[pa.binary()] * 3, *[pa.list_(pa.int64())] * 3]
            kinds += [pa.list_(pa.int32()), pa.list_(batch.column(3).type)]
            full = []
            for rid, fold, value, doc_id in zip(*(c.to_pylist() for c in batch.columns)):
                # row numbers are unique, and so are chunk numbers made from a task's first
                builder = builder or ChunkBuilder(rid, size)
                full += builder.add(rid, doc_id, fold, value or "")
            for row in full:
                yield batch_of([row], names, kinds)
        if builder and builder.held:
            yield batch_of([builder.flush()], names, kinds)

    return sent.mapInArrow(run, schema)


def batch_of(rows: list[tuple], names, kinds) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(columns, kinds)], names=list(names)
    )


class Chunk:
    """Tokens of a chunk, and the distinct words and word pairs in it."""

    def __init__(self, hashes, low, high, lengths, before, folds):
        self.hashes = np.frombuffer(hashes, np.uint64)
        self.ids = unpack_array(high, np.uint16).astype(np.uint32) << 16
        self.ids |= unpack_array(low, np.uint16)
        lengths = np.array(lengths)
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        self.before = np.concatenate(([0], self.ids[:-1])).astype(np.uint32)
        self.before[starts] = before
        self.fold = np.repeat(np.array(folds, np.int32), lengths)
        self.starts, self.lengths = starts, lengths
        pairs = (self.before.astype(np.uint64) << np.uint64(32)) | self.ids
        pairs, of = np.unique(pairs, return_inverse=True)
        self.pair_of = of.astype(np.uint32)
        del of
        first = self.hashes[(pairs >> np.uint64(32)).astype(np.uint32)]
        second = self.hashes[(pairs & np.uint64(0xFFFFFFFF)).astype(np.uint32)]
        self.pair_hashes = mixed(first, second)

    def order(self, kind: int) -> np.ndarray:
        """The words (0) or word pairs (1) by their hashes."""
        return np.argsort((self.hashes, self.pair_hashes)[kind])

    def counts(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each word or pair: how often learned from, and that without the deleted fold."""
        of, n = ((self.ids, len(self.hashes)), (self.pair_of, len(self.pair_hashes)))[kind]
        learned = self.fold != HELD_OUT
        used = learned & (self.fold != DELETED)
        return np.bincount(of[learned], minlength=n), np.bincount(of[used], minlength=n)


def mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A hash of word pairs from the hashes of their words."""
    x = first * np.uint64(0x9E3779B97F4A7C15) + (second ^ (second >> np.uint64(29)))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def rows_of(batches):
    """Rows one at a time, so that a task unpacks one chunk at once."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


CHUNK_INPUTS = ["hashes", "low", "high", "lengths", "before", "folds"]


@dataclass(frozen=True)
class Level:
    """One exchange of counts: each unit sends a row to each of ``width`` slices at most.

    ``slices`` is into how many ranges the hashes are divided by then, and
    ``groups`` how many groups of units have such slices of their own.
    """

    width: int
    slices: int
    groups: int


def levels_of(tokens: int, slice_entries: int, least: int, fan: int) -> list[Level]:
    """Levels that end in slices of about ``slice_entries`` of all the corpus' tokens.

    Groups are as many as let a slice of a group hold no more than that, too, so
    that rows of all levels together follow the tokens, not chunks times slices.
    """
    need = max(min(least, fan), -(-tokens // slice_entries), 1)
    levels, slices, rest = [], 1, need
    while not levels or rest > 1:
        width = min(fan, rest)
        slices, rest = slices * width, -(-rest // width)
        levels.append(Level(width, slices, -(-need // slices)))
    return levels


ASK = (
    "grp bigint, unit bigint, kind int, slice bigint, hashes binary, learned binary, used binary"
)
ASK_NAMES = [f.split()[0] for f in ASK.split(", ")]
ASK_KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 3]


def asks_of(group: int, unit: int, kind: int, inside: int, level: Level, hashes, counts):
    """What a unit counts of each slice inside its own one, one row each; hashes ascend."""
    first = inside * level.width
    cuts = [-(-(s << 64) // level.slices) for s in range(first + 1, first + level.width)]
    inner = np.searchsorted(hashes, np.array(cuts, np.uint64))
    bounds = np.concatenate(([0], inner, [len(hashes)])).astype(np.int64)
    rows = []
    for s in range(level.width):
        own = slice(bounds[s], bounds[s + 1])
        if bounds[s] < bounds[s + 1]:
            gaps = np.diff(hashes[own], prepend=np.uint64(0))
            packed = [pack_array(c[own].astype(np.uint64)) for c in counts]
            rows.append((group, unit, kind, first + s, pack_array(gaps), *packed))
    return batch_of(rows, ASK_NAMES, ASK_KINDS)


def chunk_asks(chunks: DataFrame, level: Level) -> DataFrame:
    """The first level's rows: each chunk's words and pairs, by slices."""

    def run(batches):
        for row in rows_of(batches):
            chunk = Chunk(*[row[c] for c in CHUNK_INPUTS])
            for kind, hashes in enumerate((chunk.hashes, chunk.pair_hashes)):
                order = chunk.order(kind)
                counts = [c[order] for c in chunk.counts(kind)]
                yield asks_of(row["grp"], row["chunk"], kind, 0, level, hashes[order], counts)

    grouped = chunks.withColumn("grp", F.pmod(F.xxhash64("chunk"), F.lit(level.groups)))
    return grouped.select("chunk", "grp", *CHUNK_INPUTS).mapInArrow(run, ASK)


def node_asks(nodes: DataFrame, level: Level) -> DataFrame:
    """A further level's rows: each node's merged words and pairs, by finer slices."""

    def run(batches):
        for row in rows_of(batches):
            hashes = np.cumsum(unpack_array(row["hashes"], np.uint64), dtype=np.uint64)
            counts = [unpack_array(row[c], np.uint64) for c in ("learned", "used")]
            group = row["grp"] % level.groups
            yield asks_of(group, row["grp"], row["kind"], row["slice"], level, hashes, counts)

    inputs = ["grp", "kind", "slice", "hashes", "learned", "used"]
    return nodes.select(*inputs).mapInArrow(run, ASK)


def by_slice(asks: DataFrame, level: Level):
    """One group for each kind and slice of each group of units; tasks grow with their number."""
    keys = ["grp", "kind", "slice"]
    return asks.repartition(2 * level.groups * level.slices, *keys).groupBy(*keys)


def added(rows: list[dict]):
    """(distinct hashes, each row's places in them, learned and used counts of them)."""
    parts = [np.cumsum(unpack_array(r["hashes"], np.uint64), dtype=np.uint64) for r in rows]
    distinct, of = np.unique(np.concatenate(parts), return_inverse=True)
    totals = []
    for name in ("learned", "used"):
        counts = np.concatenate([unpack_array(r[name], np.uint64) for r in rows])
        totals.append(np.bincount(of, weights=counts, minlength=len(distinct)).astype(np.uint64))
    return distinct, np.split(of, np.cumsum([len(p) for p in parts])[:-1]), totals


NODE = (
    "grp bigint, kind int, slice bigint, hashes binary, learned binary, used binary, "
    "units array<bigint>, places array<binary>"
)


def merged(group: pa.Table) -> pa.Table:
    """The counts of one slice of a group of units, and where in them each unit's are."""
    rows = group.to_pylist()
    distinct, places, totals = added(rows)
    columns = {
        "grp": pa.array([rows[0]["grp"]], pa.int64()),
        "kind": pa.array([rows[0]["kind"]], pa.int32()),
        "slice": pa.array([rows[0]["slice"]], pa.int64()),
        "hashes": pa.array([pack_array(np.diff(distinct, prepend=np.uint64(0)))], pa.binary()),
        "learned": pa.array([pack_array(totals[0])], pa.binary()),
        "used": pa.array([pack_array(totals[1])], pa.binary()),
        "units": pa.array([[r["unit"] for r in rows]], pa.list_(pa.int64())),
        "places": pa.array(
            [[pack_array(np.diff(p, prepend=0).astype(np.uint32)) for p in places]],
            pa.list_(pa.binary()),
        ),
    }
    return pa.table(columns)


REPLY = "unit bigint, kind int, slice bigint, learned binary, used binary"
REPLY_NAMES = [f.split()[0] for f in REPLY.split(", ")]
REPLY_KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]


def summed(group: pa.Table) -> pa.Table:
    """The corpus counts of one slice, handed back to every unit that asked, in its order."""
    rows = group.to_pylist()
    _, places, totals = added(rows)
    seen = [int(np.count_nonzero(t)) for t in totals]
    replies = [
        # the distinct words of the slice are told once
        (r["unit"], r["kind"], r["slice"], *(pack_array(t[own]) for t in totals))
        + tuple(seen if i == 0 else (0, 0))
        for i, (r, own) in enumerate(zip(rows, places))
    ]
    names, kinds = [*REPLY_NAMES, "n_learned", "n_used"], [*REPLY_KINDS, pa.int64(), pa.int64()]
    return pa.Table.from_batches([batch_of(replies, names, kinds)])


def handed_back(nodes: DataFrame, replies: DataFrame, level: Level) -> DataFrame:
    """Replies to nodes as replies to the units they were merged from.

    ``level`` is the one that the nodes asked, so at most its width of replies
    come to each node.
    """
    inside = F.floor(F.col("slice") / F.lit(level.width)).alias("slice")
    gathered = replies.groupBy(F.col("unit").alias("grp"), "kind", inside).agg(
        F.collect_list(F.struct("slice", "learned", "used")).alias("replies")
    )

    def run(batches):
        for row in rows_of(batches):
            found = sorted(row["replies"], key=lambda r: r["slice"])
            counts = [
                np.concatenate([unpack_array(r[c], np.uint64) for r in found])
                for c in ("learned", "used")
            ]
            for unit, raw in zip(row["units"], row["places"]):
                own = np.cumsum(unpack_array(raw, np.uint32), dtype=np.int64)
                values = [pack_array(c[own]) for c in counts]
                yield batch_of(
                    [(unit, row["kind"], row["slice"], *values)], REPLY_NAMES, REPLY_KINDS
                )

    known = nodes.select("grp", "kind", "slice", "units", "places").join(
        gathered, ["grp", "kind", "slice"]
    )
    return known.mapInArrow(run, REPLY)


def count_corpus(chunks: DataFrame, levels: list[Level]) -> tuple[DataFrame, tuple[int, int]]:
    """(what the corpus counts of each chunk's words and pairs, distinct words learned and used).

    Counts of a slice are merged level by level, over more and more chunks and
    in finer and finer slices, then handed back the same way.
    """
    asks, stored = chunk_asks(chunks, levels[0]), []
    for level, above in zip(levels, levels[1:]):
        nodes = written(by_slice(asks, level).applyInArrow(merged, NODE), "nodes")
        stored.append((nodes, above))
        asks = node_asks(nodes, above)
    told = by_slice(asks, levels[-1]).applyInArrow(
        summed, f"{REPLY}, n_learned bigint, n_used bigint"
    )
    replies = written(told, "counts")
    distinct = (
        replies.where("kind = 0")
        .agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_learned", "n_used")])
        .first()
    )
    for nodes, above in reversed(stored):
        replies = written(handed_back(nodes, replies, above), "counts")
    return replies, tuple(distinct)


class Model:
    """Probabilities of a chunk's tokens, from the counts handed back to it."""

    def __init__(self, row: dict, sizes: dict):
        self.chunk = chunk = Chunk(*[row[c] for c in CHUNK_INPUTS])
        self.learned, self.used = [None, None], [None, None]
        replies = sorted(row["replies"], key=lambda r: r["slice"])
        for kind in (0, 1):
            order = chunk.order(kind)
            for name, into in (("learned", self.learned), ("used", self.used)):
                # slices ascend as the hashes do, and each entry is in one of them
                found = [unpack_array(r[name], np.uint64) for r in replies if r["kind"] == kind]
                into[kind] = counts = np.empty(len(order), np.uint64)
                counts[order] = np.concatenate(found)
        self.sizes = sizes

    def parts(self, name: str):
        """A few tokens at a time: their slice, the bucket of the context, and the ML
        estimates by pair, by word and uniformly."""
        chunk, counts = self.chunk, getattr(self, name)
        n, v = self.sizes[name]
        # every learned text has one start, as it has one end
        contexts = counts[0].copy()
        ends = counts[0][chunk.hashes == np.uint64(END)].sum()
        contexts[chunk.hashes == np.uint64(START)] = ends
        for at in range(0, len(chunk.ids), STEP_TOKENS):
            own = slice(at, at + STEP_TOKENS)
            context = contexts[chunk.before[own]].astype(np.float64)
            pair = counts[1][chunk.pair_of[own]] / np.maximum(context, 1)
            word = counts[0][chunk.ids[own]] / max(n, 1)
            bucket = np.frexp(context)[1]  # 0 for none, then one bucket an octave
            yield own, bucket, pair, word, 1 / (v + 1)


def on_grid(p: np.ndarray, unit: float) -> np.ndarray:
    with np.errstate(divide="ignore"):
        steps = np.rint(GRID * np.log2(p / unit))
    return np.where(p > 0, steps, ABSENT).astype(np.int64)


def learn_weights(rows) -> dict[int, tuple[float, float, float]]:
    """Mixture weights of each bucket by expectation-maximisation on held-out counts.

    ``rows``: (bucket, step of the pair's estimate, step of the word's, count);
    steps are in 1/GRID octaves over the uniform estimate.
    """
    weights = {}
    for bucket in sorted({r[0] for r in rows}):
        own = np.array([r[1:] for r in rows if r[0] == bucket], np.float64)
        ratio = np.where(own[:, :2] == ABSENT, 0.0, np.exp2(own[:, :2] / GRID))
        ratio = np.column_stack((ratio, np.ones(len(own))))
        w = np.array(DEFAULT)
        for _ in range(ROUNDS):
            share = ratio * w
            share /= share.sum(axis=1, keepdims=True)
            w = own[:, 2] @ share
            w /= w.sum()
        w = np.maximum(w, 1e-6)  # nothing is impossible
        weights[bucket] = tuple((w / w.sum()).tolist())
    return weights


def score_texts(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    *,
    chunk_tokens: int = CHUNK_TOKENS,
    slice_entries: int = SLICE_ENTRIES,
    fan: int = FAN,
) -> DataFrame:
    """Score every whole text by an interpolated bigram model learned from nine in ten.

    A-Z are lower-cased, words split at ASCII blanks, and one end closes every
    text. Texts whose crc32 of the id as text is 0 modulo 10 are held out; the
    others are learned from. A token's probability mixes three estimates: of
    the pair with the word before, of the word, and uniform over known words
    and one more. The weights depend on the octave of the context's count; they
    are learned on fold 1, whose counts are left out for that ("deleted"), and
    then used with the counts of all learned texts.

    Returns one row per input row: the id column, ``held_out``, ``n_tokens``,
    ``n_known``, ``train_tokens``, ``base_score`` and ``score`` (log10). Other
    columns are not carried, so none can clash. A null or empty text is the
    end alone; a null id counts as the empty text. Repeated rows are scored
    row by row. With nothing learned, all estimates are uniform.

    Tokens are kept in chunks of ``chunk_tokens``; a chunk asks for each of its
    distinct words and pairs once, in at most ``fan`` rows. Where all tokens need
    more slices of ``slice_entries`` than that, the counts of groups of chunks are
    merged first, so that rows grow as the tokens do. Words
    and pairs are told apart by 64-bit hashes. The driver gets token totals and
    a histogram bounded by its grid.
    """
    chunks = written(chunked(df, id_column, text, chunk_tokens), "chunks")
    docs = chunks.select(F.explode(F.arrays_zip("lengths", "folds")).alias("d"))
    n_all, n_learned, n_used = docs.agg(
        *[
            F.coalesce(F.sum(F.when(c, F.col("d.lengths"))), F.lit(0))
            for c in (
                F.lit(True),
                F.col("d.folds") != HELD_OUT,
                ~F.col("d.folds").isin(HELD_OUT, DELETED),
            )
        ]
    ).first()
    cores = df.sparkSession.sparkContext.defaultParallelism
    levels = levels_of(n_all, slice_entries, cores, fan)
    replies, (v_learned, v_used) = count_corpus(chunks, levels)
    sizes = {"learned": (n_learned, v_learned), "used": (n_used, v_used)}
    gathered = replies.groupBy(F.col("unit").alias("chunk")).agg(
        F.collect_list(F.struct("kind", "slice", "learned", "used")).alias("replies")
    )
    known = chunks.join(gathered, "chunk")

    def held_out_counts(batches):
        for row in rows_of(batches):
            model = Model(row, sizes)
            for own, bucket, pair, word, unit in model.parts("used"):
                mine = model.chunk.fold[own] == DELETED
                keys = np.column_stack(
                    (bucket[mine], on_grid(pair[mine], unit), on_grid(word[mine], unit))
                )
                distinct, n = np.unique(keys, axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.astype(np.int64)) for c in (*distinct.T.reshape(3, -1), n)],
                    names=["bucket", "pair", "word", "n"],
                )

    histogram = (
        known.select(*CHUNK_INPUTS, "replies")
        .where(F.array_contains("folds", DELETED))
        .mapInArrow(held_out_counts, "bucket bigint, pair bigint, word bigint, n bigint")
        .groupBy("bucket", "pair", "word")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    learned = learn_weights(sorted(tuple(r) for r in histogram))
    by_bucket = np.array(
        [
            # a bucket without held-out tokens takes the weights of the next one below it
            learned[max((k for k in learned if k <= b), default=b)]
            if any(k <= b for k in learned)
            else DEFAULT
            for b in range(65)
        ]
    )
    n, v = sizes["learned"]

    def scores(batches):
        for row in rows_of(batches):
            model = Model(row, sizes)
            lengths = model.chunk.lengths
            doc = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
            sums = np.zeros((3, len(lengths)))
            for own, bucket, pair, word, unit in model.parts("learned"):
                w = by_bucket[bucket]
                p = w[:, 0] * pair + w[:, 1] * word + w[:, 2] * unit
                counts = model.learned[0][model.chunk.ids[own]]
                base = np.log10((counts + 0.1) / (n + 0.1 * (v + 1)))
                for total, values in zip(sums, (counts > 0, base, np.log10(p))):
                    total += np.bincount(doc[own], weights=values, minlength=len(lengths))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["rids"], pa.int64()),
                    pa.array(lengths),
                    pa.array(sums[0].astype(np.int64)),
                    pa.array(sums[1]),
                    pa.array(sums[2]),
                ],
                names=["rid", "n_tokens", "n_known", "base_score", "score"],
            )

    sums = known.select(*CHUNK_INPUTS, "rids", "replies").mapInArrow(
        scores, "rid bigint, n_tokens bigint, n_known bigint, base_score double, score double"
    )
    names = chunks.select(F.explode(F.arrays_zip("rids", "ids", "folds")).alias("d")).select(
        F.col("d.rids").alias("rid"), F.col("d.ids").alias("id"), F.col("d.folds").alias("fold")
    )
    # a text cut over chunks has a row in each; all of them carry its id and fold
    both = sums.select(
        "*",
        F.lit(None).cast(names.schema["id"].dataType).alias("id"),
        F.lit(None).cast("int").alias("fold"),
    ).unionByName(names, allowMissingColumns=True)
    return (
        both.groupBy("rid")
        .agg(
            F.max("id").alias("id"),
            F.max("fold").alias("fold"),
            *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")],
        )
        .select(
            F.col("id").alias(id_column),
            (F.col("fold") == HELD_OUT).alias("held_out"),
            "n_tokens",
            "n_known",
            F.lit(n).cast("bigint").alias("train_tokens"),
            "base_score",
            "score",
        )
    )
