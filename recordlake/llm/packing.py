"""Pack token sequences by best fit, planned on counts of lengths."""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordlake.llm.frames import pieces_of, written

LIMIT = 4096
END_ID = 1
CACHED_WORDS = 3 << 17

PIECE = (
    "piece int, start bigint, length bigint, ids_crc32 bigint, task bigint, local_rank bigint"
)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# words of these characters alone are normalized alike by Python and the tokenizer
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN = re.compile(rf"[{LETTERS}!-@\[-`{{-~]*")
# fixed value: the tokenizer's own rule for cutting words, for plain words
PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\s{LETTERS}0-9]+")


def byte_letters() -> list[str]:
    """The character that byte-level BPE writes for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class WordEncoder(dict):
    """Ids of a text, as little-endian unsigned 32-bit integers.

    This tokenizer cuts at white space and never looks across it, so a text's
    ids are those of its blank-separated words in turn. Words are encoded when
    first met and remembered: plain ones part by part by the tokenizer's BPE
    model, all others by the whole tokenizer. The memory is emptied when it
    holds ``cached`` entries.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.bpe = self.tokenizer.model.tokenize
        self.letters = byte_letters()
        self.packed = [struct.pack("<I", i) for i in range(self.tokenizer.get_vocab_size())]
        self.parts: dict[str, bytes] = {}
        self.cached = cached

    def part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            spelt = part
            if not part.isascii() or not part.isprintable():
                spelt = "".join([self.letters[b] for b in part.encode()])
            packed = self.packed
            found = b"".join([packed[t.id] for t in self.bpe(spelt)])
            self.parts[part] = found
        return found

    def __missing__(self, raw: bytes) -> bytes:
        word = raw.decode()
        if raw.isalpha():  # A-Z and a-z alone, as raw is bytes
            found = self.part(word.lower())
        elif raw[:-1].isalpha() and raw[-1:] in b".,":
            found = self.part(word[:-1].lower()) + self.part(word[-1])
        elif PLAIN.fullmatch(word) and "<|" not in word:
            found = b"".join(map(self.part, PARTS.findall(word.lower())))
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            found = b"".join([self.packed[i] for i in ids])
        self[raw] = found
        return found

    def encode(self, text: str) -> bytes:
        # bytes.split() cuts at ASCII blanks, all of them white space to the tokenizer
        ids = b"".join(map(self.__getitem__, text.encode().split()))
        if len(self) + len(self.parts) > self.cached:
            self.clear()
            self.parts.clear()
        return ids


def shared_encoder(path: str) -> WordEncoder:
    """The encoder of this worker process: its memory serves one task after another.

    Task functions travel with a copy of their own module, so the encoder is
    kept with the tokenizer library's module, which a process has once.
    """
    import tokenizers

    kept = vars(tokenizers).setdefault("_recordlake_encoders", {})
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]


def tokenized(
    df: DataFrame,
    id_column: str,
    text: str,
    path: str,
    limit: int,
    make_encoder: Callable = shared_encoder,
) -> DataFrame:
    """Pieces of every document, with their rank among those of their length in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = make_encoder(path)
        ranks = [0] * (limit + 1)
        end = struct.pack("<I", END_ID)
        for batch in pieces_of(batches):
            rows, pieces, starts, lengths, sums, places = [], [], [], [], [], []
            for row, value in enumerate(batch.column(2).to_pylist()):
                ids = encoder.encode(value or "") + end
                for number, at in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[at : at + 4 * limit]
                    length = len(part) // 4
                    rows.append(row)
                    pieces.append(number)
                    starts.append(at // 4)
                    lengths.append(length)
                    sums.append(zlib.crc32(part))
                    places.append(ranks[length])
                    ranks[length] += 1
            index = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(index),
                    pa.array(pieces, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (starts, lengths, sums)),
                    batch.column(1).take(index),
                    pa.array(places, pa.int64()),
                ],
                names=["id", "piece", "start", "length", "ids_crc32", "task", "local_rank"],
            )

    sent = df.select(
        F.col(f"`{id_column}`").alias("id"),
        F.spark_partition_id().cast("bigint").alias("task"),
        F.col(f"`{text}`").alias("text"),
    )
    kind = sent.schema["id"].dataType.simpleString()
    return sent.mapInArrow(run, f"id {kind}, {PIECE}")


def plan_best_fit(counts: dict[int, int], limit: int = LIMIT) -> list[tuple[int, ...]]:
    """Best fit, longest first, over counts of equal lengths.

    Returns runs (length, first rank, pieces, first sequence, pieces to a
    sequence, offset of the first): the pieces of that length with ranks from
    the first on fill consecutive sequences. Sequences with equal room left
    are kept as one group, and best fit fills the group with least room first,
    so the work and the plan follow the number of lengths and groups, not of
    documents: a length cuts at most one group in three, and each visit to a
    group at least halves its room, so a limit of 4096 allows no more than
    about 150,000 runs, whatever the corpus holds.
    """
    runs = []
    open_groups: list[tuple[int, int, int]] = []  # room left, first sequence, sequences; sorted
    sequences = 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0

        def place(room: int, first: int, many: int) -> list[tuple[int, int, int]]:
            """Fill sequences of one group; the groups that are left of it."""
            nonlocal left, rank
            each = room // length
            full = min(many, left // each)
            rest = []
            if full:
                runs.append((length, rank, full * each, first, each, limit - room))
                left, rank = left - full * each, rank + full * each
                rest.append((room - each * length, first, full))
            if full < many and left:
                runs.append((length, rank, left, first + full, left, limit - room))
                rest.append((room - left * length, first + full, 1))
                rank, left, full = rank + left, 0, full + 1
            if full < many:
                rest.append((room, first + full, many - full))
            return rest

        at = bisect_left(open_groups, (length,))
        changed = []
        while left and at < len(open_groups):
            changed += place(*open_groups.pop(at))
        if left:
            each = limit // length
            many = -(-left // each)
            changed += place(limit, sequences, many)
            sequences += many
        open_groups = sorted(open_groups + [g for g in changed if g[0]])
    return runs


def pack(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    *,
    path: str | None = None,
    limit: int = LIMIT,
) -> DataFrame:
    """Place every document, tokenized and ended by id 1, in sequences of ``limit`` tokens.

    Only documents of more than ``limit`` tokens are cut, into pieces of
    ``limit``; the last may be shorter. Returns one row per piece: the id
    column, ``piece``, ``start`` and ``length`` in the document's ids,
    ``ids_crc32``, ``sequence_id`` and ``offset``; other columns are not
    carried, so none can clash.

    Best fit is planned on the counts of the at most ``limit`` lengths. The
    pieces of one length are numbered without bringing them together: each
    tokenizing task numbers its own, and what the tasks before it hold is
    added from one row per task and length. The plan has a proven bound and is
    broadcast; a piece takes the run its rank falls in.

    A null or empty text is the end id alone. Null or repeated ids are packed
    row by row like any other; an empty table gives no rows.
    """
    pieces = written(
        tokenized(df, id_column, text, path or tokenizer_path(), limit), "pieces"
    )
    held = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    held = written(held, "lengths")
    # lengths only: at most `limit` rows, however large the corpus
    totals = held.groupBy("length").agg(F.sum("n").alias("n")).collect()
    runs = plan_best_fit({r["length"]: r["n"] for r in totals}, limit)
    plan = df.sparkSession.createDataFrame(
        runs or [(0,) * 6],
        "length bigint, first_rank bigint, n bigint, first_sequence bigint, each bigint, at bigint",
    )
    before = held.withColumn(
        "before",
        F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n"),
    ).drop("n")
    ranked = pieces.join(before, ["length", "task"]).withColumn(
        "rank", F.col("before") + F.col("local_rank")
    )
    step = F.col("rank") - F.col("first_rank")
    return (
        ranked.join(
            F.broadcast(plan.withColumnRenamed("length", "run_length")),
            (F.col("length") == F.col("run_length"))
            & (F.col("rank") >= F.col("first_rank"))
            & (step < F.col("n")),
        )
        .select(
            F.col("id").alias(id_column),
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("first_sequence") + F.floor(step / F.col("each"))).alias("sequence_id"),
            (F.col("at") + F.pmod(step, "each") * F.col("length")).alias("offset"),
        )
    )
