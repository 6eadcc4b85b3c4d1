"""Align two tokenizers' ids by the byte offsets where tokens of both end."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm.frames import annotate, pieces_of
from recordlake.llm.lm_score import pack_array, unpack_array
from recordlake.llm.packing import byte_letters

FIELDS = {
    "n_a": "bigint",
    "n_b": "bigint",
    "n_groups": "bigint",
    "n_links": "bigint",
    "groups": "string",
    "packed_links": "binary",
}
NOTHING = (0, 0, 0, 0, "", None)


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class ByteSide:
    """Byte-level BPE: ids of space and text, and the bytes of each id.

    The vocabulary numbers tokens in the order of their merges, so a token's id
    is its rank, and special tokens are left out: their strings are plain text.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        special = {t["id"] for t in described["added_tokens"] if t["special"]}
        byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        vocabulary = described["model"]["vocab"]
        self.tokens = [b""] * (max(vocabulary.values()) + 1)
        for spelt, number in vocabulary.items():
            if number not in special:
                self.tokens[number] = bytes([byte_of[c] for c in spelt])
        ranks = {token: number for number, token in enumerate(self.tokens) if token}
        self.encode = tiktoken.Encoding(
            "byte-bpe",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=ranks,
            special_tokens={},
        ).encode_ordinary


class PieceSide:
    """SentencePiece BPE with byte fallback: ids of a text, and the bytes of each id."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.tokens = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.tokens.append(bytes([int(piece[3:-1], 16)]))
            else:
                self.tokens.append(piece.replace("▁", " ").encode())
        self.encode = model.encode


def possible_pairs(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Sorted codes, id of A times ids of B plus id of B, of all pairs that can be linked.

    Tokens whose byte ranges end together agree on their last bytes, so the
    shorter is a suffix of the longer. There are at most as many pairs as the
    two vocabularies have bytes (times the tokens spelt alike): the bound of
    everything that is counted over the corpus.
    """

    def by_bytes(tokens):
        found: dict[bytes, list[int]] = {}
        for number, token in enumerate(tokens):
            found.setdefault(token, []).append(number)
        return found

    codes = set()
    for tokens, others, code in (
        (a, by_bytes(b), lambda i, j: i * len(b) + j),
        (b, by_bytes(a), lambda i, j: j * len(b) + i),
    ):
        for i, token in enumerate(tokens):
            for at in range(len(token) + 1):
                codes.update(code(i, j) for j in others.get(token[at:], ()))
    return np.array(sorted(codes), np.int64)


def cut(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """For every offset where both sides have an end, the last index there on each side.

    And whether some tokens have no bytes, so that several end at one offset.
    """
    ends_a, ends_b = np.asarray(ends_a), np.asarray(ends_b)
    last_a, last_b = (np.flatnonzero(np.diff(ends, append=-1)) for ends in (ends_a, ends_b))
    several = len(last_a) < len(ends_a) or len(last_b) < len(ends_b)
    at_a, at_b = ends_a[last_a], ends_b[last_b]
    is_end = np.zeros(max(at_a[-1], at_b[-1]) + 1, np.int8)
    is_end[at_a] = 1
    is_end[at_b] += 1
    return last_a[is_end[at_a] == 2], last_b[is_end[at_b] == 2], several


class Names:
    """Ids as text with the mark that follows: eight bytes each, digits to the right, then the mark.

    Bytes that are zero stand for nothing.
    """

    def __init__(self, size: int):
        if size > 10**7:
            raise ValueError(f"{size} ids; those of more than seven digits do not fit")
        spelt = b"".join(f"{i},".rjust(8, "\0").encode() for i in range(size))
        self.words = np.frombuffer(spelt, "<u8")

    def groups(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> str:
        """The slices up to ``last_a`` and ``last_b`` as `a1,a2|b1;a3|b2,b3`."""
        parts = np.empty(len(a) + len(b), "<u8")
        for ids, last, mark, others in ((a, last_a, "|", np.append(0, last_b[:-1] + 1)), (b, last_b, ";", last_a + 1)):
            names = self.words[ids]
            names[last] += np.uint64((ord(mark) - ord(",")) << 56)
            # a slice of A stands after all earlier slices of B, one of B also after its own of A
            sizes = np.diff(last, prepend=-1)
            parts[np.arange(len(ids)) + np.repeat(others, sizes)] = names
        spelt = parts.view(np.uint8)
        return spelt[spelt != 0].tobytes()[:-1].decode("ascii")


def linked(
    ends_a: np.ndarray, ends_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all token pairs that end together, slice by slice.

    A slice links its last tokens, and with them any tokens of no bytes before
    them that end at the same offset.
    """
    pairs = []
    for i, j in zip(last_a.tolist(), last_b.tolist()):
        pairs += [(x, y) for x in _back(ends_a, i) for y in _back(ends_b, j)]
    return tuple(np.array(pairs, np.int64).reshape(-1, 2).T)


def _back(ends: np.ndarray, last: int) -> list[int]:
    first = last
    while first and ends[first - 1] == ends[last]:
        first -= 1
    return list(range(first, last + 1))


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteSide(path_a), PieceSide(path_b)
        self.codes = possible_pairs(self.a.tokens, self.b.tokens)
        self.sizes = [np.array(list(map(len, s.tokens)), np.int64) for s in (self.a, self.b)]
        self.names = Names(max(len(self.a.tokens), len(self.b.tokens)))

    def __call__(self, text: str | None) -> tuple:
        if not text:
            return NOTHING
        spaced = " " + text
        ids_a, ids_b = self.a.encode(spaced), self.b.encode(text)
        raw = spaced.encode()
        row_a, row_b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        ends_a = np.cumsum(self.sizes[0][row_a])
        # A's tokens spell what they are given, every byte being one; its length tells of a cut
        if ends_a[-1] != len(raw) or b"".join(map(self.b.tokens.__getitem__, ids_b)) != raw:
            return NOTHING
        ends_b = np.cumsum(self.sizes[1][row_b])
        last_a, last_b, several = cut(ends_a, ends_b)
        groups = self.names.groups(row_a, row_b, last_a, last_b)
        x, y = linked(ends_a, ends_b, last_a, last_b) if several else (last_a, last_b)
        numbers = np.searchsorted(self.codes, row_a[x] * len(self.b.tokens) + row_b[y])
        packed = pack_array(numbers.astype(np.uint32))
        return len(ids_a), len(ids_b), len(last_a), len(x), groups, packed


def align(
    df: DataFrame,
    text: str = "text",
    *,
    path_a: str | None = None,
    path_b: str | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Tokenize every whole text twice and cut both id lists where both have a token end.

    A encodes a space and the text, B the text, to which it adds the space.
    Adds ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links`` (pairs of tokens
    that end together), ``groups`` (`a1,a2|b1;a3|b2,b3`: ids of A, then of B)
    and ``packed_links``: which of ``possible_pairs`` each link is, compressed.

    A null or empty text, and one whose tokens on either side do not spell
    space and text byte for byte (as where B normalises), has no tokens: zeros,
    no groups, null links. Rows are aligned one by one, so ties, repeated rows
    and empty tables need no special case. ``keep`` names the columns to carry
    (all if None); columns named like a result are replaced by it.
    """
    paths = path_a or byte_bpe_path(), path_b or piece_bpe_path()
    return annotate(df, lambda: Aligner(*paths), FIELDS, [text], keep)


def count_links(
    aligned: DataFrame, *, path_a: str | None = None, path_b: str | None = None
) -> DataFrame:
    """Add to a stored result of ``align`` what the corpus says of its links.

    ``n_best`` counts links whose pair is linked most often of all pairs with
    the same id of B, ties included; ``count_sum`` adds, over links, how often
    the pair is linked in the corpus. ``packed_links`` is dropped.

    Each task adds its links into one array over ``possible_pairs`` and sends
    what it met; the sums have that same bound, so they are broadcast. Rows
    without links have zeros; an empty table gives no rows.
    """
    spark = aligned.sparkSession
    a, b = ByteSide(path_a or byte_bpe_path()), PieceSide(path_b or piece_bpe_path())
    codes = possible_pairs(a.tokens, b.tokens)
    size = len(codes)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in pieces_of(batches):
            links = [unpack_array(raw, np.uint32) for raw in batch.column(0).drop_null().to_pylist()]
            if links:
                numbers, times = np.unique(np.concatenate(links), return_counts=True)
                counts[numbers] += times
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], names=["pair", "n"])

    sums = (
        aligned.select("packed_links")
        .mapInArrow(tally, "pair bigint, n bigint")
        .groupBy("pair")
        .agg(F.sum("n").alias("n"))
    )
    counts = np.zeros(size, np.int64)
    for row in sums.collect():  # one row a possible pair at most
        counts[row["pair"]] = row["n"]
    of_b = codes % len(b.tokens)
    highest = np.zeros(len(b.tokens), np.int64)
    np.maximum.at(highest, of_b, counts)
    known = spark.sparkContext.broadcast((counts, counts == highest[of_b]))

    def make() -> Callable[..., tuple]:
        counts, best = known.value

        def row(raw):
            if raw is None:
                return 0, 0
            links = unpack_array(raw, np.uint32)
            return int(best[links].sum()), int(counts[links].sum())

        return row

    kept = [c for c in aligned.columns if c != "packed_links"]
    return annotate(aligned, make, {"n_best": "bigint", "count_sum": "bigint"}, ["packed_links"], kept)
