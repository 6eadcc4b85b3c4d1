"""Sampled segmentations over the piece lattice, and their lossless decoding."""

from __future__ import annotations

import random
import re
import struct
import sys
import zlib
from array import array
from bisect import bisect
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from math import exp, log

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm.frames import annotate, without

SPACE = "▁"
TEMPERATURE = 1.0
BYTE_RANK = 100_000  # bytes are ranked behind every piece
TABLE_KINDS = 256
SHORT_LENGTH = 32
LARGEST_LOG = 690.0
BLOCK_CHARS = 300_000
# spaces, then letters and all that is not ASCII, or other ASCII characters; or a line end
CHUNK = re.compile(
    r" *(?:[A-Za-z\u0080-\U0010FFFF]+|[\x00-\x09\x0b-\x1f!-@\[-`{-\x7f]+)| +|\n"
)


def piece_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Lattice:
    """Forward filtering and backward sampling over the pieces of a vocabulary.

    A segmentation's weight is the product of its pieces' weights, a piece's
    being 1 / (rank + 1) to the power 1 / temperature, with the rank that the
    model's score gives. A character that no piece spells alone is spelt in
    bytes. A text is first cut into the chunks of ``CHUNK``, joined again where a
    piece lies across a cut. So no piece is left out, and each chunk is filtered
    and sampled by itself.

    Texts are taken in blocks of chunks, and both passes run over a whole block
    at once: forward over its distinct chunks, one character further at a time;
    backward over all its chunks, one piece at a time. Forward weights are
    relative to spelling each character alone, so they are 1 or more. A draw is
    a hash of the row's seed and the place in the text, so it does not depend
    on the blocks.
    """

    def __init__(self, path: str, temperature: float = TEMPERATURE):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        # every ending of a piece, with the log weight and ids of the piece it is, if any
        self.endings: dict[str, tuple[float, list[int]] | None] = {}
        self.bytes_of = [b""] * self.size
        self.byte_ids = [0] * 256
        pieces = []
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                plain = piece.replace(SPACE, " ")
                rank = min(-model.get_score(i), BYTE_RANK)
                self.bytes_of[i] = plain.encode()
                self.endings[plain] = (-log(rank + 1.0) / temperature, [i])
                pieces.append(plain)
                for at in range(1, len(plain)):
                    self.endings.setdefault(plain[at:], None)
        self.byte_weight = -log(BYTE_RANK + 1.0) / temperature
        self.plant(pieces)
        # pieces that a text's cuts could divide, such as a full stop and a quotation mark
        self.across = sorted((p for p in pieces if not CHUNK.fullmatch(p)), key=len, reverse=True)
        self.lying_across = re.compile(f"(?=({'|'.join(map(re.escape, self.across))}))")
        self.ascii_across = any(p.isascii() for p in self.across)

    def plant(self, pieces: list[str]) -> None:
        """Lay the pieces out as a trie in arrays; state 0 is its root, and no way on."""
        children: list[dict[str, int]] = [{}]
        found = []
        for piece in pieces:
            state = 0
            for char in piece:
                if char not in children[state]:
                    children[state][char] = len(children)
                    children.append({})
                state = children[state][char]
            found.append(state)
        uses = Counter(char for ways in children for char in ways)
        kinds = {char: n for n, (char, _) in enumerate(uses.most_common(), 1)}
        self.kind_of = np.zeros(sys.maxunicode + 1, np.int64)
        for char, kind in kinds.items():
            self.kind_of[ord(char)] = kind
        # states that lead on come first; their ways by the common characters are a table
        inner = [s for s, ways in enumerate(children) if ways or not s]
        leaves = [s for s, ways in enumerate(children) if s and not ways]
        new = {s: n for n, s in enumerate(inner + leaves)}
        self.n_inner = len(inner)
        self.ways = np.zeros((self.n_inner + 1, TABLE_KINDS), np.int32)
        rare = {}
        for state in inner:
            for char, child in children[state].items():
                if kinds[char] < TABLE_KINDS:
                    self.ways[new[state], kinds[char]] = new[child]
                else:
                    rare[new[state] * len(self.kind_of) + kinds[char]] = new[child]
        self.rare_keys = np.array(sorted(rare), np.int64)
        self.rare_ways = np.array([rare[k] for k in sorted(rare)], np.int64)
        # what a state's piece weighs relative to its characters alone; 0 if it is no piece
        self.piece = np.zeros(len(children), np.int64)
        self.ratio = np.zeros(len(children))
        steepest = 1e-9
        for piece, state in zip(pieces, found):
            gain = self.endings[piece][0] - sum([self.alone(char)[0] for char in piece])
            steepest = max(steepest, gain / len(piece))
            self.piece[new[state]] = self.endings[piece][1][0]
            self.ratio[new[state]] = 1.0 if len(piece) == 1 else exp(gain)
        self.longest = min(SHORT_LENGTH, int(LARGEST_LOG / steepest))

    def alone(self, char: str) -> tuple[float, list[int]]:
        """The log weight and ids of a character by itself, spelt in bytes if it is no piece."""
        edge = self.endings.get(char)
        if edge is None:
            ids = [self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]
            edge = (self.byte_weight * len(ids), ids)
        return edge

    def step(self, states: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """The states reached from ``states`` by characters of ``kinds``, 0 for none."""
        common = kinds < TABLE_KINDS
        to = self.ways[np.minimum(states, self.n_inner), np.where(common, kinds, 0)].astype(np.int64)
        rare = np.flatnonzero(~common)
        if len(rare) and len(self.rare_keys):
            keys = states[rare] * len(self.kind_of) + kinds[rare]
            at = np.minimum(np.searchsorted(self.rare_keys, keys), len(self.rare_keys) - 1)
            to[rare] = np.where(self.rare_keys[at] == keys, self.rare_ways[at], 0)
        return to

    def edges(self, chunk: str, end: int) -> list[tuple[int, float, list[int]]]:
        """(start, log weight, ids) of the pieces that may stand last in ``chunk[:end]``."""
        endings, found = self.endings, [(end - 1, *self.alone(chunk[end - 1]))]
        for start in range(end - 2, -1, -1):
            edge = endings.get(chunk[start:end], False)
            if edge:
                found.append((start, *edge))
            elif edge is False:
                break
        return found if chunk[end - 1] in endings else found[:1]

    def sample_long(self, chunk: str, draw) -> list[int]:
        """Ids of one segmentation of a long chunk, in logarithms, keeping a number a character."""
        forward = array("d", [0.0])
        for end in range(1, len(chunk) + 1):
            logs = [forward[start] + weight for start, weight, _ in self.edges(chunk, end)]
            top = max(logs)
            forward.append(top + log(sum([exp(x - top) for x in logs])))
        parts, end = array("I"), len(chunk)
        while end:
            edges = self.edges(chunk, end)
            sums = list(
                accumulate([exp(forward[start] + weight - forward[end]) for start, weight, _ in edges])
            )
            end, _, ids = edges[min(bisect(sums, draw() * sums[-1]), len(edges) - 1)]
            parts.extend(reversed(ids))
        parts.reverse()
        return parts

    def filter_forward(self, chunks: list[str], lengths: np.ndarray, spelt: list):
        """All edges of the chunks, by their ends, with running shares of the forward weights.

        A chunk of n characters has n + 1 nodes, chunk after chunk. Gives each
        node's first edge, and of the edges the share, the node before and the
        spelling: a piece, or ``size`` and more for an entry of ``spelt``.
        """
        codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = self.kind_of[codes]
        owner = np.repeat(np.arange(len(chunks)), lengths)
        first_char = np.cumsum(lengths) - lengths
        last = (first_char + lengths)[owner]  # the character behind the chunk
        start = np.arange(len(codes))
        states = self.step(np.zeros(len(codes), np.int64), kinds)
        # one character alone: its piece, or its bytes
        spelling = self.piece[states]
        no_piece = np.flatnonzero(self.ratio[states] == 0)
        if len(no_piece):
            chars, which = np.unique(codes[no_piece], return_inverse=True)
            spelling[no_piece] = self.size + len(spelt) + which
            spelt += [self.alone(chr(c))[1] for c in chars.tolist()]
        starts, ends, ratios, spellings = [start], [start + 1], [np.ones(len(start))], [spelling]
        end = start + 1
        while True:
            go = np.flatnonzero((states > 0) & (states < self.n_inner) & (end < last[start]))
            start, end, states = start[go], end[go], states[go]
            if not len(go):
                break
            states = self.step(states, kinds[end])
            end = end + 1
            found = np.flatnonzero(self.ratio[states])
            starts.append(start[found])
            ends.append(end[found])
            ratios.append(self.ratio[states[found]])
            spellings.append(self.piece[states[found]])
        # long pieces first, as they are the likely ones
        start, end, ratio, spelling = (
            np.concatenate(parts[::-1]) for parts in (starts, ends, ratios, spellings)
        )
        of = owner[start]
        before, behind, inside = start + of, end + of, start - first_char[of]
        forward = np.zeros(len(codes) + len(chunks))
        forward[first_char + np.arange(len(chunks))] = 1.0
        order = np.argsort(inside.astype(np.int16), kind="stable")
        bounds = np.searchsorted(inside[order], np.arange(self.longest + 1))
        for low, high in zip(bounds, bounds[1:]):
            # edges that begin equally far inside their chunks all end at different nodes
            edge = order[low:high]
            forward[behind[edge]] += forward[before[edge]] * ratio[edge]
        order = np.argsort(behind, kind="stable")
        before, behind = before[order], behind[order]
        sums = np.cumsum(forward[before] * ratio[order] / forward[behind])
        first_edge = np.concatenate(([0], np.cumsum(np.bincount(behind, minlength=len(forward)))))
        sums -= np.concatenate(([0.0], sums))[first_edge[behind]]
        sums[first_edge[1:][behind] - 1] = 2.0  # the last edge takes what rounding leaves
        return first_edge, sums, before, spelling[order]

    def sample_block(self, chunks: list[str], begins: np.ndarray, seeds: np.ndarray):
        """Sampled ids of all chunks, and how many ids each has."""
        number = {c: n for n, c in enumerate(dict.fromkeys(chunks))}
        which = np.fromiter(map(number.__getitem__, chunks), np.int64, len(chunks))
        distinct = [c if len(c) <= self.longest else "" for c in number]
        lengths = np.fromiter(map(len, distinct), np.int64, len(distinct))
        spelt: list = []
        first_edge, share, before, spelling = self.filter_forward(distinct, lengths, spelt)
        first_node = np.cumsum(lengths + 1) - lengths - 1
        root = first_node[which]
        node = root + lengths[which]
        counts = np.zeros(len(chunks), np.int64)
        steps = []
        long = np.flatnonzero(lengths[which] == 0)
        for i in long.tolist():
            draw = random.Random(int(seeds[i]) ^ int(begins[i])).random
            spelt.append(self.sample_long(chunks[i], draw))
        whole = self.size + len(spelt) - len(long) + np.arange(len(long))
        counts[long] = 1
        chunk = np.flatnonzero(node > root)
        node, root = node[chunk], root[chunk]
        while len(chunk):
            u = uniform(seeds[chunk], begins[chunk] + node - root)
            edge = first_edge[node]
            beyond = np.flatnonzero(u >= share[edge])
            while len(beyond):
                edge[beyond] += 1
                beyond = beyond[u[beyond] >= share[edge[beyond]]]
            counts[chunk] += 1
            steps.append((chunk, spelling[edge]))
            node = before[edge]
            left = np.flatnonzero(node > root)
            chunk, node, root = chunk[left], node[left], root[left]
        ends = np.cumsum(counts)
        drawn = np.empty(int(ends[-1]), np.int64)
        for back, (chunk, pieces) in enumerate(steps, 1):
            drawn[ends[chunk] - back] = pieces
        drawn[ends[long] - 1] = whole
        return self.spell(drawn, spelt), ends

    def spell(self, drawn: np.ndarray, spelt: list) -> tuple[np.ndarray, np.ndarray]:
        """The ids of successive spellings, and where those of each end."""
        width = np.ones(len(drawn), np.int64)
        other = np.flatnonzero(drawn >= self.size)
        if not len(other):
            return drawn.astype("<u4"), np.cumsum(width)
        width[other] = [len(spelt[i]) for i in (drawn[other] - self.size).tolist()]
        ends = np.cumsum(width)
        ids = np.repeat(drawn, width).astype("<u4")
        for end, i in zip(ends[other].tolist(), (drawn[other] - self.size).tolist()):
            ids[end - len(spelt[i]) : end] = spelt[i]
        return ids, ends

    def encode_all(self, texts: list[str], keys: list[str]) -> list[bytes]:
        """Sampled ids of each text, as little-endian 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        block, held = [], 0

        def flush() -> None:
            if not block:
                return
            chunks = [c for _, _, _, part in block for c in part]
            sizes = [len(part) for _, _, _, part in block]
            lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
            ends = np.cumsum(lengths)
            bounds = np.cumsum([0, *sizes])
            # places count from the start of each text
            shift = [at - int(ends[low] - lengths[low]) for (_, _, at, _), low in zip(block, bounds)]
            begins = ends - lengths + np.repeat(np.array(shift, np.int64), sizes)
            seeds = np.repeat(np.array([s for _, s, _, _ in block], np.uint64), sizes)
            (ids, id_ends), piece_ends = self.sample_block(chunks, begins, seeds)
            stops = id_ends[piece_ends[bounds[1:] - 1] - 1]
            for (row, _, _, _), low, high in zip(block, [0, *stops[:-1]], stops):
                out[row].append(ids[low:high].tobytes())
            block.clear()

        for row, (text, key) in enumerate(zip(texts, keys)):
            if not text:
                continue
            seed = xxhash.xxh64_intdigest(key.encode())
            for begin, part in self.parts_of(" " + text):
                block.append((row, seed, begin, part))
                held += sum(map(len, part))
                if held >= BLOCK_CHARS:
                    flush()
                    held = 0
        flush()
        return [b"".join(parts) for parts in out]

    def parts_of(self, text: str) -> Iterator[tuple[int, list[str]]]:
        """The chunks of a text, some at a time, each time with the place of the first."""
        begin, size = 0, BLOCK_CHARS
        while begin < len(text):
            chunks = self.chunks_of(text, begin, begin + size)
            if begin + size < len(text):
                chunks.pop()  # it may go on
                if not chunks:
                    size *= 2
                    continue
            yield begin, chunks
            begin, size = begin + sum(map(len, chunks)), BLOCK_CHARS

    def chunks_of(self, text: str, begin: int, end: int) -> list[str]:
        """The chunks of ``text[begin:end]``; no piece lies across ``begin``."""
        chunks = CHUNK.findall(text, begin, end)
        if not self.across or (text.isascii() and not self.ascii_across):
            return chunks
        inside = set()
        # the longest piece at each place; it may end behind ``end``
        for found in self.lying_across.finditer(text, begin, end + len(self.across[0])):
            inside.update(range(found.start(1) + 1, found.end(1)))
        if not inside:
            return chunks
        ends = list(accumulate(map(len, chunks), initial=begin))
        cuts = [at for at in ends[:-1] if at not in inside] + ends[-1:]
        return [text[low:high] for low, high in zip(cuts, cuts[1:])]

    def decode(self, ids: bytes) -> str:
        """The text that ``ids`` spell, without the space put before every text."""
        numbers = np.frombuffer(ids, "<u4").tolist()
        raw = b"".join(map(self.bytes_of.__getitem__, numbers))
        return raw[1:].decode("utf-8", "surrogatepass")


def uniform(seeds: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Uniform draws in [0, 1), one for each seed and place: the finalizer of SplitMix64."""
    z = seeds + places.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) * 2.0**-53


def sample_pieces(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    *,
    path: str | None = None,
    temperature: float = TEMPERATURE,
    seed: int = 0,
    digest_only: bool = False,
    keep: list[str] | None = None,
) -> DataFrame:
    """Add a sampled segmentation of every whole text, and whether it decodes to it.

    Adds ``ids`` (unless ``digest_only``), ``n_pieces``, ``ids_crc32`` (of the
    ids as little-endian unsigned 32-bit integers) and ``lossless``. The draws
    of a row follow from ``seed`` and its key alone: equal rows get equal
    samples, on any cluster; rows that share a key and differ in text draw
    from the same stream.

    A null or empty text has no pieces and is lossless; a null key is a key of
    its own. Ties, repeated rows and empty tables need no special case.
    ``keep`` names the columns to carry (all if None); columns named like a
    result are replaced by it.
    """
    path = path or piece_path()
    fields = {"n_pieces": "bigint", "ids_crc32": "bigint", "lossless": "boolean"}
    if not digest_only:
        fields = {"ids": "array<int>"} | fields
    kept = without(df, list(fields)).columns if keep is None else keep
    sent = df.select(
        *[F.col(f"`{c}`") for c in kept],
        F.col(f"`{key}`").cast("string").alias("__key"),
        F.col(f"`{text}`").alias("__text"),
    )

    def make():
        lattice = Lattice(path, temperature)

        def rows(row_keys, values):
            values = [v or "" for v in values]
            results = []
            for value, ids in zip(values, lattice.encode_all(values, [f"{seed}:{k}" for k in row_keys])):
                count = len(ids) // 4
                result = count, zlib.crc32(ids), lattice.decode(ids) == value
                results.append(result if digest_only else (struct.unpack(f"<{count}i", ids), *result))
            return results

        return rows

    return annotate(sent, make, fields, ["__key", "__text"], kept, batched=True)


def decode_pieces(
    df: DataFrame, ids: str = "ids", *, path: str | None = None, keep: list[str] | None = None
) -> DataFrame:
    """Add ``decoded``, the text that the ids spell; null ids give null."""
    path = path or piece_path()

    def make():
        lattice = Lattice(path)

        def row(value):
            if value is None:
                return (None,)
            return (lattice.decode(struct.pack(f"<{len(value)}i", *value)),)

        return row

    return annotate(df, make, {"decoded": "string"}, [ids], keep)
