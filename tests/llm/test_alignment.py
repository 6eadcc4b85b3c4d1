"""Cross-tokenizer alignment against a plain one."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from conftest import SF_DIR

from recordlake.llm import alignment
from recordlake.llm.frames import written
from recordlake.llm.queries import QUERIES


@pytest.fixture(scope="module")
def plain():
    """Ids and token bytes of both sides, each by its own library."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(alignment.byte_bpe_path())
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.piece_bpe_path())
    letters = {c: i for i, c in enumerate(alignment.byte_letters())}

    def sides(text):
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [
            bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("\u2581", " ").encode()
            for i in ids_b
        ]
        return (ids_a, bytes_a), (ids_b, bytes_b)

    return sides


def brute(texts, sides):
    """doc_id to its row, by offsets compared one by one."""
    found, links = {}, {}
    for i, text in texts:
        found[i], links[i] = (0, 0, 0, 0, ""), []
        if not text:
            continue
        (ids_a, bytes_a), (ids_b, bytes_b) = sides(text)
        raw = (" " + text).encode()
        if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
        links[i] = [(ids_a[x], ids_b[y]) for x in range(len(ids_a)) for y in np.flatnonzero(ends_b == ends_a[x])]
        groups, x, y = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            u, v = (int((e <= end).sum()) for e in (ends_a, ends_b))
            groups.append(",".join(map(str, ids_a[x:u])) + "|" + ",".join(map(str, ids_b[y:v])))
            x, y = u, v
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        found[i] = (len(ids_a), len(ids_b), len(groups), len(links[i]), digest)
    counts = Counter(p for held in links.values() for p in held)
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return {
        i: (*row[:4], sum(counts[p] == best[p[1]] for p in links[i]), sum(counts[p] for p in links[i]), row[4])
        for i, row in found.items()
    }


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_query_equals_brute_force(base_spark, plain):
    docs = base_spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    want = brute([(r.doc_id, r.text) for r in docs], plain)
    rows = QUERIES["op13_token_alignment"](base_spark, SF_DIR).collect()
    assert {r.doc_id: tuple(r[c] for c in NAMES) for r in rows} == want


def test_odd_texts(base_spark, plain, tmp_path):
    rng = random.Random(3)
    parts = ["<|endoftext|>", "<s>", "</s>", "<0x41>", " ", "  ", "\n", "\t", "\u2581", "é", "😀", "\u00a0", "\u3000", "ﬁ",
             "don't", "x" * 50, "1234", "中文字", "\u0301", "the ", "\x00", "\r\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(400)]
    texts += [None, "", " ", "word " * 30_000, "x" * 60_000, "x", "x"]
    rows = [(i, t, 7, "mine") for i, t in enumerate(texts)]
    df = base_spark.createDataFrame(rows, "doc_id bigint, text string, N_A int, groups string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    want = brute(list(enumerate(texts)), plain)
    got = QUERIES["op13_token_alignment"](base_spark, str(tmp_path)).collect()
    assert {r.doc_id: tuple(r[c] for c in NAMES) for r in got} == want
    assert sum(not any(row[:4]) for row in want.values()) > 3  # some do not spell the text
    whole = alignment.align(df)
    assert [c for c in whole.columns if c.lower() == "n_a"] == ["n_a"]
    none = written(alignment.align(df.where("false")), "none")
    assert alignment.count_links(none).count() == 0


def test_repeated_and_null_ids(base_spark):
    df = base_spark.createDataFrame([(1, "one two"), (1, "one two"), (None, "one two")], "doc_id bigint, text string")
    rows = alignment.count_links(written(alignment.align(df), "same")).collect()
    assert len(rows) == 3 and len({tuple(r)[2:] for r in rows}) == 1
    assert rows[0].count_sum == 3 * rows[0].n_links == 3 * rows[0].n_best


def test_tokens_of_no_bytes_link_with_all_that_end_there():
    ends_a, ends_b = [2, 2, 5], [0, 2, 5, 5]
    last_a, last_b, several = alignment.cut(ends_a, ends_b)
    assert several and (last_a.tolist(), last_b.tolist()) == ([1, 2], [1, 3])
    x, y = alignment.linked(ends_a, ends_b, last_a, last_b)
    assert list(zip(x.tolist(), y.tolist())) == [(0, 1), (1, 1), (2, 2), (2, 3)]


def test_groups_are_spelt_from_eight_bytes_an_id():
    names = alignment.Names(60_000)
    assert names.words.nbytes == 8 * 60_000
    rng = random.Random(8)
    for _ in range(50):
        sizes = [(rng.randint(1, 4), rng.randint(1, 4)) for _ in range(rng.randint(1, 9))]
        slices = [tuple([rng.choice([0, 7, 10, 59_999, rng.randrange(60_000)]) for _ in range(k)] for k in own) for own in sizes]
        a, b = (np.array(sum((own[side] for own in slices), []), np.int64) for side in (0, 1))
        last_a, last_b = (np.cumsum([own[side] for own in sizes]) - 1 for side in (0, 1))
        want = ";".join("|".join(",".join(map(str, ids)) for ids in own) for own in slices)
        assert names.groups(a, b, last_a, last_b) == want
    with pytest.raises(ValueError):
        alignment.Names(10**7 + 1)


def test_every_link_is_a_possible_pair():
    pairs = alignment.possible_pairs([b"", b"ab", b"b", b"c"], [b"b", b"ab", b"cab"])
    assert sorted(divmod(int(p), 3) for p in pairs if p // 3) == [(1, 0), (1, 1), (1, 2), (2, 0), (2, 1), (2, 2)]
