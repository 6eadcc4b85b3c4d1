"""Decontamination against every window looked up in every text."""

import hashlib
import random
import re

import numpy as np
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from recordlake.llm import decontamination as dc
from recordlake.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NAMES = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near_items")


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def brute(docs, items, length=10, slack=2):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - length + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + length]), set()).add(item)
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found, near = set(), set(), set()
        where = {}
        for i, x in enumerate(w):
            where.setdefault(x, []).append(i)
        for window, own in windows.items():
            for p in where.get(window[0], ()):
                if tuple(w[p : p + len(window)]) == window:
                    hit.update(range(p, p + len(window)))
                    found |= own
            for p in range(-slack, len(w) + slack) if all(x in where for x in window) else ():
                if all(any(abs(q - p - k) <= slack for q in where[x]) for k, x in enumerate(window)):
                    near |= own
        names = sorted(str(i) for i in found if i is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        more = {str(i) for i in near if i is not None} - set(names)
        out.append((doc, len(w), len(hit), len(names), digest, bool(hit), len(more)))
    return sorted(out, key=str)


def digests(df):
    rows = df.select(
        "doc_id", "n_words", "n_hit", F.size("items"), F.sha2(F.array_join("items", ","), 256),
        F.col("n_hit") > 0, F.size("near_items"),
    )
    return sorted((tuple(r) for r in rows.collect()), key=str)


def test_query_equals_brute_force(base_spark):
    docs, items = (
        [tuple(r) for r in base_spark.read.parquet(f"{SF_DIR}/{t}.parquet").select(i, "text").collect()]
        for t, i in (("documents", "doc_id"), ("benchmark", "item_id"))
    )
    rows = QUERIES["op12_decontamination"](base_spark, SF_DIR).collect()
    want = {r[0]: r for r in brute(docs, items)}
    got = {r.doc_id: tuple(r[c] for c in NAMES) for r in rows}
    assert {i: r[:6] for i, r in got.items()} == {i: r[:6] for i, r in want.items()}
    assert sum(r[5] for r in got.values()) > 0


def tables(spark, rng, few):
    letters = [f"w{i}" for i in range(few)] + ["É", "ß1"]
    say = lambda n: " ".join(rng.choice(letters) for _ in range(n))
    items = [(i, say(rng.choice((0, 1, 3, 4, 5, 9)))) for i in range(40)]
    items += [(5, items[6][1]), (None, say(4)), (90, None), (91, items[8][1].upper())]
    docs = [(i, say(rng.choice((0, 1, 5, 30, 200)))) for i in range(60)]
    docs += [(1, docs[2][1]), (None, docs[3][1]), (70, None), (71, items[9][1] + ", " + items[10][1])]
    return docs, items


@pytest.mark.parametrize("few, blocks, chunk", [(3, 1 << 14, 1 << 20), (3, 7, 50), (12, 5, 300)])
def test_blocks_and_chunks(base_spark, monkeypatch, few, blocks, chunk):
    """Windows dealt over several blocks, texts over several chunks, frequent and rare words."""
    monkeypatch.setattr(dc, "CHUNK_TOKENS", chunk)
    docs, items = tables(base_spark, random.Random(few * blocks), few)
    made = dc.decontaminate(
        base_spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3),
        base_spark.createDataFrame(items, "item_id bigint, text string"),
        window=4,
        block_windows=blocks,
    )
    assert digests(made) == brute(docs, items, 4)


def test_proximity_matches(base_spark):
    item = "one two three four five six seven eight nine ten"
    texts = [item, item.replace("three four", "four three"), item.replace("five", "so five"), f"a {item[4:]}", item[4:]]
    made = dc.decontaminate(
        base_spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"),
        base_spark.createDataFrame([(7, item)], "item_id bigint, text string"),
    )
    found = {r.doc_id: (r.items, r.near_items) for r in made.collect()}
    assert found == {0: (["7"], []), 1: ([], ["7"]), 2: ([], ["7"]), 3: ([], []), 4: ([], [])}


def test_odd_tables(base_spark):
    docs = [(1, "a b c"), (1, "a b c"), (2, None), (3, ""), (4, "q " * 30_000 + "a b c"), (None, "x" * 60_000)]
    items = [(1, "A b, c!"), (2, "x" * 60_000), (3, None), (4, " ")]
    wide = base_spark.createDataFrame([(*d, 1, "own") for d in docs], "doc_id bigint, text string, n_words int, Items string")
    tests = base_spark.createDataFrame([(*i, 2) for i in items], "item_id bigint, text string, number int")
    assert digests(dc.decontaminate(wide, tests)) == brute(docs, items)
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in dc.decontaminate(wide, tests).collect()}
    assert spans[4] == [(30_000, 30_003)] and spans[2] == []
    assert dc.decontaminate(wide.where("false"), tests).count() == 0
    clean = dc.decontaminate(wide, tests.where("false")).collect()
    assert len(clean) == 6 and not any(r.n_hit or r.items for r in clean)


def test_postings_round_trip():
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.integers(0, 1 << b, 50) for b in (1, 7, 8, 14, 21, 35, 50)])
    raw, ends = dc.varints(values)
    assert np.array_equal(dc.from_varints(raw.tobytes()), values) and ends[-1] == len(raw)
