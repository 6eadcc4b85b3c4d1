"""The Merkle manifest against a tree built in one piece."""

import hashlib
import random
import zlib

import pytest
from conftest import SF_DIR
from oracle_check import connect, difference
from pyspark.sql import functions as F

from recordlake.llm import merkle
from recordlake.llm.oracles import ORACLES
from recordlake.llm.queries import QUERIES

NAME = "op11_merkle_manifest"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def reduced(nodes):
    """All levels of a tree, from its leaves to its single node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + 3]) for i in range(0, len(last), 3)])
    return levels


def fold(levels, at, value):
    """Siblings from the leaf up, and the root with another leaf."""
    siblings = []
    for nodes in levels[:-1]:
        first = at - at % 3
        run = nodes[first : first + 3]
        run[at - first] = value
        siblings += [x for i, x in enumerate(run) if first + i != at]
        value, at = h(*run), at // 3
    return siblings, value


def spelt(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute(rows):
    """Rows (doc_id, source, lang, n_chars, text) to their result rows, sorted."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row, h(*map(spelt, row))))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for held in groups.values():
        held.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    trees = {s: reduced([leaf for _, leaf in groups[s]]) for s in order}
    upper = reduced([trees[s][-1][0] for s in order])
    out = []
    for at, s in enumerate(order):
        for i, (row, leaf) in enumerate(groups[s]):
            given = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = None if row[4] is None else row[4].replace("\n", "")
                given = h(*map(spelt, (*row[:4], text)))
            low, value = fold(trees[s], i, given)
            high, root = fold(upper, at, value)
            out.append((row[0], leaf, trees[s][-1][0], upper[-1][0], h(*low, *high), root, root == upper[-1][0]))
    return sorted(out, key=str)


def result(df):
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def rows_of(sizes, rng):
    rows = []
    for source, size in sizes.items():
        for _ in range(size):
            text = rng.choice([None, "", "a\nb", "é\n\n", "plain", "1:-"])
            rows.append((rng.randrange(10**6), source, rng.choice(["en", None]), rng.choice([1, None]), text))
    return rows


def proved(df, **options):
    made = merkle.manifest(
        df,
        tampered={"text": F.replace("text", F.lit("\n"), F.lit(""))},
        touched=F.crc32(F.col("doc_id").cast("string")) % 2 == 0,
        **options,
    )
    return made.withColumn("proof_sha256", F.sha2("proof", 256))


def test_query_equals_sql(base_spark):
    assert difference(QUERIES[NAME](base_spark, SF_DIR), connect(SF_DIR), ORACLES[NAME]) is None


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_tiers_of_blocks_equal_one_tree(base_spark, levels):
    """A source of many blocks and tiers, sources of one row, and a null source."""
    rows = rows_of({"hot": 400, None: 10, "": 1, "é": 27, "z": 9, **{f"s{i}": 1 + i % 4 for i in range(30)}}, random.Random(levels))
    df = base_spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(proved(df, levels=levels)) == brute(rows)


def test_copies_lead_to_the_folded_root(base_spark):
    rows = rows_of({"a": 50, "b": 5}, random.Random(9))
    made = proved(base_spark.createDataFrame(rows, SCHEMA), levels=2).collect()
    for r in made:
        copied = r.copied.split(",")
        assert copied[-1] == r.folded_root and len(r.proof) % 64 == 0
    # four levels of 50 leaves or two of 5, and one of two subroots
    assert sorted({len(r.copied.split(",")) for r in made}) == [3, 5]


def test_versions_share_all_other_nodes():
    tree = merkle.PersistentTree([h(str(i)) for i in range(20)], 3, None)
    before = list(tree.digests), list(tree.children)
    made = len(tree.digests)
    root = tree.replace(7, h("x"))
    assert (tree.digests[:made], tree.children[:made]) == before
    assert len(tree.digests) == made + 1 + tree.height
    leaves = [h(str(i)) for i in range(20)]
    leaves[7] = h("x")
    assert tree.digests[root] == reduced(leaves)[-1][0]
    reached, todo = set(), [root]
    while todo:
        at = todo.pop()
        reached.add(at)
        todo += tree.children[at]
    assert len({n for n in reached if n >= made}) == 1 + tree.height


def test_odd_rows(base_spark):
    rows = [
        (1, "a", "en", 1, "x\ny"),
        (1, "a", "en", 1, "x\ny"),
        (1, "a", "en", 1, "x\nz"),
        (None, "a", None, None, None),
        (None, None, None, None, "\n"),
        (-3, None, "en", 5, "long\n" * 50_000),
        (2, "b", "en", 0, ""),
    ]
    wide = base_spark.createDataFrame([(*r, 1, "own") for r in rows], SCHEMA + ", leaf int, Root string")
    assert result(proved(wide)) == brute(rows)
    one = base_spark.createDataFrame(rows[:1], SCHEMA)
    assert result(proved(one)) == brute(rows[:1])
    assert proved(one.where("false")).count() == 0


def test_rows_alike_are_spread(base_spark):
    df = base_spark.range(3000).select(
        F.lit(5).cast("bigint").alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"),
        F.lit(1).cast("bigint").alias("n_chars"), F.lit("t").alias("text"),
    )
    rows = [tuple(r) for r in df.collect()]
    assert result(proved(df.repartition(3), levels=3)) == brute(rows)
