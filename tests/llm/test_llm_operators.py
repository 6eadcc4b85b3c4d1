"""Each operator against brute force, and on odd rows and empty tables."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from conftest import SF_DIR
from oracle_check import connect, difference
from pyspark.sql import functions as F

from recordlake.llm import ann, license_rules, lm_score, packing, piece_sampling, pii, secret_scan, simhash, warc
from recordlake.llm.license_rules import ANCHORS, SENTENCES, scan_licenses
from recordlake.llm.oracles import ORACLES
from recordlake.llm.quality import RULES, Cascade, Text, judge_quality
from recordlake.llm.queries import QUERIES
from recordlake.llm.secret_scan import redact, scan_secrets


ODD = [
    (1, "Alpha beta gamma delta.\nAlpha beta gamma delta.", "en"),
    (1, "Alpha beta gamma delta.\nAlpha beta gamma delta.", "en"),
    (2, None, None),
    (3, "", "de"),
    (4, "word " * 30_000, "en"),
    (5, "x" * 60_000, "en"),
    (None, "mail a1@b.cc or +1 (555) 123-4567; password=abcdef0123456789", None),
    (6, " \t\n\x0b\x0c\r ", "fr"),
    (7, "é😀▁ <|endoftext|>\x00 42.1.2.3", "es"),
]


@pytest.fixture(scope="session")
def odd(base_spark):
    """Nulls, empty and very long texts, repeated rows, and columns named like results."""
    rows = [(i, t, lang, "mine", 1) for i, t, lang in ODD]
    names = "doc_id bigint, text string, lang string, Spans string, kept int"
    return base_spark.createDataFrame(rows, names)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


def docs_of(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(base_spark, name):
    assert difference(QUERIES[name](base_spark, SF_DIR), connect(SF_DIR), ORACLES[name]) is None


# quality


def test_cascade_order_follows_rejections_per_cost_and_keeps_verdicts():
    clock = iter(range(10**9))
    cascade = Cascade(RULES, 20, clock=lambda: next(clock))
    texts = [Text("a### b$$$ " * 40), Text("Plain words stand here in a row. " * 20)] * 30
    plain = [all(r.passes(t) for r in RULES) for t in texts]
    assert [cascade.keeps(t) for t in texts] == plain
    assert cascade.rules[0].name in ("few_symbols", "mostly_words")


def test_quality_odd_rows(odd, none):
    rows = judge_quality(odd).collect()
    assert len(rows) == odd.count() and judge_quality(none).count() == 0
    assert {r.n_words for r in rows if r.text is None or r.doc_id == 3} == {0}
    assert all(r.kept is False for r in rows if r.n_words < 50)
    assert [r.n_repeat_words for r in rows if r.doc_id == 4] == [30_000]


# secrets


def brute_secrets(t):
    assign = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    out = [(m.start(), 0, m.end()) for m in re.finditer(assign, t, re.I | re.A) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    names = ("assign", "access", "hex")
    return ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_secrets(base_spark, odd, none):
    rng = random.Random(1)
    parts = ["password", "API_KEY", "=", ": ", "'", "AKIA", "ABCDEF0123456789", "f" * 31, "0", " ",
             "toKen", "é", "\n", "s3cretV4lue9", "ſecret=12345678"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(800)]
    novel = "the private key part is Zx9+Qw3/Lk8RtY7uPo2mNb5v for the host"
    df = base_spark.createDataFrame(list(enumerate([*texts, novel])), "doc_id bigint, text string")
    rows = scan_secrets(df).collect()
    for r in rows:
        want = brute_secrets(r.text)
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(want.split(",")) - {""} <= set(r.spans.split(","))
    assert rows[-1].spans == f"novel:{novel.index('Zx9')}:{novel.index(' for')}"
    assert scan_secrets(none).count() == 0
    found = scan_secrets(odd)
    assert [c.lower() for c in found.columns].count("spans") == 1 and found.count() == 9
    marked = redact(found).where("doc_id is null").first().text
    assert marked.endswith("; [SECRET]")


def test_secrets_written_twice(base_spark):
    rng = random.Random(11)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    prose = "The service reads it when the host starts and keeps it in memory for as long as it runs there. " * 4
    texts = []
    for gap in (1, 40, 150, 240, 252):
        for _ in range(20):
            key = "".join(rng.choice(letters) for _ in range(32))
            texts.append(f"the api key {key} {prose[:gap]} and the api key {key} {prose[:100]}")
    df = base_spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in redact(scan_secrets(df)).collect():
        assert r.n_novel == 2 and r.text.count("[SECRET]") == 2


def test_novelty_tells_keys_from_names(base_spark):
    rng = random.Random(12)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    names = "well-established state-of-the-art session_token_service validate_user_session request_id_generator".split()
    keys = ["".join(rng.choice(letters) for _ in range(n)) for n in (16, 20, 24, 32, 40) for _ in range(20)]
    keys += ["".join(rng.choice(letters + "0123456789") for _ in range(n)) for n in (16, 24, 40) for _ in range(30)]
    texts = [f"the api key of {w}" for w in names] + [f"the author of {k}" for k in keys[:5]]
    texts += [f"the api key is {k} here" for k in keys]
    df = base_spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r.n_novel for r in scan_secrets(df).collect()}
    assert not any(found[i] for i in range(10))
    assert sum(found[i + 10] for i in range(len(keys))) >= 0.98 * len(keys)
    for word in ("author", "authority"):
        assert not secret_scan.CONTEXT.search(f"the {word} of")
    for word in ("auth: ", "OAuth ", "basicAuth=", "auth_key", "Authorization: Basic "):
        assert secret_scan.CONTEXT.search(word)


def test_novelty_over_library_names_and_keys_of_every_length():
    import argparse, asyncio, decimal, email, http.client, inspect, logging, socket, ssl, subprocess, unittest  # noqa: E401

    modules = (argparse, asyncio, decimal, email, http.client, inspect, logging, socket, ssl, subprocess, unittest)
    names = {n for m in modules for o in (m, *vars(m).values()) for n in dir(o)}
    names = sorted(n for n in names if secret_scan.CANDIDATE.fullmatch(n))
    novelty, rng = secret_scan.Novelty(secret_scan.IDENTIFIERS, 256, None), random.Random(5)

    def found(word):
        return bool(novelty.spans(f"the api key of {word} for the host", 48))

    assert len(names) > 300 and sum(map(found, names)) <= 0.03 * len(names)
    low = "abcdefghijklmnopqrstuvwxyz"
    for letters in (low + "0123456789", "0123456789ABCDEF", low + low.upper() + "0123456789", low.upper() + "234567"):
        for n in (16, 24, 64, 256, 512, 1024):
            keys = ["".join(rng.choices(letters, k=n)) for _ in range(50)]
            assert sum(map(found, keys)) >= 48
    for word in ("ReadWriteOncePodVolumeClaim", "-".join(names[:300:20]), "in-and-out-of-the-" * 12 + "house"):
        assert not found(word)


# near-duplicates


def brute_print(t):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    order = sorted(prints)
    parent = {i: i for i in order}

    def head(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, i in enumerate(order):
        for j in order[n + 1 :]:
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = sorted((head(i), head(j)))
                parent[b] = a
    return {i: head(i) for i in order}


def test_simhash_components(base_spark):
    docs = {r.doc_id: r.text for r in docs_of(base_spark).collect()}
    prints = {i: brute_print(t) for i, t in docs.items()}
    want = brute_components(prints)
    rows = QUERIES["op6_simhash_near_dedup"](base_spark, SF_DIR).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        i: (f"{p:016x}", want[i]) for i, p in prints.items()
    }


def test_hot_buckets_are_compared_in_parts(base_spark):
    rng = random.Random(2)
    values = {0x0123_4567_89AB_CDEF ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(400)}
    rows = [(simhash._signed(v),) for v in values]
    links = simhash.links_between(base_spark.createDataFrame(rows, "fp bigint"), chunk=20)
    roots = simhash.components(links).select("root").distinct().count()
    want = len(set(brute_components(dict(enumerate(values))).values()))
    alone = len(values) - simhash.components(links).count()
    assert roots + alone == want


def test_simhash_odd_rows(odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == 9 and simhash.near_duplicates(none).count() == 0
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {2}
    assert simhash.first_of_group(odd).count() == 9 - 1 - 2


def test_repeated_and_null_ids_lose_no_other_text(base_spark, odd, none):
    rows = [(1, "a b c d e f"), (1, "g h i j k l"), (None, "m n o p q"), (None, "m n o p q"), (2, "a b c d e f")]
    df = base_spark.createDataFrame(rows, "doc_id bigint, text string")
    want = sorted([(1, "a b c d e f"), (1, "g h i j k l"), (None, "m n o p q")], key=str)
    got = simhash.first_of_group(df).collect()
    assert sorted([(r.doc_id, r.text) for r in got], key=str) == want
    assert simhash.first_of_group(odd).count() == 9 - 1 - 2
    assert simhash.first_of_group(none).count() == 0


# packing


def test_packing(base_spark, odd, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    for df in (docs_of(base_spark), odd):
        texts = [(r.doc_id, r.text) for r in df.collect()]
        rows = packing.pack(df).collect()
        want = Counter()
        for i, t in texts:
            ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
            for n, at in enumerate(range(0, len(ids), 4096)):
                part = ids[at : at + 4096]
                want[i, n, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))] += 1
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
        sequences = {}
        for r in rows:
            sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for places in sequences.values():
            ends = [0, *(o + n for o, n in sorted(places))]
            assert [o for o, _ in sorted(places)] == ends[:-1] and ends[-1] <= 4096
        tokens = sum(r.length for r in rows)
        assert len(sequences) <= -(-tokens // 4096) + 2
    assert packing.pack(none).count() == 0


# licences


def test_licences(base_spark, odd, none):
    bsd = "\n".join(SENTENCES[k] for k in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names"))
    wrapped = SENTENCES["mit-grant"].replace(" copy of ", "\n  copy of ")
    texts = [
        f"Prose here.\n{bsd}\nMore.",
        f"{wrapped} {SENTENCES['mit-condition']}",
        "x | y\nLicensed under the Apache License, Version 2.0.\nz",
        "A licence is not here, nor a license.",
        SENTENCES["mit-warranty"],
    ]
    df = base_spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = scan_licenses(df).collect()
    assert [r.licenses for r in rows] == ["BSD-3-Clause", "MIT", "Apache-2.0", "", ""]
    assert rows[4].n_sentences == 1
    _, start, end = rows[2].spans.split(":")
    assert texts[2][int(start) : int(end)] == SENTENCES["apache-notice"]
    assert scan_licenses(odd).count() == 9 and scan_licenses(none).count() == 0
    found = QUERIES["op8_license_scan"](base_spark, SF_DIR).agg(F.sum("n_sentences")).first()[0]
    notices = [SENTENCES[k] for k in SENTENCES if k.endswith("notice")]
    want = sum(r.text.count(n) for r in docs_of(base_spark).collect() for n in notices)
    assert found == want > 0
    assert all(any(a in s.lower().encode() for a in ANCHORS) for s in SENTENCES.values())


def test_licence_notices_names_and_identifiers(base_spark):
    cases = {
        "Licensed under the BSD 3-Clause License.": "BSD-3-Clause",
        "Released under the Apache License, Version 2.0.": "Apache-2.0",
        "This work is licensed under CC BY 4.0.": "CC-BY-4.0",
        "This project is released under the MIT License.": "MIT",
        "We publish; the code is\nreleased under\nCC BY-SA 3.0 and more.": "CC-BY-SA-3.0",
        "# SPDX-License-Identifier: BSD-3-Clause": "BSD-3-Clause",
        "SPDX-License-Identifier: MIT OR Apache-2.0": "MIT,Apache-2.0",
        "SPDX-License-Identifier: GPL-2.0+": "GPL-2.0-or-later",
        "SPDX-License-Identifier: LGPL-2.1-or-later": "LGPL-2.1-or-later",
        "SPDX-License-Identifier: MIT-unknown": "",
        "It is distributed under the terms of the GNU Affero General Public License version 3.": "AGPL-3.0-only",
        "licensed under the GNU Lesser General Public License v3 or later": "LGPL-3.0-or-later",
        "available under the Eclipse Public License 2.0": "EPL-2.0",
        "released under the ISC License": "ISC",
        "This is free and unencumbered software released into the public domain.": "Unlicense",
        "    Apache License\n  Version 2.0, January 2004\n  http://x": "Apache-2.0",
        "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007": "GPL-3.0-only",
        "Mozilla Public License Version 2.0\n=====\n": "MPL-2.0",
        f"MIT License\n\n{SENTENCES['mit-grant']}": "MIT",
        "They spoke of the MIT License at length.": "",
        "The permission is warranted.": "",
    }
    df = base_spark.createDataFrame(list(enumerate(cases)), "doc_id bigint, text string")
    got = {list(cases)[r.doc_id]: r.licenses for r in scan_licenses(df).collect()}
    assert got == cases


def brute_licences(text, sentences, leads, notices):
    """A plain matcher over all sentences, leads with names, and rules; no SPDX lines."""
    lines = [re.findall("[a-z0-9]+", line.lower()) for line in text.split("\n")]
    words = [w for line in lines for w in line]
    line_of = [n for n, line in enumerate(lines) for _ in line]

    def standing(known, at):
        return [(at + len(w), name) for w, name in known.items() if tuple(words[at : at + len(w)]) == w]

    found, at = [], 0
    while at < len(words):
        # the longest; of equally long ones a sentence, then the notice with the shorter lead
        ways = [(end, 1, 0, name) for end, name in standing(sentences, at)]
        for named, lead in standing(leads, at):
            ways += [(end, 0, -len(lead), f"{name}-named") for end, name in standing(notices, named)]
        to, _, _, name = max(ways, default=(0, 0, 0, None), key=lambda w: w[:3])
        if name and "-title-" in name:
            before = [w for w, n in zip(words[:at], line_of) if n == line_of[at]]
            if before not in ([], ["the"]) or (to < len(words) and line_of[to] == line_of[to - 1]):
                name = None
        if name:
            found.append(name)
        at = to if name else at + 1
    met, at, titled = [], 0, None
    while at < len(found):
        rules = [(x, r) for x, r in license_rules.CATALOGUE_RULES if tuple(found[at : at + len(r)]) == tuple(r)]
        if not rules:
            at, titled = at + 1, None
            continue
        licence, rule = rules[0]
        if titled != licence:
            met.append(licence)
        titled = licence if "-title-" in found[at] else None
        at += len(rule)
    return ",".join(found), ",".join(met)


def test_licences_equal_a_plain_matcher(base_spark):
    def by_words(entries):
        return {license_rules.normalised(text): name for text, name in entries}

    sentences = by_words((t, n) for n, t in license_rules.CATALOGUE.items())
    leads = by_words((lead, lead) for lead in license_rules.LEADS)
    notices = by_words(license_rules.NOTICES.items())
    rng, texts = random.Random(8), []
    plain = [t for n, t in license_rules.CATALOGUE.items() if "spdx" not in n.lower()]
    titles = [t for n, t in license_rules.CATALOGUE.items() if "-title-" in n]
    own = [t for n, t in SENTENCES.items() if "spdx" not in n.lower()]
    for _ in range(250):
        parts = []
        for _ in range(rng.randint(1, 6)):
            made = rng.choice((plain, titles, own, own, [""]))
            part = rng.choice(made) or f"{rng.choice(license_rules.LEADS)} {rng.choice(list(license_rules.NOTICES))}"
            part = rng.choice((str, str.upper, lambda t: t.replace(" ", "\n ", 2)))(part)
            if rng.random() < 0.2:
                part = part[: rng.randrange(len(part))]  # cut short
            parts += [part, rng.choice(("\n", "\n", " ", " and then some words, ", ". The\n", "; it is "))]
        texts.append("".join(parts))
    df = base_spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.sentence_ids, r.licenses) for r in scan_licenses(df).collect()}
    want = {i: brute_licences(t, sentences, leads, notices) for i, t in enumerate(texts)}
    assert got == want and sum(bool(x) for _, x in want.values()) > 150


# pieces


def test_pieces_decode_and_repeat(base_spark, odd, none):
    rows = piece_sampling.sample_pieces(odd).collect()
    again = piece_sampling.sample_pieces(odd.repartition(3)).collect()
    assert Counter(map(str, rows)) == Counter(map(str, again))
    assert all(r.lossless for r in rows) and len(rows) == 9
    decoded = piece_sampling.decode_pieces(piece_sampling.sample_pieces(odd)).collect()
    assert all(r.decoded == (r.text or "") for r in decoded)
    assert piece_sampling.sample_pieces(none).count() == 0
    assert QUERIES["op10_piece_sampling"](base_spark, SF_DIR).where("not lossless").count() == 0


def test_samples_follow_the_lattice():
    lattice = piece_sampling.Lattice(piece_sampling.piece_path())
    weights = {}

    def walk(end, ids, weight):
        if not end:
            weights[ids] = weight
        else:
            for start, w, piece in lattice.edges(" thesi", end):
                walk(start, (*piece, *ids), weight * math.exp(w))

    walk(6, (), 1.0)
    total, draw, n = sum(weights.values()), random.Random(3).random, 20_000
    together = lattice.encode_all(["thesi"] * n, list(map(str, range(n))))
    alone = [lattice.sample_long(" thesi", draw) for _ in range(n)]
    for samples in ([struct.unpack(f"<{len(b) // 4}I", b) for b in together], map(tuple, alone)):
        seen = Counter(samples)
        assert set(seen) <= set(weights)
        assert all(abs(seen[k] / n - w / total) < 0.02 for k, w in weights.items())


def test_samples_are_of_every_segmentation_by_the_whole_vocabulary():
    """Against an enumeration of the vocabulary itself, over spaces, marks and unknown characters."""
    import sentencepiece

    path = piece_sampling.piece_path()
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    weight_of, byte_of = {}, {}
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            byte_of[int(model.id_to_piece(i)[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            piece = model.id_to_piece(i).replace("\u2581", " ")
            weight_of[piece] = i, 1 / (min(-model.get_score(i), piece_sampling.BYTE_RANK) + 1)

    def segmentations(text):
        if not text:
            yield (), 1.0
        for end in range(1, len(text) + 1):
            if text[:end] in weight_of:
                ids, weight = [weight_of[text[:end]][0]], weight_of[text[:end]][1]
            elif end == 1:
                ids = [byte_of[b] for b in text[0].encode()]
                weight = (piece_sampling.BYTE_RANK + 1.0) ** -len(ids)
            else:
                continue
            for rest, more in segmentations(text[end:]):
                yield (*ids, *rest), weight * more

    lattice, rng, n = piece_sampling.Lattice(path), random.Random(11), 4000
    crossing = [".\u201d", " [\u2026]", "\u201d.\u201d,", "a \u00bb, b", "no.\u2019)"]
    texts = ["".join(rng.choices("th e.,\u201d\u00bb\n\u6f22\U0001f600an", k=6)) for _ in range(12)]
    across = set()
    for text in crossing + texts:
        weights = dict(segmentations(" " + text))
        total = sum(weights.values())
        seen = Counter(
            struct.unpack(f"<{len(b) // 4}I", b)
            for b in lattice.encode_all([text] * n, list(map(str, range(n))))
        )
        assert set(seen) <= set(weights)
        assert all(abs(seen[k] / n - w / total) < 0.05 for k, w in weights.items())
        across |= {i for ids in seen for i in ids}
    assert {weight_of[p][0] for p in lattice.across} & across


def test_samples_do_not_depend_on_blocks(monkeypatch):
    lattice = piece_sampling.Lattice(piece_sampling.piece_path())
    texts = ["", "x" * 5000 + " \u6f22\U0001f600 end", "a b\nc  d\x00\u2581 " * 300, "\u6f22" * 40, "(\u201d." * 90, "end.\u201d \u00bb, " * 99]
    whole = lattice.encode_all(texts, ["k"] * len(texts))
    assert [lattice.decode(b) for b in whole] == texts
    monkeypatch.setattr(piece_sampling, "BLOCK_CHARS", 64)
    assert lattice.encode_all(texts, ["k"] * len(texts)) == whole
    assert [lattice.encode_all([t], ["k"])[0] for t in texts] == whole


# archives


def test_archives(base_spark):
    body = "<p>same</p>" * 20
    pages = base_spark.createDataFrame(
        [(5, "http://a/ b", body, 1), (3, None, body, 1), (3, "http://c", body, 1), (9, "x", None, 1),
         (None, "http://d", body, 1), (7, "http://e", "short", 1), (8, "http://e", "short", 1)],
        "page_id bigint, url string, html string, record_type int",
    )
    rows = warc.pages_through_warc(pages, archive_bytes=200).collect()
    got = Counter((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in rows)
    n = len(body)
    assert got == Counter(
        [(3, "response", None, n), (3, "revisit", 3, n), (5, "revisit", 3, n), (None, "revisit", 3, n),
         (9, "response", None, 0), (7, "response", None, 5), (8, "response", None, 5)]
    )
    assert {r.payload_digest for r in rows if r.payload_bytes == n} == {
        hashlib.sha256(body.encode()).hexdigest()
    }
    assert warc.pages_through_warc(pages.where("false")).count() == 0


def test_arc_headers_of_both_versions():
    for version in (1, 2):
        record = warc.arc_record(version, "http://a/b", "1.2.3.4", "1999", "text/html", b"a\nb")
        fields, body = warc.parse_arc(record + b"beyond", version)
        assert (fields["URL"], fields["Archive-date"], body) == ("http://a/b", "1999", b"a\nb")
        assert warc.arc_version(warc.arc_version_block(version, "x", "1999")) == version
        with pytest.raises(ValueError):
            warc.parse_arc(record[:-3], version)
    assert warc.iso_date("19990203") == "1999-02-03T00:00:00Z"


@pytest.mark.parametrize("version", [1, 2])
def test_arc_layouts_give_all_records(base_spark, version):
    bodies = [f"HTTP/1.1 200 OK\r\nX-Page-Id: {i}\r\n\r\n{'a b 7' * i}\n".encode() for i in range(90, 94)]
    bodies.append(bodies[0] + random.Random(1).randbytes(200_000))
    parts = [warc.arc_version_block(version, "x", "1999")]
    parts += [warc.arc_record(version, f"http://{i}", "1.2.3.4", "1999", "text/html", b) for i, b in enumerate(bodies)]
    whole = b"".join(parts)
    layouts = {
        "plain": whole,
        "padded": whole + b"\x00",
        "one member": warc.gzip_member(whole) + b"\x00",
        "a member each": b"".join(map(warc.gzip_member, parts)),
        "two each": b"".join(warc.gzip_member(b"".join(parts[i : i + 2])) for i in (0, 2, 4)),
        "joined": whole + whole,
    }
    for name, content in layouts.items():
        got = [(f["URL"], body) for _, f, body in warc.arc_records(content)]
        want = [(f"http://{i}", b) for i, b in enumerate(bodies)]
        assert got == want * (2 if name == "joined" else 1), name
    for bad in (whole + b"left over", whole + b"left over\n", whole[:-4], layouts["one member"][:-9], warc.gzip_member(whole) + b"x"):
        with pytest.raises((ValueError, zlib.error)):
            list(warc.arc_records(bad))
    rows = [(k, bytearray(v)) for k, v in list(layouts.items())[:5]]
    df = base_spark.createDataFrame(rows, "path string, content binary")
    assert warc.facts_of(df).count() == 5 * len(bodies)


def test_foreign_records_become_warc(base_spark):
    page = b"<p>an old page, long enough to be revisited</p>" * 4
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nhello\r\n0\r\n\r\n"
    records = [
        ("http://crlf/", "text/html", b"HTTP/1.1 200 OK\r\nContent-Length: 9\r\n\r\n" + page),
        ("http://lf/", "text/html", b"HTTP/1.0 200 OK\nServer: old\n\n" + page),
        ("http://headless/", "text/html", page),
        ("dns:example.com", "text/dns", b"19990101000000\nexample.com. 300 IN A 1.2.3.4\n"),
        ("http://chunked/", "text/html", chunked),
        ("http://cut/", "text/html", b"HTTP/1.1 204 No Content\r\nX-Page-Id: x1"),
        ("http://empty/", "no-type", b""),
        ("http://latin/\xe9".encode("latin-1"), "text/html", b"HTTP/1.1 200 OK\r\n\r\nshort"),
    ]
    parts = [warc.arc_version_block(1, "x", "1999")]
    for url, mime, body in records:
        raw = url if isinstance(url, bytes) else url.encode()
        parts.append(raw + f" 1.2.3.4 19990101000000 {mime} {len(body)}\n".encode() + body + b"\n")
    df = base_spark.createDataFrame([("a", bytearray(b"".join(parts)))], "path string, content binary")
    made = warc.arc_to_warc(df).collect()
    assert [r.content for r in made] == [r.content for r in warc.arc_to_warc(df).collect()]
    blocks = [warc.parse_warc(m) for r in made for m in warc.gunzip_members(r.content)]
    kinds = {f["WARC-Target-URI"]: (f["WARC-Type"], f.get("Content-Type")) for f, _ in blocks[1:]}
    http = "application/http; msgtype=response"
    assert blocks[0][0]["WARC-Type"] == "warcinfo" and len(kinds) == len(records)
    assert kinds["dns:example.com"] == ("resource", "text/dns")
    assert kinds["http://crlf/"] == ("response", http) and kinds["http://chunked/"] == ("response", http)
    assert kinds["http://lf/"][0] == kinds["http://headless/"][0] == "revisit"
    heads = {f["WARC-Target-URI"]: block for f, block in blocks[1:]}
    assert heads["http://headless/"] == b"" and heads["http://lf/"] == b"HTTP/1.0 200 OK\nServer: old\n\n"
    assert heads["http://chunked/"] == chunked
    back = base_spark.createDataFrame([(r.content,) for r in made], "content binary").withColumn("path", F.lit("p"))
    rows = {r.url: r for r in warc.read_warc(back).collect()}
    same = hashlib.sha256(page).hexdigest()
    for url in ("http://crlf/", "http://lf/", "http://headless/"):
        assert (rows[url].payload_bytes, rows[url].payload_digest) == (len(page), same)
    assert rows["http://chunked/"].payload_bytes == len(chunked.partition(b"\r\n\r\n")[2])
    assert rows["http://cut/"].payload_bytes == 0 and rows["http://cut/"].page_id is None
    bare = b"WARC/1.0\r\nWARC-Type: revisit\r\nWARC-Record-ID: <u>\r\nWARC-Date: d\r\nWARC-Target-URI: dns:x\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    foreign = base_spark.createDataFrame([("p", bytearray(warc.gzip_member(bare)))], "path string, content binary")
    row = warc.read_warc(foreign).first()
    assert (row.record_type, row.payload_bytes, row.payload_digest) == ("revisit", None, None)


def test_archives_are_dealt_out_by_their_bytes(base_spark, monkeypatch):
    before = base_spark.conf.get("spark.sql.shuffle.partitions")
    base_spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        pages = base_spark.read.parquet(f"{SF_DIR}/pages.parquet")
        plain = {tuple(r) for r in warc.pages_through_warc(pages, archive_bytes=1 << 14).collect()}
        monkeypatch.setattr(warc, "TASK_BYTES", 1 << 16)
        dealt = [tuple(r) for r in warc.pages_through_warc(pages, archive_bytes=1 << 14).collect()]
        assert set(dealt) == plain and len(dealt) == pages.count()
    finally:
        base_spark.conf.set("spark.sql.shuffle.partitions", before)


# language model


@pytest.mark.parametrize("sizes", [{}, {"chunk_tokens": 500}, {"chunk_tokens": 700, "slice_entries": 900, "fan": 3}])
def test_language_model(base_spark, sizes):
    df = docs_of(base_spark)
    rows = {r.doc_id: r for r in lm_score.score_texts(df, **sizes).collect()}
    texts = {r.doc_id: (r.text or "").encode().lower().split() + [b" end"] for r in df.collect()}
    fold = {i: zlib.crc32(str(i).encode()) % 10 for i in texts}

    def counts(folds):
        words, pairs, contexts = Counter(), Counter(), Counter()
        for i, w in texts.items():
            if fold[i] in folds:
                words.update(w)
                pairs.update(zip([b" start", *w], w))
                contexts.update([b" start", *w[:-1]])
        return words, pairs, contexts

    def bucket(n):
        return int(np.frexp(float(n))[1])

    used, pairs, contexts = counts(range(2, 10))
    n, unit = sum(used.values()), 1 / (len(used) + 1)
    grid = lambda p: int(lm_score.on_grid(np.array([p]), unit)[0])
    held = Counter()
    for i, w in texts.items():
        if fold[i] == 1:
            for u, t in zip([b" start", *w], w):
                p = pairs[u, t] / max(contexts[u], 1)
                held[bucket(contexts[u]), grid(p), grid(used[t] / n)] += 1
    weights = lm_score.learn_weights([(*k, c) for k, c in held.items()])
    words, pairs, contexts = counts(range(1, 10))
    n, v = sum(words.values()), len(words)
    assert set(rows) == set(texts)
    for i, w in texts.items():
        r = rows[i]
        base = sum(math.log10((words[t] + 0.1) / (n + 0.1 * (v + 1))) for t in w)
        score = 0.0
        for u, t in zip([b" start", *w], w):
            a, b, c = weights[max(k for k in weights if k <= bucket(contexts[u]))]
            score += math.log10(a * pairs[u, t] / max(contexts[u], 1) + b * words[t] / n + c / (v + 1))
        assert (r.held_out, r.n_tokens, r.train_tokens) == (fold[i] == 0, len(w), n)
        assert r.n_known == sum(words[t] > 0 for t in w)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)
    out = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_rows_of_counts_grow_as_the_tokens():
    for fan in (2, 8, 64, lm_score.FAN):
        rows = []
        for chunks in (10**3, 10**4, 10**5, 10**6):
            tokens = chunks * lm_score.CHUNK_TOKENS
            levels = lm_score.levels_of(tokens, lm_score.SLICE_ENTRIES, 8, fan)
            assert levels[-1].groups == 1 and all(a.width <= fan for a in levels)
            units = [chunks, *[a.groups * a.slices for a in levels[:-1]]]
            rows.append(sum(n * a.width for n, a in zip(units, levels)) / chunks)
            for a in levels:
                # a slice of a group holds no more than asked for, the last ones as well
                assert tokens <= a.groups * a.slices * lm_score.SLICE_ENTRIES
        # a level more may come with ten times the chunks, never ten times the rows a chunk
        assert all(b - a <= 5 * fan for a, b in zip(rows, rows[1:])) and rows[-1] <= 20 * fan
    wide = lm_score.levels_of(10**11, lm_score.SLICE_ENTRIES, 8000, 64)
    assert wide == lm_score.levels_of(10**11, lm_score.SLICE_ENTRIES, 8, 64)


def test_rows_of_counts_sent(base_spark):
    words = [f"w{i % 977} v{i % 1009} u{i}" for i in range(1200)]
    sent = []
    for n in (300, 600, 1200):
        df = base_spark.createDataFrame(list(enumerate(words[:n])), "doc_id long, text string").repartition(4)
        chunks = lm_score.written(lm_score.chunked(df, "doc_id", "text", 50), "chunks")
        levels = lm_score.levels_of(4 * n, 100, 2, 4)
        asks = lm_score.chunk_asks(chunks, levels[0])
        total = asks.count()
        for level, above in zip(levels, levels[1:]):
            nodes = lm_score.written(lm_score.by_slice(asks, level).applyInArrow(lm_score.merged, lm_score.NODE), "n")
            asks = lm_score.node_asks(nodes, above)
            total += asks.count()
        assert len(levels) >= 2
        sent.append(total)
    assert sent[1] < 2.8 * sent[0] and sent[2] < 2.8 * sent[1]


def test_language_model_odd_rows(odd, none):
    rows = lm_score.score_texts(odd).collect()
    assert len(rows) == 9 and sorted(r.n_tokens for r in rows)[:3] == [1, 1, 1]
    assert lm_score.score_texts(none).count() == 0


# personal data


def brute_personal(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        total = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d))
        if 12 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_personal_data(base_spark, odd, none):
    rng = random.Random(4)
    parts = ["a@b.c", "@", "+1 (555) 123-4567", "1.2.3.4", "256.1.1.1", ".5.6.7.8", " ", "\n", "é😀",
             "4111 1111 1111 1111", "x_y@d.e", "12", "-", "+49", "9" * 13, "john (at) ex dot com"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(500)]
    texts.append("mail a1@b.cc " * 700)
    df = base_spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = pii.find_personal_data(df).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute_personal(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(want.split(",")) - {""} <= set(r.spans.split(","))
    plan = pii.candidates(df, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    found = {r.doc_id: r for r in pii.find_personal_data(odd).collect()}
    assert (found[None].n_email, found[None].n_phone, found[7].n_ip) == (1, 1, 1)
    assert pii.find_personal_data(none).count() == 0


def planted_personal(n=300):
    """Texts of base spans and other numbers, and texts of one variant each by what it is."""
    rng = random.Random(13)
    num = lambda k: "".join(rng.choice("0123456789") for _ in range(k))

    def card():
        body = "4" + num(14)
        total = sum(x if i % 2 else sum(divmod(2 * x, 10)) for i, x in enumerate(map(int, body[::-1])))
        return body + str(-total % 10)

    texts = []
    for _ in range(n):
        c = card()
        texts += [
            f"call the phone +1 {num(3)} {num(3)} {num(4)} today",
            f"contact ann{num(2)}@site{num(1)}.example.org for more",
            f"pay with card {c[:4]} {c[4:8]} {c[8:12]} {c[12:]} now",
            f"on 20{num(2)}-0{rng.randint(1, 9)}-1{num(1)} there were {num(3)} of {num(5)} parts, v{num(1)}.{num(1)}",
            f"section {num(1)}.{num(2)} costs {num(3)},{num(3)} and item-{num(4)} is {num(2)}%",
            f"the order {num(16)} and {num(4)}-{num(4)} went by",
        ]
    planted = {}
    for what, make in (
        ("phone", lambda: (p := f"{num(3)}-{num(3)}-{num(4)}", f"call the phone {p} today")),
        ("email", lambda: (p := f"ann{num(2)} at site{num(1)} dot org", f"contact {p} for more")),
        ("card", lambda: ((c := card()) and (p := ".".join(c[i : i + 4] for i in (0, 4, 8, 12))), f"pay with card {p} now")),
    ):
        planted[what] = [make() for _ in range(20)]
    return texts, planted


def test_planted_variants_come_out(base_spark):
    texts, planted = planted_personal()
    rows = [(i, t) for i, t in enumerate([*texts, *[t for v in planted.values() for _, t in v]])]
    df = base_spark.createDataFrame(rows, "doc_id bigint, text string")
    spans = {r.doc_id: r.spans for r in pii.find_personal_data(df).collect()}
    at = len(texts)
    for what, cases in planted.items():
        got = 0
        for part, text in cases:
            start = text.index(part)
            got += f"{what}_variant:{start}:{start + len(part)}" in spans[at].split(",")
            at += 1
        assert got >= 18, (what, got)
    # ordinary numbers are not taken for personal data
    wrong = sum(bool(spans[i]) for i in range(len(texts)) if i % 6 in (3, 4))
    assert wrong <= 0.05 * len(texts) / 3


def test_personal_data_does_not_depend_on_partitions(base_spark):
    texts, planted = planted_personal()
    texts = [*texts, *[t for v in planted.values() for _, t in v], *texts[:40]]
    df = base_spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    results = [
        {r.doc_id: r.spans for r in pii.find_personal_data(df.repartition(n)).collect()} for n in (1, 3, 7)
    ]
    assert results[0] == results[1] == results[2]
    assert any("variant" in s for s in results[0].values())


def test_personal_data_is_learnt_from_all_candidates(base_spark, monkeypatch):
    rng = random.Random(21)
    numbers = [" ".join(f"n{rng.randrange(10**6)}" for _ in range(100)) for _ in range(240)]
    texts = [*numbers, *[f"mail ann{i}@site.org now" for i in range(1200)], *numbers[:9]]
    df = base_spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    stored, write = {}, pii.written
    monkeypatch.setattr(pii, "written", lambda found, label: stored.setdefault(label, write(found, label)))
    pii.find_personal_data(df)
    learnt = stored["weighted"].groupBy("valid").agg(F.sum("weight").alias("n")).collect()
    # an address counts twice, as it is and as a variant; copies of a text count once
    assert {r.valid: r.n for r in learnt} == {False: 24_000, True: 2_400}


# neighbours


def test_neighbours(base_spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 16))
    x = centres[rng.integers(12, size=1500)] + 0.3 * rng.standard_normal((1500, 16))
    x[100:500] = x[100]  # a hot vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(2000, None), (2020, []), (2040, [0.0] * 16), (2060, [math.nan] * 16), (2080, [None] * 16)]
    df = base_spark.createDataFrame(rows + odd + [(None, x[0].tolist())], "vec_id bigint, embedding array<double>")
    asks = F.pmod("vec_id", F.lit(20)) == 0
    got = ann.nearest(df, is_query=asks, cell_rows=100, query_rows=10).toPandas()
    hits = 0
    for q, own in got.groupby("query_id"):
        own = own.sort_values("rank")
        assert list(own["rank"]) == list(range(1, 21)) and q not in set(own.vec_id)
        products = (x * x[q]).sum(axis=1)
        assert np.array_equal(own.score.to_numpy(), products[own.vec_id])
        products[q] = -np.inf
        hits += len(set(own.vec_id) & set(np.lexsort((np.arange(1500), -products))[:20]))
    assert got.query_id.nunique() == 75 and hits >= 0.9 * 75 * 20
    few = ann.nearest(df.where("vec_id < 5"), is_query=asks).collect()
    assert [r.rank for r in few] == [1, 2, 3, 4]
    assert ann.nearest(df.where("false"), is_query=asks).count() == 0


# pipeline


def test_pipeline(base_spark):
    import corpus_pipeline

    docs = docs_of(base_spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(base_spark, docs, SF_DIR)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    plain = {r.doc_id: r.text for r in docs_of(base_spark).collect()}
    good = {i for i, t in plain.items() if not (x := Text(t)).base_failed and all(r.passes(x) for r in RULES)}
    heads = set(brute_components({i: brute_print(plain[i]) for i in good}).values())
    rows = docs.collect()
    assert {r.doc_id for r in rows} == heads
    for r in rows:
        assert (r.text == plain[r.doc_id]) == (not brute_secrets(plain[r.doc_id]))
        assert not brute_secrets(r.text) and r.n_chars == len(r.text)
    packed = corpus_pipeline.run(base_spark, SF_DIR)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == heads


def test_pipeline_odd_rows(base_spark, odd, none):
    """Nulls, repeats, an empty table, and columns named like what the operators add."""
    import corpus_pipeline

    words = " ".join(f"word{i}x" for i in range(60))
    rows = [
        (1, f"{words} api_key=abcdef0123456789", "en", "a", 5, "k", -1, "s"),
        (1, f"{words} api_key=abcdef0123456789", "en", "a", 5, "k", -1, "s"),
        (None, f"{words} one more", None, None, None, None, None, None),
        (2, words[::-1], "en", "a", 7, "mine", -2, "t"),
        (3, None, None, None, None, None, None, None),
        (4, "", "en", "b", 0, "x", 0, "u"),
    ]
    names = "doc_id bigint, text string, lang string, source string, n_chars int, kept string, fp int, Spans string"
    docs = base_spark.createDataFrame(rows, names)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(base_spark, docs, SF_DIR)
        assert docs.dtypes == base_spark.createDataFrame([], names).dtypes
        assert stage(base_spark, none, SF_DIR).count() == 0
        assert stage(base_spark, odd, SF_DIR).columns == odd.columns
    kept = {r.doc_id: r for r in docs.collect()}
    assert set(kept) == {1, 2, None} and len(kept) == docs.count()
    assert kept[1].text == f"{words} [SECRET]" and kept[1].n_chars == len(kept[1].text)
    assert tuple(kept[2]) == rows[3] and (kept[1].kept, kept[1].fp, kept[1].Spans) == ("k", -1, "s")
    assert corpus_pipeline.pack_sequences(base_spark, docs, SF_DIR).count() == 3
