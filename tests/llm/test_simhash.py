from __future__ import annotations

import random

import xxhash
from pyspark.sql import functions as F

from trailmark.llm import graph, simhash
from trailmark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text, size=4):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    if not words:
        return 0
    hashes = [
        xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42) for i in range(max(1, len(words) - size + 1))
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, max_bits):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(fps))]


def test_query_equals_brute_force(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    fps = [plain_fingerprint(text) for _, text in docs]
    expected = [(docs[i][0], f"{fps[i]:016x}", docs[r][0]) for i, r in enumerate(plain_components(fps, 4))]
    assert sorted(map(tuple, QUERIES["op6_simhash"](spark, SF).collect())) == expected


def test_links_of_dense_and_chained_fingerprints(spark, monkeypatch):
    random.seed(3)
    fps = set()
    for _ in range(12):
        fp = random.getrandbits(64)
        for _ in range(40):  # walks of up to three bits, and crowds around one place
            fps.add(fp)
            fp ^= sum(1 << b for b in random.sample(range(64), random.randint(1, 5)))
    middle = random.getrandbits(64)
    fps |= {middle ^ sum(1 << b for b in random.sample(range(64), 2)) for _ in range(300)}
    fps = sorted(fp - (1 << 64) if fp >> 63 else fp for fp in fps)
    frame = spark.createDataFrame([(fp,) for fp in fps], "fp long")
    for block in (512, 20):
        monkeypatch.setattr(simhash, "BLOCK", block)
        for bits in (0, 1, 3, 4):
            found = {r.node: r.root for r in graph.components(simhash.links(frame, bits)).collect()}
            plain = plain_components([fp & (2**64 - 1) for fp in fps], bits)
            assert [found.get(fp, fp) for fp in fps] == [fps[r] for r in plain]


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    found = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(101)}, **{1000 + i: 1000 for i in range(200)}}


def test_odd_rows(spark):
    rows = [(1, None, 0), (2, "", 0), (None, " \n", 0), (4, "One two", 0), (4, "one TWO", 0), (None, "alone here", 0), (7, "x " * 30000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root int")
    found = simhash.near_duplicates(docs, 4, 4).select("doc_id", simhash.hexadecimal(F.col("fp")).alias("f"), "component_id").collect()
    by = sorted((r.doc_id or -1, r.f == "0" * 16, r.component_id) for r in found if r.f != f"{plain_fingerprint('alone here'):016x}")
    assert by == [(-1, True, 1), (1, True, 1), (2, True, 1), (4, False, 4), (4, False, 4), (7, False, 7)]
    assert [r.component_id for r in found if r.f == f"{plain_fingerprint('alone here'):016x}"] == [None]
    assert simhash.near_duplicates(docs.limit(0), 4, 4).count() == 0
