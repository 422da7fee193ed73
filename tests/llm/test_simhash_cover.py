"""SimHash groups against all pairs, the guarantee of the masks, and the odd rows."""

import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from tidemark.llm import queries, simhash_cover

SF = "/root/testdata/sf0.001"


def fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)})) if w]
    grams = [" ".join(words[k : k + 3]) for k in range(max(len(words) - 2, 1))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode("utf-8", "surrogatepass"), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(prints):
    """Smallest id reachable over pairs within three bits, by trying all pairs."""
    top = {k: k for k in prints}

    def root(k):
        while top[k] != k:
            top[k] = k = top[top[k]]
        return k

    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            x, y = sorted((root(a), root(b)))
            top[y] = x
    return {k: root(k) for k in prints}


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_every_choice_of_places_leaves_a_mask(radius):
    for places in (list(range(64)), list(range(5, 17))):
        made = simhash_cover.masks(places, radius)
        assert all(any(not m & sum(1 << p for p in off) for m in made) for off in itertools.combinations(places, radius))
        assert len(made) == 2 ** (radius + 1) - 1 and all(m and not m & ~sum(1 << p for p in places) for m in made)


def test_forest_joins_what_all_pairs_join():
    rng = np.random.default_rng(2)
    for _ in range(30):
        fp = rng.integers(0, 2**9, 60).astype(np.uint64)
        fp = np.unique(fp)
        a, b = simhash_cover.forest(fp, 1)
        top = groups_of_links(len(fp), zip(a, b))
        want = groups_of_links(len(fp), ((i, j) for i in range(len(fp)) for j in range(i) if int(fp[i] ^ fp[j]).bit_count() <= 1))
        assert top == want and len(a) == len(fp) - len(set(top))


def groups_of_links(n, pairs):
    top = list(range(n))
    for a, b in pairs:
        x, y = sorted((top[a], top[b]))
        top = [x if t == y else t for t in top]
    return top


def near(rng, count):
    """Clusters of fingerprints around few centres, some of them dense, with steps of up to four bits."""
    out = {}
    for k in range(count):
        base = rng.choice([0, (1 << 64) - 1, 0x123456789ABCDEF0]) if k % 3 else rng.getrandbits(64)
        for _ in range(rng.randint(0, 9)):
            base ^= 1 << rng.randrange(64) if k % 2 else 1 << rng.randrange(12)
        out[k] = base
    return out


@pytest.mark.parametrize("most", [1024, 8])
def test_links_join_what_all_pairs_join(spark, monkeypatch, most):
    monkeypatch.setattr(simhash_cover, "MOST", most)
    prints = near(random.Random(most), 700)
    first = {}
    for k, fp in prints.items():
        first.setdefault(fp, k)
    frame = spark.createDataFrame([(k, fp - (1 << 64) if fp >> 63 else fp) for fp, k in first.items()], "node long, fp long").repartition(3)
    got = {r.node: r.component for r in simhash_cover.components(simhash_cover.links(frame)).collect()}
    assert {k: got.get(k, k) for k in first.values()} == groups({k: fp for fp, k in first.items()})


def test_long_lists_of_hot_buckets(spark, monkeypatch):
    monkeypatch.setattr(simhash_cover, "BROADCAST_BUCKETS", 0)
    monkeypatch.setattr(simhash_cover, "MOST", 30)
    frame = spark.createDataFrame([(k, k) for k in range(200)], "node long, fp long")
    assert {r.component for r in simhash_cover.components(simhash_cover.links(frame)).collect()} == {0}


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = {k: fingerprint(t) for k, t in docs.items()}
    want = groups(prints)
    got = queries.QUERIES["op11_simhash_cover"](spark, SF).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(k, f"{prints[k]:016x}", want[k]) for k in docs} and len(got) == len(docs)
    assert any(r.doc_id != r.component_id for r in got)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(simhash_cover, "BLOCK", 100)
    texts = [None, "", " \t\n", "one", "ONE", "two words", "Two  words", "a b c d e f g", "a b c d e f g", "é\x0bÉ ü\x85x", "w " * 5000 + "end", "Ää b"]
    given = [(k, t, "x", 0) for k, t in enumerate(texts)] + [(3, "one", "x", 0), (None, "one", "x", 0)]
    frame = spark.createDataFrame(given, "doc_id long, text string, fp string, node int").repartition(3)
    found = simhash_cover.link_groups(frame).collect()
    want = groups({k: fingerprint(t) for k, t in enumerate(texts)})
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in found) == sorted((str(k), f"{fingerprint(t):016x}", str(want.get(k))) for k, t, *_ in given)
    assert want[1] == want[2] == 0 and want[4] == 3 and want[6] == 5 and want[8] == 7
    assert simhash_cover.link_groups(frame.where("doc_id = 99")).count() == 0
    named = simhash_cover.link_groups(frame.selectExpr("concat('d', doc_id) as name", "text as body"), id_col="name", text_col="body")
    assert named.columns == ["name", "fingerprint", "component_id"] and named.where("name = 'd6' and component_id = 'd5'").count() == 1
