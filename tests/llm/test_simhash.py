from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from riskspark.llm import simhash
from riskspark.llm.graph import components


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def brute_components(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    distinct = sorted(set(prints))
    close = [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 2]
    group = grouped(close, distinct)
    least = {}
    for (i, _), f in zip(rows, prints):
        if i is not None:
            least[group[f]] = min(least.get(group[f], i), i)
    return sorted(((i is None, i, f, least.get(group[f])) for (i, _), f in zip(rows, prints)), key=str)


def edge_rows():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 4)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \t\n"), (None, "a b c"), (103, "A B\x0bC"), (103, "a b c")]
    return rows + [(104, "long text " * 20_000)]


@pytest.mark.parametrize("cell", [16, 1])
def test_components_match_brute_force(spark, monkeypatch, cell):
    # With cells of one, all members of shared cells go through Hamming balls.
    monkeypatch.setattr(simhash, "CELL", cell)
    rows = edge_rows()
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, f int")
    got = simhash.near_duplicates(df, "doc_id", "text").collect()
    mine = [(r[0] is None, r[0], r["f"] & (2**64 - 1), r["component_id"]) for r in got]
    assert sorted(mine, key=str) == brute_components(rows)


@pytest.mark.parametrize("cell", [16, 1])
def test_links_of_close_fingerprints(spark, monkeypatch, cell):
    monkeypatch.setattr(simhash, "CELL", cell)
    rng = np.random.default_rng(3)
    prints = {0, 3, 5, 1 << 63, (1 << 63) | 1}
    for center in rng.integers(0, 1 << 62, 4).tolist():
        prints |= {center ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (25, 2))}
    signed = [simhash._signed(p) for p in prints]
    links = simhash.links(spark.createDataFrame([(p,) for p in signed], "f long")).collect()
    assert all(((r["u"] ^ r["v"]) & (2**64 - 1)).bit_count() <= 2 for r in links)
    want = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    ours, theirs = grouped([tuple(r) for r in links], signed), grouped(want, signed)
    assert len({(ours[p], theirs[p]) for p in signed}) == len(set(ours.values())) == len(set(theirs.values()))


def test_lower_bound(spark):
    rng = random.Random(1)
    rows = [(simhash._signed(rng.getrandbits(64)), simhash._signed(rng.getrandbits(64))) for _ in range(50)]
    df = spark.createDataFrame(rows, "a long, b long")
    out = df.select("a", "b", simhash.manhattan(simhash.embedding(df.a), simhash.embedding(df.b)).alias("m"))
    for a, b, m in out.collect():
        a, b = a & (2**64 - 1), b & (2**64 - 1)
        counts = [abs((a >> s & 3).bit_count() - (b >> s & 3).bit_count()) for s in range(0, 64, 2)]
        assert m == sum(counts) <= (a ^ b).bit_count()


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df, "doc_id", "text").collect() == []
    assert simhash.keep_one(df).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(7, 7), (None, 3)]
    out = components(spark.createDataFrame(links, "u long, v long")).collect()
    found = {r["node"]: r["component"] for r in out}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 150)}


def groups_of(rows):
    """The group of every fingerprint, by brute force."""
    prints = sorted({plain_fingerprint(t) for _, t in rows})
    close = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2]
    return grouped(close, prints)


def family(rng, size, copies, edits):
    """Copies of one text with a few edits each; the text itself is not among them."""
    base = [f"word{rng.randint(0, 5000)}" for _ in range(size)]
    out = []
    for _ in range(copies):
        copy = list(base)
        for _ in range(rng.randint(*edits)):
            copy[rng.randrange(size)] = f"other{rng.randint(0, 9999)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("cell", [16, 2])
def test_one_of_each_group_stays(spark, monkeypatch, cell):
    """Families without their original, with many members in one cell, against brute force: no link is lost."""
    monkeypatch.setattr(simhash, "CELL", cell)
    rng = random.Random(8)
    texts = [t for size, edits in ((300, (0, 2)), (300, (2, 5)), (2000, (1, 3))) for t in family(rng, size, 60, edits)]
    texts += family(rng, 40, 20, (0, 0)) + [" ".join(f"w{rng.randint(0, 5000)}" for _ in range(80)) for _ in range(10)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    rows += [(970, None), (971, ""), (972, "two words"), (973, "two words"), (973, "two words"), (None, "Two Words"), (974, "one")]
    names = "doc_id long, text string, component_id string, k1 string, id string, rest string, lead string"
    df = spark.createDataFrame([(i, t, *"abcde") for i, t in rows], names)
    kept = simhash.keep_one(df).collect()
    assert kept[0].__fields__ == df.columns and tuple(kept[0])[2:] == tuple("abcde")
    group, least = groups_of(rows), {}
    for i, t in rows:
        if i is not None:
            g = group[plain_fingerprint(t)]
            least[g] = min(least.get(g, i), i)
    assert sorted(r["doc_id"] for r in kept) == sorted(least.values())


def test_one_of_each_group_of_the_given_documents_stays(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    group, least = groups_of(rows), {}
    for i, t in rows:
        g = group[plain_fingerprint(t)]
        least[g] = min(least.get(g, i), i)
    assert sorted(r["doc_id"] for r in simhash.keep_one(docs).collect()) == sorted(least.values())


def test_groups_without_an_id_of_their_own_stay(spark):
    rng = random.Random(12)
    base = [" ".join(f"word{rng.randint(0, 9000)}" for _ in range(200)) for _ in range(6)]
    rows = [(None, b) for b in base[:4]] + [(None, base[0].upper())]
    # Document 5 has texts of two groups, one of them shared with document 9.
    rows += [(5, base[4]), (5, base[5]), (9, base[5].upper()), (5, base[4])]
    # A text without id belongs to a group with one.
    rows += [(None, base[4].upper())]
    group = groups_of(rows)
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = [group[plain_fingerprint(r["text"])] for r in kept]
    assert sorted(found) == sorted(set(group.values())) and len(found) == 6
    assert sorted(str(r["doc_id"]) for r in kept) == ["5", "5", "None", "None", "None", "None"]
