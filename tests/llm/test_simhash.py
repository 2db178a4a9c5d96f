import random

import numpy as np
import xxhash

from tasteloom.llm import simhash

SCHEMA = "doc_id long, text string, fp string, k string"


def slow_fingerprint(text, n=3):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


TEXTS = [None, "", " \n ", "One", "one TWO", "a b c d e", "A b  c\td e", "É é x\u00a0y z w", "w " * 5000 + "end"]


def test_fingerprint_equals_the_definition():
    for text in TEXTS:
        assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_groups_equal_brute_force(spark):
    rng = random.Random(5)
    values = [rng.getrandbits(64) for _ in range(60)]
    for v in values[:40]:
        for _ in range(3):
            values.append(v ^ (1 << rng.randrange(64)) ^ rng.choice([0, 1 << rng.randrange(64)]))
    values = sorted({v - (1 << 64) if v >> 63 else v for v in values})
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    got = {frozenset(r) for r in simhash.near_pairs(df).collect()}
    mask = (1 << 64) - 1
    want = {frozenset((a, b)) for a in values for b in values if a < b and bin((a ^ b) & mask).count("1") <= 2}
    assert got == want and want


def test_components_ties_and_edge_rows(spark):
    rows = [(i, t, "x", "y") for i, t in enumerate(TEXTS)] + [(3, "One", "x", "y"), (None, "lone words here", "x", "y")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[0]["component_id"] == by[1]["component_id"] == by[2]["component_id"] == 0 and by[0]["fp"] == 0
    assert by[6]["component_id"] == 5 and by[None]["component_id"] is None
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def bits(a, b):
    return bin(a ^ b).count("1")


def brute_components(rows):
    """Smallest key that each row's fingerprint reaches in steps of at most two bits."""
    prints = {p: None for p in (slow_fingerprint(t) for _, t in rows)}
    left, out = set(prints), {}
    while left:
        group, todo = set(), [left.pop()]
        while todo:
            p = todo.pop()
            group.add(p)
            near = {q for q in left if bits(p, q) <= 2}
            left -= near
            todo += near
        keys = [i for i, t in rows if i is not None and slow_fingerprint(t) in group]
        out |= {p: min(keys, default=None) for p in group}
    return out


def corpus(rng):
    """Texts, exact copies, copies with a word changed far in, and edge rows."""
    rows = []
    for i in range(40):
        base = [f"w{rng.randrange(5000)}" for _ in range(800)]
        rows.append((10 * i + 1, " ".join(base)))
        rows += [(10 * i + 2 + j, " ".join(base[:-1] + [f"end{j % 2}"])) for j in range(3)]
    rows += [(1000 + i, rows[0][1]) for i in range(50)] + [(2000, None), (2001, ""), (2000, None), (None, "x"), (5000, "long " * 60_000)]
    return rows + [(9, rows[4][1]), (9, "a text of its own"), (3000, "one more text here"), (3000, "one more text here")]


def test_one_of_each_equals_brute_force_with_clashing_names(spark):
    rows = corpus(random.Random(1))
    roots = brute_components(rows)
    schema = "doc_id long, text string, kept long, n int, k string, row string, d string, component_id long, fp string, key string"
    df = spark.createDataFrame([(i, t, 1, 2, "a", "b", "c", 3, "d", "e") for i, t in rows], schema)
    got = simhash.one_of_each(df)
    kept = [r["doc_id"] for r in got.collect()]
    leads = {i for i, t in rows if i is not None} - {i for i, t in rows if i is not None and roots[slow_fingerprint(t)] < i}
    assert got.columns == df.columns and sorted(k for k in kept if k is not None) == sorted(leads) and kept.count(None) == 1
    assert 1000 not in leads and 3000 in leads and len(leads) < len(rows) / 2
    told = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(df).collect() if r["doc_id"] not in (9, None)}
    assert told == {i: roots[slow_fingerprint(t)] for i, t in rows if i not in (9, None)}
    assert simhash.one_of_each(spark.createDataFrame([], schema)).collect() == []
