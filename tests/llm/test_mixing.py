import hashlib
import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest

from tasteloom.llm import mixing
from tests.test_plans import plan

SCHEMA = "doc_id long, text string, source string, size long, target string, _key string, _place int, n int"


def brute_targets(sizes, weights=(5, 2, 1), share=Fraction(3, 2), repeats=2):
    """Share by weight, cut at the cap, share the excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, excess, free = {s: Fraction(0) for s in names}, share * sum(sizes.values()), set(names)
    while excess and free:
        heavy = sum(weight[s] for s in free)
        for s in free:
            target[s] += excess * weight[s] / heavy
        excess = sum((target[s] - repeats * sizes[s] for s in free if target[s] > repeats * sizes[s]), Fraction(0))
        for s in list(free):
            if target[s] >= repeats * sizes[s]:
                target[s] = Fraction(repeats * sizes[s])
                free.discard(s)
    return target


def brute(rows):
    words = [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, s in rows]
    sizes = defaultdict(int)
    for _, s, n in words:
        sizes[s] += n
    targets, out = brute_targets(sizes), []
    for source, size in sizes.items():
        own = [(i is None, hashlib.md5(f"mix:{i}".encode()).hexdigest(), i or 0, n) for i, s, n in words if s == source]
        copies, rest = divmod(int(targets[source]), size) if size else (0, 0)
        for none, _, i, n in sorted(own):
            part = min(n, rest)
            rest -= part
            out.append((None if none else i, source, n, size, round(float(targets[source]), 6), copies * n + part))
    return sorted(out, key=repr)


def found(spark, rows):
    df = spark.createDataFrame([(i, t, s, 1, "x", "y", 2, 3) for i, t, s in rows], SCHEMA)
    got = mixing.mix(df).collect()
    assert all(0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"] + r["part"] for r in got)
    return sorted(((r["doc_id"], r["source"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in got), key=repr)


def test_equals_brute_force_with_a_hot_source_and_edge_rows(spark):
    rng = random.Random(5)
    rows = [(i, " ".join("w" for _ in range(rng.randrange(60))), rng.choice("aaaaabéz")) for i in range(300)]
    rows += [(300 + i, "one\ttwo three x \x0bfour", None) for i in range(30)]
    rows += [(7, rows[7][1], rows[7][2])] * 3 + [(None, "a b c", "b"), (None, None, "b"), (None, "a b c", "b")]
    rows += [(400, None, "empty"), (401, "", "empty"), (402, " \n", None), (403, "long " * 50_000, "z"), (404, "x", "Z")]
    got = found(spark, rows)
    assert got == brute(rows) == found(spark, rows[::-1])
    taken = defaultdict(int)
    for _, s, _, _, target, n in got:
        taken[s, target] += n
    assert all(n == int(target) for (_, target), n in taken.items())


@pytest.mark.parametrize("rows", [[], [(1, None, "a")], [(1, "a b", None)], [(1, "a b c", "a"), (2, "d", "b")]])
def test_small_tables(spark, rows):
    assert found(spark, rows) == brute(rows)


def test_targets_of_many_sources(spark):
    rng = random.Random(2)
    for n in (1, 2, 7, 40):
        sizes = {f"s{i:03d}": rng.choice([0, 1, 5, 50, 3000]) for i in range(n)} | {None: 9}
        table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = mixing.budgets(table).collect()
        want = brute_targets(sizes)
        assert {r["source"]: round(r["target"], 6) for r in got} == {s: round(float(t), 6) for s, t in want.items()}


@pytest.mark.parametrize("size", [20_000_000, 50_000_000, 10**12])
def test_targets_of_large_sources(spark, size):
    """The words left to share may fit in 32 bits while their product with a weight does not."""
    sizes = {f"s{i:02d}": size + i for i in range(20)}
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.budgets(table).collect()}
    assert got == pytest.approx({s: float(t) for s, t in brute_targets(sizes).items()}, rel=1e-12)


def test_plan_is_native(spark):
    df = spark.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string")
    text = plan(mixing.mix(df))
    assert not any(word in text for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
