import random

from tasteloom.llm import decontaminate as d

DOCS = "doc_id long, text string, leaks string, item_id long"


def edit_distance_in(pattern, text):
    """Least edit distance of the pattern to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != c)))
        row = new
    return min(row)


def random_text(rng, n):
    return "".join(rng.choice("abcde ") for _ in range(n))


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        i = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[i] = rng.choice("xyz")
        elif kind == 1:
            out.insert(i, "q")
        else:
            del out[i]
    return "".join(out)


def test_myers_equals_the_table():
    rng = random.Random(2)
    for _ in range(60):
        p, t = random_text(rng, rng.randrange(1, 90)), random_text(rng, rng.randrange(0, 120))
        assert d.myers(d.masks(p), len(p), t, anchored=False)[0] == edit_distance_in(p, t)


def test_finds_all_within_budget_and_nothing_else():
    rng = random.Random(4)
    items = [(i, d.normal(random_text(rng, rng.randrange(30, 140)))) for i in range(12)]
    finder = d.Finder(items, 0.1)
    for trial in range(120):
        item, text = rng.choice(items)
        passage = edited(rng, text, rng.randrange(0, len(text) // 7))
        whole = random_text(rng, rng.randrange(0, 200)) + passage + random_text(rng, rng.randrange(0, 200))
        got = {m["item_id"]: m["distance"] for m in finder.leaks(whole)}
        want = {}
        for i, t in items:
            distance = edit_distance_in(t, d.normal(whole))
            if distance <= int(len(t) * 0.1):
                want[i] = distance
        assert got == want


def test_places_are_those_of_the_original_text():
    text = "  Pre \n fix THE  Item\tis HERE, ok. Suffix"
    (leak,) = d.Finder([(1, d.normal("the item is here, ok."))], 0.1).leaks(text)
    assert text[leak["start"]:leak["stop"]] == "THE  Item\tis HERE, ok." and leak["distance"] == 0


def test_tables_with_nulls_and_clashing_names(spark):
    item = "the quick brown fox jumps over the lazy dog again and again"
    docs = spark.createDataFrame([
        (1, "x " + item.upper() + " y", "old", 1), (1, "x " + item, "old", 1), (2, None, None, None), (3, "", "", 0),
        (None, item, "", 0), (4, "clean text " * 3000, "", 0)], DOCS)
    bench = spark.createDataFrame([(7, item, "z"), (8, None, "z"), (9, "", "z"), (None, "clean text", "z"), (7, item, "z")],
                                  "item_id long, text string, leaks string")
    got = d.with_leaks(docs, bench).collect()
    assert sorted((str(r["doc_id"]), [x["item_id"] for x in r["leaks"]]) for r in got) == [
        ("1", [7]), ("1", [7]), ("2", []), ("3", []), ("4", []), ("None", [7])]
    clean = d.decontaminate(docs, bench)
    assert clean.columns == docs.columns and sorted(r["doc_id"] for r in clean.collect()) == [2, 3, 4]
    assert d.decontaminate(docs, bench.limit(0)).count() == 6 and d.decontaminate(docs.limit(0), bench).count() == 0


def test_benchmark_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(d, "BLOCK_CHARS", 100)
    rng = random.Random(9)
    items = [(i, random_text(rng, 80)) for i in range(7)]
    docs = spark.createDataFrame([(i, f"zz {t} zz") for i, t in items], "doc_id long, text string")
    got = d.with_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert all(r["doc_id"] in [x["item_id"] for x in r["leaks"]] for r in got)
