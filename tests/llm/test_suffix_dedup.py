import hashlib
import random

import numpy as np
import pytest

from tasteloom.llm import suffix_dedup as s

SCHEMA = "doc_id long, text string, spans string, key string"


def brute(rows, size=50):
    first = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, t in sorted((x for x in texts if x[0] is not None), key=lambda x: x[0]):
        for j in range(len(t) - size + 1):
            first.setdefault(t[j:j + size], i)
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for j in range(len(t) - size + 1 if i is not None else 0):
            if first[t[j:j + size]] < i:
                gone[j:j + size] = b"\1" * size
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for j, g in enumerate(gone) if g and not (j and gone[j - 1]))
        out.append((str(i), len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(spark, rows, **how):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    got = s.repeated_spans(df, **how).collect()
    return sorted((str(r["key"]), r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in got)


def corpus(seed):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdé \0") for _ in range(rng.randrange(30, 300))) for _ in range(6)]
    rows = []
    for i in rng.sample(range(1000), 60):
        parts = [rng.choice([*passages, "".join(rng.choice("ab") for _ in range(40)), "z" * 90, ""]) for _ in range(4)]
        text = "".join(parts)
        rows.append((i, text[rng.randrange(0, 20):]))
    rows += [(2000 + i, rows[i][1]) for i in range(20)] + [rows[0], rows[0], (None, rows[1][1]), (3000, None), (3001, "")]
    return rows + [(4000, passages[0] * 300)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, monkeypatch, seed):
    rows = corpus(seed)
    assert found(spark, rows) == brute(rows)
    # Many portions, buckets, collections and blocks of rows.
    monkeypatch.setattr(s, "CUT_BYTES", 2000)
    monkeypatch.setattr(s, "BUCKET_BYTES", 3000)
    monkeypatch.setattr(s, "APPLY_BYTES", 3000)
    monkeypatch.setattr(s, "COLLECTION", 7)
    monkeypatch.setattr(s, "ROWS", 333)
    monkeypatch.setattr(s, "STEP", 500)
    assert found(spark, rows) == brute(rows)


def shared_passage(texts=400):
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    passage = word(120)
    return [(i, word(rng.randrange(150)) + (passage if i % 3 == 0 else "") + word(rng.randrange(150))) for i in range(texts)]


def test_pieces_at_the_ends_of_a_common_passage_have_anchors_of_their_own(monkeypatch):
    texts = [np.frombuffer(t.encode(), dtype=np.uint8) for _, t in shared_passage()]
    data, bounds = np.concatenate(texts), np.cumsum([0, *map(len, texts)])

    def most(crowded):
        starts, stops, anchors = s.cut_pieces(data, bounds, crowded=crowded)
        different = {(int(h), data[a:b].tobytes()) for a, b, h in zip(starts, stops, anchors)}
        return max(np.unique([h for h, _ in different], return_counts=True)[1])

    cells = np.bincount(s.cells_of(s.anchor_hashes(data)), minlength=s.CELLS)
    assert most(None) > 50 and most(cells > 20) < 10


def test_crowded_strings_change_no_result(spark, monkeypatch):
    rows = shared_passage() + corpus(7)
    monkeypatch.setattr(s, "CROWD_LEAST", 20)
    monkeypatch.setattr(s, "BUCKET_BYTES", 3000)
    own = spark.createDataFrame([(i, (t or "").encode()) for i, t in rows], "key long, text binary")
    assert s.crowded_cells(own, 1000) is not None
    assert found(spark, rows) == brute(rows)


def test_other_window_sizes_and_empty_tables(spark):
    rows = corpus(3)[:30]
    assert found(spark, rows, size=20) == brute(rows, 20)
    assert found(spark, []) == [] and found(spark, [(1, None)]) == brute([(1, None)])


def test_pieces_longer_than_a_byte_can_count(spark):
    rng = random.Random(4)
    passages = ["".join(rng.choice("abcdefgh") for _ in range(n)) for n in (210, 400, 900)]
    rows = [(i, "".join(rng.choice("xyz") for _ in range(i)) + passages[i % 3] + f"end {i}") for i in range(12)]
    assert found(spark, rows, size=200) == brute(rows, 200)


def test_kept_bytes_are_returned_on_request(spark):
    text = "this passage is quite long and it stands in both of the documents."
    df = spark.createDataFrame([(1, text, "x", "y"), (2, "A " + text + " B", "x", "y")], SCHEMA)
    kept = {r["key"]: bytes(r["kept"]) for r in s.repeated_spans(df, keep=True).collect()}
    assert kept == {1: text.encode(), 2: b"A  B"}


def test_every_window_lies_in_one_piece():
    rng = np.random.default_rng(5)
    texts = [rng.integers(97, 100, n).astype(np.uint8) for n in (0, 10, 49, 50, 51, 400)] + [np.full(500, 97, np.uint8)]
    data, bounds = np.concatenate(texts), np.cumsum([0, *map(len, texts)])
    starts, stops, _ = s.cut_pieces(data, bounds)
    windows = sorted(i for a, b in zip(starts, stops) for i in range(a, b - 49))
    want = [b + i for b, t in zip(bounds, texts) for i in range(len(t) - 49)]
    assert windows == want and (stops - starts).max() <= 84


def test_columns_are_a_sorted_collection(tmp_path, monkeypatch):
    monkeypatch.setattr(s, "ROWS", 11)
    rng = random.Random(8)
    texts = [bytes(rng.choice(b"abc") for _ in range(rng.randrange(3, 9))) for _ in range(12)]
    files = s.ExternalColumns(str(tmp_path), len(texts))
    who, at = np.arange(12), np.arange(12)
    for n in range(1, 9):
        live = np.array([len(texts[i]) >= n for i in who])
        who, at = who[live], at[live]
        by = np.argsort(at)
        who, at = who[by], at[by]
        at = files.insert(at, np.array([texts[i][len(texts[i]) - n] for i in who], dtype=np.uint8), who, n)
    whole = {name: np.concatenate([files._read(name, a) for a in range(0, files.rows, 11)]) for name in files.FIELDS}
    suffixes = [texts[p][len(texts[p]) - n:] for p, n in zip(whole["piece"], whole["length"])]
    assert suffixes == sorted(suffixes) and len(suffixes) == 12 + sum(map(len, texts))

    def common(x, y):
        n = 0
        while n < min(len(x), len(y)) and x[n] == y[n]:
            n += 1
        return n

    assert whole["prefix"][1:].tolist() == [common(x, y) for x, y in zip(suffixes, suffixes[1:])]
    files.close()
