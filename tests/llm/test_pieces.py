import numpy as np
import pytest
import sentencepiece

from tasteloom.llm import pieces as p

SCHEMA = "doc_id long, text string, ids string, decoded long"
TEXTS = [
    "Hello world", "", " ", "  two  spaces  ", "\n\ttabs\r\n", "日本語 and 😀 mixed, ñandú!", "a" * 3000, "ab " * 20_000,
    "x" + "yz" * 200 + " end", None, "Hello world", "naïve café — “quotes”", "\0nul\0", "<s> </s> <unk> <0x0A>",
]


@pytest.fixture(scope="module")
def vocabulary():
    return p.Vocabulary.load()


def test_ids_are_those_of_the_public_library(vocabulary):
    public = sentencepiece.SentencePieceProcessor(model_file=p.MODEL)
    ids, sizes = p.Encoder(vocabulary).encode(TEXTS + ["a▁b ▁"])
    got = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
    assert got == [public.encode(t) if t else [] for t in TEXTS + ["a▁b ▁"]]


def test_small_index_blocks_and_forgetting_change_nothing(vocabulary, monkeypatch):
    want = p.Encoder(vocabulary).encode(TEXTS)
    monkeypatch.setattr(p, "INDEX_CHARS", 40)
    monkeypatch.setattr(p, "REMEMBERED", 3)
    encoder = p.Encoder(vocabulary)
    for _ in range(2):
        got = encoder.encode(TEXTS)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_suffix_array_orders_by_the_first_codes():
    codes = np.frombuffer("banana-bandana-".encode("utf-32-le"), dtype="<i4")
    text = "banana-bandana-"
    got = p.suffix_array(codes, 4).tolist()
    assert sorted(got) == list(range(len(text)))
    keys = [text[i:i + 4] for i in got]
    assert keys == sorted(keys)


def test_matches_are_all_occurrences(vocabulary):
    encoder = p.Encoder(vocabulary)
    text = "▁the▁then\n▁other\n"
    codes = np.frombuffer(text.encode("utf-32-le"), dtype="<i4").copy()
    places, numbers = encoder.matches(codes)
    got = {(int(i), vocabulary.pieces[encoder.ids[n]]) for i, n in zip(places, numbers)}
    usable = [x for x, ok in zip(vocabulary.pieces, vocabulary.usable) if ok]
    assert got == {(i, x) for x in usable for i in range(len(text)) if text.startswith(x, i)}


def test_round_trip_in_tables(spark, vocabulary):
    df = spark.createDataFrame([(i, t, "old", 0) for i, t in enumerate(TEXTS)] + [(None, "x", "old", 0)], SCHEMA)
    encoded = p.with_ids(df, vocabulary, check="fine")
    rows = p.with_text(encoded, vocabulary).collect()
    assert len(rows) == len(TEXTS) + 1 and all(r["decoded"] == r["text"] and r["fine"] for r in rows)
    by = {r["doc_id"]: r["ids"] for r in rows}
    assert by[9] is None and by[1] == [] and by[0] == by[10]
    assert p.with_ids(df.limit(0), vocabulary).collect() == []
