import math

import numpy as np
import pytest

from tasteloom.llm import language as g
from tasteloom.llm.pieces import SPACE, Vocabulary

SCHEMA = "doc_id long, text string, lang string, score string"


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.load()


def ways(vocabulary, word):
    """All segmentations of a word, as tuples of piece numbers."""
    ids = {p: i for i, (p, ok) in enumerate(zip(vocabulary.pieces, vocabulary.usable)) if ok}
    text = SPACE + word

    def rest(at):
        if at == len(text):
            yield ()
        for end in range(at + 1, len(text) + 1):
            piece = ids.get(text[at:end])
            head = (piece,) if piece is not None else None
            if piece is None and end == at + 1:
                head = tuple(vocabulary.byte_ids[b] for b in text[at].encode())
            if head:
                for tail in rest(end):
                    yield head + tail

    return list(rest(0))


def test_forward_sums_and_expected_uses_match_enumeration(vocabulary):
    table = np.random.default_rng(1).normal(size=(len(vocabulary.pieces), 3)) - 9
    words = ["the", "thing", "a", "été", "漢字x", "other"]
    lattice = g.Lattice(vocabulary)
    (block,) = lattice.blocks(words)
    scores = block.scores(table)
    uses = block.uses(table, np.array([0, 1, 2, 0, 1, 2]), np.array([1, 2, 3, 4, 5, 6]))
    want = np.zeros_like(uses)
    for n, word in enumerate(words):
        paths = ways(vocabulary, word)
        for k in range(3):
            assert scores[n, k] == pytest.approx(math.log(sum(math.exp(sum(table[i, k] for i in path)) for path in paths)))
        k = n % 3
        whole = sum(math.exp(sum(table[i, k] for i in path)) for path in paths)
        for path in paths:
            for i in path:
                want[k, i] += (n + 1) * math.exp(sum(table[j, k] for j in path)) / whole
    assert np.allclose(uses, want)


def test_long_words_stay_finite(vocabulary):
    (block,) = g.Lattice(vocabulary).blocks(["xq" * 20_000])
    assert np.isfinite(block.scores(np.full((len(vocabulary.pieces), 2), -12.0))).all()


def test_learns_and_tells_languages(spark):
    en = "the quick brown fox jumps over the lazy dog and then it runs to the river"
    de = "der schnelle braune fuchs springt über den faulen hund und dann läuft er zum fluss"
    rows = [(i, en if i % 2 else de, "en" if i % 2 else "de", "x") for i in range(20)] + [(50, en, None, "x"), (51, None, "en", "x")]
    model = g.learn(spark.createDataFrame(rows, SCHEMA))
    assert model.languages == ("de", "en")
    asked = [("the fox and the dog",), ("der hund und der fluss",), (None,), ("",), ("12 345 !?",), ("½ ²",), ("the dog " * 9000,)]
    df = spark.createDataFrame(asked, "text string")
    got = [tuple(r["p"]) for r in df.select(g.predict(df["text"], model).alias("p")).collect()]
    assert [x[0] for x in got] == ["en", "de", "und", "und", "und", "und", "en"]
    assert all(0 <= x[1] <= 1 for x in got) and got[2][1] == 0.0


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([(1, "x", None, "x")], SCHEMA)
    assert g.learn(empty) is None
    assert empty.select(g.predict(empty["text"], None).alias("p")).first()["p"]["lang"] == "und"


def test_sums_of_tiny_probabilities_equal_those_in_logarithms():
    vocabulary = Vocabulary.load()
    rng = np.random.default_rng(2)
    table = np.log(rng.dirichlet(np.ones(len(vocabulary.pieces)), 3)).T.copy()
    words = ["a", "hello", "x" * 900, "\U0001F600" * 40, "wort", "\u4e00\u9fa5" * 60, "été" * 5] + [f"w{i}" for i in range(50)]
    (block,) = g.Lattice(vocabulary).blocks(words)
    want = block.sweep(block.weights(table))[block.last]
    assert want.min() < np.log(g.TINY) and np.allclose(block.scores(table), want, rtol=1e-10)
