"""Language of a text by unigram models over vocabulary pieces, summed over all segmentations.

Each language has a probability per piece of a fixed public vocabulary. The probability of a word is the
sum over all ways to write it as pieces, by the forward algorithm; no piece spans words, so a text is
the product of its words. The probabilities are learned by expectation maximisation: the expected use of
each piece, over all segmentations, becomes its probability of the next round.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.pieces import INDEX_CHARS, MODEL, PORTION_CHARS, SPACE, Encoder, Vocabulary
from tasteloom.sources.scratch import cut

ROUNDS = 2
SMOOTH = 0.1
# Languages that a model can hold: its size is this times the vocabulary.
MAX_LANGUAGES = 256
REMEMBERED = 1 << 18
WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    """``table[piece]`` has one log probability per language of ``languages``; ``prior`` too is logarithmic."""

    languages: tuple[str, ...]
    prior: np.ndarray
    table: np.ndarray
    vocabulary: Vocabulary

# Sums of probabilities below this are taken again in logarithms.
TINY = 1e-250


class Lattice:
    """All segmentations of many words into pieces; characters without a piece are written as bytes."""

    def __init__(self, vocabulary: Vocabulary):
        self.matcher = Encoder(vocabulary)
        self.byte_ids = np.array(vocabulary.byte_ids)

    def blocks(self, words: list[str]) -> Iterator["Block"]:
        at = 0
        while at < len(words):
            size, first = 0, at
            while at < len(words) and (at == first or size + len(words[at]) + 2 <= INDEX_CHARS):
                size += len(words[at]) + 2
                at += 1
            yield Block(self, words[first:at])


class Block:
    """Words laid end to end: nodes are places between characters, edges are pieces."""

    def __init__(self, lattice: Lattice, words: list[str]):
        self.lattice, self.words = lattice, words
        text = "".join([f"{SPACE}{w}\n" for w in words])
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<i4").copy()
        sizes = np.array([len(w) + 1 for w in words])
        self.first = np.r_[0, np.cumsum(sizes + 1)[:-1]]
        self.last = self.first + sizes
        codes[self.last] = -2
        start, number = lattice.matcher.matches(codes)
        stop = start + lattice.matcher.sizes[number]
        piece = lattice.matcher.ids[number]
        # One edge per character that is no piece; its bytes are looked up by edge number.
        covered = np.zeros(len(codes), dtype=bool)
        covered[start[stop == start + 1]] = True
        covered[self.last] = True
        bare = np.flatnonzero(~covered)
        self.raw = [lattice.byte_ids[list(text[i].encode("utf-8", "surrogatepass"))] for i in bare]
        start, stop = np.r_[start, bare], np.r_[stop, bare + 1]
        self.piece = np.r_[piece, np.full(len(bare), -1)]
        self.bare = len(piece) + np.arange(len(bare))
        self.word = np.repeat(np.arange(len(words)), sizes + 1)[start]
        self.start, self.stop, self.nodes = start, stop, len(codes)
        self.steps = int(sizes.max())

    def weights(self, table: np.ndarray) -> np.ndarray:
        """Logarithm of each edge's probability, one column per column of the table of logarithms."""
        out = table[np.maximum(self.piece, 0)]
        for edge, ids in zip(self.bare, self.raw):
            out[edge] = table[ids].sum(axis=0)
        return out

    def sweep(self, logs: np.ndarray, backwards: bool = False) -> np.ndarray:
        """Logarithm, per node, of the sum over all ways from its word's start (or to its end)."""
        base, source, target, order, steps = self._order(backwards)
        logs = logs[order]
        total = np.full((self.nodes, logs.shape[1]), -np.inf)
        total[base] = 0.0
        for a, b, ends in steps:
            ways = total[source[a:b]] + logs[a:b]
            # The largest term is taken out, so that words of any length stay within range.
            top = np.maximum.reduceat(ways, ends - a, axis=0)
            spread = np.repeat(top, np.diff(np.r_[ends, b]), axis=0)
            total[target[ends]] = top + np.log(np.add.reduceat(np.exp(ways - spread), ends - a, axis=0))
        return total

    def _order(self, backwards: bool = False) -> tuple:
        """(start of each word, edges' sources, targets, order of the edges, steps): a step is the edges from a to b, and
        where among them a new target begins; every step's sources lie in steps before it."""
        base = self.last if backwards else self.first
        source, target = (self.stop, self.start) if backwards else (self.start, self.stop)
        step = np.abs(target - base[self.word])
        order = np.argsort(step * self.nodes + target)
        source, target, step = source[order], target[order], step[order]
        heads = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
        cuts = np.searchsorted(step, np.arange(1, self.steps + 2))
        group = np.searchsorted(heads, cuts)
        steps = [
            (cuts[t], cuts[t + 1], heads[group[t] : group[t + 1]]) for t in range(self.steps) if cuts[t] < cuts[t + 1]
        ]
        return base, source, target, order, steps

    def scores(self, table: np.ndarray) -> np.ndarray:
        """Log probability of each word in each language.

        Probabilities are added as they are; words whose sum comes near the smallest double are summed in logarithms.
        """
        base, source, target, order, steps = self._order()
        chance = np.exp(self.weights(table))[order]
        total = np.zeros((self.nodes, chance.shape[1]))
        total[base] = 1.0
        for a, b, ends in steps:
            total[target[ends]] = np.add.reduceat(total[source[a:b]] * chance[a:b], ends - a, axis=0)
        told = total[self.last]
        tiny = np.flatnonzero((told < TINY).any(axis=1))
        out = np.log(np.maximum(told, TINY))
        if len(tiny):
            for part in self.lattice.blocks([self.words[i] for i in tiny]):
                done, tiny = tiny[: len(part.words)], tiny[len(part.words) :]
                out[done] = part.sweep(part.weights(table))[part.last]
        return out

    def uses(self, table: np.ndarray, language: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Expected uses (language, piece) where word i occurs ``times[i]`` times in ``language[i]``."""
        logs = self.weights(table)[np.arange(len(self.start)), language[self.word]][:, None]
        ahead, behind = self.sweep(logs), self.sweep(logs, backwards=True)
        share = ahead[self.start] + logs + behind[self.stop] - ahead[self.last][self.word]
        use = times[self.word] * np.exp(np.minimum(share[:, 0], 0.0))
        out = np.zeros((table.shape[1], table.shape[0]))
        own = self.piece >= 0
        np.add.at(out, (language[self.word[own]], self.piece[own]), use[own])
        for edge, ids in zip(self.bare, self.raw):
            np.add.at(out, (language[self.word[edge]], ids), use[edge])
        return out


def word_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, word, n) over all words of all texts; tasks count their batches first."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: dict[str, Counter] = {}
            for language, body in zip(batch[lang], batch[text]):
                counts.setdefault(language, Counter()).update(words(body))
            rows = [(k, w, n) for k, c in counts.items() for w, n in c.items()]
            yield pd.DataFrame(rows, columns=["lang", "word", "n"])

    counted = docs.select(lang, text).mapInPandas(count, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def words(text: str | None) -> list[str]:
    """Runs of letters in lower case: digits and signs say nothing of the language."""
    return WORD.findall(text.lower()) if text else []


def learn(
    docs: DataFrame, lang: str = "lang", text: str = "text", vocabulary_path: str = MODEL, rounds: int = ROUNDS,
    smooth: float = SMOOTH,
) -> Model | None:
    """A model from the rows with a language and a text; None if there are none.

    Every word of every text counts. The counts of distinct words are a table; each round
    sends the model to the tasks and brings back one number per language and piece used.
    """
    vocabulary = Vocabulary.load(vocabulary_path)
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = known.groupBy(lang).agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return None
    sizes = sorted((r[lang], r["n"]) for r in sizes)
    languages = tuple(name for name, _ in sizes)
    total = sum(n for _, n in sizes)
    prior = np.array([log(n / total) for _, n in sizes])
    counts = cut(word_counts(known, text, lang), "words")
    pieces = len(vocabulary.pieces)
    table = np.full((pieces, len(languages)), -log(pieces))
    for _ in range(rounds):
        uses = np.full((len(languages), pieces), smooth)
        for row in _expected(counts, languages, vocabulary, table).collect():
            uses[row["lang"], row["piece"]] += row["n"]
        table = np.log(uses / uses.sum(axis=1, keepdims=True)).T.copy()
    return Model(languages, prior, table, vocabulary)


def _expected(counts: DataFrame, languages: tuple[str, ...], vocabulary: Vocabulary, table: np.ndarray) -> DataFrame:
    number = {name: i for i, name in enumerate(languages)}

    def expect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice = Lattice(vocabulary)
        uses = np.zeros((len(languages), len(vocabulary.pieces)))
        for batch in batches:
            language, times = batch["lang"].map(number).to_numpy(), batch["n"].to_numpy()
            done = 0
            for block in lattice.blocks(list(batch["word"])):
                part = slice(done, done + len(block.first))
                uses += block.uses(table, language[part], times[part])
                done = part.stop
        lang, piece = np.nonzero(uses)
        yield pd.DataFrame({"lang": lang, "piece": piece, "n": uses[lang, piece]})

    rows = counts.mapInPandas(expect, "lang int, piece int, n double")
    return rows.groupBy("lang", "piece").agg(F.sum("n").alias("n"))


def _portions(texts: pd.Series) -> Iterator[list[str | None]]:
    """The texts in lists of about PORTION_CHARS characters: their words are Python strings."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text or "")
        if size >= PORTION_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def predict(text: Column, model: Model | None) -> Column:
    """struct(lang, score): the likeliest language of each whole text and its posterior probability.

    Texts that are null or have no letter get ``und`` and 0, as does every text without a model.
    Equal scores go to the first language by name.
    """
    if model is None:
        return F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))

    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        lattice = Lattice(model.vocabulary)
        place: dict[str, int] = {}
        scores = np.empty((1024, len(model.languages)))
        for batch in texts:
            out = []
            for portion in _portions(batch):
                if len(place) > REMEMBERED:
                    place = {}
                split = [words(t) for t in portion]
                new = list({w: None for ws in split for w in ws if w not in place})
                place.update(zip(new, range(len(place), len(place) + len(new))))
                if len(place) > len(scores):
                    scores = np.resize(scores, (2 * len(place), len(model.languages)))
                done = len(place) - len(new)
                for block in lattice.blocks(new):
                    scores[done : done + len(block.words)] = block.scores(model.table)
                    done += len(block.words)
                for ws in split:
                    if not any(c.isalpha() for w in ws for c in w):
                        out.append((UNKNOWN, 0.0))
                        continue
                    total = scores[[place[w] for w in ws]].sum(axis=0) + model.prior
                    best = int(np.argmax(total))
                    out.append((model.languages[best], float(1 / np.exp(total - total[best]).sum())))
            yield pd.DataFrame(out, columns=["lang", "score"])

    return F.pandas_udf(judge, "lang string, score double")(text)
