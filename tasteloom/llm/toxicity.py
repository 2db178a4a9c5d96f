"""Toxicity by weak supervision: many voters, a generative model of them, a linear classifier.

Voters speak for one class or abstain: words of fixed and of mined lexicons and ways of writing speak for "toxic",
the absence of all of them and quiet writing for "clean". The generative model has, per class, how often a
voter speaks given whether its parent in a tree of voters does; the tree joins the voters that go together most beyond
what the class explains, so voters that repeat each other count once. The labels of the training rows are one
more voter, whose accuracy is estimated like the others'. Expectation maximisation runs over the vote patterns of all
documents until the likelihood stands still. The posterior it gives is what the classifier learns.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.sources.scratch import cut

# Words of abuse in four languages.
LEXICONS = {
    "en": "idiot moron stupid trash scum loser pathetic disgusting worthless clown fool dumb hate",
    "de": "idiot trottel dumm abschaum verlierer widerlich wertlos arschloch depp",
    "fr": "idiot imbécile stupide ordure minable dégoûtant pathétique connard crétin",
    "es": "idiota imbécil estúpido basura escoria perdedor patético asqueroso inútil",
}
PREFIXES = (4, 5, 6, 7)
# Features in fewer labelled documents, or with a lower bound of their log odds below this, are not mined.
LEAST_DOCS, LEAST_ODDS, ERRORS = 4, 1.0, 2.0
# Most columns of the classifier for mined words, the surest ones, and how many of them are voters.
WORDS, MINED_VOTERS = 1024, 44
# Bound of the labelled rows that the classifier is fitted on.
SAMPLE = 20_000
# The label voter's accuracy at the start, and the weight in rows of that opinion.
LABEL_ACCURACY, LABEL_ROWS = 0.98, 10.0
# Rounds end when a round gains less than this likelihood per row.
GAIN, MOST_ROUNDS = 1e-5, 200
RIDGE = 0.05
LETTERS = re.compile(r"[^\W\d_]+")
UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
FEATURES = "patterns array<double>, found array<int>, votes long"


def tokens(text: str) -> set[str]:
    """Distinct words of letters in lower case."""
    out: set[str] = set()
    for word in set(text.lower().split()):
        if word.isalpha():
            out.add(word)
        else:
            out.update(LETTERS.findall(word))
    return out


def features(words: set[str]) -> set[str]:
    """The words, and their beginnings marked with a star."""
    out = set(words)
    for word in words:
        size = len(word)
        for n in PREFIXES:
            if size < n:
                break
            out.add(word[:n] + "*")
    return out


def patterns(text: str, count: int) -> list[float]:
    """Numbers about the way of writing, each between 0 and about 2."""
    size = max(len(text), 1)
    upper = len(UPPER.findall(text))
    return [
        upper / size, float("!!" in text), min(text.count("!") * 100 / size, 1.0), float("??" in text),
        float(np.log10(1 + count) / 4),
    ]


@dataclass(frozen=True)
class Model:
    """Feature words, the surest first, the classifier's weights, and what the label model estimates of each voter:
    the chance that a text for which it speaks is toxic. The last entry is of the labels."""

    words: tuple[str, ...]
    weights: np.ndarray
    toxic_if_said: np.ndarray

    def score(self, text: str | None) -> float:
        found, shape = extract(text or "", {w: i for i, w in enumerate(self.words)})
        return float(self.scores([found], [shape])[0])

    def scores(self, found: list, shapes: list) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(design(found, shapes, len(self.words)) @ self.weights, -30, 30)))


def extract(text: str, place: dict[str, int]) -> tuple[list[int], list[float]]:
    """(numbers of the feature words in the text, pattern numbers)."""
    words = tokens(text)
    found = set()
    get = place.get
    for word in words:
        if (i := get(word)) is not None:
            found.add(i)
        size = len(word)
        for n in PREFIXES:
            if size < n:
                break
            if (i := get(word[:n] + "*")) is not None:
                found.add(i)
    return sorted(found), patterns(text, len(words))


def design(found: list, shapes: list, words: int) -> np.ndarray:
    """Rows of the classifier: feature words, pattern numbers, how many words there are, and 1."""
    shapes = np.array([list(s) for s in shapes], dtype=float).reshape(len(found), -1)
    out = np.zeros((len(found), words + shapes.shape[1] + 2))
    for row, numbers in zip(out, found):
        row[np.asarray(numbers, dtype=int)] = 1
        row[words] = min(len(numbers), 8) / 8
    out[:, words + 1 : -1], out[:, -1] = shapes, 1
    return out


CLEAN_VOTERS, PATTERN_VOTERS = 2, 5


def vote(found: list[int], shape: list[float], lexicons: dict[int, int], mined: int) -> int:
    """Bits of the voters that speak: mined words, lexicons, patterns of abuse, then the two that say clean."""
    bits = 0
    for i in found:
        if i < mined:
            bits |= 1 << i
        if i in lexicons:
            bits |= lexicons[i]
    loud = (shape[0] > 0.3, shape[1] > 0, shape[2] > 0.5, shape[3] > 0)
    base = mined + len(LEXICONS)
    for i, spoken in enumerate((*loud, len(found) > 1, not found, not any(loud) and shape[0] < 0.1)):
        bits |= int(spoken) << (base + i)
    return bits


def packed(text: Column) -> Column:
    """The distinct words of each whole text, compressed: what is shuffled where texts meet their labels."""

    def pack(bodies: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in bodies:
            yield pd.Series([zlib.compress(" ".join(sorted(tokens(b or ""))).encode(), 1) for b in batch])

    return F.pandas_udf(pack, "binary")(text)


def mine(labelled: DataFrame, text: str, label: str) -> list[str]:
    """``mined`` of whole texts."""
    return mined(labelled.select(packed(F.col(text)).alias("words"), F.col(label).alias("label")))


def mined(labelled: DataFrame) -> list[str]:
    """The feature words that most surely go with the label, by the lower bound of their log odds.

    Document counts run over all rows of ``labelled`` (words as ``packed``, label), which is read once, and are summed
    within a task before they are shuffled. Of words and beginnings that are nested only the surest counts, of equal
    ones the longest: so each entry is a stem of its own. At most WORDS entries come back.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            toxic, other = Counter(), Counter()
            for words, y in zip(batch["words"], batch["label"]):
                own = toxic if y else other
                own.update(features(set(zlib.decompress(words).decode().split(" ")) - {""}))
                own[""] += 1  # no word is empty: the number of documents
            names = list(toxic.keys() | other.keys())
            yield pd.DataFrame({"w": names, "t": [toxic[w] for w in names], "o": [other[w] for w in names]})

    counts = labelled.select("words", "label").mapInPandas(count, "w string, t long, o long")
    counts = cut(counts.groupBy("w").agg(F.sum("t").alias("t"), F.sum("o").alias("o")), "counts")
    sizes = counts.where("w = ''").first()
    if sizes is None or not sizes["t"] or not sizes["o"]:
        return []
    t, o = F.col("t") + 0.5, F.col("o") + 0.5
    odds = F.log(t / (sizes["t"] + 1 - t)) - F.log(o / (sizes["o"] + 1 - o))
    least = odds - ERRORS * F.sqrt(1 / t + 1 / o)
    sure = counts.where((F.col("w") != "") & (F.col("t") + F.col("o") >= LEAST_DOCS)).select("w", least.alias("least"))
    # A stem has at most one feature per beginning on its way, so this many rows hold WORDS stems or nearly so.
    rows = sure.where(F.col("least") >= LEAST_ODDS).orderBy(F.col("least").desc(), F.length("w").desc(), "w")
    return stems([r["w"] for r in rows.limit(WORDS * (2 + len(PREFIXES))).collect()])[:WORDS]


def stems(ranked: list[str]) -> list[str]:
    """Those of a ranked list of words and beginnings that are not nested with one before them."""
    kept, whole, beginnings = [], set(), set()
    for w in ranked:
        own = [w.rstrip("*")[:n] for n in range(1, len(w.rstrip("*")) + 1)]
        if own[-1] in beginnings or not whole.isdisjoint(own):
            continue
        kept.append(w)
        whole.add(own[-1])
        beginnings.update(own)
    return kept


def fit(
    docs: DataFrame, labels: DataFrame, trains: Column, key: str = "doc_id", text: str = "text", label: str = "toxic",
    sample: int = SAMPLE,
) -> Model | None:
    """A model from texts and, of some of them, labels 0 or 1; None where a class has no example.

    ``docs``: all texts, from which the voters' statistics come. ``labels`` (key, label): learned
    from are rows where ``trains`` holds. Words are mined and voters are judged by all of them; the classifier alone
    is fitted on at most ``sample``, those of smallest key hash, so that the choice does not depend on the order.
    Rows without a key or a label are left out; documents that repeat a key count each, but once in the sample.
    """
    named = cut(training_labels(labels, trains, key, label), "named")
    own = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    # Merged at every size: both sides grow with the documents.
    words_of = own.where(F.col("_key").isNotNull()).select("_key", packed(F.col("_text")).alias("words"))
    sure = mined(words_of.hint("merge").join(named, "_key").select("words", F.col("_label").alias("label")))
    labelled = training_rows(docs, labels, trains, key, text, label, sample)
    fixed = list(dict.fromkeys(w for words in LEXICONS.values() for w in words.split()))
    words = tuple(sure + [w for w in fixed if w not in set(sure)])
    place = {w: i for i, w in enumerate(words)}
    n_mined = min(len(sure), MINED_VOTERS)
    lexicons: dict[int, int] = {}
    for k, listed in enumerate(LEXICONS.values()):
        for w in listed.split():
            lexicons[place[w]] = lexicons.get(place[w], 0) | 1 << (n_mined + k)
    voters = n_mined + len(LEXICONS) + PATTERN_VOTERS + CLEAN_VOTERS

    def look(bodies: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in bodies:
            rows = [extract(b or "", place) for b in batch]
            yield pd.DataFrame({
                "patterns": [shape for _, shape in rows], "found": [found for found, _ in rows],
                "votes": [vote(found, shape, lexicons, n_mined) for found, shape in rows],
            })

    looked = F.pandas_udf(look, FEATURES)
    rows = labelled.select(F.col(label).cast("int").alias("y"), looked(F.col(text)).alias("x")).select("y", "x.*").toPandas()
    if rows["y"].nunique() < 2:
        return None
    # Votes meet the labels, texts do not.
    votes = own.select("_key", looked(F.col("_text"))["votes"].alias("votes")).join(named, "_key", "left")
    counts = cut(votes.groupBy("votes", F.col("_label").cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n")), "votes")
    crowd = fit_voters(counts, voters)
    truth = rows["y"].to_numpy(dtype=float)
    chance = crowd.chance(_bits(rows["votes"].to_numpy(), voters), truth)
    weights = logistic(design(list(rows["found"]), list(rows["patterns"]), len(words)), chance)
    return Model(words, weights, crowd.toxic_if_said())


def _bits(votes: np.ndarray, voters: int) -> np.ndarray:
    return ((votes[:, None] >> np.arange(voters)) & 1).astype(float)


@dataclass(frozen=True)
class Voters:
    """The generative model. Per class: how often each voter speaks if its parent does (``loud``) or not (``quiet``);
    how often the label is 1; the share of toxic texts. The root is its own parent and has one rate."""

    parent: np.ndarray
    loud: np.ndarray
    quiet: np.ndarray
    labelled: np.ndarray
    prior: float

    @classmethod
    def of(cls, both: np.ndarray, mass: np.ndarray, told: np.ndarray, parent: np.ndarray | None) -> Voters:
        """From sums per class: pairs of voters that speak together, rows, and labels (class by label).

        Without a tree the one of greatest mutual information of the pairs, given the class, is taken.
        """
        if parent is None:
            parent = widest_tree(shared_information(both, mass))
        j = np.arange(len(parent))
        alone = both[:, j, j]
        together, of_parent = both[:, j, parent], alone[:, parent]
        loud = (together + 0.5) / (of_parent + 1)
        quiet = (alone - together + 0.5) / (mass[:, None] - of_parent + 1)
        root = parent == j
        loud[:, root] = quiet[:, root] = ((alone + 0.5) / (mass[:, None] + 1))[:, root]
        opinion = LABEL_ROWS * np.array([1 - LABEL_ACCURACY, LABEL_ACCURACY])
        share = float(np.clip(mass[1] / max(mass.sum(), 1e-9), 1e-3, 1 - 1e-3))
        return cls(parent, loud, quiet, (told[:, 1] + opinion) / (told.sum(axis=1) + LABEL_ROWS), share)

    def likelihood(self, spoken: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Log of the chance of each row's votes, label (NaN: none) and class; a column per class."""
        out = np.empty((len(spoken), 2))
        for y, share in ((0, 1 - self.prior), (1, self.prior)):
            rate = np.where(spoken[:, self.parent] > 0, self.loud[y], self.quiet[y])
            out[:, y] = np.log(share) + np.log(np.where(spoken > 0, rate, 1 - rate)).sum(axis=1)
            said = np.log(np.where(label == 1, self.labelled[y], 1 - self.labelled[y]))
            out[:, y] += np.where(np.isnan(label), 0, said)
        return out

    def chance(self, spoken: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Posterior chance of "toxic" per row."""
        odds = self.likelihood(spoken, label)
        return 1 / (1 + np.exp(-np.clip(odds[:, 1] - odds[:, 0], -30, 30)))

    def toxic_if_said(self) -> np.ndarray:
        """Chance of "toxic" where a voter speaks, each alone; the last entry is of the label 1."""
        rate, known = np.empty_like(self.loud), self.parent == np.arange(len(self.parent))
        rate[:, known] = self.loud[:, known]
        while not known.all():
            below = ~known & known[self.parent]
            above = rate[:, self.parent[below]]
            rate[:, below] = above * self.loud[:, below] + (1 - above) * self.quiet[:, below]
            known |= below
        rate = np.column_stack([rate, self.labelled])
        return self.prior * rate[1] / (self.prior * rate[1] + (1 - self.prior) * rate[0])


def shared_information(both: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """Mutual information of each pair of voters within a class, summed over classes by their rows."""
    out = np.zeros(both.shape[1:])
    for y in (0, 1):
        n = mass[y] + 2
        one = (np.diag(both[y]) + 1) / n
        cells = {(1, 1): (both[y] + 0.5) / n}
        cells[1, 0] = one[:, None] - cells[1, 1]
        cells[0, 1] = one[None, :] - cells[1, 1]
        cells[0, 0] = 1 - cells[1, 1] - cells[1, 0] - cells[0, 1]
        for (a, b), p in cells.items():
            p = np.maximum(p, 1e-12)
            apart = np.where(a, one, 1 - one)[:, None] * np.where(b, one, 1 - one)[None, :]
            out += mass[y] * p * np.log(p / apart)
    return out


def widest_tree(weight: np.ndarray) -> np.ndarray:
    """Parent of each node in a spanning tree of greatest weight, node 0 being the root."""
    parent, best = np.zeros(len(weight), dtype=int), weight[0].astype(float).copy()
    inside = np.zeros(len(weight), dtype=bool)
    inside[0] = True
    while not inside.all():
        new = int(np.where(inside, -np.inf, best).argmax())
        inside[new] = True
        closer = (weight[new] > best) & ~inside
        best[closer], parent[closer] = weight[new][closer], new
    return parent


def fit_voters(counts: DataFrame, voters: int) -> Voters:
    """The generative model from (votes, label, n): each vote pattern of all documents with its label, if any.

    Rows without a label weigh at most as much as those with one, so that the labels say which class is which
    however many texts have none. Each round sends the model out and brings back sums of one row per task.
    """
    marked = F.col("label").isNotNull()
    totals = counts.agg(
        F.sum(F.when(marked, F.col("n"))).alias("told"), F.sum(F.when(~marked, F.col("n"))).alias("untold")).first()
    told, untold = totals["told"] or 0, totals["untold"] or 0
    light = min(1.0, told / untold) if untold else 1.0
    weighed = counts.select("votes", F.col("label").cast("double").alias("label"), (F.col("n") * F.when(marked, 1.0).otherwise(light)).alias("n"))
    # The labelled rows alone give the tree and the first rates.
    both, mass, labels, _ = _sums(weighed.where("label IS NOT NULL"), None, voters)
    model = Voters.of(both, mass, labels, None)
    before = -np.inf
    for _ in range(MOST_ROUNDS):
        both, mass, labels, likelihood = _sums(weighed, model, voters)
        if likelihood - before < GAIN * mass.sum():
            break
        model, before = Voters.of(both, mass, labels, model.parent), likelihood
    return model


def label_model(votes: DataFrame, sample: np.ndarray, truth: np.ndarray, voters: int) -> np.ndarray:
    """Posterior chance of "toxic" for rows with votes ``sample`` and labels ``truth``.

    ``votes`` (votes, n): each vote pattern of documents without labels, with its count.
    """
    named = votes.sparkSession.createDataFrame(
        [(int(v), int(y), 1) for v, y in zip(sample, truth)], "votes long, label int, n long")
    counts = votes.select("votes", F.lit(None).cast("int").alias("label"), "n").unionByName(named)
    return fit_voters(counts, voters).chance(_bits(sample, voters), np.asarray(truth, dtype=float))


def _sums(rows: DataFrame, model: Voters | None, voters: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Per class, how often each two voters speak together, its rows, its labels; and the likelihood.

    Without a model a row belongs to the class of its label.
    """

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both, mass, labels, total = np.zeros((2, voters, voters)), np.zeros(2), np.zeros((2, 2)), 0.0
        for batch in batches:
            spoken, n = _bits(batch["votes"].to_numpy(), voters), batch["n"].to_numpy(dtype=float)
            label = batch["label"].to_numpy(dtype=float)
            if model is None:
                toxic = label
            else:
                chances = model.likelihood(spoken, label)
                total += float(n @ np.logaddexp(chances[:, 0], chances[:, 1]))
                toxic = 1 / (1 + np.exp(-np.clip(chances[:, 1] - chances[:, 0], -30, 30)))
            for y, share in ((0, n * (1 - toxic)), (1, n * toxic)):
                both[y] += spoken.T @ (spoken * share[:, None])
                mass[y] += share.sum()
                for k in (0, 1):
                    labels[y, k] += share[label == k].sum()
        yield pd.DataFrame({"v": [np.r_[both.ravel(), mass, labels.ravel(), total]]})

    flat = rows.mapInPandas(add, "v array<double>").select(F.posexplode("v").alias("i", "x"))
    out = np.zeros(2 * voters * voters + 7)
    for row in flat.groupBy("i").agg(F.sum("x").alias("x")).collect():
        out[row["i"]] = row["x"]
    return out[:-7].reshape(2, voters, voters), out[-7:-5], out[-5:-1].reshape(2, 2), float(out[-1])


def logistic(x: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic regression on chances, by Newton steps; the last column is free."""
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (chance - p) - ridge * w)
        w = w + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return w


def score(text: Column, model: Model | None) -> Column:
    """Chance that each whole text is toxic; null and empty texts are scored like texts without
    words. Without a model every text gets 0."""
    if model is None:
        return F.lit(0.0)

    def judge(bodies: Iterator[pd.Series]) -> Iterator[pd.Series]:
        place = {w: i for i, w in enumerate(model.words)}
        for batch in bodies:
            rows = [extract(b or "", place) for b in batch]
            chances = [
                model.scores([f for f, _ in part], [s for _, s in part])
                for part in (rows[i : i + 4096] for i in range(0, len(rows), 4096))
            ]
            yield pd.Series(np.concatenate(chances) if chances else np.empty(0))

    return F.pandas_udf(judge, "double")(text)


def training_labels(labels: DataFrame, trains: Column, key: str, label: str) -> DataFrame:
    """(_key, _label) of the labels for which ``trains`` holds; of labels that repeat a key the highest."""
    named = labels.where(trains & F.col(key).isNotNull() & F.col(label).isNotNull())
    return named.groupBy(F.col(key).alias("_key")).agg(F.max(label).alias("_label"))


def with_labels(docs: DataFrame, named: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """(text, label) of all documents that ``named`` has; of documents that repeat a key one counts."""
    own = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = own.join(named, "_key").groupBy("_key").agg(F.min("_text").alias(text), F.first("_label").alias(label))
    return rows.select(text, label)


def training_rows(
    docs: DataFrame, labels: DataFrame, trains: Column, key: str, text: str, label: str, sample: int
) -> DataFrame:
    """(text, label) of at most ``sample`` labelled documents.

    The keys are chosen before the texts are met, so that what is broadcast is bounded by ``sample``, and
    no text is shuffled for the join. Of documents that repeat a key one counts, and of labels the highest.
    """
    named = training_labels(labels, trains, key, label)
    chosen = cut(named.orderBy(F.xxhash64("_key"), "_key").limit(sample), "labelled")
    return cut(with_labels(docs, F.broadcast(chosen), key, text, label), "training")
