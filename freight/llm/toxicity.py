"""Toxicity by weak supervision: many voters, a generative model of them, a linear classifier.

Voters are lexicon entries (words and beginnings of words that toxic texts hold more often than others), entries that
are frequent in a text, and patterns (shouting, runs of signs).  A generative label model estimates by expectation
maximisation how often each voter fires on toxic and on clean texts; a voter that keeps silent says something too.
Voters that fire together beyond what the label explains form a group with one say.  Labels are taken as they are, and texts without a
label take part.  A logistic classifier over the same features is then trained on the posterior labels.

The lexicon is chosen by counts over all labelled rows, by one join that shuffles texts at any size.  The label
model and the classifier learn from bounded samples (``TOXIC``, ``CLEAN``, ``UNLABELLED`` rows, about), picked by a hash
of the id and joined by broadcast; scoring is one pass over whole texts, without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freight.llm.common import bound_batches

#: Rows of the samples, about.
TOXIC, CLEAN, UNLABELLED = 3000, 6000, 3000
#: Entries of the lexicon, and how many candidates there are for them; least number of toxic texts that hold an entry, and
#: least part of them; how many times as often as clean ones, at least, with how many standard errors to spare.
ENTRIES, CANDIDATES, SUPPORT, SHARE, LIFT, SPARE = 400, 4000, 4, 0.004, 7.0, 1.0
#: Lengths of word beginnings; an entry is frequent in a text with so many of its words, and one of so many words at least.
BEGINNINGS, TWICE, DENSE = (4, 5, 6, 7, 8), 2, 150
#: Posterior of a labelled text; rounds of the label model; from which correlation on voters share a say; how many firing
#: voters of a group are told apart; texts added to every count.
LABEL_TRUST, ROUNDS, ALIKE, LEVELS, SMOOTH = 0.995, 12, 0.15, 3, 0.1
#: Newton steps and ridge of the classifier.
STEPS, DECAY = 12, 1e-5
#: A text is called toxic from this score on.
THRESHOLD = 0.3
#: Words whose entries a worker keeps at hand.
WORDS_KEPT = 1 << 17
#: Entries whose counts a task keeps before it hands them on.
ENTRIES_KEPT = 1 << 18

PATTERNS = ("shouting", "exclaiming", "signs")
_WORD = re.compile(r"[^\W\d_]+")
_SIGNS = re.compile(r"[^\w\s]{3,}")


def entries_of(word: str) -> list[str]:
    """The word, and its beginnings with a star."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


def frequent(count: int, words: int) -> bool:
    """Whether an entry with ``count`` of the words of a text is frequent in it."""
    return count >= TWICE and count * DENSE >= words


def patterns_of(text: str) -> list[int]:
    """Numbers of the patterns that the text shows."""
    upper = sum(map(str.isupper, text))
    shown = (
        upper > 20 and 2 * upper > sum(map(str.isalpha, text)),
        text.count("!") > 3 and 50 * text.count("!") > len(text),
        len(_SIGNS.findall(text)) > 3,
    )
    return [i for i, yes in enumerate(shown) if yes]


@dataclass
class Model:
    """The lexicon, and the classifier's weights: patterns first, then entries.  An entry that ends in ^ must be frequent."""

    lexicon: list[str]
    weights: np.ndarray
    bias: float
    _places: dict = field(default_factory=dict, repr=False)
    _words: dict = field(default_factory=dict, repr=False)

    def features(self, text: str | None) -> list[int]:
        """Sorted numbers of the patterns and entries in a text."""
        text = text or ""
        if not self._places:
            for i, entry in enumerate(self.lexicon, len(PATTERNS)):
                self._places.setdefault(entry.rstrip("^"), [None, None])[entry.endswith("^")] = i
        if len(self._words) > WORDS_KEPT:
            self._words.clear()
        words = _WORD.findall(text.lower())
        counts: Counter = Counter()
        for word, n in Counter(words).items():
            entries = self._words.get(word)
            if entries is None:
                entries = self._words[word] = [e for e in entries_of(word) if e in self._places]
            for entry in entries:
                counts[entry] += n
        found = set(patterns_of(text))
        for entry, n in counts.items():
            there, often = self._places[entry]
            found.update(place for place, yes in ((there, True), (often, frequent(n, len(words)))) if yes and place is not None)
        return sorted(found)

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-(self.weights[self.features(text)].sum() + self.bias))))


def groups_of(votes: np.ndarray, classes: list[np.ndarray]) -> list[np.ndarray]:
    """Voters that fire together beyond what the class explains, in groups: each joins the first group whose leader it follows.

    ``classes`` holds, for each class, how much every text counts in it.
    """
    alike = np.zeros((votes.shape[1],) * 2)
    for side in classes:
        centred = (votes - (side @ votes) / side.sum()) * np.sqrt(side)[:, None]
        cover = centred.T @ centred
        deviation = np.sqrt(np.diag(cover)) + 1e-9
        alike = np.maximum(alike, cover / np.outer(deviation, deviation))
    groups: dict[int, list[int]] = {}
    for voter in range(votes.shape[1]):
        leader = next((leader for leader in groups if alike[voter, leader] > ALIKE), voter)
        groups.setdefault(leader, []).append(voter)
    return [np.array(group) for group in groups.values()]


def label_model(votes: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The probability that each text is toxic, by the votes (0 or 1, a row for a text; surer voters first).

    ``label`` is 1, 0, or -1 where there is none; ``weight`` how many texts a row stands for.  Given the class, groups of
    voters are independent, and each has its own chance that none, one, ... or ``LEVELS`` and more of its voters
    fire, so a group has one say however many voters it has, and silence counts.  The chances are estimated by
    expectation maximisation; the prior is that of the labelled texts.
    """
    labelled = label >= 0
    if not labelled.any():
        return np.full(len(votes), 0.5)
    votes = votes.astype(float)
    given = np.where(label == 1, LABEL_TRUST, 1 - LABEL_TRUST)
    known = np.where(labelled, weight, 0.0)
    prior = float(np.clip((given * known).sum() / known.sum(), 1e-6, 1 - 1e-6))
    unit = known[labelled].mean()
    groups = groups_of(votes, [given * known, (1 - given) * known])
    fired = [np.minimum(votes[:, group].sum(axis=1), LEVELS).astype(int) for group in groups]
    posterior, mass = given, known
    for _ in range(ROUNDS):
        logits = np.full(len(votes), np.log(prior / (1 - prior)))
        for level in fired:
            sides = [np.bincount(level, side * mass, LEVELS + 1) + SMOOTH * unit for side in (posterior, 1 - posterior)]
            logits += (np.log(sides[0] / sides[0].sum()) - np.log(sides[1] / sides[1].sum()))[level]
        posterior = np.where(labelled, given, 1 / (1 + np.exp(-np.clip(logits, -30, 30))))
        mass = weight
    return posterior


def fit_classifier(votes: np.ndarray, posterior: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """A logistic classifier of the posterior labels, with a ridge, by Newton steps."""
    share = weight / weight.sum()
    inputs = np.concatenate([votes, np.ones((len(votes), 1))], axis=1)
    ridge = np.full(inputs.shape[1], DECAY)
    ridge[-1] = 1e-9
    weights = np.zeros(inputs.shape[1])
    for _ in range(STEPS):
        chance = 1 / (1 + np.exp(-np.clip(inputs @ weights, -30, 30)))
        slope = inputs.T @ (share * (posterior - chance)) - ridge * weights
        curve = (inputs * (share * np.maximum(chance * (1 - chance), 1e-4))[:, None]).T @ inputs + np.diag(ridge)
        weights += np.linalg.solve(curve, slope)
    return weights[:-1], float(weights[-1])


def _count_entries(batches):
    """Texts of either class that hold an entry, summed over batches up to a bound."""
    counts: dict[bool, Counter] = {True: Counter(), False: Counter()}

    def flushed():
        names = sorted(counts[True] | counts[False])
        sides = [pa.array([counts[side][name] for name in names], pa.int64()) for side in (True, False)]
        counts[True].clear()
        counts[False].clear()
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *sides], ["entry", "toxic", "clean"])

    for batch in batches:
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = _WORD.findall((text or "").lower())
            own: Counter = Counter()
            for word, n in Counter(words).items():
                for entry in entries_of(word):
                    own[entry] += n
            side = counts[toxic]
            for entry, n in own.items():
                side[entry] += 1
                if frequent(n, len(words)):
                    side[entry + "^"] += 1
        if len(counts[True]) + len(counts[False]) > ENTRIES_KEPT:
            yield flushed()
    yield flushed()


def choose_lexicon(candidates: list[tuple[str, float]], most: int = ENTRIES) -> list[str]:
    """Of entries with their log-odds, the surest first: those that no shorter or longer one of the same words makes idle.

    An entry is left out if the lexicon has a beginning of it, or words that begin with it, with much the same odds.
    """
    chosen: dict[str, float] = {}
    for entry, odds in candidates:
        often = "^" if entry.endswith("^") else ""
        stem = entry.rstrip("^").rstrip("*")
        kin = [stem[:n] + "*" + often for n in range(min(BEGINNINGS), len(stem) + 1)] + [stem + often]
        longer = [other for other in chosen if entry.rstrip("^").endswith("*") and other.startswith(stem) and other.endswith("^") == bool(often)]
        if all(other not in chosen or chosen[other] < odds - np.log(2) for other in kin) and all(chosen[other] < odds - np.log(2) for other in longer):
            chosen[entry] = odds
        if len(chosen) == most:
            break
    return list(chosen)


def _collect_votes(model: Model):
    def votes(batches):
        for batch in batches:
            found = [np.array(model.features(text), np.uint16).tobytes() for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], ["label", "weight", "votes"])

    return votes


def train(documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", toxic: str = "toxic") -> Model:
    """A model from ``documents`` and the labels of some of them (1: toxic, 0: clean; others count as none).

    Of several labels of an id the largest counts; documents of a repeated id all take its label.  The sample
    of texts without a label holds none of those with one.  Without toxic and clean texts every score is the
    share of toxic ones, 0 if there are none.
    """
    bound_batches(documents.sparkSession)
    labels = labels.where(F.col(toxic).isin(0, 1)).groupBy(F.col(id_column).alias("id")).agg(F.max(toxic).cast("int").alias("label")).where("id is not null")
    counts = {r["label"]: r["n"] for r in labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = documents.count()
    wide = F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1 << 30)).cast("double") / (1 << 30)
    parts = {1: min(1.0, TOXIC / max(1, counts.get(1, 0))), 0: min(1.0, CLEAN / max(1, counts.get(0, 0))), -1: min(1.0, UNLABELLED / max(1, total))}
    # bounded by TOXIC + CLEAN rows
    picked = labels.where(wide < F.when(F.col("label") == 1, parts[1]).otherwise(parts[0]))
    texts = documents.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    known = texts.join(F.broadcast(picked), "id")
    every = known.select("label", F.when(F.col("label") == 1, 1 / parts[1]).otherwise(1 / parts[0]).alias("weight"), "text")
    if counts.get(1):
        some = texts.where(wide < parts[-1])
        # bounded by UNLABELLED rows: those of the sample that do have a label
        known_too = labels.join(F.broadcast(some.select("id")), "id", "left_semi").select("id")
        some = some.join(F.broadcast(known_too), "id", "left_anti")
        every = every.unionAll(some.select(F.lit(-1).alias("label"), F.lit(1 / parts[-1]).alias("weight"), "text"))
    lexicon = []
    if counts.get(1) and counts.get(0):
        n = {1: counts[1], 0: counts[0]}
        # counts are of all labelled rows, the sample is for the label model and the classifier only; the labels grow
        # with the texts, so they are merged by a shuffle at any size
        labelled = texts.join(labels.hint("merge"), "id")
        entries = labelled.select(F.col("label") == 1, "text").mapInArrow(_count_entries, "entry string, toxic long, clean long")
        least = max(SUPPORT, SHARE * n[1])
        entries = entries.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(F.col("toxic") >= least)
        odds = F.log((F.col("toxic") + 0.5) / (n[1] + 1)) - F.log((F.col("clean") + 0.5) / (n[0] + 1))
        doubt = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
        # how much surer the entry makes: log-odds times the root of its support
        entries = entries.select("entry", (odds * F.sqrt("toxic")).alias("gain"), odds.alias("odds")).where(odds - SPARE * doubt > F.log(F.lit(LIFT)))
        found = entries.orderBy(F.col("gain").desc(), F.length("entry"), "entry").limit(CANDIDATES).collect()
        lexicon = choose_lexicon([(r["entry"], r["odds"]) for r in found])
    model = Model(lexicon, np.zeros(len(PATTERNS) + len(lexicon)), -30.0)
    rows = every.mapInArrow(_collect_votes(model), "label int, weight double, votes binary").collect()
    if not rows or not counts.get(1) or not counts.get(0):
        share = min(1.0, counts.get(1, 0) / max(1, sum(counts.values())))
        model.bias = float(np.log((share + 1e-9) / (1 - share + 1e-9)))
        return model
    rows.sort(key=lambda r: (r["label"], r["votes"]))
    votes = np.zeros((len(rows), len(model.weights)))
    for line, row in zip(votes, rows, strict=True):
        line[np.frombuffer(row["votes"], np.uint16)] = 1
    weight = np.array([row["weight"] for row in rows])
    label = np.array([row["label"] for row in rows])
    # texts without a label weigh no more than those with one, or guesses would outvote what is known
    weight[label < 0] *= min(1.0, weight[label >= 0].sum() / max(weight[label < 0].sum(), 1e-12))
    posterior = label_model(votes, label, weight)
    model.weights, model.bias = fit_classifier(votes, posterior, weight)
    return model


def score(text: Column, model: Model) -> Column:
    """From 0 to 1, higher: toxic likelier.  Null and empty texts get what a text without any feature gets."""

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        return pa.array([model.score(value) for value in column.to_pylist()], pa.float64())

    return scored(text)


def score_documents(documents: DataFrame, model: Model, text: str = "text", into: str = "toxicity") -> DataFrame:
    """``documents`` with a column ``into`` of scores, in place of one of that name; every row is kept."""
    bound_batches(documents.sparkSession)
    return documents.withColumn(into, score(F.col(text), model))
