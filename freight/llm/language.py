"""Language identification by error-correcting output codes.

Every learned language has a codeword; for each bit one binary classifier over hashed character
n-grams is trained.  A text gets the language whose codeword is nearest to the bits, where the loss of
each bit is weighted by how often its classifier was right on that language.  If the two
nearest codewords are about as near, the text is ambiguous.

The classifiers are fitted on a bounded, balanced sample of the distinct labelled texts (``SAMPLE_ROWS``), in
which copies of a text count once.  The sample's n-gram counts are made in tasks, so the driver gets one
vector of bounded length for each sampled text; prediction is one pass over whole texts, without a shuffle.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freight.llm.common import bound_batches, written

#: Labelled texts on which the classifiers are fitted; each language gets an equal part, at least one text.
SAMPLE_ROWS = 4000
#: Bins of hashed n-grams (a power of two), the longest n-gram, and code points counted at once.
BINS_LOG2, LONGEST, POINTS_AT_ONCE = 12, 3, 1 << 20
#: Fitting: steps, step size, weight decay.
STEPS, RATE, DECAY = 150, 0.3, 1e-5
#: A text is ambiguous if its best language has a smaller score than this.
CERTAIN = 0.5
#: Parts of a language's texts that are ranked apart when the sample is drawn.
SLICES = 64
#: Codes tried, and the agreements between codewords looked at in all tries, at most; sample vectors unpacked at once.
TRIES, AGREEMENTS, VECTORS_AT_ONCE = 200, 1 << 24, 4096
UNDETERMINED = "und"

PREDICTED = "struct<lang_pred:string,score:double,ambiguous:boolean>"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((unicodedata.category(chr(point))[0] == "L" for point in range(0x110000)), bool, 0x110000)


def _hashed(points: np.ndarray, n: int) -> np.ndarray:
    """Bins of the n-grams of code points, without those that are all gaps."""
    size = len(points) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint32)
    mixed = np.full(size, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    some = np.zeros(size, bool)
    for i in range(n):
        gram = points[i : i + size]
        mixed = (mixed ^ gram) * np.uint32(0x85EBCA6B)
        mixed ^= mixed >> np.uint32(15)
        some |= gram != 0
    return ((mixed * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BINS_LOG2))[some]


def features(text: str | None) -> np.ndarray | None:
    """The text's n-gram counts by bin, square-rooted, of length one; None if it has no letter."""
    lowered = (text or "").lower()
    counts, found = np.zeros(1 << BINS_LOG2, np.int64), False
    step = POINTS_AT_ONCE
    for first in range(0, len(lowered), step):
        # pieces overlap by the longest n-gram less one, so that none is lost
        lead = min(first, LONGEST - 1)
        points = np.frombuffer(lowered[first - lead : first + step].encode("utf-32-le", "surrogatepass"), np.uint32)
        letters = _letters()[points]
        points = np.where(letters, points, np.uint32(0))
        found = found or bool(letters[lead:].any())
        for n in range(1, LONGEST + 1):
            counts += np.bincount(_hashed(points[max(0, lead - n + 1) :], n), minlength=1 << BINS_LOG2)
    if not found:
        return None
    vector = np.sqrt(counts.astype(np.float32))
    return vector / np.linalg.norm(vector)


def codewords(languages: int) -> np.ndarray:
    """A codeword of +1 and -1 for each language: all splits in two if few, else far random ones."""
    if languages < 2:
        return np.zeros((languages, 0), np.float32)
    if languages <= 5:
        splits = np.arange(1, 1 << (languages - 1))
        return np.where(splits[None, :] >> np.arange(languages)[:, None] & 1, 1, -1).astype(np.float32)
    rng, best, far = np.random.default_rng(1), None, -1
    length = 10 * int(np.ceil(np.log2(languages)))
    for attempt in range(TRIES):
        code = np.where(rng.random((languages, length)) < 0.5, np.float32(1), np.float32(-1))
        splits = np.abs(code.sum(axis=0)).max() < languages
        if splits and (nearest := length - _most_agreement(code)) > far:
            best, far = code, nearest
        if best is not None and (attempt + 1) * languages**2 > AGREEMENTS:
            break
    return best


def _most_agreement(code: np.ndarray) -> float:
    """The largest inner product of two codewords."""
    most = -float(code.shape[1])
    for first in range(0, len(code), 1024):
        agree = code[first : first + 1024] @ code.T
        agree[np.arange(len(agree)), np.arange(first, first + len(agree))] = -code.shape[1]
        most = max(most, float(agree.max()))
    return most


@dataclass
class Model:
    """Languages, their codewords, the bit classifiers, and the weight of each bit for each language."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def decode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest language of each vector, and its share of the likelihood."""
        margins = vectors @ self.weights + self.bias
        # loss of each bit if the language were right: logistic, weighted
        as_one, as_other = np.logaddexp(0, -margins), np.logaddexp(0, margins)
        losses = as_one @ (self.trust * (self.code > 0)).T + as_other @ (self.trust * (self.code < 0)).T
        likely = np.exp(-(losses - losses.min(axis=1, keepdims=True)))
        best = losses.argmin(axis=1)
        return best, likely[np.arange(len(best)), best] / likely.sum(axis=1)


def _unpacked(packed: list[tuple[bytes, bytes]]) -> np.ndarray:
    vectors = np.zeros((len(packed), 1 << BINS_LOG2), np.float32)
    for vector, (bins, values) in zip(vectors, packed, strict=True):
        vector[np.frombuffer(bins, np.uint16)] = np.frombuffer(values, np.float32)
    return vectors


def fit(packed: list[tuple[bytes, bytes]], labels: list[str]) -> Model:
    """Logistic classifiers of all bits at once, by gradient steps with momentum over the whole sample.

    The sample's vectors come as bins and values (see ``_packed``).
    """
    languages = sorted(set(labels))
    code = codewords(len(languages))
    index = {language: i for i, language in enumerate(languages)}
    y = np.array([index[label] for label in labels], np.int64)
    size = np.bincount(y, minlength=len(languages))
    share = 1 / size[y] / max(1, len(languages))
    weights, bias = np.zeros((1 << BINS_LOG2, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    speed, speed_bias = np.zeros_like(weights), np.zeros_like(bias)
    pieces = [slice(first, first + VECTORS_AT_ONCE) for first in range(0, len(labels), VECTORS_AT_ONCE)]
    # a sample of usual size is one piece and stays unpacked
    whole = _unpacked(packed) if len(pieces) == 1 else None

    def vectors(piece: slice) -> np.ndarray:
        return _unpacked(packed[piece]) if whole is None else whole

    for _ in range(STEPS if code.shape[1] else 0):
        step, step_bias = np.zeros_like(weights), np.zeros_like(bias)
        for piece in pieces:
            x, target = vectors(piece), code[y[piece]]
            margins = (x @ weights + bias) * target
            pull = (target * share[piece, None] / (1 + np.exp(margins))).astype(np.float32)
            step += x.T @ pull
            step_bias += pull.sum(axis=0)
        speed = 0.9 * speed + step - DECAY * weights
        speed_bias = 0.9 * speed_bias + step_bias
        weights += 10 * RATE * speed
        bias += RATE * speed_bias
    right = np.zeros(code.shape)
    for piece in pieces:
        np.add.at(right, y[piece], (vectors(piece) @ weights + bias) * code[y[piece]] > 0)
    trust = right / np.maximum(size, 1)[:, None]
    trust = trust * (trust > 0.5) + 1e-9
    # a codeword's weights sum to its length, so that losses of languages compare
    trust *= code.shape[1] / np.maximum(trust.sum(axis=1, keepdims=True), 1e-9)
    return Model(languages, code, weights, bias, trust)


def _packed(batches):
    # bounded: only sampled texts come here
    seen = set()
    for batch in batches:
        labels, keys, bins, values = [], [], [], []
        for label, key, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if (label, key) in seen:
                continue
            seen.add((label, key))
            vector = features(text)
            if vector is not None:
                used = np.flatnonzero(vector)
                labels.append(label)
                keys.append(key)
                bins.append(used.astype(np.uint16).tobytes())
                values.append(vector[used].tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(labels, pa.string()), pa.array(keys, pa.int64()), pa.array(bins, pa.binary()), pa.array(values, pa.binary())],
            ["label", "key", "bins", "vals"],
        )


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", rows: int = SAMPLE_ROWS) -> Model:
    """A model from the rows of ``labelled`` that have a language and a text with a letter.

    Of each language as many distinct texts are used as there are, or an equal part of ``rows`` (at least one),
    those with the smallest hashes; copies of a text count once, however many they are.  Any number of
    languages is learned; the model and the sample grow with it.  No such row: a model without
    languages, which finds none.
    """
    bound_batches(labelled.sparkSession)
    labelled = labelled.select(F.col(lang).alias("label"), F.xxhash64(text).alias("key"), F.col(text).alias("text"))
    labelled = labelled.where(F.col("label").isNotNull() & F.col("text").rlike(r"\p{L}"))
    keys = written(labelled.select("label", "key").distinct(), "language_keys")
    languages = keys.agg(F.countDistinct("label")).first()[0]
    if not languages:
        return fit([], [])
    # the first of each slice, then the first of those: no task gets all texts of a language
    picked, part = keys.withColumn("slice", F.pmod("key", F.lit(SLICES))), -(-rows // languages)
    for within in (["label", "slice"], ["label"]):
        by_hash = Window.partitionBy(*within).orderBy(F.xxhash64("key", F.lit(1)), "key")
        picked = picked.withColumn("nth", F.row_number().over(by_hash)).where(F.col("nth") <= part).drop("nth")
    picked = picked.drop("slice")
    # at most ``rows`` keys, and one more for each language
    sampled = labelled.join(F.broadcast(picked), ["label", "key"])
    packed = sampled.select("label", "key", "text").mapInArrow(_packed, "label string, key long, bins binary, vals binary")
    # tasks return a text once each, this returns it once
    packed = packed.groupBy("label", "key").agg(F.any_value(F.struct("bins", "vals")).alias("vector")).collect()
    packed.sort(key=lambda r: (r["label"], r["key"]))
    return fit([(bytes(r["vector"]["bins"]), bytes(r["vector"]["vals"])) for r in packed], [r["label"] for r in packed])


def predict(text: Column, model: Model) -> Column:
    """``struct<lang_pred, score, ambiguous>`` of a text column.

    A text that is null or has no letter is ``und`` with score 0, and ambiguous; so is every text if
    the model has no language.  ``score`` is the best language's share, from 0 to 1.
    """

    @F.arrow_udf(PREDICTED)
    def predicted(column: pa.Array) -> pa.Array:
        langs, scores = [], []
        texts = column.to_pylist()
        for first in range(0, len(texts), 256):
            vectors = [features(value) for value in texts[first : first + 256]]
            known = [vector for vector in vectors if vector is not None]
            found = iter(())
            if known and model.languages:
                best, share = model.decode(np.stack(known))
                found = iter(zip(best.tolist(), share.tolist(), strict=True))
            for vector in vectors:
                i, score = next(found, (-1, 0.0)) if vector is not None else (-1, 0.0)
                langs.append(model.languages[i] if i >= 0 else UNDETERMINED)
                scores.append(float(score))
        unsure = [lang == UNDETERMINED or score < CERTAIN for lang, score in zip(langs, scores, strict=True)]
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(unsure, pa.bool_())], ["lang_pred", "score", "ambiguous"])

    return predicted(text)


def identify(documents: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """``documents`` with a column ``into`` (see ``predict``), in place of one of that name; every row is kept."""
    bound_batches(documents.sparkSession)
    return documents.withColumn(into, predict(F.col(text), model))
