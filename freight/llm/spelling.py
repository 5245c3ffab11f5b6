"""Spelling variants: words that differ by one letter, found by probing Bloom filters with generated edits.

1. Words are counted over all texts; those that occur often enough are the vocabulary, stored once.
2. The vocabulary's keys (hashes of the words) go into Bloom filters, a shard for each word length, in blocks of
   512 bits: all bits of a word lie in one block.  The bits are set by an aggregate over all tasks; the filters are
   broadcast and together never larger than ``FILTER_BYTES``.  A vocabulary too large for 16 bits a word
   gets more false positives, never fewer words.
3. Every task probes the edits of its words: each letter deleted, and each letter replaced by every later letter of
   the vocabulary.  So each pair is met once: from its longer word, or from the one with the smaller letter.  Keys of edits
   come from the word's key by one addition, no string is built.
4. Only positives are shuffled, as hashes: a join with the vocabulary by key finds the words, and comparing the
   strings removes false positives and colliding keys.
5. Each word's form is its most frequent near word; chains of forms are followed by pointer doubling.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freight.llm.common import bound_batches, shuffle_width, written

#: Runs of letters; the shortest word and the least number of occurrences.
LETTERS, SHORTEST, LEAST = r"[A-Za-zÀ-ÿ]+", 5, 3
#: A form occurs at least so many times as often as the word.
LEAD = 2
#: Bits of a block, bits of a filter for each word, probes in the block, and bytes of all filters together.
BLOCK, BITS_EACH, PROBES, FILTER_BYTES = 512, 16, 5, 64 << 20
#: Words of this length and more share a shard.
LAST_SHARD = 48
#: Letters that a task probes at once.
LETTERS_AT_ONCE = 1 << 17
#: Bits of the bitmaps that Spark's aggregate builds.
_CHUNK = 1 << 15
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(word: Column) -> Column:
    """A-Z in lower case, every other letter as it is."""
    ascii_only = F.octet_length(word) == F.length(word)
    return F.when(ascii_only, F.lower(word)).otherwise(F.translate(word, _UPPER, _LOWER))


def runs(documents: DataFrame, id_column: str = "doc_id", text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """``id`` (as text, empty for null) and ``word`` of every maximal run of at least ``shortest`` letters, A-Z in lower case."""
    pattern = LETTERS.removesuffix("+") + f"{{{shortest},}}"
    found = F.explode(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))).alias("run")
    rows = documents.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), found)
    return rows.select("id", lower_ascii(F.col("run")).alias("word"))


def with_slips(words: DataFrame, every: int) -> DataFrame:
    """The words, with one letter gone where the CRC-32 of ``<id>:<word>`` is a multiple of ``every``: the one at that number modulo the length."""
    code = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
    rows = words.select("word", code.alias("code"))
    place = (F.col("code") % F.length("word")).cast("int")
    cut = F.concat(F.substring(F.col("word"), F.lit(1), place), F.substring(F.col("word"), place + 2, F.length("word")))
    return rows.select(F.when(F.col("code") % every == 0, cut).otherwise(F.col("word")).alias("word"))


def counted(words: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """``word, n`` of the words with enough letters and occurrences; merged before the shuffle, so frequent words are no load."""
    rows = words.where(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return rows.where(F.col("n") >= least)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits spread over the whole number; one to one."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Words:
    """Letters of several words one behind the other, and what their hashes are made of."""

    def __init__(self, words: list[str]):
        self.lengths = np.array([len(word) for word in words], np.int64)
        self.letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        ends = np.cumsum(self.lengths)
        self.word = np.repeat(np.arange(len(words)), self.lengths)
        self.place = np.arange(len(self.letters)) - np.repeat(ends - self.lengths, self.lengths)
        powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(int(self.lengths.max(initial=1)), _BASE, np.uint64)]))
        self.power = powers[self.place]
        # sums of the terms before each letter, within its word
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.letters * self.power)])
        opens = sums[np.repeat(ends - self.lengths, self.lengths)]
        self.before = sums[:-1] - opens
        self.through = sums[1:] - opens
        self.sums = sums[ends] - sums[ends - self.lengths]

    @staticmethod
    def keys(sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return mixed(sums ^ mixed(lengths.astype(np.uint64)))

    def deleted(self) -> np.ndarray:
        """Sums of the words without each of their letters."""
        return self.before + (self.sums[self.word] - self.through) * np.uint64(_BACK)

    def replaced(self, letter: int) -> np.ndarray:
        """Sums of the words with each of their letters in turn replaced by ``letter``."""
        return self.sums[self.word] + (np.uint64(letter) - self.letters) * self.power


class Filters:
    """Blocked Bloom filters, a shard for each length; ``blocks`` holds the number of blocks of each shard."""

    def __init__(self, counts: dict[int, int], most: int = FILTER_BYTES):
        wanted = {shard: -(-n * BITS_EACH // BLOCK) for shard, n in counts.items()}
        # shards are shrunk alike where all of them would not fit
        scale = min(1.0, most * 8 / BLOCK / max(1, sum(wanted.values())))
        self.blocks = np.zeros(LAST_SHARD + 1, np.int64)
        for shard, n in wanted.items():
            self.blocks[shard] = max(1, int(n * scale))
        self.first = np.cumsum(self.blocks) - self.blocks
        self.bits = np.zeros(0, np.uint64)

    def block(self, keys: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block of each key, and whether its shard has any."""
        shard = np.minimum(lengths, LAST_SHARD)
        count = self.blocks[shard]
        return self.first[shard] + ((keys >> np.uint64(32)) * count.astype(np.uint64) >> np.uint64(32)).astype(np.int64), count > 0

    @staticmethod
    def bit(keys: np.ndarray, probe: int) -> np.ndarray:
        return ((keys >> np.uint64(9 * probe)) & np.uint64(BLOCK - 1)).astype(np.int64)

    def holds(self, keys: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Places of the keys that may be in the vocabulary."""
        block, some = self.block(keys, lengths)
        left = np.flatnonzero(some)
        for probe in range(PROBES):
            bit = self.bit(keys[left], probe)
            word = self.bits[block[left] * (BLOCK // 64) + (bit >> 6)]
            left = left[(word >> (bit & 63).astype(np.uint64) & np.uint64(1)) > 0]
        return left


def _keyed(batches):
    """The vocabulary with its keys."""
    for batch in batches:
        words = Words(batch.column(0).to_pylist())
        keys = Words.keys(words.sums, words.lengths).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(words.lengths.astype(np.int32)), pa.array(keys)], ["word", "n", "length", "key"])


def _bits_set(filters: Filters):
    """The bits of each word, as chunk and place in the chunk."""

    def bits(batches):
        for batch in batches:
            lengths, keys = (batch.column(i).to_numpy() for i in (0, 1))
            keys = keys.view(np.uint64)
            block, _ = filters.block(keys, lengths)
            place = np.concatenate([block * BLOCK + filters.bit(keys, probe) for probe in range(PROBES)])
            yield pa.RecordBatch.from_arrays([pa.array(place // _CHUNK), pa.array(place % _CHUNK)], ["chunk", "place"])

    return bits


def _pieces(words: list[str]):
    """Slices of a list of words of bounded size; a longer word stands alone."""
    first, size = 0, 0
    for at, word in enumerate(words):
        if size and size + len(word) > LETTERS_AT_ONCE:
            yield slice(first, at)
            first, size = at, 0
        size += len(word)
    if size:
        yield slice(first, len(words))


def _edits(words: Words, alphabet: list[int]):
    """Letter put there, sums and lengths of the edits of every letter, and which of them are wanted."""
    lengths = words.lengths[words.word]
    # of equal neighbours only the first is deleted: the result is the same
    fresh = np.ones(len(lengths), bool)
    fresh[1:] = (words.letters[1:] != words.letters[:-1]) | (words.place[1:] == 0)
    yield "", words.deleted(), lengths - 1, fresh
    for letter in alphabet:
        yield chr(letter), words.replaced(letter), lengths, words.letters < np.uint64(letter)


def _probe(filters, alphabet: list[int]):
    """Edits that may be words: keys of both, place, and the letter put there (none if deleted)."""

    def probe(batches):
        held = filters.value
        for batch in batches:
            some = batch.column(0).to_pylist()
            for piece in _pieces(some):
                words = Words(some[piece])
                own = Words.keys(words.sums, words.lengths)
                for letter, sums, sizes, wanted in _edits(words, alphabet):
                    at = np.flatnonzero(wanted)
                    keys = Words.keys(sums[at], sizes[at])
                    found = held.holds(keys, sizes[at])
                    at = at[found]
                    if len(at):
                        columns = (
                            pa.array(keys[found].view(np.int64)),
                            pa.array(own[words.word[at]].view(np.int64)),
                            pa.array(words.place[at].astype(np.int32)),
                            pa.array([letter] * len(at), pa.string()),
                        )
                        yield pa.RecordBatch.from_arrays(list(columns), ["near_key", "key", "place", "letter"])

    return probe


def near_words(vocabulary: DataFrame, most: int = FILTER_BYTES) -> DataFrame:
    """``word, n, near, near_n``: every pair of words that differ by one inserted, deleted or replaced letter, both ways round.

    ``vocabulary`` has distinct, non-null, non-empty ``word`` and ``n``; it is read several times, so it should be stored.
    ``most`` bounds the bytes of the filters.
    """
    spark = vocabulary.sparkSession
    bound_batches(spark)
    keyed = written(vocabulary.select("word", "n").mapInArrow(_keyed, "word string, n long, length int, key long"), "vocabulary")
    shard = F.least("length", F.lit(LAST_SHARD))
    # a row for each shard; the alphabet is bounded by the letters there are
    counts = {r["shard"]: r["n"] for r in keyed.groupBy(shard.alias("shard")).agg(F.count(F.lit(1)).alias("n")).collect()}
    letters = keyed.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).where("letter <> ''").distinct()
    alphabet = sorted(ord(r["letter"]) for r in letters.collect())
    filters = Filters(counts, most)
    place = keyed.select("length", "key").mapInArrow(_bits_set(filters), "chunk long, place long")
    chunks = place.groupBy("chunk").agg(F.bitmap_construct_agg("place").alias("bits")).collect()
    size = max(1, -(-int(filters.blocks.sum()) * BLOCK // _CHUNK))
    filters.bits = np.zeros(size * _CHUNK // 64, np.uint64)
    for row in chunks:
        filters.bits[row["chunk"] * _CHUNK // 64 : (row["chunk"] + 1) * _CHUNK // 64] = np.frombuffer(bytes(row["bits"]), "<u8")
    # dealt out anew: the work grows with the letters, not with the stored bytes
    dealt = keyed.select("word").repartition(shuffle_width(spark), "word")
    probed = dealt.mapInArrow(_probe(spark.sparkContext.broadcast(filters), alphabet), "near_key long, key long, place int, letter string")

    near = keyed.select(F.col("key").alias("near_key"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    met = probed.join(near, "near_key").join(keyed.select("key", "word", "n"), "key")
    edit = F.concat(F.substring(F.col("word"), F.lit(1), F.col("place")), F.col("letter"), F.substring(F.col("word"), F.col("place") + 2, F.length("word")))
    pairs = written(met.where(F.col("near") == edit).select("word", "n", "near", "near_n"), "pairs")
    return pairs.unionAll(pairs.select("near", "near_n", "word", "n"))


def _roots(links: DataFrame) -> DataFrame:
    """``word, root``: where the chain from each ``word`` over its ``form`` ends, by doubling the steps.

    A form occurs at least ``LEAD`` times as often as its word, so chains have no rings and few steps.
    """
    links = written(links.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if links.join(further, "root", "left_semi").isEmpty():
            return links
        links = written(links.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "forms")


def variants(vocabulary: DataFrame, lead: int = LEAD, most: int = FILTER_BYTES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each word of a vocabulary (``word``, ``n``).

    The form is the near word of largest ``n`` (ties: the smallest by code points), if that is at least ``lead`` times
    the word's own; else null.  The root is the last of the chain of forms, the word itself without any.
    """
    if lead < 2:
        raise ValueError("lead must be 2 or more")
    near = near_words(vocabulary, most).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near"))).alias("best")
    )
    rows = vocabulary.select("word", "n").join(near, "word", "left")
    led = -F.col("best.rank") >= lead * F.col("n")
    rows = rows.select(
        "word",
        F.when(led, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(led, -F.col("best.rank")).alias("form_n"),
    )
    rows = written(rows, "variants")
    roots = _roots(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def text_variants(documents: DataFrame, every: int, id_column: str = "doc_id", text: str = "text", shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """``variants`` of the words of whole texts, with a slip in one of ``every`` words (see ``with_slips``).

    Null and empty texts have no word; a null id counts as empty text; every repeated row counts.  Other columns play no part.
    """
    # a run loses at most one letter, so shorter ones never count
    words = with_slips(runs(documents, id_column, text, shortest), every)
    return variants(written(counted(words, shortest, least), "words"))
