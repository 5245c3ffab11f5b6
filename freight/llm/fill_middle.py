"""Fill-in-the-middle: a text is cut at two places into prefix, middle and suffix, and the middle moved to the end.

Cuts lie between units, which are lines.  A text is divided into blocks of ``BLOCK`` bytes, and a Fenwick tree
over the blocks stores how many units end in each and how many code points begin there.  Binary lifting descends
the tree to the block that holds the end of the k-th unit and sums the code points before it on the way; only
that block is then searched for the place.  Cuts and the kind of rearrangement depend on a seed and the id alone.

Rows are independent of each other: one pass over the table in Arrow batches, no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freight.llm.common import bound_batches

#: Bytes of a block.
BLOCK = 1 << 12
#: Marks of the three parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Of a hundred texts, how many are rearranged at all, and how many of those with the suffix first.
RATE, SUFFIX_FIRST = 100, 50

FILLED = "struct<output:string,form:string,n:bigint,prefix_chars:bigint,middle_chars:bigint>"
_NEWLINE = 0x0A


class BlockTree:
    """A Fenwick tree over the blocks of a text's bytes, of unit ends and of code points."""

    def __init__(self, data: np.ndarray, block: int = BLOCK):
        self.data, self.block = data, block
        ends = data == _NEWLINE
        if len(data):
            ends[-1] = True  # the last unit may lack a line break
        self.ends = ends
        starts = np.arange(0, len(data), block)
        counts = np.zeros((len(starts) + 1, 2), np.int64)
        if len(starts):
            counts[1:, 0] = np.add.reduceat(ends, starts, dtype=np.int64)
            counts[1:, 1] = np.add.reduceat(_begins(data), starts, dtype=np.int64)
        # node i sums the lowest-set-bit(i) blocks that end with block i, which is the difference of two running sums
        sums, nodes = np.cumsum(counts, axis=0), np.arange(len(counts))
        self.units, self.points = (int(total) for total in sums[-1])
        self.tree = sums - sums[nodes - (nodes & -nodes)]

    def cut(self, k: int) -> tuple[int, int]:
        """Bytes and code points of the first ``k`` units, for k from 0 to ``units``."""
        at, left, points = 0, k, 0
        for level in reversed(range(len(self.tree).bit_length())):
            ahead = at + (1 << level)
            # stay before the block in which the k-th unit ends
            if ahead < len(self.tree) and self.tree[ahead, 0] < left:
                at, left, points = ahead, left - int(self.tree[ahead, 0]), points + int(self.tree[ahead, 1])
        if not left:
            return 0, 0
        first = at * self.block
        place = first + int(np.flatnonzero(self.ends[first : first + self.block])[left - 1]) + 1
        return place, points + int(np.count_nonzero(_begins(self.data[first:place])))


def _begins(data: np.ndarray) -> np.ndarray:
    """Whether a byte of UTF-8 begins a code point."""
    return (data & 0xC0) != 0x80


@dataclass(frozen=True)
class Settings:
    """Seed of the choices, rates in hundredths, and the marks of prefix, suffix and middle."""

    seed: int = 7
    rate: int = RATE
    suffix_first: int = SUFFIX_FIRST
    prefix: str = PREFIX
    suffix: str = SUFFIX
    middle: str = MIDDLE

    @property
    def marks(self) -> tuple[bytes, bytes, bytes]:
        return self.prefix.encode(), self.suffix.encode(), self.middle.encode()


def fill(text: bytes, key: str, settings: Settings = Settings(), block: int = BLOCK) -> tuple[bytes, str, int, int | None, int | None]:
    """Output, form, units, and code points of prefix and middle (None if plain) of one text; ``key`` is its id."""
    tree = BlockTree(np.frombuffer(text, np.uint8), block)
    digest = sha256(f"{settings.seed}:{key}".encode()).digest()
    one, two, plain, first = (int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))
    p, s, m = settings.marks
    if not text or any(mark in text for mark in (p, s, m)) or plain % 100 >= settings.rate:
        return text, PLAIN, tree.units, None, None
    low, high = sorted((one % (tree.units + 1), two % (tree.units + 1)))
    (a, a_points), (b, b_points) = tree.cut(low), tree.cut(high)
    if first % 100 < settings.suffix_first:
        return b"".join((s, text[b:], p, text[:a], m, text[a:b])), SPM, tree.units, a_points, b_points - a_points
    return b"".join((p, text[:a], s, text[b:], m, text[a:b])), PSM, tree.units, a_points, b_points - a_points


def unfill(output: str, form: str, settings: Settings = Settings()) -> str:
    """The text that ``fill`` was given, from its output and form."""
    if form == PLAIN:
        return output
    opens, turns = (settings.suffix, settings.prefix) if form == SPM else (settings.prefix, settings.suffix)
    if form not in (PSM, SPM) or not output.startswith(opens):
        raise ValueError(f"not the output of form {form}")
    # a rearranged text held no mark, so each is found once
    head, tail = output[len(opens) :].split(turns, 1)
    tail, middle = tail.split(settings.middle, 1)
    return tail + middle + head if form == SPM else head + middle + tail


def filled(text: Column, key: Column, settings: Settings = Settings()) -> Column:
    """``struct<output, form, n, prefix_chars, middle_chars>`` of a text and its id as text."""

    @F.arrow_udf(FILLED)
    def rearranged(texts: pa.Array, keys: pa.Array) -> pa.Array:
        rows = [fill(text, key, settings) for text, key in zip(texts.cast(pa.binary()).to_pylist(), keys.to_pylist(), strict=True)]
        output, form, n, prefix, middle = zip(*rows, strict=True) if rows else ((),) * 5
        columns = [pa.array(output, pa.binary()).cast(pa.string()), pa.array(form, pa.string()), *(pa.array(x, pa.int64()) for x in (n, prefix, middle))]
        return pa.StructArray.from_arrays(columns, ["output", "form", "n", "prefix_chars", "middle_chars"])

    return rearranged(text, key)


def restored(output: Column, form: Column, settings: Settings = Settings()) -> Column:
    """The exact text, from ``output`` and ``form`` alone."""

    @F.arrow_udf("string")
    def original(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        return pa.array([unfill(o, f, settings) for o, f in zip(outputs.to_pylist(), forms.to_pylist(), strict=True)], pa.string())

    return original(output, form)


def fill_in_middle(documents: DataFrame, settings: Settings = Settings(), id_column: str = "doc_id", text: str = "text", into: str = "fim") -> DataFrame:
    """``documents`` with a column ``into`` (see ``filled``), in place of one of that name; every row is kept.

    Units are the matches of ``[^\\n]*\\n|[^\\n]+``; an empty or null text has none and stays plain, as does one that
    holds a mark.  A null id counts as empty text, so rows without an id share their choices; repeated rows
    are treated alike.  Columns of other names play no part.
    """
    bound_batches(documents.sparkSession)
    key = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return documents.withColumn(into, filled(F.coalesce(F.col(text), F.lit("")), key, settings))


def digests(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Of each document the units, form and sizes, and SHA-256 of the output and of the text restored from it."""
    rows = fill_in_middle(documents.select("doc_id", "text"), settings)
    back = restored(F.col("fim.output"), F.col("fim.form"), settings)
    return rows.select(
        "doc_id",
        "fim.n",
        "fim.form",
        "fim.prefix_chars",
        "fim.middle_chars",
        F.sha2("fim.output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )


ORACLE = """
with hashed as (select doc_id, coalesce(text, '') as text, sha256('7:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
units as (select doc_id, text, regexp_extract_all(text, '[^\\n]*\\n|[^\\n]+') as lines,
  [cast('0x' || h[8 * i - 7 : 8 * i] as bigint) for i in [1, 2, 3, 4]] as h from hashed),
cuts as (select *, len(lines) as n, least(h[1] % (len(lines) + 1), h[2] % (len(lines) + 1)) as a, greatest(h[1] % (len(lines) + 1), h[2] % (len(lines) + 1)) as b,
  case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h[3] % 100 >= 100 then 'plain'
    when h[4] % 100 < 50 then 'spm' else 'psm' end as form from units),
parts as (select *, array_to_string(lines[1 : a], '') as p, array_to_string(lines[a + 1 : b], '') as m, array_to_string(lines[b + 1 : n], '') as s from cuts)
select doc_id, cast(n as bigint) as n, form,
  case when form <> 'plain' then cast(length(p) as bigint) end as prefix_chars,
  case when form <> 'plain' then cast(length(m) as bigint) end as middle_chars,
  sha256(case form when 'plain' then text when 'spm' then '<S>' || s || '<P>' || p || '<M>' || m else '<P>' || p || '<S>' || s || '<M>' || m end) as output_sha256,
  sha256(case form when 'plain' then text else p || m || s end) as restored_sha256
from parts
"""
