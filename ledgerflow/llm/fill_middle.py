"""Fill-in-the-middle: documents are cut at two ranks of an indexable skip list.

A document's units are its runs of letters and its single other code points. They stand
in a skip list whose links carry two widths: the units and the code points they pass.
Every unit is in the lowest lane; a unit's hash decides how many express lanes it is in
as well (one in `FAN_OUT` of each lane). To find the code point at which a unit begins,
the search runs along the top lane while the link's units fit into what is left of the
rank, adds up both widths, and goes down a lane: about FAN_OUT steps a lane, and exact.

The lanes are arrays: a lane's links are the differences of the unit numbers and of the
code points of the units that are in it.

Which documents are cut, where, and in which order their parts are written follows from
a hash of doc_id alone, so any task, and any later run, does the same. A document whose
text holds one of the marks stays plain, therefore parts and marks never run together
and `restored` gives back the text.

Defined results: a null text is empty and plain, with no units; an empty one too. A null
doc_id is hashed as if it were written with no digits. Rows that repeat a doc_id are cut
by the same hash, each in its own text. Texts are handled one by one, whole, whatever
their length. Other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.ngram_join import slices

FAN_OUT = 8
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90  # of 100
SPM_BELOW = 20  # of 100
SEED = 1


def unit_starts(text: str) -> tuple[np.ndarray, int]:
    """The code point at which each unit begins, and the number of code points."""
    c = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    small = c | 32
    letter = (small >= 97) & (small <= 122) & (c < 128)
    begins = np.ones(len(c), dtype=bool)
    begins[1:] = ~(letter[1:] & letter[:-1])
    return np.flatnonzero(begins), len(c)


def lanes_of(count: int, fan_out: int = FAN_OUT) -> np.ndarray:
    """For each unit, the express lanes it is in: how often `fan_out` divides a hash of its number."""
    x = np.arange(count, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    lanes = np.zeros(count, dtype=np.int64)
    at = np.arange(count)
    while len(at):
        at = at[x[at] % np.uint64(fan_out) == 0]
        x[at] //= np.uint64(fan_out)
        x[at] |= np.uint64(1) << np.uint64(63)  # never runs out of bits
        lanes[at] += 1
    return lanes


class SkipList:
    """Units with the code points before them, found by rank.

    The head stands before the first unit; a link leads from a unit to the next one of its lane
    and carries the units and the code points between their beginnings. The end is in
    every lane.
    """

    def __init__(self, starts: np.ndarray, length: int, fan_out: int = FAN_OUT):
        self.count, self.length = len(starts), length
        lanes = lanes_of(len(starts), fan_out)
        if len(starts):
            lanes[0] = 64  # the head
        self.lanes = []
        lane, members = 0, np.arange(len(starts))
        while len(members) and (lane == 0 or len(members) > 1):
            units = np.diff(members, append=len(starts))
            points = np.diff(starts[members], append=length)
            # A member's place in the lane below, to go down.
            below = np.searchsorted(previous, members) if lane else members
            self.lanes.append((units, points, below))
            previous, lane = members, lane + 1
            members = members[lanes[members] >= lane]
        self.steps = 0

    def seek(self, rank: int) -> int:
        """The code points before the unit of this rank (the text's length for the rank behind the last)."""
        if rank >= self.count:
            return self.length
        left, points, at = rank, 0, 0
        for units, widths, below in reversed(self.lanes):
            while at < len(units) and units[at] <= left:
                left -= int(units[at])
                points += int(widths[at])
                at += 1
                self.steps += 1
            if not left:
                break
            at = int(below[at])
        return points


def arranged(form: str, prefix: str, middle: str, suffix: str) -> str:
    if form == "psm":
        return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four numbers of 32 bits, from a hash of the seed and doc_id."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("long").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(h, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


OUTPUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def fill_in_middle(docs: DataFrame, seed: int = SEED, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """`docs` (doc_id, text), rearranged: doc_id, n (units), form, prefix_chars, middle_chars, output."""
    text = F.coalesce("text", F.lit(""))
    a, b, c, d = draws(F.col("doc_id"), seed)
    plain = (text == "") | text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE) | (c % 100 >= plain_from)
    form = F.when(plain, "plain").when(d % 100 < spm_below, "spm").otherwise("psm")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), form.alias("form"), a.alias("a"), b.alias("b"))
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.large_string()]
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            ids, forms, first, second = (batch.column(k).to_pylist() for k in (0, 2, 3, 4))
            out = []
            for k, name in enumerate(ids):
                text = batch.column(1)[k].as_py()
                starts, length = unit_starts(text)
                n = len(starts)
                if forms[k] == "plain":
                    out.append((name, n, "plain", None, None, text))
                    continue
                units = SkipList(starts, length)
                low, high = sorted((first[k] % (n + 1), second[k] % (n + 1)))
                i, j = units.seek(low), units.seek(high)
                out.append((name, n, forms[k], i, j - i, arranged(forms[k], text[:i], text[i:j], text[j:])))
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), kinds)], names=names)

    return rows.mapInArrow(run, OUTPUT)


def restored(output: Column, form: Column) -> Column:
    """The text that was rearranged."""

    def between(a: str, b: str | None) -> Column:
        rest = F.split_part(output, F.lit(a), F.lit(2))
        return F.split_part(rest, F.lit(b), F.lit(1)) if b else rest

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
