"""Fill-in-middle transformation over seekable compressed text.

A text is stored as independent zstandard frames with the units, code points and bytes before each. A frame
ends where a unit ends. To cut a text, only the frames that hold the cuts are decompressed; to emit or digest it, frames
stream in the order of the output. A new draw (other seed, other rates) needs the frames only, not the texts.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import Scratch, apart, beside_row

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
#: Where a unit ends within a text: after a word, before white space.
AFTER_WORD = re.compile(r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
#: The marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
#: Percent of texts that are transformed, and of these that take the suffix first.
FIM_PERCENT, SPM_PERCENT = 50, 80
#: Code points after which a frame ends with the next unit.
FRAME = 16_384
LEVEL = 3

FRAMES = "frames array<binary>, units array<long>, chars array<long>, marked boolean"


@dataclass
class Frames:
    """A text as frames. ``units`` and ``chars`` count what lies before each frame, with the total at the end."""

    frames: list[bytes]
    units: list[int]
    chars: list[int]
    #: Whether the text itself holds one of the marks.
    marked: bool

    def text(self, i: int) -> str:
        return zstandard.ZstdDecompressor().decompress(self.frames[i]).decode()

    def cut(self, unit: int) -> tuple[int, int]:
        """(frame, code points into it) of the end of the first ``unit`` units; reads one frame at most."""
        i = bisect_right(self.units, unit) - 1
        if i >= len(self.frames) or self.units[i] == unit:
            return i, 0
        last = next(islice(UNIT.finditer(self.text(i)), unit - self.units[i] - 1, None))
        return i, last.end()

    def part(self, begin: tuple[int, int], end: tuple[int, int]) -> Iterator[str]:
        """The text between two cuts, a frame at a time."""
        for i in range(begin[0], min(end[0] + 1, len(self.frames))):
            if i == end[0] and not end[1]:
                return
            whole = self.text(i)
            yield whole[begin[1] if i == begin[0] else 0:end[1] if i == end[0] else None]

    def place(self, cut: tuple[int, int]) -> int:
        """Code points of the text before a cut."""
        return self.chars[cut[0]] + cut[1]


def pack(text: str | None, size: int = FRAME) -> Frames:
    """The frames of a text; a null one is empty and has none."""
    text = text or ""
    press = zstandard.ZstdCompressor(level=LEVEL)
    frames, units, chars, start = [], [0], [0], 0
    while start < len(text):
        found = AFTER_WORD.search(text, start + size)
        end = found.start() if found else len(text)
        piece = text[start:end]
        frames.append(press.compress(piece.encode()))
        units.append(units[-1] + sum(1 for _ in UNIT.finditer(piece)))
        chars.append(end)
        start = end
    return Frames(frames, units, chars, any(m in text for m in (PREFIX, SUFFIX, MIDDLE)))


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """The first four 8-digit groups of the digest of ``seed:doc_id``; a null id has no digits."""
    found = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(found[i:i + 8], 16) for i in (0, 8, 16, 24)]


@dataclass
class Plan:
    """Where a text is cut and how its parts are put together."""

    form: str
    first: tuple[int, int]
    second: tuple[int, int]


def plan(text: Frames, doc_id: int | None, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> Plan:
    h1, h2, h3, h4 = draws(doc_id, seed)
    n = text.units[-1]
    if not n or text.marked or h3 % 100 >= fim_percent:
        return Plan("plain", (0, 0), (0, 0))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    return Plan("spm" if h4 % 100 < spm_percent else "psm", text.cut(a), text.cut(b))


def output(text: Frames, how: Plan) -> Iterator[str]:
    """The transformed text, frame by frame."""
    start, end = (0, 0), (len(text.frames), 0)
    if how.form == "plain":
        yield from text.part(start, end)
        return
    prefix, suffix = (PREFIX, (start, how.first)), (SUFFIX, (how.second, end))
    for mark, cuts in (*((suffix, prefix) if how.form == "spm" else (prefix, suffix)), (MIDDLE, (how.first, how.second))):
        yield mark
        yield from text.part(*cuts)


def restore(made: str, form: str) -> str:
    """The text that ``output`` was made from, from the output and its form alone."""
    if form == "plain":
        return made
    one, two = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    at, middle = made.index(two, len(one)), made.rindex(MIDDLE)
    parts = {one: made[len(one):at], two: made[at + len(two):middle]}
    return parts[PREFIX] + made[middle + len(MIDDLE):] + parts[SUFFIX]


def store_frames(docs: DataFrame, size: int = FRAME) -> DataFrame:
    """``row`` with all columns of ``docs`` but the text, ``doc_id`` beside it, and the text as frames.

    A null text is an empty one, without frames. A unit longer than a frame has one of its own. Rows that repeat are stored each.
    """
    def batch_of(batches):
        for batch in batches:
            packed = [pack(t, size) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), *(pa.array([getattr(p, c) for p in packed], t) for c, t in (
                    ("frames", pa.list_(pa.binary())), ("units", pa.list_(pa.int64())), ("chars", pa.list_(pa.int64())), ("marked", pa.bool_())))],
                ["row", "doc_id", "frames", "units", "chars", "marked"])

    rows = apart(docs, F.col("doc_id").cast("long").alias("doc_id"))
    return rows.mapInArrow(batch_of, beside_row(rows, f"doc_id long, {FRAMES}"))


def _transformed(stored: DataFrame, fields: str, values, seed: int, fim_percent: int, spm_percent: int) -> DataFrame:
    schema = beside_row(stored, f"doc_id long, n long, form string, prefix_chars long, middle_chars long, {fields}")

    def batch_of(batches):
        for batch in batches:
            out = []
            for doc_id, *parts in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "frames", "units", "chars", "marked"))):
                text = Frames(*parts)
                how = plan(text, doc_id, seed, fim_percent, spm_percent)
                a, b = (None, None) if how.form == "plain" else (text.place(how.first), text.place(how.second))
                out.append((text.units[-1], how.form, a, None if a is None else b - a, *values(text, how)))
            columns = list(zip(*out)) if out else [()] * (len(schema) - 2)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * (len(schema) - 6)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))], schema.names)

    return stored.mapInArrow(batch_of, schema)


def fill_in_middle(stored: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """``row``, ``doc_id``, the number of units ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` of stored frames.

    Empty texts and those that hold a mark stay plain; so do all but ``fim_percent`` of the others. Rows of equal id get
    equal draws. An empty table gives an empty result.
    """
    return _transformed(stored, "output string", lambda t, how: ("".join(output(t, how)),), seed, fim_percent, spm_percent)


def digests(stored: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """As ``fill_in_middle`` with ``output_sha256`` and, of the text rebuilt from output and form alone, ``restored_sha256``."""
    def values(text: Frames, how: Plan) -> tuple[str, str]:
        made, digest = [], hashlib.sha256()
        for piece in output(text, how):
            digest.update(piece.encode())
            made.append(piece)
        return digest.hexdigest(), hashlib.sha256(restore("".join(made), how.form).encode()).hexdigest()

    return _transformed(stored, "output_sha256 string, restored_sha256 string", values, seed, fim_percent, spm_percent)


def transform(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Store the frames of ``docs`` in the shared folder and digest their transformation."""
    scratch = Scratch(docs.sparkSession, "frames")
    return digests(scratch.keep(store_frames(docs), "store", compression="none"), seed)
