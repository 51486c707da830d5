"""Fill-in-middle transformation by repeated-capture matching.

One ``fullmatch`` of ``(unit)*`` by the regex library keeps every repetition of the group, so ``ends(1)`` holds where each unit of the whole
text ends: its length is the number of units, and two of its entries are the cuts. Units meet any text, so the match never goes back and is
linear in the text. The library has an inner limit of some millions of repetitions, so a text of more than PIECE code points is matched
in pieces that end before a code point that is no letter, where a unit ends too.

The cuts and the form come from hashes of the document's id, so runs agree wherever a row is processed. Rows are independent: one pass
over the table, no shuffle, memory of one text and its units' ends.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A text is a run of these units: a run of ASCII letters, or one code point of any other kind.
UNITS = regex.compile(r"([A-Za-z]+|[^A-Za-z])*")
NO_LETTER = regex.compile(r"[^A-Za-z]")
#: Code points matched at once.
PIECE = 1_000_000
#: Marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of texts that are changed, and of these, percent with the suffix in front.
CHANGED, SUFFIX_FIRST = 90, 20


def draws(key: str) -> tuple[int, ...]:
    """The first four 8-digit groups of the hex sha256 of "1:" and the key, as unsigned integers."""
    digest = hashlib.sha256(f"1:{key}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def unit_ends(text: str) -> np.ndarray | list[int]:
    """Where each unit of the whole text ends."""
    if len(text) <= PIECE:
        return UNITS.fullmatch(text).ends(1)
    parts, at = [], 0
    while at < len(text):
        follows = NO_LETTER.search(text, at + PIECE)
        stop = follows.start() if follows else len(text)
        parts.append(np.array(UNITS.fullmatch(text, at, stop).ends(1)))
        at = stop
    return np.concatenate(parts)


def transform(text: str, key: str) -> tuple[int, str, int | None, int | None, str]:
    """(number of units, form, code points of the prefix, of the middle, output) of one text."""
    ends = unit_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = draws(key)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= CHANGED:
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (int(ends[i - 1]) if i else 0 for i in (first, second))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SUFFIX_FIRST:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: Iterable[str] = ("doc_id",)) -> DataFrame:
    """The kept columns and, for each row, n (units, long), form (plain, psm or spm), prefix_chars, middle_chars (long, null if plain) and output (string).

    A null text counts as empty. A null id draws as the empty key. Empty texts and texts that hold a mark are plain. Repeated rows give equal
    rows; rows with one id and different texts share their draws. A kept column named like a result is replaced by it; other columns don't matter.
    An empty table gives an empty table. A text is matched whole, however long; while it is, a unit takes some 150 bytes up to PIECE code points, and 8 beyond.
    """
    made = {"n": T.LongType(), "form": T.StringType(), "prefix_chars": T.LongType(), "middle_chars": T.LongType(), "output": T.StringType()}
    keep = [c for c in dict.fromkeys(keep) if c not in made]
    kept = docs.select(*[F.col(f"`{c}`") for c in keep])
    schema = T.StructType([*kept.schema, *[T.StructField(c, t) for c, t in made.items()]])
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                keys, texts = part.column(len(keep)).to_pylist(), part.column(len(keep) + 1).to_pylist()
                # Bytes that are not UTF-8 come back as they were.
                rows = [transform(t.decode("utf-8", "surrogateescape"), k) for k, t in zip(keys, texts, strict=True)]
                n, form, before, middle, output = zip(*rows, strict=True)
                whole = pa.array([o.encode("utf-8", "surrogateescape") for o in output], pa.binary()).view(pa.string())
                arrays = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(before, pa.int64()), pa.array(middle, pa.int64()), whole]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *arrays], names=[*keep, *made])

    return source.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that fill_in_middle() made output from. A text with a mark of its own is plain, so the marks of an output cut it into just its parts."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output)
