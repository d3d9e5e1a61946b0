"""Removal of repeated passages by hashing normalised units of lines.

Lines are cut into short units after words whose hash is the smallest of their neighbourhood,
so a passage is cut alike wherever it stands in a line, but for a few words at its edges.  Digests of the normalised units are grouped over the
whole table; the occurrence with the smallest (doc_id, text hash, unit) stays, and runs of
later occurrences that hold enough words are removed.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.llm.common import fresh, map_arrow, stage, unstage
from kindred.llm.tokens import batches_of

#: Words on either side among which a word must have the smallest hash to end a unit.
REACH = 3
#: Repeats of one word after which a unit ends.
SAME = 8
#: Words that a run of repeated units must have to be removed.
MIN_WORDS = 20
#: Bytes of text that are cut at a time (one larger text goes alone), and characters of the words whose hashes are remembered.
SLICE_BYTES, REMEMBERED = 1_000_000, 1_000_000

_WORD = re.compile(r"\S+")
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], dtype=np.uint64)


class _Hashes(dict):
    """The first eight bytes of normalised words' MD5; emptied when it grows large."""

    held = 0

    def __missing__(self, word: str) -> int:
        self.held += len(word)
        if self.held > REMEMBERED:
            self.clear()
            self.held = len(word)
        found = self[word] = int.from_bytes(hashlib.md5(word.encode("utf-8")).digest()[:8], "big")
        return found


_HASHES = _Hashes()


def _hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def unit_ends(sizes: list[int], hashes: np.ndarray) -> np.ndarray:
    """For each word, whether a unit ends with it; ``sizes`` are the numbers of words of the lines.

    A unit ends after a word whose hash's first four bytes are less than those of the REACH
    words before it and not more than those of the REACH words after it, within the line;
    after every SAME repeats of one word in a row; and at the line's end.
    """
    sizes = np.array(sizes, dtype=np.int64)
    blank = np.iinfo(np.int64).max
    flat = np.full(len(hashes) + REACH * (len(sizes) + 1), blank)
    at = np.arange(len(hashes)) + REACH * (1 + np.repeat(np.arange(len(sizes)), sizes))  # REACH blanks before each line
    flat[at] = (hashes >> np.uint64(32)).astype(np.int64)
    middle = flat[REACH : len(flat) - REACH]
    ends = middle < blank
    for k in range(1, REACH + 1):
        ends &= (middle < flat[REACH - k : len(flat) - REACH - k]) & (middle <= flat[REACH + k : len(flat) - REACH + k])
    new = np.append(True, middle[1:] != middle[:-1])[: len(middle)]
    place = np.arange(len(middle)) - np.maximum.accumulate(np.where(new, np.arange(len(middle)), 0))
    ends |= place % SAME == SAME - 1
    found = ends[at - REACH]
    found[np.cumsum(sizes)[sizes > 0] - 1] = True
    return found


def _lines(texts: list[str]) -> tuple[list[str], list[int], list[int]]:
    """Normalised words of all texts, words of each line, and words of each text."""
    words, sizes, of_text = [], [], []
    for text in texts:
        before = len(words)
        for line in text.split("\n"):
            found = line.lower().split()
            words += found
            sizes.append(len(found))
        of_text.append(len(words) - before)
    return words, sizes, of_text


def text_units(texts: list[str]) -> list[list[list[str]]]:
    """The units of each text, as normalised words."""
    out = []
    for text in texts:
        words, sizes, _ = _lines([text])
        cuts = np.flatnonzero(unit_ends(sizes, _hashes(words))) + 1
        out.append([words[a:b] for a, b in zip([0, *cuts.tolist()], cuts.tolist())])
    return out


def unit_spans(text: str) -> list[tuple[int, int]]:
    """Start and end (code points) of each unit, in the order of ``text_units``."""
    words, sizes, _ = _lines([text])
    cuts = np.flatnonzero(unit_ends(sizes, _hashes(words))).tolist()
    # lower case may change a word's length, so places come from the text itself
    spans, at = [], 0
    for line in text.split("\n"):
        spans += [(at + m.start(), at + m.end()) for m in _WORD.finditer(line)]
        at += len(line) + 1
    return [(spans[a][0], spans[b][1]) for a, b in zip([0, *(c + 1 for c in cuts)], cuts)]


def unit_digests(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each unit of the texts, in order: its digest, its words, and the text it is in."""
    words, sizes, of_text = _lines(texts)
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    hashes = _hashes(words)
    starts = np.append(0, np.flatnonzero(unit_ends(sizes, hashes))[:-1] + 1)
    n = np.diff(np.append(starts, len(words)))
    place = (np.arange(len(words)) - np.repeat(starts, n) + 1).astype(np.uint64)
    mixed = (hashes ^ (place * _MIX[0])) * _MIX[1]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX[2]
    digest = np.add.reduceat(mixed ^ (mixed >> np.uint64(32)), starts) + n.astype(np.uint64) * _MIX[0]
    return digest.view(np.int64), n, np.repeat(np.arange(len(texts)), of_text)[starts]


def repeated_runs(units: list[int], words: list[int], min_words: int) -> list[tuple[int, int]]:
    """First and last unit of each run of neighbouring units with ``min_words`` words at least."""
    order = np.argsort(units)
    u, w = np.asarray(units)[order], np.asarray(words)[order]
    starts = np.flatnonzero(np.diff(u, prepend=u[0] - 2) > 1)
    totals = np.add.reduceat(w, starts)
    ends = np.append(starts[1:], len(u)) - 1
    return [(int(u[s]), int(u[e])) for s, e, n in zip(starts, ends, totals) if n >= min_words]


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the spans; blanks around a cut shrink to one, a line left blank goes."""
    if not spans:
        return text
    out, at = [], 0
    for start, end in spans:
        out.append(text[at:start].rstrip(" \t") if text[end : end + 1] in ("", "\n") else text[at:start])
        at = end
        if text[at : at + 1] == " " and (not text[:start] or text[start - 1 : start] in ("", "\n", " ")):
            at += 1
        if text[at : at + 1] == "\n" and (start == 0 or text[start - 1] == "\n"):
            at += 1
    out.append(text[at:])
    return "".join(out)


def units(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(digest, doc_id, h, unit, words): a row a unit of every text."""
    schema = pa.schema([("digest", pa.int64()), ("doc_id", pa.int64()), ("h", pa.int32()), ("unit", pa.int32()), ("words", pa.int32())])

    def run(batches):
        for batch in batches:
            for at, texts in batches_of(batch.column(2), SLICE_BYTES):
                digest, n, which = unit_digests(texts.to_pylist())
                first = np.searchsorted(which, np.arange(len(texts)))
                unit, take = np.arange(len(which)) - first[which], pa.array(which + at)
                yield pa.RecordBatch.from_arrays([pa.array(digest), batch.column(0).take(take), batch.column(1).take(take), pa.array(unit, pa.int32()), pa.array(n, pa.int32())], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.hash(text_col).alias("h"), F.col(text_col).alias("text")).filter("text <> ''")
    return map_arrow(rows, run, "digest long, doc_id long, h int, unit int, words int")


def repeated_units(found: DataFrame) -> DataFrame:
    """Units that occurred before: all but the smallest (doc_id, h, unit) of each digest; null ids last.

    Copies of a digest meet as one partially aggregated row.  The join back is between two
    plain exchanges, so a digest with very many occurrences is split over tasks.
    """
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "unit")
    first = found.groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first")
    return found.join(first, "digest").filter(rank > F.col("first")).select("doc_id", "h", "unit", "words")


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, removed_col: str = "removed") -> DataFrame:
    """``docs`` with repeated passages cut out of the text, and a last column with the spans cut out.

    All other columns are kept.  The last column is called ``removed_col``, with underscores
    before it if the table has such a column: an array of (start, end) in code points of the
    original text, in order.  A null text stays null, an empty one empty.  Rows with the same
    id and text count as one document: all of them keep, or lose, the same passages.  Repeats
    within a text go too.  An empty table gives no row.  Texts are cut and rewritten
    ``SLICE_BYTES`` at a time, a longer text alone.
    """
    removed_col, key, hash_, marks = fresh(docs, removed_col, "__id", "__h", "__marks")
    found = stage(units(docs, id_col, text_col), "units")
    by_doc = repeated_units(found).groupBy("doc_id", "h").agg(F.array_distinct(F.collect_list(F.struct("unit", "words"))).alias(marks))
    by_doc = stage(by_doc.withColumnsRenamed({"doc_id": key + "_", "h": hash_ + "_"}), "repeats")
    unstage(found)
    keyed = docs.withColumns({key: F.col(id_col).cast("long"), hash_: F.hash(text_col)})
    joined = keyed.join(by_doc, keyed[key].eqNullSafe(by_doc[key + "_"]) & (keyed[hash_] == by_doc[hash_ + "_"]), "left")
    joined = joined.select(*docs.columns, F.col(marks).getField("unit").alias(key), F.col(marks).getField("words").alias(hash_))
    schema = T.StructType([*docs.schema.fields, T.StructField(removed_col, T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))])
    place, n, names = docs.columns.index(text_col), len(docs.columns), [*docs.columns, removed_col]
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def rewrite(batches):
        for batch in batches:
            for at, texts in batches_of(batch.column(place), SLICE_BYTES):
                part = batch.slice(at, len(texts))
                removed = [[] for _ in range(len(texts))]
                new = None
                for i in np.flatnonzero(np.asarray(part.column(n).is_valid())).tolist():
                    runs = repeated_runs(part.column(n)[i].as_py(), part.column(n + 1)[i].as_py(), min_words)
                    if runs:
                        new = new or texts.to_pylist()
                        spans = unit_spans(new[i])
                        cut = [(spans[a][0], spans[b][1]) for a, b in runs]
                        new[i] = without(new[i], cut)
                        removed[i] = [{"start": a, "end": b} for a, b in cut]
                columns = [part.column(k) for k in range(n)]
                if new:
                    columns[place] = pa.array(new, columns[place].type)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(removed, spans_type)], names=names)

    return map_arrow(joined, rewrite, schema)


def passage_report(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text without repeated passages, n_removed passages, removed_spans as start:end,... ."""
    rows = docs.select("doc_id", "text")
    done = drop_repeats(rows, min_words=min_words)
    spans = F.transform("removed", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return done.select("doc_id", "text", F.size("removed").cast("long").alias("n_removed"), F.array_join(spans, ",").alias("removed_spans"))
