"""Exact whole-text encoding with the tokenizers library, one distinct unit at a time.

A byte-level tokenizer cuts text into pieces by a fixed pattern and merges inside pieces
only.  A piece always starts at a lone space or newline between two visible characters, so
encoding the distinct units between such cuts once a batch and gathering their ids gives the
library's ids of the whole text.  Other texts go to the library whole: those with other white
space, with an added token's string, or with characters beyond the Latin blocks, on whose
classes two Unicode versions might differ.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are cut and gathered at a time (one larger text goes alone).
BATCH_BYTES = 8_000_000
#: Units encoded side by side in one string, and strings that the library encodes at a time.
BESIDE, TOGETHER = 256, 32
#: Units that are gathered at a time, and bytes of units whose ids are remembered from batch to batch.
GATHERED, REMEMBERED = 1 << 18, 8_000_000

_IRREGULAR = r"[ \n][ \n]|^[ \n]|[ \n]$|[\x{0}\t\r\x{b}\x{c}\x{85}\x{a0}]|[^\x{0}-\x{24f}]"


def batches_of(column: pa.Array, most: int = BATCH_BYTES):
    """(first row, rows) runs of a string column with at most ``most`` bytes, one row at least."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
    start, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and held + n > most:
            yield start, column.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, column.slice(start)


def gather(values: np.ndarray, starts: np.ndarray, counts: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The runs ``values[starts[c] : starts[c] + counts[c]]`` for each of ``codes``, joined."""
    out, done = np.empty(int(sum(counts[codes[i : i + GATHERED]].sum() for i in range(0, len(codes), GATHERED))), values.dtype), 0
    for i in range(0, len(codes), GATHERED):
        part = codes[i : i + GATHERED]
        n = counts[part]
        ends = np.cumsum(n)
        out[done : done + ends[-1]] = values[np.arange(ends[-1]) + np.repeat(starts[part] - (ends - n), n)]
        done += int(ends[-1])
    return out


def encoded(tok, texts: list[str]):
    """Ids of each text; the library's own objects, many times larger, live for a few texts only."""
    for i in range(0, len(texts), TOGETHER):
        for e in tok.encode_batch_fast(texts[i : i + TOGETHER], add_special_tokens=False):
            yield np.array(e.ids, dtype=np.uint32)


def without_memory(path: str, **changes):
    """The tokenizer of a file, its model's word cache off (each distinct unit comes once) and parts changed."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer, models

    spec = json.loads(Tokenizer.from_file(path).to_str()) | changes
    tok = Tokenizer.from_str(json.dumps(spec))
    options = {k: v for k, v in spec["model"].items() if k not in ("type", "vocab", "merges") and v is not None}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
    tok.model = models.BPE(vocab=spec["model"]["vocab"], merges=merges, cache_capacity=0, **options)
    return tok


class UnitMemory:
    """Ids of units that were encoded before, a bounded number of them."""

    def __init__(self, encode):
        self.encode = encode
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.string())
        self.ids, self.starts, self.counts = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def places(self, units: pa.Array) -> np.ndarray:
        """Where in ``starts`` and ``counts`` each of the distinct ``units`` is, after encoding those that were not known."""
        if self.known.nbytes + units.nbytes > REMEMBERED:
            self._forget()
        at = pc.index_in(units, value_set=self.known)
        new = units.filter(pc.is_null(at))
        places = np.asarray(pc.fill_null(at, -1)).astype(np.int64)
        places[places < 0] = len(self.known) + np.arange(len(new))
        if len(new):
            ids, starts, counts = self.encode(new.to_pylist())
            self.starts = np.concatenate([self.starts, starts + len(self.ids)])
            self.counts = np.concatenate([self.counts, counts])
            self.ids = np.concatenate([self.ids, ids])
            self.known = pa.concat_arrays([self.known, new])
        return places


class ByteEncoder:
    """Ids of whole texts as unsigned 32-bit arrays."""

    def __init__(self, path: str):
        self.tok = without_memory(path)
        added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.irregular = "|".join([_IRREGULAR, *map(re.escape, added)])
        size = self.tok.get_vocab_size(with_added_tokens=True)
        self.lengths = np.array([len(self.tok.id_to_token(i) or "") for i in range(size)], dtype=np.int64)
        self.memory = UnitMemory(self._units)

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return list(encoded(self.tok, texts))

    def _units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct units, and where each unit's ids start and how many they are.

        A unit stands for itself with a space before it, unless it starts with a newline or,
        as a text's first unit, with a zero byte.  All but the first units are encoded side by
        side; the byte lengths of the ids tell where each ends.
        """
        beside = [i for i, u in enumerate(units) if u[0] != "\0"]
        whole = [u if u[0] == "\n" else " " + u for u in map(units.__getitem__, beside)]
        runs = self._library(["".join(whole[i : i + BESIDE]) for i in range(0, len(whole), BESIDE)])
        alone = [i for i, u in enumerate(units) if u[0] == "\0"]
        single = self._library([units[i][1:] for i in alone])
        ids = np.concatenate([*runs, *single, np.empty(0, np.uint32)])
        starts, counts = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        joint = sum(map(len, runs))
        size = np.asarray(pc.binary_length(pa.array(whole, pa.string())), dtype=np.int64)
        ends = np.searchsorted(np.cumsum(self.lengths[ids[:joint]]), np.cumsum(size)) + 1
        starts[beside] = np.append(0, ends[:-1])[: len(beside)]
        counts[beside] = ends - starts[beside]
        counts[alone] = [len(x) for x in single]
        starts[alone] = joint + np.cumsum(counts[alone]) - counts[alone]
        return ids, starts, counts

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text of a string array without nulls."""
        out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(texts)
        odd = np.asarray(pc.match_substring_regex(texts, self.irregular)) | (np.asarray(pc.binary_length(texts)) == 0)
        for i in np.flatnonzero(odd).tolist():
            out[i] = self._library([texts[i].as_py()])[0]
        plain = np.flatnonzero(~odd)
        if len(plain):
            marked = pc.binary_join_element_wise("\0", pc.replace_substring(texts.take(pa.array(plain)), "\n", " \n"), "")
            cut = pc.split_pattern(marked, " ")
            coded = cut.flatten().dictionary_encode()
            codes = self.memory.places(coded.dictionary)[np.asarray(coded.indices)]
            all_ids = gather(self.memory.ids, self.memory.starts, self.memory.counts, codes)
            ends = np.append(0, np.cumsum(self.memory.counts[codes]))[np.append(0, np.cumsum(np.asarray(pc.list_value_length(cut))))]
            for k, i in enumerate(plain.tolist()):
                out[i] = all_ids[ends[k] : ends[k + 1]]
        return out


@lru_cache(maxsize=4)
def byte_encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)
