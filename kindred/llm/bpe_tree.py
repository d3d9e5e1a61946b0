"""Byte-pair encoding of long texts by tree concatenation, and decoding.

A long text is cut in leaves, wherever that falls, which are encoded in parallel; neighbours
are then joined pairwise, in a tree: a window around the join is encoded again, growing until
it starts with ids of the left side and ends in ids of the right side, exactly.  Windows begin
and end at blanks, where no piece goes on, so the agreement makes the join exact.

A piece without a blank may be very long too.  It is cut into leaves of the symbols that the
merges work on, and joined the same way: a sequence whose neighbouring ids are each the
encoder's own choice for their joint text is the encoding of the whole.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from itertools import groupby
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import map_arrow, shuffle_partitions, stage
from kindred.llm.tokens import UnitMemory, batches_of, encoded, gather, without_memory

#: Code points of a text's leaf and symbols (bytes) of a piece's; texts and pieces of more than two leaves go through the tree.
LEAF = 4096
#: Bytes of ids that a task joins at a time (one larger text goes alone).
JOINED_BYTES = 1_000_000
#: Words that the first window takes from either side, and kinds of parts.
WORDS = 4
IDS, PIECE, TEXT = range(3)
#: Ids by which a window must agree with either side, and ids a side in the first window.
AGREE, WINDOW = 4, 16
#: Words encoded side by side in one string.
BESIDE = 256

_SPACES = re.compile("[\t-\r ]+")


class WordBPE:
    """The encoder of a word-level BPE file: its library pipeline taken apart at the pieces."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.added = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        self.split_added = re.compile("(" + "|".join(sorted(map(re.escape, self.added), key=len, reverse=True)) + ")") if self.added else None
        # the same pieces and model for normalised words, where an added token's string is plain text
        self.bare = without_memory(path, normalizer=None, added_tokens=[], truncation=None, padding=None)
        self.model = self.bare.model
        self.suffix = self.model.end_of_word_suffix or ""
        self.small = "<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4"
        size = self.tok.get_vocab_size(with_added_tokens=False)
        self.lengths = np.array([len((self.bare.id_to_token(i) or "").removesuffix(self.suffix)) for i in range(size)], dtype=np.int64)
        self.memory = UnitMemory(self.words)

    def normalised(self, text: str) -> str:
        if text.isascii():
            return _SPACES.sub(" ", text).lower()
        return self.tok.normalizer.normalize_str(text)

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words without white space, and where each word's start and how many they are.

        White space always ends a piece, so words are encoded side by side; the byte lengths of
        the ids tell where each ends.
        """
        joined = [" ".join(words[i : i + BESIDE]) for i in range(0, len(words), BESIDE)]
        ids = np.concatenate([*encoded(self.bare, joined), np.empty(0, np.uint32)])
        size = np.asarray(pc.binary_length(pa.array(words, pa.string())), dtype=np.int64)
        reached = np.append(0, np.cumsum(self.lengths[ids]))
        ends = np.searchsorted(reached, np.cumsum(size))
        starts = np.append(0, ends[:-1])[: len(words)]
        return ids, starts, np.where(size > 0, ends - starts, 0)

    def _ids(self, words: list[str]) -> bytes:
        return self.words([w for w in words if w])[0].astype("<u4").tobytes()

    def encode(self, texts: list[str], limit: int) -> list[bytes | list[bytes | str]]:
        """Each text's ids as bytes; or its parts, if it has a piece of over ``limit`` symbols."""
        out: list = [b""] * len(texts)
        plain, clean = [], []
        for i, text in enumerate(texts):
            if self.split_added and self.split_added.search(text):
                out[i] = self.parts(text, limit)
            else:
                plain.append(i)
                clean.append(self.normalised(text))
        cut = pc.split_pattern(pa.array(clean, pa.string()), " ")
        coded = cut.flatten().dictionary_encode()
        words, codes = coded.dictionary, np.asarray(coded.indices)
        ends = np.append(0, np.cumsum(np.asarray(pc.list_value_length(cut), dtype=np.int64)))
        large = np.asarray(pc.binary_length(words)) > limit
        if large.any():
            words = pc.if_else(pa.array(large), "", words)
        places = self.memory.places(words)[codes]
        ids, starts, counts = self.memory.ids, self.memory.starts, self.memory.counts
        all_ids = gather(ids, starts, counts, places).astype("<u4")
        at = np.append(0, np.cumsum(counts[places]))[ends]
        for k, i in enumerate(plain):
            if large.any() and large[codes[ends[k] : ends[k + 1]]].any():
                out[i] = self.parts(texts[i], limit)
            else:
                out[i] = all_ids[at[k] : at[k + 1]].tobytes()
        return [b"".join(x) if isinstance(x, list) and not any(isinstance(p, str) for p in x) else x for x in out]

    def symbols(self, symbols: str) -> tuple[list[int], list[int]]:
        """Ids of one piece, given as byte-level symbols, and their lengths in symbols."""
        found = self.model.tokenize(symbols)
        cut = len(self.suffix)
        sizes = [len(t.value) - cut if self.suffix and t.value.endswith(self.suffix) else len(t.value) for t in found]
        return [t.id for t in found], sizes

    def parts(self, text: str, limit: int) -> list[bytes | str]:
        """A text's ids as bytes, and between them its long pieces as symbol strings, in order."""
        out: list[bytes | str] = []
        for segment in self.split_added.split(text) if self.split_added else [text]:
            if segment in self.added:
                out.append(np.array([self.added[segment]], "<u4").tobytes())
                continue
            words = self.normalised(segment).split(" ")
            small: list[str] = []
            for word in words:
                if len(word.encode("utf-8")) <= limit:
                    small.append(word)
                    continue
                for symbols, _ in self.bare.pre_tokenizer.pre_tokenize_str(word):
                    if len(symbols) <= limit:
                        out.append(self._ids(small))
                        small = []
                        out.append(np.array(self.symbols(symbols)[0], "<u4").tobytes())
                    else:
                        out.append(self._ids(small))
                        small = []
                        out.append(symbols)
            out.append(self._ids(small))
        return out

    def join(self, left: tuple[list[int], list[int]], right: tuple[list[int], list[int]], symbols: str) -> tuple[list[int], list[int]]:
        """The encoding of ``symbols``, the joint text of two encoded neighbours."""
        (a_ids, a_len), (b_ids, b_len) = left, right
        a_at, b_at = np.concatenate([[0], np.cumsum(a_len)]), np.concatenate([[0], np.cumsum(b_len)])
        middle = int(a_at[-1])
        reach = WINDOW
        while True:
            i, j = max(0, len(a_ids) - reach), min(len(b_ids), reach)
            begin, end = int(a_at[i]), middle + int(b_at[j])
            ids, sizes = self.symbols(symbols[begin:end])
            ok = i == 0 or (reach > AGREE and ids[:AGREE] == a_ids[i : i + AGREE])
            if ok and j == len(b_ids):
                return a_ids[:i] + ids, a_len[:i] + sizes
            if ok:
                place = {int(x) + middle: k for k, x in enumerate(b_at[: j + 1])}
                at = begin
                for k, size in enumerate(sizes):
                    # the window's last ids see an end that is not there: agreement must come before them
                    if at > middle and at in place and k + AGREE < len(ids):
                        m = place[at]
                        if m + AGREE <= j and ids[k : k + AGREE] == b_ids[m : m + AGREE]:
                            return a_ids[:i] + ids[:k] + b_ids[m:], a_len[:i] + sizes[:k] + b_len[m:]
                    at += size
            reach *= 2

    def tree(self, leaves: list[tuple[list[int], list[int]]], symbols: list[str]) -> list[int]:
        """Joins neighbouring leaves pairwise until one sequence is left."""
        while len(leaves) > 1:
            joint = ["".join(symbols[k : k + 2]) for k in range(0, len(symbols), 2)]
            leaves = [self.join(leaves[2 * k], leaves[2 * k + 1], joint[k]) if 2 * k + 1 < len(leaves) else leaves[2 * k] for k in range(len(joint))]
            symbols = joint
        return leaves[0][0]

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts that are encoded in one go."""
        return [np.frombuffer(x, "<u4") for x in self.encode(texts, 1 << 62)]

    def text_leaves(self, texts: list[str]) -> list["Leaf"]:
        """Encoded leaves, with first and last words that have ids enough to agree, apart from the words at the very ends, which a cut may have split."""
        edges: list = [None] * len(texts)
        words, open_ = 2 * WORDS, range(len(texts))
        while open_:
            for i in open_:
                head, tail = _first_words(texts[i], words), _last_words(texts[i], words)
                edges[i] = (texts[i], texts[i], True) if texts[i] in (head, tail) else (head, tail, False)
            left = [i for i in open_ if not edges[i][2]]
            inner = self.whole([x for i in left for x in (_last_words(edges[i][0], words - 1), _first_words(edges[i][1], words - 1))])
            open_ = [i for k, i in enumerate(left) if min(len(inner[2 * k]), len(inner[2 * k + 1])) < 2 * AGREE]
            words *= 2
        return [Leaf(ids, *edge) for ids, edge in zip(self.whole(texts), edges)]

    def join_texts(self, pairs: list[tuple["Leaf", "Leaf"]]) -> list["Leaf"]:
        """The joint text of each two encoded neighbours, encoded again in a window around the join."""
        out: list = [None] * len(pairs)
        words, open_ = WORDS, list(range(len(pairs)))
        while open_:
            cut = [(_last_words(pairs[i][0].tail, words), _first_words(pairs[i][1].head, words)) for i in open_]
            ids = self.whole([x for a, b in cut for x in (a, b, a + b)])
            again = []
            for k, (i, (a, b)) in enumerate(zip(open_, cut)):
                (left, right), (old_a, old_b, new) = pairs[i], ids[3 * k : 3 * k + 3]
                fits = np.array_equal(left.ids[len(left.ids) - len(old_a) :], old_a) and np.array_equal(right.ids[: len(old_b)], old_b)
                starts = left.short and a == left.tail or len(old_a) >= AGREE and np.array_equal(new[:AGREE], old_a[:AGREE])
                ends = right.short and b == right.head or len(old_b) >= AGREE and np.array_equal(new[len(new) - AGREE :], old_b[len(old_b) - AGREE :])
                if fits and starts and ends:
                    joint = np.concatenate([left.ids[: len(left.ids) - len(old_a)], new, right.ids[len(old_b) :]])
                    out[i] = Leaf(joint, left.head + right.head if left.short else left.head, left.tail + right.tail if right.short else right.tail, left.short and right.short)
                elif a == left.tail and b == right.head:
                    raise ValueError("the two sides of a join do not agree")  # their leaves were not encoded by this tokenizer
                else:
                    again.append(i)
            words, open_ = 2 * words, again
        return out

    def text_trees(self, many: list[list["Leaf"]]) -> list[np.ndarray]:
        """Joins neighbouring leaves of each text pairwise, a level of all trees at a time, until each text is one sequence."""
        many = list(many)
        while any(len(leaves) > 1 for leaves in many):
            at = [(i, k) for i, leaves in enumerate(many) for k in range(0, len(leaves) - 1, 2)]
            joined = dict(zip(at, self.join_texts([tuple(many[i][k : k + 2]) for i, k in at])))
            many = [[joined.get((i, k), leaves[k]) for k in range(0, len(leaves), 2)] for i, leaves in enumerate(many)]
        return [leaves[0].ids for leaves in many]

    def joined(self, part: list[dict], trees) -> bytes:
        """Ids of one part of a text; those of whole texts are the next of ``trees``."""
        kind = part[0]["kind"]
        if kind == IDS:
            return part[0]["ids"]
        if kind == TEXT:
            return next(trees).tobytes()
        leaves = [(np.frombuffer(r["ids"], "<u4").tolist(), np.frombuffer(r["sizes"], "<u4").tolist()) for r in part]
        return np.array(self.tree(leaves, [r["symbols"] for r in part]), "<u4").tobytes()

    def decode(self, many: list[bytes]) -> list[str]:
        return self.tok.decode_batch([np.frombuffer(x, "<u4").tolist() for x in many], skip_special_tokens=False)


@lru_cache(maxsize=4)
def word_bpe(path: str) -> WordBPE:
    return WordBPE(path)


class Leaf(NamedTuple):
    """A stretch of text: its ids, its first and last words, and whether these are each the whole stretch."""

    ids: np.ndarray
    head: str
    tail: str
    short: bool


_BLANKS = " \n\t\r\x0b\x0c"


def _first_words(text: str, n: int) -> str:
    """The text up to a blank after ``n`` words, or all of it."""
    found = re.match(r"(?:[\t-\r ]*+[^\t-\r ]++){%d}(?=[\t-\r ])" % n, text)
    return text[: found.end()] if found else text


def _last_words(text: str, n: int) -> str:
    """The text from a blank before the last ``n`` words on, or all of it."""
    at = len(text)
    while n and at >= 0:
        end = at
        at = max(text.rfind(c, 0, at) for c in _BLANKS)
        n -= end > at + 1
    return text[max(at, 0) :]


def _cut(symbols: str, leaf: int) -> list[str]:
    return [symbols[i : i + leaf] for i in range(0, len(symbols), leaf)]


def _digest(ids: list[bytes], texts: list[str]) -> list[list]:
    return [
        [len(x) // 4 for x in ids],
        [hashlib.sha256(x).hexdigest() for x in ids],
        [hashlib.sha256(t.encode("utf-8")).hexdigest() for t in texts],
    ]


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", leaf: int = LEAF) -> DataFrame:
    """Encode and decode every text: doc_id, n_tokens, ids_sha256, decoded_sha256.

    A null text is an empty one; each repeated row gives a row.  An empty table gives none.
    Texts of up to two leaves are done where they are read.  The leaves of longer texts, or of
    their pieces if one is longer than two leaves, are dealt out over all tasks and encoded;
    then each text's ids meet in one task, which joins them.  No task holds more than its own
    texts.
    """
    limit = 2 * leaf
    unbroken = re.compile(r"[^\t-\r ]{%d}" % max(1, limit // 4))  # four bytes a code point at most
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    first = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("part", pa.int32()), ("leaf", pa.int32()), ("kind", pa.int32()), ("symbols", pa.string()), ("ids", pa.binary()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    ddl = "doc_id long, key long, part int, leaf int, kind int, symbols string, ids binary, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def encode(batches):
        bpe, key = word_bpe(tokenizer), TaskContext.get().partitionId() << 33
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for at, texts in batches_of(batch.column(1)):
                out, done, done_docs, here, here_docs = [], [], [], [], []
                for doc_id, text in zip(doc_ids[at:], texts.to_pylist()):
                    if len(text) > limit and not unbroken.search(text):
                        key += 1
                        out += [(doc_id, key, 0, i, TEXT, s, None, None, None, None) for i, s in enumerate(_cut(text, leaf))]
                    else:
                        here.append(text)
                        here_docs.append(doc_id)
                for doc_id, found in zip(here_docs, bpe.encode(here, limit) if here else []):
                    key += 1
                    if isinstance(found, bytes):
                        done.append(found)
                        done_docs.append(doc_id)
                        continue
                    for k, part in enumerate(found):
                        if isinstance(part, str):
                            out += [(doc_id, key, k, i, PIECE, s, None, None, None, None) for i, s in enumerate(_cut(part, leaf))]
                        else:
                            out.append((doc_id, key, k, 0, IDS, None, part, None, None, None))
                out += [(d, None, None, None, None, None, None, n, a, b) for d, n, a, b in zip(done_docs, *_digest(done, bpe.decode(done)))]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), first)], schema=first)

    def encode_leaves(batches):
        bpe = word_bpe(tokenizer)
        for batch in batches:
            kinds, symbols, ids = (batch.column(c).to_pylist() for c in ("kind", "symbols", "ids"))
            texts = iter(bpe.text_leaves([s for k, s in zip(kinds, symbols) if k == TEXT]) if TEXT in kinds else [])
            made = []
            for kind, text, old in zip(kinds, symbols, ids):
                if kind == TEXT:
                    found = next(texts)
                    made.append((None, found.ids.astype(bpe.small).tobytes(), None, found.head, None if found.short else found.tail))
                elif kind == PIECE:
                    x, y = bpe.symbols(text)
                    made.append((text, np.array(x, "<u4").tobytes(), np.array(y, "<u4").tobytes(), None, None))
                else:
                    made.append((None, old, None, None, None))
            kept = ["doc_id", "key", "part", "leaf", "kind"]
            types = (pa.string(), pa.binary(), pa.binary(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), *(pa.array(c, t) for c, t in zip(zip(*made), types))], names=[*kept, "symbols", "ids", "sizes", "head", "tail"])

    def join_leaves(batches):
        bpe = word_bpe(tokenizer)

        def joined(texts: list[list[dict]]) -> pa.RecordBatch:
            parts = [[list(part) for _, part in groupby(text, itemgetter("part"))] for text in texts]
            long = [part for text in parts for part in text if part[0]["kind"] == TEXT]
            trees = iter(bpe.text_trees([[Leaf(np.frombuffer(r["ids"], bpe.small).astype("<u4"), r["head"], r["head"] if r["tail"] is None else r["tail"], r["tail"] is None) for r in part] for part in long]))
            ids = [b"".join(bpe.joined(part, trees) for part in text) for text in parts]
            n, a, b = _digest(ids, bpe.decode(ids))
            return pa.RecordBatch.from_arrays([pa.array([t[0]["doc_id"] for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], names=result)

        waiting, size = [], 0
        for _, text in groupby((row for batch in batches for row in batch.to_pylist()), itemgetter("key")):
            waiting.append(list(text))
            size += sum(len(r["ids"]) for r in waiting[-1])
            if size > JOINED_BYTES:
                yield joined(waiting)
                waiting, size = [], 0
        if waiting:
            yield joined(waiting)

    result = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    found = stage(map_arrow(rows, encode, ddl), "bpe")
    short = found.filter("n_tokens is not null").select(*result)
    leaves = found.filter("n_tokens is null").select("doc_id", "key", "part", "leaf", "kind", "symbols", "ids")
    leaves = leaves.repartition(shuffle_partitions(docs.sparkSession), "key", "part", "leaf")
    leaves = map_arrow(leaves, encode_leaves, "doc_id long, key long, part int, leaf int, kind int, symbols string, ids binary, sizes binary, head string, tail string")
    leaves = leaves.repartition(shuffle_partitions(docs.sparkSession), "key").sortWithinPartitions("key", "part", "leaf")
    long = map_arrow(leaves, join_leaves, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return short.unionByName(long.select(*result))
