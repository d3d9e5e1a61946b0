"""Language of words and texts by a linear-chain conditional random field.

States are the learned languages.  A word's emission scores add weights of its prefixes,
suffixes, inner n-grams and whole form (the lexicon), hashed into one table; a learned matrix
scores transitions between neighbouring words.  Forward-backward gives each word's language
probabilities, also in texts that switch language; a text's language is the one with the
largest total over its words.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import map_arrow, stage
from kindred.llm.tokens import batches_of

#: Learning texts a language at most, and of all languages together (one a language at least); words and characters of each (a bounded sample of the labelled rows).
TRAIN_TEXTS, TRAIN_TOTAL, TRAIN_WORDS, TRAIN_CHARS = 300, 12_000, 120, 4000
#: Bits of a feature's hash, weights in the table of all features and languages, code points of a word that features see on either side.
HASH, WEIGHTS, REACH = 17, 1 << 25, 12
EPOCHS, RATE, DECAY = 4, 0.25, 1e-6
#: Languages whose counts are broadcast; more are joined by shuffle.
BROADCAST_LANGS = 100_000
#: Words after which forward and backward scores are normalised.
NORMALISED = 8
#: Sequences of a gradient step.
BATCH = 16
#: Every so many learning sequences, pieces of two languages are joined, so that switches are learned.
SWITCH_EVERY = 3
SEED = 11
UNKNOWN = "und"
#: Numbers in a padded forward-backward block, and in the memory of word emissions.
_SLOTS, _REMEMBERED = 1_600_000, 800_000
#: Bytes of text that are labelled at a time (one larger text goes alone).
SLICE_BYTES = 2_000_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_STRIP = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()) + "«»“”„‘’…–—¿¡"


def words_of(text: str | None) -> list[str]:
    """Lower-case words with a letter, punctuation around them aside."""
    found = [w.strip(_STRIP) for w in (text or "").lower().split()]
    return [w for w in found if w and (w.isalpha() or any(c.isalpha() for c in w))]


def features(words: list[str]) -> np.ndarray:
    """Hashed features, a row a word: lexicon, prefixes and suffixes of 1-4, inner 2- and 3-grams."""
    n = len(words)
    heads = np.zeros((n, REACH), dtype=np.uint64)
    tails = np.zeros((n, REACH), dtype=np.uint64)
    raw = np.frombuffer("".join(w[:REACH].ljust(REACH, "\0") for w in words).encode("utf-32-le"), "<u4").reshape(n, REACH)
    heads[:] = raw
    back = np.frombuffer("".join(w[-REACH:].rjust(REACH, "\0") for w in words).encode("utf-32-le"), "<u4").reshape(n, REACH)
    tails[:] = back[:, ::-1]
    out = []

    def emit(value: np.ndarray, kind: int) -> None:
        h = (value + np.uint64(kind)) * _MIX
        h ^= h >> np.uint64(29)
        out.append(((h * _MIX) >> np.uint64(64 - HASH)).astype(np.int64))

    with np.errstate(over="ignore"):
        for side, kind in ((heads, 1), (tails, 11)):
            value = np.zeros(n, dtype=np.uint64)
            for k in range(4):
                value = value * np.uint64(0x100000001B3) + side[:, k] + np.uint64(1)
                emit(value, kind + k)
        lexicon = np.zeros(n, dtype=np.uint64)
        for k in range(REACH):
            lexicon = lexicon * np.uint64(0x100000001B3) + heads[:, k] + tails[:, k] * np.uint64(31) + np.uint64(1)
        emit(lexicon, 21)
        for size, last in ((2, 7), (3, 6)):
            for at in range(1, last):
                value = np.zeros(n, dtype=np.uint64)
                for k in range(size):
                    value = value * np.uint64(0x100000001B3) + heads[:, at + k] + np.uint64(1)
                emit(np.where(heads[:, at + size - 1] == 0, np.uint64(0), value), 30 + size)
    return np.stack(out, axis=1)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class CRF:
    """Weights of hashed features by language, start and transition scores."""

    def __init__(self, langs: list[str]):
        k = len(langs)
        self.langs = langs
        # with very many languages, features share rows of a smaller table
        self.drop = max(0, HASH + (k - 1).bit_length() - (WEIGHTS.bit_length() - 1))
        self.table = np.zeros((1 << max(0, HASH - self.drop), k), dtype=np.float32)
        self.move = np.zeros((k, k))

    def emissions(self, found: np.ndarray) -> np.ndarray:
        return self.table[found >> self.drop].sum(axis=-2)

    def _scan(self, emit: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward and backward scores and scaled emissions; ``emit`` is (steps, texts, languages), padded.

        Scores of a word are right up to a factor; they are normalised every few words, long
        before they could vanish.
        """
        steps, n, k = emit.shape
        move = np.exp(self.move)
        scaled = np.exp(emit - emit.max(axis=2, keepdims=True))
        ahead, behind = np.empty_like(scaled), np.ones_like(scaled)
        ahead[0] = scaled[0]
        for t in range(1, steps):
            np.matmul(ahead[t - 1], move, out=ahead[t])
            ahead[t] *= scaled[t]
            if t % NORMALISED == 0:
                ahead[t] /= ahead[t].sum(axis=1, keepdims=True)
        for t in range(steps - 2, -1, -1):
            np.matmul(behind[t + 1] * scaled[t + 1], move.T, out=behind[t])
            if t % NORMALISED == 0:
                behind[t] /= behind[t].sum(axis=1, keepdims=True)
            behind[t, t + 1 >= length] = 1.0
        return ahead, behind, scaled

    def marginals(self, emit: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Language probabilities of each word, zero beyond a text's length."""
        ahead, behind, _ = self._scan(emit, length)
        ahead *= behind
        ahead /= ahead.sum(axis=2, keepdims=True)
        ahead[np.arange(len(emit))[:, None] >= length] = 0
        return ahead

    def _expect(self, emit: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected labels of each word, and expected transitions summed over all sequences."""
        ahead, behind, scaled = self._scan(emit, length)
        move = np.exp(self.move)
        pair = np.zeros_like(move)
        for t in range(len(emit) - 1):
            after = scaled[t + 1] * behind[t + 1]
            total = ((ahead[t] @ move) * after).sum(axis=1)
            pair += (ahead[t] * (np.where(t + 1 < length, 1, 0) / total)[:, None]).T @ after
        node = ahead * behind
        node /= node.sum(axis=2, keepdims=True)
        node[np.arange(len(emit))[:, None] >= length] = 0
        return node, pair * move

    def learn(self, sequences: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Gradient ascent on the conditional likelihood of the labels, BATCH padded sequences at a time."""
        rng, k = np.random.default_rng(SEED), len(self.langs)
        sums_t, sums_m = np.full_like(self.table, 1e-6), np.full((k, k), 1e-6)
        for _ in range(EPOCHS):
            order = rng.permutation(len(sequences))
            for at in range(0, len(order), BATCH):
                some = [sequences[i] for i in order[at : at + BATCH]]
                length = np.array([len(label) for _, label in some])
                found = np.zeros((int(length.max()), len(some), some[0][0].shape[1]), dtype=np.int64)
                gold, seen = np.zeros((*found.shape[:2], k)), np.zeros((k, k))
                for j, (rows, label) in enumerate(some):
                    found[: len(label), j] = rows
                    gold[np.arange(len(label)), j, label] = 1
                    np.add.at(seen, (label[:-1], label[1:]), 1)
                node, pair = self._expect(self.emissions(found).astype(np.float64), length)
                step_m = seen - pair
                sums_m += step_m**2
                self.move += RATE * step_m / np.sqrt(sums_m) - DECAY * self.move
                inside = np.arange(len(found))[:, None] < length
                rows = found[inside] >> self.drop
                where, of = np.unique(rows, return_inverse=True)
                step = np.zeros((len(where), k), dtype=np.float32)
                np.add.at(step, of.reshape(-1), np.repeat((gold - node)[inside].astype(np.float32), rows.shape[1], axis=0))
                sums_t[where] += step**2
                self.table[where] += RATE * step / np.sqrt(sums_t[where])


def train(sample: pd.DataFrame) -> CRF | None:
    """A model of the rows (lang, text) of ``sample``; sequences are pieces of up to 40 words."""
    langs = sorted(sample["lang"].unique())
    if not langs:
        return None
    rng = np.random.default_rng(SEED)
    pieces: list[tuple[list[str], int]] = []
    for lang, text in zip(sample["lang"], sample["text"]):
        words = words_of(text)[:TRAIN_WORDS]
        pieces += [(words[i : i + 40], langs.index(lang)) for i in range(0, len(words), 40)]
    pieces = [p for p in pieces if p[0]]
    sequences = []
    for i, (words, label) in enumerate(pieces):
        labels = [label] * len(words)
        if i % SWITCH_EVERY == 0 and len(pieces) > 1:
            other, second = pieces[int(rng.integers(len(pieces)))]
            words, labels = words + other[:20], labels + [second] * len(other[:20])
        sequences.append((features(words), np.array(labels)))
    model = CRF(langs)
    model.learn(sequences)
    return model


class Labeller:
    """Applies a model to texts; remembers the emissions of words it has seen."""

    def __init__(self, model: CRF):
        self.model = model
        self.memory = _REMEMBERED // len(model.langs)
        self.slots = _SLOTS // len(model.langs)
        self.known: dict[str, int] = {}
        self.rows = np.zeros((self.memory, len(model.langs)), dtype=np.float32)

    def _codes(self, texts: list[list[str]]) -> tuple[list[np.ndarray], np.ndarray]:
        """Each text's words as rows of an emission table, and that table."""
        known = self.known
        new = list(set().union(*texts).difference(known))
        if len(known) + len(new) > self.memory:
            known.clear()
            new = list(set().union(*texts))
        rows = self.rows
        if len(new) > self.memory:
            local = {w: i for i, w in enumerate(new)}
            rows = np.concatenate([self.model.emissions(features(new[i : i + 20_000])) for i in range(0, len(new), 20_000)])
        else:
            for i in range(0, len(new), 20_000):
                part = new[i : i + 20_000]
                start = len(known)
                rows[start : start + len(part)] = self.model.emissions(features(part))
                known.update(zip(part, range(start, start + len(part))))
            local = known
        return [np.fromiter(map(local.__getitem__, t), np.int64, len(t)) for t in texts], rows

    def word_marginals(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Language probabilities of every word of each text."""
        out: list[np.ndarray] = [np.zeros((0, len(self.model.langs)))] * len(texts)
        for part, marginals in self._blocks(texts):
            for j, i in enumerate(part):
                out[i] = marginals[: len(texts[i]), j]
        return out

    def _blocks(self, texts: list[list[str]]):
        codes, rows = self._codes(texts)
        order = sorted((i for i in range(len(texts)) if texts[i]), key=lambda i: len(texts[i]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and len(texts[order[end]]) * (end + 1 - at) <= self.slots:
                end += 1
            part = order[at:end]
            length = np.array([len(texts[i]) for i in part])
            grid = np.zeros((int(length.max()), len(part)), dtype=np.int64)
            for j, i in enumerate(part):
                grid[: len(codes[i]), j] = codes[i]
            yield part, self.model.marginals(rows[grid].astype(np.float64), length)
            at = end

    def texts(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, share of the words' probability) of each text."""
        words = [words_of(t) for t in texts]
        out = [(UNKNOWN, 0.0)] * len(texts)
        for part, marginals in self._blocks(words):
            total = marginals.sum(axis=0)
            for i, row in zip(part, total):
                best = int(row.argmax())
                out[i] = (self.model.langs[best], float(min(1.0, row[best] / row.sum())))
        return out


def learning_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> pd.DataFrame:
    """Rows (lang, text) of every language, by hash of the id, none of them held out.

    A language gives TRAIN_TEXTS rows at most, fewer if the languages are so many that they
    would be over TRAIN_TOTAL together, and one at least.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.filter("text is not null and lang is not null").filter(~held_out("doc_id"))
    rows = rows.select("lang", F.xxhash64("doc_id", "text").alias("h"), F.substring(F.substring_index("text", " ", 2 * TRAIN_WORDS), 1, TRAIN_CHARS).alias("text"))
    each = stage(rows.groupBy("lang").agg(F.count("*").alias("n"), F.min("h").alias("first")), "languages")
    langs = each.count()
    most = max(1, min(TRAIN_TEXTS, TRAIN_TOTAL // max(1, langs)))
    share = F.least(F.lit(1.0), 2.0 * most / F.col("n"))
    near = rows.join(F.broadcast(each) if langs <= BROADCAST_LANGS else each, "lang").filter((F.col("h") == F.col("first")) | (F.pmod(F.xxhash64("h"), F.lit(1 << 20)) < share * (1 << 20)))
    chosen = near.groupBy("lang").agg(F.slice(F.array_sort(F.collect_set(F.struct("h", "text"))), 1, most).alias("s"))
    return chosen.select("lang", F.explode("s.text").alias("text")).toPandas().sort_values(["lang", "text"], ignore_index=True)


def held_out(id_col: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def label_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every text.

    Learns from at most TRAIN_TEXTS texts of every language, none of them held out; predicts
    from the text alone, all of it.  A null text, or one without a letter, is ``und``
    with score 0; so is every text if there is nothing to learn from.  Repeated rows are
    labelled each; a null id isn't held out; empty tables give no row.
    """
    model = train(learning_sample(docs, id_col, text_col, lang_col))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))

    def run(batches):
        labeller = labeller_of(sent)
        for batch in batches:
            found: list[tuple[str, float]] = []
            for _, part in batches_of(batch.column(2), SLICE_BYTES):
                found += labeller.texts(part.to_pylist()) if labeller else [(UNKNOWN, 0.0)] * len(part)
            lang, score = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return map_arrow(rows, run, "doc_id long, held_out boolean, lang_pred string, score double")


_labellers: dict[int, Labeller | None] = {}


def labeller_of(sent) -> Labeller | None:
    """The worker's labeller of a broadcast model; one is kept."""
    model = sent.value
    if id(model) not in _labellers:
        _labellers.clear()
        _labellers[id(model)] = Labeller(model) if model else None
    return _labellers[id(model)]
