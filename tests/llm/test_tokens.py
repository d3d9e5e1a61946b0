import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kindred.llm import bpe_tree, pfor
from kindred.llm.common import new_dir
from kindred.llm.tokens import ByteEncoder

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PIECES = ["a", "the", "don't", " ", "  ", "\n", "\n\n", "\t", "é", "ß", "漢字", "\0", "\x1c", "\x85", "\xa0", "'s", " 's", "1234", "½", "_", ".", "(!", "<|endoftext|>", "😀", "\r\n", "x" * 70, "İ", "ª"]
ODD = [(None, None), (1, None), (1, ""), (2, "same"), (2, "same"), (2, "other"), (5, "word " * 30_000), (6, "é" * 3000 + " <|endoftext|> b"), (-7, "\n\n x")]


def test_encoder_equals_the_library():
    rng, encoder = random.Random(5), ByteEncoder(BYTE)
    texts = ["", "a", "\n", " ", "\0 a"] + ["".join(rng.choice(PIECES) for _ in range(rng.randrange(14))) for _ in range(1500)]
    plain = Tokenizer.from_file(BYTE)
    assert [x.tolist() for x in encoder.encode(pa.array(texts))] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("make", [lambda r, n: r.integers(0, 50_257, n), lambda r, n: r.integers(0, 2**32, n), lambda r, n: np.full(n, 7), lambda r, n: np.where(r.random(n) < 0.02, 2**31, r.integers(0, 9, n))])
@pytest.mark.parametrize("n", [1, 127, 128, 129, 5000])
def test_blocks_round_trip(make, n):
    ids = make(np.random.default_rng(n), n).astype(np.uint32)
    blocks = pfor.encode_blocks(ids)
    starts = np.cumsum([0, *map(len, blocks)])[:-1].tolist()
    assert np.array_equal(pfor.decode_blocks(b"".join(blocks), starts)[:n], ids)


def test_any_range_can_be_read(tmp_path):
    where, rng = f"file://{tmp_path}", np.random.default_rng(1)
    writer, all_ids = pfor.ShardWriter(where, "a.ktok", "1"), []
    for i, n in enumerate([0, 1, 300, 70_000, 5]):
        ids = rng.integers(0, 50_257, n).astype(np.uint32)
        writer.add(i, ids)
        all_ids += ids.tolist()
    writer.close()
    reader = pfor.ShardReader(where, "a.ktok")
    for start, n in [(0, 1), (127, 3), (299, 70_000), (70_300, 99), (80_000, 5)]:
        assert reader.read(start, n).tolist() == all_ids[start : start + n]
    (tmp_path / "b.ktok").write_bytes((tmp_path / "a.ktok").read_bytes()[:-9])
    with pytest.raises(ValueError):
        pfor.ShardReader(where, "b.ktok")


def test_token_files_of_odd_rows(spark):
    docs = spark.createDataFrame([(*r, "x") for r in ODD], "doc_id long, text string, n_tokens string")
    got = [tuple(r) for r in pfor.token_file_digests(spark, docs, BYTE, 3).collect()]
    plain = Tokenizer.from_file(BYTE)
    digests = [(i, (raw := np.array(plain.encode(t or "", add_special_tokens=False).ids + [0], "<u4")).size, zlib.crc32(raw.tobytes())) for i, t in ODD]
    assert sorted((d, n, c) for d, _, n, c in got if d is not None) == sorted(x for x in digests if x[0] is not None)
    got.sort(key=lambda r: r[1])
    assert [r[1] for r in got] == np.cumsum([0, *(r[2] for r in got)])[:-1].tolist()
    assert [r[0] for r in got] == sorted((r[0] for r in got), key=lambda d: (d is not None, d))
    assert pfor.token_file_digests(spark, docs.filter("false"), BYTE).count() == 0


def test_manifest_and_shards(spark):
    where = new_dir(spark, "tokens")
    docs = spark.createDataFrame([(i, f"text {i} " * (i % 7)) for i in range(100)], "doc_id long, text string")
    manifest = pfor.write_token_files(docs, where, BYTE, 4).collect()
    assert sum(m.n_docs for m in manifest) == 100 and len(manifest) <= 4


def brute(rows):
    plain, out = Tokenizer.from_file(WORD), []
    for i, t in rows:
        ids = plain.encode(t or "", add_special_tokens=False).ids
        text = plain.decode(ids, skip_special_tokens=False)
        out.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


@pytest.mark.parametrize("leaf", [16, 256])
def test_tree_equals_the_library(spark, leaf):
    rng = random.Random(leaf)
    rows = list(ODD)
    for alphabet in ["ab", "theandion", "abcdefghijklmnopqrstuvwxyz", "é漢字ßxyz", "0123456789", "=-_!.", " \n\t<|endoftext|>ABC'sÀİΣ", "aA<|startoftext|>"]:
        rows += [(10, "".join(rng.choice(alphabet) for _ in range(n))) for n in (3, 300, 6000)]
    rows += [(11, "a" * 5000), (11, "ab" * 4000 + " end")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, ids int").repartition(3)
    got = [tuple(r) for r in bpe_tree.encode_decode(docs, WORD, leaf=leaf).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_empty_table(spark):
    assert bpe_tree.encode_decode(spark.createDataFrame([], "doc_id long, text string"), WORD).count() == 0


def test_text_tree_is_exact_wherever_cuts_fall():
    """Ids of texts cut anywhere, even in words, marks and added tokens, are the library's of the whole."""
    rng = random.Random(9)
    bpe = bpe_tree.word_bpe(WORD)
    parts = ["the", "Word", "it's", "12", "?!", "é", "e\u0301", "\u0301", "ΑΣ", "İ", "日本", "<|endoftext|>", "<|endof", "text|>", "\u00a0", "\u2003", "x" * 30, "😀"]
    blanks = [" ", "  ", "\n", "\r\n", "\t", "\x0b", "", "", " \u00a0 "]
    joined = windows = 0
    for _ in range(300):
        text = "".join(rng.choice(parts) + rng.choice(blanks) for _ in range(rng.randrange(1, 120)))
        leaf = rng.choice([1, 3, 8, 40, 200])
        leaves = bpe.text_leaves(bpe_tree._cut(text, leaf))
        joined += len(leaves) > 1
        windows += sum(not x.short for x in leaves)
        assert bpe.text_trees([leaves])[0].tolist() == bpe.tok.encode(text, add_special_tokens=False).ids, text
    assert joined > 200 and windows > 50


def test_long_texts_of_the_table_go_through_the_tree(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    leaf = 512
    assert docs.filter(f"length(text) > {2 * leaf}").count() > 20
    got = {r.doc_id: r.ids_sha256 for r in bpe_tree.encode_decode(docs, WORD, leaf=leaf).collect()}
    tok = bpe_tree.word_bpe(WORD).tok
    for r in docs.collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        assert got[r.doc_id] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
