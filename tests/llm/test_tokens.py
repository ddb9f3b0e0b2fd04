"""Encoding, counting and storing tokens against the library."""

from __future__ import annotations

import hashlib
import random
import zlib

import edge
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from headrace import session
from headrace.llm import bpe, token_blocks, token_counts, vocabulary

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module", params=[WORD, BYTE])
def both(request):
    with open(request.param, encoding="utf-8") as file:
        return vocabulary.Vocabulary(file.read()), Tokenizer.from_file(request.param)


ODD = [
    "", " ", "  a  b ", "don't 'test **'t12'3 it's\n\n\nx  y", "aaaa aaaaaaa aaa", "a\x1cb \x85 d\xa0e f",
    "<|endoftext|>a<|startoftext|>  b <|endoftext|>", "Σας ΟΔΟΣ Σ́ é ẛ̣ ſ ﬁ Å", "中文字符 测试, 日本語。",
    "١٢٣ ² ½ Ⅷ x²", "😀😀 a😀b", "\r\n\r\n a\t b\n c", "'s're 've'x", "İstanbul ǅ", "a  \n  b\n c \n",
    " 　", "̈a ̈", "x" * 500 + " ", "=====\n-----'\n", "ÿẞ straße µ ª × ÷",
]


def test_ids_are_the_library_s(both):
    vocab, library = both
    draw = random.Random(1)
    signs = "aab 'tsre\n\té.,!12<|>_́Σ中 \x85"
    texts = ODD + ["".join(draw.choice(signs) for _ in range(draw.randint(1, 40))) for _ in range(3000)]
    for text in texts:
        assert vocab.ids(text) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_counts_of_all_prefixes(both):
    vocab, library = both
    for word in ("unbelievable", "aaaaaaaaaa", "thththethe", "internationalisation", "zzz"):
        counts = token_counts.prefix_counts(vocab, word)
        for end in range(1, len(word) + 1):
            last, at, n = vocab.last_tokens(word[:end]), end, 0
            while at:
                at, n = at - last[at][1], n + 1
            assert counts[end] == n
            if not vocab.suffix:
                assert n == len(library.encode(word[:end], add_special_tokens=False).ids)


def test_truncation_keeps_the_budget(spark, docs):
    library = Tokenizer.from_file(BYTE)
    texts = [edge.PROSE, "a<|endoftext|>b c", "", None, "中文 😀😀", "internationalisation"]
    for budget in (0, 1, 3, 8, 1000):
        for i, r in enumerate(sorted(token_counts.truncate(docs(*texts), BYTE, budget).collect())):
            whole = library.encode(texts[i] or "", add_special_tokens=False)
            assert (texts[i] or "").startswith(r["text"])
            if len(whole.ids) <= budget:
                assert r["text"] == (texts[i] or "")
            elif texts[i].isascii():
                assert r["n_bytes"] == (whole.offsets[budget - 1][1] if budget else 0)


def test_edges(spark, edges, empty, tmp_path):
    word, byte = Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)
    path = session.fresh_dir(spark, "test-blocks")
    token_blocks.write(edges, path, WORD)
    encoded, counted = edge.by_id(bpe.digests(edges, WORD, with_ids=True)), edge.by_id(token_counts.count(edges, BYTE, 8))
    plain, stored = edge.by_id(bpe.encode(edges, WORD)), edge.by_id(token_blocks.digests(spark, path))
    assert sum(map(len, stored.values())) == len(edge.TEXTS)
    at = 0
    for i, text in sorted(edge.TEXTS, key=lambda t: (t[0] is not None, t[0] or 0)):
        ids = word.encode(text or "", add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        shown = word.decode(ids, skip_special_tokens=False)
        for r in encoded[i]:
            assert r["n_tokens"] == len(ids) and list(r["ids"]) == ids
            assert r["ids_sha256"] == hashlib.sha256(raw).hexdigest()
            assert r["decoded_sha256"] == hashlib.sha256(shown.encode()).hexdigest()
        assert all(list(r["ids"]) == ids and r["decoded"] == shown for r in plain[i])
        n = len(byte.encode(text or "", add_special_tokens=False).ids)
        for r in counted[i]:
            assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((text or "").encode()), n, n > 8)
        full = np.array([*ids, 2], "<u4").tobytes()
        assert (at, len(ids) + 1, zlib.crc32(full)) in {(r["start"], r["n_tokens"], r["ids_crc32"]) for r in stored[i]}
        at += len(ids) + 1
    for none in (bpe.digests(empty, WORD), token_counts.count(empty, BYTE), bpe.encode(empty, WORD)):
        assert none.count() == 0
    path = session.fresh_dir(spark, "test-blocks")
    token_blocks.write(empty, path, WORD)
    assert token_blocks.digests(spark, path).count() == 0


def test_decoding_joins_vocabulary_strings(spark):
    library = Tokenizer.from_file(WORD)
    lists = [[1000, 49407, 5000], [], None, [320, 320]]
    frame = spark.createDataFrame(list(enumerate(lists)), "doc_id long, ids array<int>")
    for r in bpe.decode(frame, WORD).collect():
        assert r["decoded"] == library.decode(lists[r["doc_id"]] or [], skip_special_tokens=False)


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
def test_blocks_round_trip(n):
    draw = np.random.default_rng(n)
    for ids in (
        draw.integers(0, 50_000, n), draw.integers(0, 3, n), np.full(n, 7),
        np.where(draw.random(n) < 0.05, 2**32 - 1, draw.integers(5, 9, n)), draw.integers(0, 2**32, n),
    ):
        ids = ids.astype(np.uint32)
        at, payload = token_blocks.pack(ids)
        assert (token_blocks.unpack(at, payload)[:n] == ids).all()
        for k in range(0, len(at), 3):
            some = token_blocks.unpack(at[k : k + 1], payload)[: n - 128 * k]
            assert (some == ids[128 * k : 128 * k + 128]).all()


def test_runs_are_read_from_the_blocks_that_hold_them(spark, docs):
    texts = [f"{edge.PROSE} {i}" * 40 for i in range(60)]
    path = session.fresh_dir(spark, "test-blocks")
    token_blocks.write(docs(*texts), path, WORD)
    whole = np.concatenate([r["ids"] for r in sorted(token_blocks.read(spark, path).collect(), key=lambda r: r["start"])])
    for start, length in ((0, 1), (130, 300), (65_000, 2000), (len(whole) - 5, 50)):
        got = [i for r in sorted(token_blocks.read_run(spark, path, start, length).collect()) for i in r["ids"]]
        assert got == whole[start : start + length].tolist()


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_stored_ids_are_the_library_s_with_special_tokens_and_case(path):
    with open(path, encoding="utf-8") as file:
        vocab = vocabulary.Vocabulary(file.read())
    texts = ["<|endoftext|> A<|startoftext|>b", "<|ENDOFTEXT|>", None, "é  x\x1cy", "THE the ThE"]
    for text, ids in zip(texts, token_blocks.encode(vocab, pa.array(texts), 2)):
        assert ids.tolist() == [*vocab.library.encode(text or "", add_special_tokens=False).ids, 2]
