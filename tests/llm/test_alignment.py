from __future__ import annotations

import hashlib
import random
from collections import Counter

import edge
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from headrace.llm import alignment, frames

SMALL = "/root/testdata/sf0.001"
A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
SHOWN = {letter: b for b, letter in alignment.vocabulary._SHOWN.items()}


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(libraries, text):
    """Ids and bytes of both sides by the libraries."""
    a, b = libraries
    if not text:
        return [], []
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    side_a = [(i, bytes(SHOWN[c] for c in a.id_to_token(i))) for i in ids_a]
    side_b = [
        (i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
        for i in ids_b
    ]
    raw = (" " + text).encode()
    if any(b"".join(x for _, x in side) != raw for side in (side_a, side_b)):
        return [], []
    return side_a, side_b


def ranges(side):
    ends = np.cumsum([len(x) for _, x in side]).tolist()
    return list(zip([0, *ends], ends))


def brute(libraries, texts):
    rows = []
    for _, text in texts:
        side_a, side_b = tokens(libraries, text)
        at_a, at_b = ranges(side_a), ranges(side_b)
        ends = sorted({e for _, e in at_a} & {e for _, e in at_b})
        groups, first_of = [], [0, 0]
        for end in ends:
            parts = []
            for n, (side, at) in enumerate(((side_a, at_a), (side_b, at_b))):
                k = first_of[n]
                while k < len(at) and at[k][1] <= end:
                    k += 1
                parts.append(",".join(str(i) for i, _ in side[first_of[n] : k]))
                first_of[n] = k
            groups.append("|".join(parts))
        links, first = [], 0
        for (i, _), (s, e) in zip(side_a, at_a):
            while first < len(at_b) and at_b[first][1] <= s:
                first += 1
            k = first
            while k < len(at_b) and at_b[k][0] < e:
                links.append((i, side_b[k][0]))
                k += 1
        rows.append((len(side_a), len(side_b), groups, links))
    count = Counter(pair for *_, links in rows for pair in set(links))
    most: dict[int, int] = {}
    for (a, _), n in count.items():
        most[a] = max(most.get(a, 0), n)
    out = []
    for (i, _), (n_a, n_b, groups, links) in zip(texts, rows):
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        best = sum(count[p] == most[p[0]] for p in links)
        out.append((i, n_a, n_b, len(groups), len(links), best, sum(count[p] for p in links), digest))
    return sorted(out, key=str)


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def check(frame, texts, libraries, **how):
    found = alignment.report(frame, A, B, **how)
    assert found.columns == NAMES
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(libraries, texts)


def test_small_table_both_joins(spark, libraries):
    documents = frames.table(spark, SMALL, "documents")
    texts = [(r["doc_id"], r["text"]) for r in documents.collect()]
    check(documents, texts, libraries)
    check(documents, texts, libraries, broadcast_pairs=0)


ODD = [
    "▁mark", "a ▁ b", "<s> </s> <unk> <0x41> <|endoftext|>", "  two  spaces \n\n x\t", " ", "   ", "x " * 3,
    "x" * 3000, "日本語 中文 😀 é́", "aaa" + " " * 700 + "b ", "ﬁ ² ™ ½", "​﻿\x00\x7f", "\n", "Ünï cödé\r\n",
]


def test_edges(edges, libraries, spark, empty):
    check(edges, edge.TEXTS, libraries)
    texts = list(enumerate(ODD)) + [(None, "no id"), (None, "other"), (3, "again"), (3, "again")]
    check(frames.tune(spark).createDataFrame(edge.rows(texts), edge.SCHEMA), texts, libraries)
    assert alignment.report(empty, A, B).count() == 0


def test_both_sides_give_the_libraries_ids(libraries):
    with open(B, "rb") as file:
        pieces = alignment.Pieces(file.read())
    with open(A, encoding="utf-8") as file:
        plain = alignment.Plain(file.read())
    assert plain.fast is not None
    draw = random.Random(5)
    signs = [*"abc  \n\t .,é́日　 ​😀ﬁ²\x00\x7f<0x41>'s", "the", "▁", "tion", "'ll", "<|endoftext|>"]
    settled = [chr(c) for c in range(0x250)] + [chr(c) for c in range(0x2010, 0x2028)]
    texts = ["".join(draw.choices(signs, k=draw.randint(1, 30))) for _ in range(2000)]
    texts += ["".join(draw.choices(settled, k=draw.randint(1, 30))) for _ in range(3000)]
    texts += [x + c + y for c in settled for x in ("a", " ", "1", ".") for y in ("a", " ", "  b", "1", ".", "'s", "\n")]
    texts += ["a" * 499, "a" * 500, " " * 499 + "b", " " * 500 + "b", "\n" * 700, "ab1." * 300]
    for text in texts:
        ids, spelled = plain.encode(" " + text)
        assert ids.tolist() == libraries[0].encode(" " + text, add_special_tokens=False).ids, repr(text)
        assert spelled == (" " + text).encode()
        assert pieces.encode(" " + text)[0].tolist() == libraries[1].encode(text)


def test_cuts():
    draw = random.Random(6)
    for _ in range(400):
        end_a, end_b, first, base = [], [], [0], 0
        for _ in range(draw.randint(0, 5)):
            size = draw.choice([0, 1, 2, 9, 40, 300])
            if size:
                a = sorted({*draw.sample(range(1, size + 1), draw.randint(0, size)), size})
                b = sorted({*draw.sample(range(1, size + 1), draw.randint(0, size)), size})
                if draw.random() < 0.3:  # hardly a common end
                    a, b = [x for x in a if x % 2 or x == size], [x for x in b if not x % 2 or x == size]
                end_a += [base + x for x in a]
                end_b += [base + x for x in b]
            base += size
            first.append(len(end_a))
        common = set(end_b)
        want = [k for k, x in enumerate(end_a) if x in common]
        arrays = (np.array(v, np.int64) for v in (end_a, end_b, first))
        assert alignment.cuts(*arrays).tolist() == want
