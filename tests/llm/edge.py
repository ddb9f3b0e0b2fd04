"""Documents with everything that may go wrong, and helpers of the tests."""

from __future__ import annotations

import re

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that operators use inside.
    "row string, fp long, digest long, word string, items array<string>, spans int, kept boolean, "
    "n_tokens string, start string, lines int, gone int, letter int, _id long, cuts int, h int, doc int"
)

PROSE = (
    "The quick brown fox jumps over the lazy dog while seventeen other animals of the forest "
    "watch from behind a tall green hedge and wonder what all of the noise might be about"
)


def rows(texts: list[tuple[int | None, str | None]], lang: str | None = None) -> list[tuple]:
    clash = ("r", 1, 2, "w", ["i"], 3, True, "n", "s", 4, 5, 6, 7, 8, 9, 10)
    return [(i, t, lang, None, None, *clash) for i, t in texts]


LONG = " ".join(f"Word{i % 977} and" for i in range(30_000)) + "\n" + "x" * 70_000

TEXTS: list[tuple[int | None, str | None]] = [
    (0, ""),
    (1, None),
    (2, " \t\n \r\n "),
    (3, PROSE),
    (4, PROSE),
    (4, PROSE),
    (5, PROSE + "\n" + PROSE.upper() + "\nand a short end"),
    (None, "a row without an id " + PROSE),
    (6, LONG),
    (7, "### $$$ %%%\n*** &&& |||\n12 34 56"),
    (8, "Ünïcödé wörds É́ 中文 😀 \x00 nul <|endoftext|> mark"),
    (9, "Licensed under CC BY-NC 4.0.\nAll Rights Reserved. all rights reserved"),
    (10, "one\none\n\none two\ntwo one\n" * 3),
    (11, "same same same same same same same same same same same same same same same same " * 4),
]


def spaced(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


def alnum(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def by_id(frame) -> dict[int | None, list]:
    out: dict[int | None, list] = {}
    for r in frame.collect():
        out.setdefault(r["doc_id"], []).append(r)
    return out
