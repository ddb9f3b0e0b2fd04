from __future__ import annotations

import edge
import pyarrow as pa

from headrace.llm import words


def test_words_of_texts_that_touch():
    column = pa.array(["ab cd", "ef", "", "  x\ty ", "é É\x00z", None, "averyveryverylongwordindeed ab", "b"])
    for fold, split in ((words.SPACED, edge.spaced), (words.ALNUM, edge.alnum)):
        w = words.words(column.slice(0), fold)
        for i, text in enumerate(column.to_pylist()):
            got = [w.raw[a:b].tobytes() for a, b in zip(w.start[w.first[i] : w.first[i + 1]], w.end[w.first[i] : w.first[i + 1]])]
            assert [edge.lower(g.decode()) for g in got] == [edge.lower(x) for x in split(text)]
    assert len(words.words(pa.array([], pa.string()), words.SPACED).start) == 0


def test_equal_words_have_equal_values_wherever_they_stand():
    texts = ["alpha Beta gammagammagamma", "gammaGAMMAgamma beta", "x alpha"]
    w = words.words(pa.array(texts), words.SPACED)
    named: dict[str, set[int]] = {}
    for a, b, v in zip(w.start, w.end, w.value):
        named.setdefault(w.raw[a:b].tobytes().decode().lower(), set()).add(int(v))
    assert all(len(v) == 1 for v in named.values())
    assert len(set.union(*named.values())) == len(named) == 4


def test_slices_cut_between_rows():
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(50)), "text": ["y" * (k * 13 % 40) for k in range(50)]})
    parts = list(words.slices(batch, "text", 64))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict() and len(parts) > 5
