"""What the merge of suffix runs holds at once."""

import random

import pyarrow as pa

from tidelog.llm import suffixes
from tidelog.llm.suffixes import CORE, WINDOW

from .test_memory import peak


def runs_of(texts, at_once=2000):
    """Rows of runs as the merge step gets them, and their anchors' count."""
    data = [x.encode() for x in texts]
    found = [dict() for _ in data]
    for i, x in enumerate(data):
        for h, _, place, first, last in zip(*(c.tolist() for c in suffixes.anchors(*suffixes.text_buffer(pa.array([x.decode()]))))):
            found[i].setdefault(h, []).append(place << 16 | (place - first) << 8 | (last - first))
    column = [[{"packed": p, "more": None, "n": 2} for ps in f.values() for p in ps] for f in found]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(data))), pa.array(range(len(data))), pa.array(texts), pa.array(column)], ["k1", "k2", "text", "found"])
    rows = pa.Table.from_batches(suffixes._runs(1, 20_000)(batch.slice(low, at_once) for low in range(0, len(data), at_once))).sort_by("part").combine_chunks()
    return rows.to_batches()


def repeats(texts):
    raw, seen = [x.encode() for x in texts], {}
    for i, x in enumerate(raw):
        for s in range(len(x) - WINDOW + 1):
            seen.setdefault(x[s:s + WINDOW], []).append((i, s))
    return {x for at in seen.values() if len(at) > 1 for x in at}


def result(rows):
    gone = set()
    for batch in suffixes._merge(iter(rows)):
        for k1, spans in zip(batch.column("k1").to_pylist(), batch.column("spans").to_pylist()):
            gone |= {(k1, b) for low, high in zip(spans[::2], spans[1::2]) for b in range(low, high)}
    return gone


def test_a_common_string_between_differing_texts():
    r = random.Random(3)

    def some(n):
        return "".join(r.choices("abcdefgh", k=n))

    core = some(CORE + 60)
    texts = [some(150) + core + some(150) for _ in range(3000)]
    rows = runs_of(texts)
    assert result(rows) == set()
    most, _ = peak(suffixes._merge(iter(rows)))
    assert most < 12 << 20


def test_long_copies_go_as_stretches():
    r = random.Random(4)
    text = "".join(r.choices("abcdefgh", k=400_000))
    rows = runs_of([text, "x" + text, "yz" + text], 1)
    assert len(result(rows)) == 3 * len(text)
    most, _ = peak(suffixes._merge(iter(rows)))
    assert most < 10 << 20


def test_windows_that_share_a_part_of_both_sides():
    r = random.Random(5)
    left, core, right = ("".join(r.choices("ab", k=n)) for n in (170, 60, 170))
    texts = []
    for _ in range(400):
        a, b = r.randrange(171), r.randrange(171)
        texts.append("".join(r.choices("ab", k=r.randrange(200))) + left[170 - a:] + core + right[:b] + "".join(r.choices("ab", k=r.randrange(200))))
    want = {(i, b) for i, s in repeats(texts) for b in range(s, s + WINDOW)}
    assert len(want) > 1000
    for few in (suffixes._WINDOWS, 1000, 1):
        suffixes._WINDOWS, kept = few, suffixes._WINDOWS
        try:
            assert result(runs_of(texts)) == want
        finally:
            suffixes._WINDOWS = kept
