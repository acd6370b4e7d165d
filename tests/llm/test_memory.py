"""What the Python tasks hold at once."""

import random
import tracemalloc

import pyarrow as pa
import public_tokenizers

from tidelog.llm import bpe, suffixes


def peak(rows):
    """Bytes in use at most while the rows are made, and the number of batches."""
    tracemalloc.start()
    n = sum(1 for _ in rows)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most, n


def test_anchors_of_some_texts_are_in_memory_at_once():
    r = random.Random(1)
    texts = pa.array(["".join(r.choices("abcdefgh ", k=4000)) for _ in range(3000)])
    ids = pa.array(range(3000))
    batch = pa.RecordBatch.from_arrays([ids, ids, texts], ["k1", "k2", "text"])
    suffixes.powers(1 << 20)
    for step in (suffixes._anchor_counts, suffixes._anchor_rows):
        whole, small = peak(step(iter([batch]))), peak(step(iter([batch.slice(0, 200)])))
        # one's stretch of a mebibyte takes most of it, however many texts follow
        assert whole[1] > 10 and whole[0] < 1.5 * small[0]


def test_a_block_of_words_is_gone_before_the_next():
    r = random.Random(2)
    path = public_tokenizers.path("byte_bpe_50k.json")
    bpe._vocabulary(path)

    def block(k):
        # a sign beyond 16 bits makes all characters of a text four bytes wide
        texts = pa.array([" ".join(f"{k}x{r.randrange(10**6)}" for _ in range(400)) + " 😀" for _ in range(300)])
        return pa.RecordBatch.from_arrays([pa.array(range(300)), texts], ["doc_id", "text"])

    blocks = [block(k) for k in range(4)]
    for step in (bpe._split(path, 8), bpe._pack(path, 8, ["doc_id"])):
        one, four = peak(step(iter(blocks[:1]))), peak(step(iter(blocks)))
        assert four[1] == 4 and four[0] < 1.25 * one[0]
        assert one[0] < 30 << 20
