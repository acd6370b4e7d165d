"""BPE encoding and decoding with a table of distinct words.

Texts are taken in blocks (one Arrow batch each).  A block's texts are split into words; its distinct words go, dealt by a
hash, to the tasks of the word table, where each distinct word of the corpus is encoded once; the ids go back to the
block, whose texts are by then arrays of word numbers, and are put in their places.  Texts themselves do not move:
a block travels as compressed word numbers.  Decoding looks every id up in the table of pieces (fixed by the tokenizer).

Null texts are empty: no ids.  Rows are encoded one by one, so repeated rows and ids do not matter.  Further columns are
carried on request.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

from .common import give_back, lean, text_buffer

# White space as the tokenizer's expressions have it: the Unicode property, without the separators 0x1C to 0x1F.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A word is a run of other characters with at most one space before it, or white space that belongs to no such run.  The
#: tokenizer splits words further (letters, digits, signs), but never across these bounds, so they encode one by one.
PATTERN = rf" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
BATCH_BYTES = 32 << 20
_WORDS = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("words", pa.list_(pa.string()))])
_IDS = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("size", pa.int64()), ("ids", pa.binary())])


class Vocabulary:
    """What the tasks need of a tokenizer file: how to split, the special pieces, an encoder of words, the bytes of each id."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} or spec["normalizer"]:
            raise ValueError("a byte-level BPE without normalizer and prefix space is asked for")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        choices = "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
        self.split = re.compile(f"({choices})").split
        self.words = re.compile(PATTERN).findall
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # bytes that print stand for themselves, the others for the characters from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        self.pieces: list[bytes] = [b""] * (1 + max([*spec["model"]["vocab"].values(), *self.special.values()]))
        for piece, i in spec["model"]["vocab"].items():
            self.pieces[i] = bytes(byte[c] for c in piece)
        for piece, i in self.special.items():
            self.pieces[i] = piece.encode()

    def of_text(self, text: str) -> list[str]:
        """The words of a text; a special piece is a word."""
        if not any(s in text for s in self.special):
            return self.words(text)
        return [w for i, part in enumerate(self.split(text)) for w in ([part] if i % 2 else self.words(part))]

    def encode(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit integers."""
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]


@lru_cache(1)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _blocks(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Blocks and their numbers, which depend on their rows alone: a task that runs again makes the same ones."""
    for batch in it:
        column = batch.column("text")
        sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)) // BATCH_BYTES
        edges = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), batch.num_rows]
        for low, high in zip(edges, edges[1:]):
            if low < high:
                block = batch.slice(low, high - low)
                digest = xxhash.xxh3_64()
                for part in (*text_buffer(block.column("text")), repr([block.column(c).to_pylist() for c in block.schema.names if c != "text"]).encode()):
                    digest.update(part)
                yield digest.intdigest() - (1 << 63), block


def _texts(batch: pa.RecordBatch) -> Iterator[str | None]:
    """One text at a time as a string, which may take four times its bytes."""
    return (x.as_py() for x in batch.column("text"))


def _numbered(vocabulary: Vocabulary, texts: Iterable[str | None]) -> tuple[list[str], list[int], np.ndarray]:
    """Distinct words in the order in which they occur, the number of words of each text, and all texts as word numbers."""
    # a factory bound to the dictionary itself would keep it until Python looks for cycles
    numbers: defaultdict[str, int] = defaultdict(count().__next__)
    lengths, flat = [], array("I")
    for text in texts:
        found = vocabulary.of_text(text or "")
        flat.extend(map(numbers.__getitem__, found))
        lengths.append(len(found))
    return list(numbers), lengths, np.array(flat, np.uint32)


def _part(words: list[str], parts: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh32_intdigest(w) % parts for w in words), np.int32, len(words))


def _split(path: str, parts: int):
    def words_of(block: int, batch: pa.RecordBatch) -> pa.RecordBatch:
        distinct: dict[str, None] = {}  # in the order of _numbered
        for text in _texts(batch):
            distinct.update(dict.fromkeys(_vocabulary(path).of_text(text or "")))
        words = list(distinct)
        del distinct
        part = _part(words, parts)
        order = np.argsort(part, kind="stable")
        some, begin = np.unique(part[order], return_index=True)
        taken = pa.array(words, pa.string()).take(pa.array(order))
        lists = pa.ListArray.from_arrays(pa.array([*begin, len(words)], pa.int32()), taken)
        return pa.RecordBatch.from_arrays([pa.array([block] * len(some), pa.int64()), pa.array(some, pa.int32()), lists], schema=_WORDS)

    @lean
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # nothing of a block stays while the next one is split
        return (words_of(*block) for block in _blocks(it))

    return run


def _encode(path: str):
    @lean
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        part, table = None, {}
        for batch in it:
            # in order of part; a batch may hold the words of a whole part, so one row at a time becomes strings
            for block, own, words in (tuple(c[i].as_py() for c in batch.columns) for i in range(batch.num_rows)):
                if own != part:
                    part, table = own, {}
                new = [w for w in words if w not in table]
                table.update(zip(new, vocabulary.encode(new)))
                found = [table[w] for w in words]
                sent = np.array([len(found), *map(len, found)], "<u4").tobytes() + b"".join(found)
                yield pa.RecordBatch.from_arrays([
                    pa.array([block], pa.int64()), pa.array([part], pa.int32()), pa.array([len(sent)], pa.int64()),
                    pa.array([pa.Codec("zstd").compress(sent, asbytes=True)], pa.binary())], schema=_IDS)

    return run


def _pack(path: str, parts: int, carry: list[str]):
    def packed(block: int, batch: pa.RecordBatch) -> pa.RecordBatch:
        codec, sent = pa.Codec("zstd"), {}

        def send(name: str, value: bytes) -> None:
            sent[name] = len(value), codec.compress(value, asbytes=True)

        rest = pa.table([batch.column(c) for c in carry], names=carry)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rest.schema) as out:
            out.write_table(rest)
        send("rest", sink.getvalue().to_pybytes())
        words, lengths, flat = _numbered(_vocabulary(path), _texts(batch))
        part = _part(words, parts).tobytes()
        del words
        send("lengths", np.array(lengths, "<i8").tobytes())
        # the low, middle and high bytes apart compress better
        send("numbers", b"".join((flat >> s & 255).astype(np.uint8).tobytes() for s in (0, 8, 16, 24)))
        send("parts", part)
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), *(pa.array([n], pa.int64()) for n, _ in sent.values()), *(pa.array([v], pa.binary()) for _, v in sent.values())],
            ["block", *(f"{k}_n" for k in sent), *sent])

    @lean
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (packed(*block) for block in _blocks(it))

    return run


def _unpacked(sent: bytes) -> list[bytes]:
    """Ids of each word: their number of words, the lengths, and the ids."""
    lengths = np.frombuffer(sent, "<u4", int.from_bytes(sent[:4], "little"), 4)
    ends = np.cumsum(lengths) + 4 + 4 * len(lengths)
    return [sent[a:b] for a, b in zip((ends - lengths).tolist(), ends.tolist())]


def _join(path: str, names: list[str], texts: bool):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        pieces = np.array(_vocabulary(path).pieces, object)
        ids = {p: _unpacked(pa.Codec("zstd").decompress(x, n, asbytes=True)) for p, n, x in zip(*(right[c].to_pylist() for c in ("part", "size", "ids")))}
        # blocks with equal rows have one number: several rows on the left, and as many equal ones on the right
        out = pa.concat_tables(_placed(left.slice(i, 1), ids, pieces, names, texts) for i in range(left.num_rows))
        ids.clear()
        give_back()
        return out

    return run


def _placed(packed: pa.Table, ids: dict[int, list[bytes]], pieces: np.ndarray, names: list[str], texts: bool) -> pa.Table:
    codec = pa.Codec("zstd")
    sent = {k: codec.decompress(packed[k][0].as_buffer(), packed[f"{k}_n"][0].as_py(), asbytes=True) for k in ("rest", "lengths", "numbers", "parts")}
    rest = pa.ipc.open_stream(sent["rest"]).read_all()
    low, mid, high, top = np.frombuffer(sent["numbers"], np.uint8).reshape(4, -1).astype(np.uint32)
    numbers = low | mid << 8 | high << 16 | top << 24
    part = np.frombuffer(sent["parts"], np.int32)
    table = np.empty(len(part), object)
    for p, found in ids.items():
        table[part == p] = found
    # an id-to-piece look-up for each id of a distinct word
    decoded = np.empty(len(part), object)
    decoded[:] = [b"".join(pieces[np.frombuffer(x, "<u4")]) for x in table]
    at = np.concatenate(([0], np.cumsum(np.frombuffer(sent["lengths"], "<i8"))))
    made: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []} | ({"ids": [], "decoded": []} if texts else {})
    for begin, end in zip(at, at[1:]):
        some = numbers[begin:end]
        encoded = b"".join(table[some])
        plain = b"".join(decoded[some]).decode("utf-8", "replace")
        made["n_tokens"].append(len(encoded) // 4)
        made["ids_sha256"].append(hashlib.sha256(encoded).hexdigest())
        made["decoded_sha256"].append(hashlib.sha256(plain.encode()).hexdigest())
        if texts:
            made["ids"].append(np.frombuffer(encoded, "<u4").astype(np.int32))
            made["decoded"].append(plain)
    kinds = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
    return pa.table([*(rest[c] for c in names), *(pa.array(v, kinds.get(k, pa.string())) for k, v in made.items())], names=[*names, *made])


def bpe_round_trip(docs: DataFrame, path: str, carry: tuple[str, ...] = ("doc_id",), texts: bool = False) -> DataFrame:
    """``carry``, n_tokens, ids_sha256 (of the ids as little-endian 32-bit integers) and decoded_sha256 of each text.

    ``path`` is a byte-level BPE file that all tasks can open.  With ``texts`` the ids and the decoded text follow.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [f"carry_{i}" for i in range(len(carry))]
    rows = docs.select(*(docs[c].alias(n) for c, n in zip(carry, names)), "text")
    kinds = dict(rows.dtypes)
    words = rows.mapInArrow(_split(path, parts), "block long, part int, words array<string>")
    ids = words.repartition("part").sortWithinPartitions("part").mapInArrow(_encode(path), "block long, part int, size long, ids binary")
    packed = rows.mapInArrow(_pack(path, parts, names), "block long, " + "".join(f"{k}_n long, " for k in ("rest", "lengths", "numbers", "parts"))
                             + "rest binary, lengths binary, numbers binary, parts binary")
    out = "".join(f"{n} {kinds[n]}, " for n in names) + "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * texts
    joined = packed.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(_join(path, names, texts), out)
    return joined.withColumnsRenamed(dict(zip(names, carry)))
