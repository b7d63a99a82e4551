"""Encoding a whole corpus with a public byte-level BPE vocabulary.

Per batch the distinct pieces of text are encoded together. A pair occurrence
index maps each pair of neighbouring symbols to all its positions in the batch;
the active pairs are merged in ascending order of rank, each at all its
positions at once, and only the lists of the affected neighbours change.

No shuffle, no join: a task needs the vocabulary (a fixed file of 0.8 MB, read
from ``tokenizer_dir`` by the driver and sent along with the job) and its own
rows. The ids of pieces and pairs are kept between batches of a worker, in
tables of bounded size.

Defined results: empty text -> [], null text -> [].
"""

from __future__ import annotations

import base64
import heapq
import os
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the public vocabulary files are; a parameter of every function here.
TOKENIZER_DIR = "/opt/tokenizers"
#: Pieces kept per worker, and the longest piece kept.
CACHE_PIECES, CACHE_CHARS = 400_000, 64
#: Pairs kept per worker, with or without a merge.
CACHE_PAIRS = 2_000_000

#: Fixed value: the white space of the Unicode property.
_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Fixed value: the public vocabulary's split of text into words.
_WORDS = regex.compile(f"'(?:s|t|re|ve|m|ll|d)| ?\\p{{L}}+| ?\\p{{N}}+| ?[^{_WS}\\p{{L}}\\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
#: Coarser: a run without white space and the blank before it. Words never cross its edges.
_PIECES = regex.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")


@lru_cache(maxsize=4)
def vocabulary(name: str, tokenizer_dir: str = TOKENIZER_DIR) -> dict[bytes, int]:
    """Bytes of each token -> its rank, which is its id."""
    path = os.path.join(tokenizer_dir, f"{name}.tiktoken")
    if not os.path.exists(path):
        raise ValueError(f"no byte-level BPE vocabulary named {name!r} in {tokenizer_dir}")
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Tables:
    """What merging needs of a vocabulary: ids of the single bytes, bytes by id, and the merges met so far."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.back = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.back[rank] = token
        self.known: dict[int, int] = {}


_ready: dict[tuple[str, str], Tables] = {}


def _tables(name: str, tokenizer_dir: str, ranks: dict[bytes, int] | None = None) -> Tables:
    """Built once per worker, from ``ranks`` or else from the file."""
    key = name, tokenizer_dir
    if key not in _ready:
        _ready[key] = Tables(ranks if ranks is not None else vocabulary(name, tokenizer_dir))
    return _ready[key]


def merge_words(words: list[bytes], tables: Tables) -> list[list[int]]:
    """Token ids of each word, all words merged together over one pair index."""
    ranks, single, known, back = tables.ranks, tables.single, tables.known, tables.back
    if len(known) > CACHE_PAIRS:
        known.clear()

    def merged(a: int, b: int) -> int:
        """Id of the pair's merge, -1 if it has none."""
        key = a << 20 | b
        if (r := known.get(key)) is None:
            r = known[key] = ranks.get(back[a] + back[b], -1)
        return r

    sym: list[int] = []
    right: list[int] = []
    left: list[int] = []
    starts: list[int] = []
    for w in words:
        p, n = len(sym), len(w)
        starts.append(p if n else -1)
        sym.extend([single[b] for b in w])
        left.extend([-1, *range(p, p + n - 1)] if n else [])
        right.extend([*range(p + 1, p + n), -1] if n else [])
    where: dict[int, list[int]] = defaultdict(list)  # merged id -> positions of its pairs' left symbols
    for p, q in enumerate(right):
        if q >= 0 and (r := merged(sym[p], sym[q])) >= 0:
            where[r].append(p)
    active = list(where)
    heapq.heapify(active)
    while active:
        rank = heapq.heappop(active)
        new: set[int] = set()
        for p in sorted(where.pop(rank, ())):  # left to right within a word
            if sym[p] < 0 or (q := right[p]) < 0 or merged(sym[p], sym[q]) != rank:
                continue  # an earlier merge took one of the two
            sym[p], sym[q] = rank, -1
            right[p] = nxt = right[q]
            if nxt >= 0:
                left[nxt] = p
                if (r := merged(rank, sym[nxt])) >= 0:
                    where[r].append(p)
                    new.add(r)
            if (prv := left[p]) >= 0 and (r := merged(sym[prv], rank)) >= 0:
                where[r].append(prv)
                new.add(r)
        for r in new:
            heapq.heappush(active, r)
    out = []
    for p in starts:
        ids = []
        while p >= 0:
            ids.append(sym[p])
            p = right[p]
        out.append(ids)
    return out


class Encoder:
    """Encodes batches of texts; keeps the ids of short pieces."""

    def __init__(self, name: str, tokenizer_dir: str = TOKENIZER_DIR, ranks: dict[bytes, int] | None = None):
        self.tables = _tables(name, tokenizer_dir, ranks)
        self.kept: dict[str, array] = {}

    def pieces(self, pieces: Iterable[str]) -> dict[str, array]:
        """Ids of the pieces that aren't kept yet."""
        pieces = list(pieces)
        split = [[w.encode("utf-8", "surrogatepass") for w in _WORDS.findall(p)] for p in pieces]
        words = list({w for ws in split for w in ws})
        ids = dict(zip(words, merge_words(words, self.tables), strict=True))
        return {p: array("i", [t for w in ws for t in ids[w]]) for p, ws in zip(pieces, split, strict=True)}

    def encode_batch(self, texts: list[str | None]) -> list[array]:
        """Ids of each text; an empty or null text has none."""
        cut = [_PIECES.findall(t) if t else [] for t in texts]
        if len(self.kept) > CACHE_PIECES:
            self.kept.clear()
        kept = self.kept
        new = self.pieces({p for ps in cut for p in ps if p not in kept})
        kept.update((p, ids) for p, ids in new.items() if len(p) <= CACHE_CHARS)
        out = []
        for ps in cut:
            ids = array("i")
            for p in ps:
                ids.extend(kept.get(p) or new[p])
            out.append(ids)
        return out


def _blocks(texts: list[str | None], chars: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges of about so many characters: batches of long texts stay small."""
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= chars:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def encode_corpus(df: DataFrame, id_col: str, text_col: str, tokenizer: str = "byte_bpe_50k", tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    """(id, ids array<int>) of every row; null and empty texts give an empty list.

    Ids are passed through as they are: null and repeated ids stay. Only the two
    columns named are read, so others may have any name.
    """
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ranks = df.sparkSession.sparkContext.broadcast(vocabulary(tokenizer, tokenizer_dir))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, tokenizer_dir, ranks.value)
        for b in batches:
            texts = b.column(1).to_pylist()
            for lo, hi in _blocks(texts):
                rows = encoder.encode_batch(texts[lo:hi])
                offsets, flat = array("i", [0]), array("i")
                for ids in rows:
                    flat.extend(ids)
                    offsets.append(len(flat))
                lists = pa.ListArray.from_arrays(pa.array(memoryview(offsets), pa.int32()), pa.array(memoryview(flat), pa.int32()) if flat else pa.array([], pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), lists], names=["id", "ids"])

    return src.mapInArrow(run, f"id {dict(src.dtypes)['id']}, ids array<int>").withColumnRenamed("id", id_col)


def count_tokens(df: DataFrame, id_col: str, text_col: str, tokenizer: str = "byte_bpe_50k", tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    """(id, n_tokens bigint) of every row; null and empty texts have 0."""
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ranks = df.sparkSession.sparkContext.broadcast(vocabulary(tokenizer, tokenizer_dir))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, tokenizer_dir, ranks.value)
        for b in batches:
            texts, sizes = b.column(1).to_pylist(), array("q")
            for lo, hi in _blocks(texts):
                sizes.extend(map(len, encoder.encode_batch(texts[lo:hi])))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(memoryview(sizes), pa.int64()) if sizes else pa.array([], pa.int64())], names=["id", "n_tokens"])

    return src.mapInArrow(run, f"id {dict(src.dtypes)['id']}, n_tokens long").withColumnRenamed("id", id_col)


def decode_corpus(df: DataFrame, id_col: str, ids_col: str, tokenizer: str = "byte_bpe_50k", tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    """(id, text) of lists of token ids; an empty or null list gives ''. Bytes that are no text come out as U+FFFD."""
    src = df.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    ranks = df.sparkSession.sparkContext.broadcast(vocabulary(tokenizer, tokenizer_dir))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = _tables(tokenizer, tokenizer_dir, ranks.value).back
        for b in batches:
            texts = [b"".join([back[i] for i in ids or ()]).decode("utf-8", "replace") for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return src.mapInArrow(run, f"id {dict(src.dtypes)['id']}, text string").withColumnRenamed("id", id_col)
