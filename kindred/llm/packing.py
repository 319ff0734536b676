"""Lexical retrieval packing of whole documents into windows.

Documents are packed where they are read: a shard is a run of at most ``SHARD_DOCS`` documents or ``SHARD_TOKENS`` ids
of one input partition, so nothing is shuffled and a lost task packs the same shard again. A shard's documents are
indexed whole by a BM25 inverted index, though full windows are cut from the long ones first; each seed's query returns the unused neighbours that share its telling terms, and
they fill its window greedily, the last one cut to fit.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm import tokens
from kindred.llm.common import text_of

SHARD_DOCS, SHARD_TOKENS = 2048, 4_000_000
QUERY_TERMS, K1, B = 12, 1.2, 0.75


class Bm25:
    """An inverted index of a shard: postings by term, each with its BM25 weight."""

    def __init__(self, docs: list[np.ndarray]) -> None:
        found = [np.unique(d, return_counts=True) for d in docs]
        self.n = len(docs)
        sizes = np.array([len(t) for t, _ in found])
        doc = np.repeat(np.arange(self.n), sizes)
        term, place = np.unique(np.concatenate([t for t, _ in found]), return_inverse=True)
        tf = np.concatenate([c for _, c in found]).astype(np.float64)
        df = np.bincount(place, minlength=len(term))
        idf = np.log1p((self.n - df + 0.5) / (df + 0.5))
        long = np.array([len(d) for d in docs], np.float64)
        weight = idf[place] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * long[doc] / max(1.0, long.mean())))
        order = np.argsort(place, kind="stable")
        self.docs, self.weights = doc[order], weight[order]
        self.starts = np.concatenate([[0], np.cumsum(df)])
        telling = np.where(df[place] > 1, weight, 0.0)  # a term that one document alone has finds nothing
        ends = np.cumsum(sizes)
        self.queries = []
        for a, b in zip(ends - sizes, ends):
            w = telling[a:b]
            top = np.argpartition(-w, QUERY_TERMS)[:QUERY_TERMS] if len(w) > QUERY_TERMS else np.arange(len(w))
            self.queries.append(place[a:b][top[w[top] > 0]])

    def neighbours(self, doc: int, unused: np.ndarray) -> np.ndarray:
        """The unused documents that share a telling term with ``doc``, best first."""
        runs = [np.arange(self.starts[t], self.starts[t + 1]) for t in self.queries[doc]]
        if not runs:
            return np.empty(0, np.int64)
        at = np.concatenate(runs)
        score = np.bincount(self.docs[at], self.weights[at], self.n)
        score[~unused] = 0
        score[doc] = 0
        hits = np.flatnonzero(score)
        return hits[np.argsort(-score[hits], kind="stable")]


def pack(docs: list[np.ndarray], window: int) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset): each id in exactly one piece, sequences of at most ``window``."""
    out, sequence = [], 0
    start = np.zeros(len(docs), np.int64)
    for d, ids in enumerate(docs):
        while len(ids) - start[d] >= window:
            out.append((d, int(start[d]), window, sequence, 0))
            start[d] += window
            sequence += 1
    tails = [d for d, ids in enumerate(docs) if len(ids) > start[d]]
    if not tails:
        return out
    left = np.array([len(docs[d]) - start[d] for d in tails])
    unused = np.ones(len(tails), bool)
    index = Bm25([docs[d] for d in tails])
    following = 0
    for seed in range(len(tails)):
        if not unused[seed]:
            continue
        used, sequence = 0, sequence + 1

        def put(t: int) -> None:
            nonlocal used
            size = min(int(left[t]), window - used)
            out.append((tails[t], int(start[tails[t]]), size, sequence - 1, used))
            start[tails[t]] += size
            left[t] -= size
            used += size
            unused[t] = left[t] > 0

        put(seed)
        if used < window:
            for t in index.neighbours(seed, unused):
                put(int(t))
                if used == window:
                    break
        while used < window:  # no more neighbours: documents in their order
            while following < len(tails) and not unused[following]:
                following += 1
            if following == len(tails):
                break
            put(following)
    return out


SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def _packer(window: int, folder: str, vocabulary: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, sequence = tokens.load(folder, vocabulary), TaskContext.get().partitionId() << 40
        names, docs, size = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal sequence
            pieces = pack(docs, window)
            columns = [
                [names[d] for d, *_ in pieces],
                [s for _, s, *_ in pieces],
                [n for _, _, n, *_ in pieces],
                [zlib.crc32(docs[d][s : s + n].astype("<u4").tobytes()) for d, s, n, *_ in pieces],
                [len(docs[d]) for d, *_ in pieces],
                [sequence + q for *_, q, _ in pieces],
                [o for *_, o in pieces],
            ]
            sequence += 1 + max(q for *_, q, _ in pieces)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [c.split()[0] for c in SCHEMA.split(", ")])

        for b in batches:
            for name, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                names.append(name)
                docs.append(np.append(encode(text.as_py()), np.uint32(0)))
                size += len(docs[-1])
                if len(docs) >= SHARD_DOCS or size >= SHARD_TOKENS:
                    yield flush()
                    names, docs, size = [], [], 0
        if docs:
            yield flush()

    return run


def pack_documents(docs: DataFrame, window: int = 1024, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None, vocabulary: str = "byte_bpe_50k") -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are its text's and then a 0; null and empty texts are that 0 alone. Each input row is packed, also
    rows that repeat an id or have none. Only a shard's last sequence may be short. sequence_id is unique over all
    shards. An empty table gives an empty result; other columns, whatever their names, are not read."""
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(text_col).alias("text"))
    return plain.mapInArrow(_packer(window, folder or tokens.folder(), vocabulary), SCHEMA)
