"""Exact de-duplication with a cuckoo-filter index of live digests.

Every row's text is normalised (runs of ASCII white space become one space) and hashed natively. Index shards hold the
digests in cuckoo filters: a filter miss proves a digest new, a hit is verified against the full digest stored in the
bucket, and a filter that overflows is rebuilt at twice the size from its stored keys. Each input partition first folds
its own rows into such an index, so that a text with any number of copies sends one row a partition through the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import SPACE, cut, shuffle_partitions, text_of, with_rows, without_rows

SLOTS, KICKS = 4, 200
NO_ID = (1 << 63) - 1


class CuckooIndex:
    """A cuckoo filter over live 32-byte digests, each with a payload. Two candidate buckets of four slots; a slot holds
    a 16-bit fingerprint and the place of its full key, which verifies hits and from which the table is resized."""

    def __init__(self, buckets: int = 64) -> None:
        self.buckets = 1 << max(1, (buckets - 1).bit_length())
        self.keys: list[bytes | None] = []
        self.payloads: list = []
        self.free: list[int] = []
        self.resizes = self.false_hits = 0
        self._clear()

    def _clear(self) -> None:
        self.prints = [0] * (self.buckets * SLOTS)
        self.places = [-1] * (self.buckets * SLOTS)

    @staticmethod
    def _print(key: bytes) -> int:
        return int.from_bytes(key[8:10], "little") or 1

    def _first(self, key: bytes) -> int:
        return int.from_bytes(key[:8], "little") & (self.buckets - 1)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (((mark * 0x5BD1E995) >> 3 | 1) & (self.buckets - 1))

    def _slot(self, key: bytes) -> int:
        """The slot that holds ``key``, or -1: fingerprint hits count only once the stored key agrees."""
        mark, bucket = self._print(key), self._first(key)
        for b in (bucket, self._other(bucket, mark)):
            for s in range(b * SLOTS, b * SLOTS + SLOTS):
                if self.prints[s] == mark and self.places[s] >= 0:
                    if self.keys[self.places[s]] == key:
                        return s
                    self.false_hits += 1
        return -1

    def get(self, key: bytes):
        s = self._slot(key)
        return None if s < 0 else self.payloads[self.places[s]]

    def __contains__(self, key: bytes) -> bool:
        return self._slot(key) >= 0

    def __len__(self) -> int:
        return len(self.keys) - len(self.free)

    def _put(self, place: int) -> bool:
        key = self.keys[place]
        mark, bucket = self._print(key), self._first(key)
        for b in (bucket, self._other(bucket, mark)):
            for s in range(b * SLOTS, b * SLOTS + SLOTS):
                if self.places[s] < 0:
                    self.prints[s], self.places[s] = mark, place
                    return True
        for kick in range(KICKS):
            s = bucket * SLOTS + (place + kick) % SLOTS
            self.prints[s], mark = mark, self.prints[s]
            self.places[s], place = place, self.places[s]
            bucket = self._other(bucket, mark)
            for t in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.places[t] < 0:
                    self.prints[t], self.places[t] = mark, place
                    return True
        return False

    def insert(self, key: bytes, payload) -> None:
        """Insert a digest, or replace a live one's payload."""
        if (s := self._slot(key)) >= 0:
            self.payloads[self.places[s]] = payload
            return
        if self.free:
            place = self.free.pop()
            self.keys[place], self.payloads[place] = key, payload
        else:
            place = len(self.keys)
            self.keys.append(key)
            self.payloads.append(payload)
        while not self._put(place):
            self._resize()
            if self._slot(key) >= 0:
                break

    def _resize(self) -> None:
        """Double the table and fill it anew from the stored keys."""
        while True:
            self.buckets *= 2
            self.resizes += 1
            self._clear()
            if all(self._put(p) for p, k in enumerate(self.keys) if k is not None):
                return

    def delete(self, key: bytes) -> bool:
        """Delete a live digest; only a verified slot is cleared, so other keys with its fingerprint stay."""
        if (s := self._slot(key)) < 0:
            return False
        place = self.places[s]
        self.prints[s], self.places[s] = 0, -1
        self.keys[place] = self.payloads[place] = None
        self.free.append(place)
        return True

    def items(self) -> Iterator[tuple[bytes, object]]:
        return ((k, p) for k, p in zip(self.keys, self.payloads) if k is not None)


FOLDED = "digest binary, first_id bigint, first_row bigint, copies bigint"


def _fold(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Fold rows (digest, first_id, first_row, copies) into a cuckoo index and emit its live entries."""
    index = CuckooIndex()
    for batch in batches:
        for key, first, row, copies in zip(batch.digest, batch.first_id, batch.first_row, batch.copies):
            key = bytes(key)
            held = index.get(key)
            if held is None:
                index.insert(key, [first, row, copies])
            else:
                if (first, row) < (held[0], held[1]):
                    held[0], held[1] = first, row
                held[2] += copies
    out = [(k, *p) for k, p in index.items() if p[2] > 0]
    for at in range(0, len(out), 10_000):
        yield pd.DataFrame(out[at : at + 10_000], columns=["digest", "first_id", "first_row", "copies"])


def build_index(keys: DataFrame, shards: int) -> DataFrame:
    """The live index of ``keys`` (digest, first_id, first_row, copies), a shard a partition. Shard sizes follow
    ``shards``; a hot digest reaches its shard as one row from each input partition."""
    return keys.mapInPandas(_fold, FOLDED).repartition(shards, "digest").mapInPandas(_fold, FOLDED)


def update_index(index: DataFrame, inserted: DataFrame, deleted: DataFrame, live: DataFrame, shards: int) -> DataFrame:
    """Apply inserted rows and deleted rows (same columns, copies 1) to an index; a digest without live copies goes.
    ``live`` (digest, first_id, first_row) are all rows as they are afterwards: of a digest whose first row was deleted
    they alone tell which row is the first now, and only such digests are looked up there."""
    gone = deleted.withColumn("copies", -F.col("copies"))
    rows = cut(index.unionByName(inserted).unionByName(gone).repartition(shards, "digest").mapInPandas(_apply, FOLDED + ", headless boolean"), "index")
    headless = rows.where("headless").select("digest", "copies")
    first = live.select("digest", "first_id", "first_row").join(headless, "digest").groupBy("digest").agg(F.min(F.struct("first_id", "first_row")).alias("f"), F.first("copies").alias("copies"))
    return rows.where("not headless").drop("headless").unionByName(first.select("digest", "f.first_id", "f.first_row", "copies"))


def _apply(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """As ``_fold``, with deletions from the live index once no copy is left; ``headless`` if the first row went."""
    index, removed = CuckooIndex(), CuckooIndex()
    for batch in batches:
        for key, first, row, copies in zip(batch.digest, batch.first_id, batch.first_row, batch.copies):
            key = bytes(key)
            target = removed if copies < 0 else index
            held = target.get(key)
            if held is None:
                target.insert(key, [first, row, copies])
            else:
                held[0], held[1] = min((held[0], held[1]), (first, row))
                held[2] += copies
    for key, gone in list(removed.items()):
        if (held := index.get(key)) is not None:
            held[2] += gone[2]
            if held[2] <= 0:
                index.delete(key)
    # a deleted row that lies no later than the first live one known was the first itself
    out = [(k, *p, (g := removed.get(k)) is not None and (g[0], g[1]) <= (p[0], p[1])) for k, p in index.items()]
    for at in range(0, len(out), 10_000):
        yield pd.DataFrame(out[at : at + 10_000], columns=["digest", "first_id", "first_row", "copies", "headless"])


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row: Column | None = None) -> DataFrame:
    """(doc_id, digest, row): a key per input row; ``row`` tells rows with one id apart once the table is written."""
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.unhex(F.sha2(F.regexp_replace(text_of(text_col), SPACE, " ").cast("binary"), 256)).alias("digest"),
        (F.monotonically_increasing_id() if row is None else row).alias("row"),
    )


def _ones(keys: DataFrame) -> DataFrame:
    return keys.select("digest", F.coalesce("doc_id", F.lit(NO_ID)).alias("first_id"), F.col("row").alias("first_row"), F.lit(1).cast("bigint").alias("copies"))


#: A digest of more than a 10,000th of all rows is hot; there are fewer than 10,000, which are broadcast.
HOT = 10_000


def _looked_up(keys: DataFrame, shard_rows: int) -> DataFrame:
    """``keys`` with their digest's first row and copies. Rows of hot digests meet them where they are read, so that the
    shuffle deals the others alone."""
    n = keys.count()
    index = cut(build_index(_ones(keys), max(shuffle_partitions(keys.sparkSession), -(-n // shard_rows))), "index")
    hot = F.col("copies") > max(1, n // HOT)
    held = keys.join(F.broadcast(index.where(hot).withColumn("is_hot", F.lit(True))), "digest", "left")
    rest = held.where("is_hot is null").select(*keys.columns).join(index.where(~hot), "digest")
    return held.where("is_hot").drop("is_hot").unionByName(rest)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_rows: int = 1_000_000) -> DataFrame:
    """One row for each input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after runs of ASCII white space become one space; null text is empty text. The row
    with the smallest doc_id stays; null ids come last, and of rows that repeat one id a single one stays, the first in
    scan order. keep_id is null only for a group without any id. An empty table gives an empty result; other columns
    of the input, whatever their names, are not read."""
    keys = cut(digests(docs, id_col, text_col), "digests")
    return _looked_up(keys, shard_rows).select(
        "doc_id",
        F.when(F.col("first_id") != NO_ID, F.col("first_id")).alias("keep_id"),
        F.col("copies").alias("group_size"),
        (F.col("row") == F.col("first_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_rows: int = 1_000_000) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``exact_duplicates`` keeps."""
    tagged = with_rows(docs)
    keys = cut(digests(tagged, f"r.{id_col}", f"r.{text_col}", F.col("row")), "digests")
    return without_rows(tagged, _looked_up(keys, shard_rows).where("row <> first_row").select("row"))
