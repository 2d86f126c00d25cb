"""What the operators share: passes over texts, and word hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gossamr.session import ship

#: Rows that a pass turns into Python objects at a time.
SLICE = 250
#: Entries that a worker's word cache holds before it is emptied; a word is some 60 bytes.
CACHE = 200_000


def append(df: DataFrame, inputs: list[str], fields: list[T.StructField], start: Callable[[], Callable]) -> DataFrame:
    """df with fields appended, by one Arrow pass without a shuffle.

    start() makes a function of the input columns' lists that returns a list for each field. A column of df with
    the name of a field is replaced; all others pass through as they are.
    """
    new = {f.name for f in fields}
    keep = [f for f in df.schema.fields if f.name not in new]
    kept, used, names = [f.name for f in keep], list(inputs), [f.name for f in fields]
    schema = T.StructType(keep + fields)
    types = [_arrow(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                made = work(*(part.column(c).to_pylist() for c in used))
                arrays = [pa.array(x, type=t) for x, t in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + arrays, names=kept + names)

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def emit(df: DataFrame, inputs: list[str], fields: list[T.StructField], start: Callable[[], Callable], finish: bool = False) -> DataFrame:
    """New rows made by one Arrow pass over the input columns.

    start() makes a function of the input columns' lists that returns equally long lists, one for each field; with
    finish, it returns that function and another one, without arguments, that is called after the last rows.
    """
    used, names, types, schema = list(inputs), [f.name for f in fields], [_arrow(f.dataType) for f in fields], T.StructType(fields)

    def pack(made) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, type=t) for x, t in zip(made, types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, last = start() if finish else (start(), None)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                made = work(*(part.column(c).to_pylist() for c in used))
                if made is not None:
                    yield pack(made)
        if last:
            for made in last():
                yield pack(made)

    ship(df.sparkSession)
    return df.select(*used).mapInArrow(run, schema)


def public_pattern() -> str:
    """The pattern of the public rank files, where the caller names none."""
    import public_tokenizers

    return public_tokenizers.PATTERN


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    return {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.StringType: pa.string(), T.BinaryType: pa.binary(), T.DoubleType: pa.float64(), T.BooleanType: pa.bool_()}[type(kind)]


def field(name: str, kind: str) -> T.StructField:
    kinds = {"long": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "binary": T.BinaryType(), "double": T.DoubleType(), "boolean": T.BooleanType()}
    return T.StructField(name, T.ArrayType(kinds[kind[:-2]]) if kind.endswith("[]") else kinds[kind])


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, computed once and kept while the cache has room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs of characters other than [\\x20\\x09-\\x0D], in UTF-8. Null: none."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lowered_words_of(text: str | None) -> list[bytes]:
    """As words_of, with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (that of splitmix64), elementwise."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams of a sequence of word hashes, in order."""
    out = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - n + 1 + i])
    return out


#: Unsigned CRC-32 in SQL: its byte table, and crc(text) as a fold over the text's UTF-8 bytes.
CRC_SQL = r"""
RECURSIVE bits AS (SELECT i::BIGINT AS i, i::BIGINT AS c, 0 AS k FROM range(256) r(i) UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS crcs FROM bits WHERE k = 8)
"""


def crc_sql(text: str) -> str:
    """The expression of the checksum of a text expression, in a query with crc_table."""
    byte_list = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda b: CAST('0x' || b AS BIGINT))"
    return f"xor(list_reduce({byte_list}, lambda a, b: xor(a >> 8, crcs[1 + (xor(a, b) & 255)]), 4294967295::BIGINT), 4294967295)"
