"""Pack token ids into windows of near-equal fill by multiway differencing.

Each task takes its own documents, ``GROUP_DOCUMENTS`` at a time, so nothing is shuffled and
no group grows with the input. A document's full windows stand alone; what is left is cut
into pieces of at most ``PIECE`` ids, and the pieces of a group are dealt to windows by
Karmarkar-Karp differencing (``partition``).

Defined results: a null or empty text is its end id alone; a null doc_id is carried; repeated
rows are packed one by one; an empty table gives an empty result; other columns are ignored.
A window never exceeds its length, a piece never spans windows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from countermill.llm.partition import fill_windows
from countermill.llm.tokens import TextTokens

LENGTH = 2048
END_ID = 1
PIECE = 512
GROUP_DOCUMENTS = 512

_tokens: dict[str, TextTokens] = {}


def _tokenizer(path: str) -> TextTokens:
    """One for each worker, kept between tasks."""
    if path not in _tokens:
        _tokens.clear()
        _tokens[path] = TextTokens(path)
    return _tokens[path]


def _cuts(n: int, length: int, piece: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(start, size) of the full windows of n ids, and of the pieces after them."""
    full = [(s, length) for s in range(0, n - n % length, length)]
    rest = n - n % length
    return full, [(s, min(piece, n - s)) for s in range(rest, n, piece)]


def _packer(path: str, length: int, end_id: int, piece: int, group: int, with_ids: bool):
    kinds = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    kinds += [("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
    kinds += [("ids", pa.list_(pa.int32()))] * with_ids
    schema = pa.schema(kinds)

    def pack(held: list[tuple], first: int) -> tuple[pa.RecordBatch, int]:
        rows, rest, number = [], [], first

        def put(doc_id, ids, start: int, size: int, sequence: int, offset: int) -> None:
            part = ids[start : start + size]
            row = (doc_id, start, size, zlib.crc32(part.tobytes()), len(ids), sequence, offset)
            rows.append(row + ((part.astype(np.int32),) if with_ids else ()))

        for doc_id, ids in held:
            full, pieces = _cuts(len(ids), length, piece)
            for start, size in full:
                put(doc_id, ids, start, size, number, 0)
                number += 1
            rest += [(doc_id, ids, start, size) for start, size in pieces]
        for window in fill_windows([x[3] for x in rest], length):
            offset = 0
            for at in window:
                put(*rest[at], number, offset)
                offset += rest[at][3]
            number += 1
        columns = [pa.array(x, t.type) for x, t in zip(zip(*rows), schema)]
        return pa.RecordBatch.from_arrays(columns, schema=schema), number

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokens = _tokenizer(path)
        number = TaskContext.get().partitionId() << 40
        held: list[tuple] = []
        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokens.rows(batch.column("text"))):
                held.append((doc_id, np.append(ids, np.uint32(end_id)).astype("<u4")))
                if len(held) >= group:
                    packed, number = pack(held, number)
                    yield packed
                    held = []
        if held:
            yield pack(held, number)[0]

    columns = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return run, columns + ", ids array<int>" * with_ids


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    length: int = LENGTH,
    end_id: int = END_ID,
    piece: int = PIECE,
    group: int = GROUP_DOCUMENTS,
    with_ids: bool = True,
) -> DataFrame:
    """One row for each piece: its document, place there, ids and their checksum, window
    (``sequence_id``) and place in it."""
    texts = docs.selectExpr("cast(doc_id as bigint) as doc_id", "text")
    return texts.mapInArrow(*_packer(tokenizer_path, length, end_id, piece, group, with_ids))
