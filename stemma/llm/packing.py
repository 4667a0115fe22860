"""Packing by power-of-two decomposition: a document is cut into pieces of 1024 tokens and of the binary digits of the rest.

A document of n tokens gives n // 1024 pieces of 1024 and one piece for every binary digit of n % 1024, longest first.
Each piece is a sequence of its own, its length is a power of two, so no sequence crosses documents and none needs
padding; sequences of equal length form a bucket, and a batch is drawn from one bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm.bpe import encoder
from stemma.llm.storage import in_batches, text_bytes

SEQUENCE = 1024
#: The id after each document's ids.
END = 0


def lengths(n: int, most: int = SEQUENCE) -> list[int]:
    """Lengths of the pieces of ``n`` tokens; ``most`` is a power of two."""
    return [most] * (n // most) + [1 << k for k in range(most.bit_length() - 2, -1, -1) if n % most >> k & 1]


def pack(docs: DataFrame, path: str | None = None, most: int = SEQUENCE) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    ``length`` is the bucket, and the offset in the sequence is 0, as a sequence is one piece. Null and empty texts give
    the end id alone. Repeated rows and rows with a null doc_id are packed each for itself. sequence_id is unique,
    follows the order of the scan and needs no shuffle; a task that runs again gives the same ids. Columns of ``docs``
    other than doc_id and text are not read.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.json")

    def work(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encode, rows = encoder(path), []
        for doc_id, text in zip(part.columns[0].to_pylist(), part.columns[1].to_pylist()):
            ids = encode(text.decode()) + END.to_bytes(4, "little")
            n, start = len(ids) // 4, 0
            for length in lengths(n, most):
                rows.append((doc_id, start, length, ids[4 * start : 4 * (start + length)], n))
                start += length
        types = [part.schema.field(0).type, pa.int64(), pa.int64(), pa.binary(), pa.int64()]
        names = ["doc_id", "start", "length", "ids", "doc_tokens"]
        for k in range(0, len(rows), 4096):
            columns = zip(*rows[k : k + 4096])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", text_bytes())
    out = in_batches(source, work, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long")
    return out.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def digest(packed: DataFrame) -> DataFrame:
    """The pieces with the crc32 of their ids instead of the ids; a row for each piece, so repeats and null doc_ids stay."""
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
