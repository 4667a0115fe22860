"""Which characters texts have, and how often."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.functions.scalar import character_name

#: Code points that a table without plain characters leaves out. Fixed values.
PLAIN = (20, 126)


def histogram(texts: DataFrame, text: str = "text") -> DataFrame:
    """c, n of all texts. Each task counts what it reads, so no more rows are shuffled than there are characters, by task; null texts have none."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for value in batch.column(0):
                total.update(value.as_py() or "")
        yield pa.record_batch([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["c", "n"])

    return texts.select(F.col(text).cast("string")).mapInArrow(count, "c string, n long").groupBy("c").agg(F.sum("n").alias("n"))


def table(texts: DataFrame, text: str = "text", plain: bool = False) -> DataFrame:
    """The most frequent first, of equally frequent ones the smaller: n, c, name; without printable ASCII unless ``plain``."""
    out = histogram(texts, text)
    shown = out if plain else out.where(~F.ascii("c").between(*PLAIN))
    return shown.select("n", "c", character_name("c").alias("name")).orderBy(F.desc("n"), "c")
