"""Token counts of whole texts: a broadcast table of frequent spans, worker caches for the rest."""

from __future__ import annotations

import sys
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm import codec, tasks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Spans in the broadcast table, and the longest of them: at most 1.5 MB before compression.
TABLE_SPANS = 1 << 16
TABLE_SPAN_CHARS = 20
# Distinct spans a task counts before it lets go of the rare ones.
COUNTED_SPANS = 1 << 18


def _pack(counts: Counter) -> bytes:
    best = sorted(counts.items(), key=lambda item: (-item[1], item[0]))[:TABLE_SPANS]
    return zlib.compress("\n".join(f"{n} {span}" for span, n in best).encode(), 1)


def _unpack(record: bytes) -> Counter:
    counts: Counter = Counter()
    for line in zlib.decompress(record).decode().split("\n"):
        if line:
            number, span = line.split(" ", 1)
            counts[span] = int(number)
    return counts


def merge_counts(records: list[bytes]) -> bytes:
    """The most frequent spans of several tables."""
    total: Counter = Counter()
    for record in records:
        total.update(_unpack(record))
    return _pack(total)


def _count_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's most frequent spans; the rare ones are let go whenever too many are held."""
    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text:
                counts.update(text.split(" ")[1:])
            if len(counts) > COUNTED_SPANS:
                floor = sorted(counts.values())[len(counts) // 2]
                counts = Counter({s: n for s, n in counts.items() if n > floor})
    short = Counter(
        {s: n for s, n in counts.items() if n > 1 and 0 < len(s) <= TABLE_SPAN_CHARS and "\n" not in s}
    )
    yield pa.RecordBatch.from_arrays([pa.array([_pack(short)], pa.binary())], names=["record"])


def frequent_spans(df: DataFrame, text: str) -> list[str]:
    """The spans seen most often, from all rows: one bounded table per task, merged as a tree."""
    tables = df.select(F.col(text).cast("string")).mapInArrow(_count_spans, "record binary")
    merged = tasks.tree_merge(tables, merge_counts)
    return list(_unpack(merged)) if merged else []


def token_counts(
    df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", limit: int = 512
) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row; other columns are not read.

    Tokens are those ``tokenizers`` gives for the vocabulary file without added special tokens.  Null
    and empty texts have no bytes and no tokens; a null key is passed on; repeated rows are counted
    each; an empty table gives no rows.  The frequent spans only save time: any span is counted
    exactly.  No row is shuffled.
    """
    spark = df.sparkSession
    spans = frequent_spans(df, text)
    lengths = np.array(codec.Codec(vocabulary).count([" " + s for s in spans]), dtype=np.uint8)
    table = spark.sparkContext.broadcast((zlib.compress("\n".join(spans).encode()), lengths.tobytes()))
    name = uuid.uuid4().hex
    kind = df.schema[key].dataType.simpleString()

    def fresh() -> codec.Codec:
        return codec.Codec(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blob, sizes = table.value
        known = zlib.decompress(blob).decode().split("\n") if sizes else []
        coder = tasks.worker_cache(f"counts {vocabulary}", fresh)
        for batch in batches:
            for part in tasks.slices(batch, 1):
                if coder.loaded != name or coder.chars > codec.KEPT_CHARS:
                    coder.preload(known, np.frombuffer(sizes, np.uint8), name)
                data = part.column(1)
                widths = np.diff(tasks.flat(data)[1])
                found = np.array(coder.count(data.to_pylist()), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(widths), pa.array(found), pa.array(found > limit)],
                    names=[key, "n_bytes", "n_tokens", "over_limit"],
                )

    rows = df.select(F.col(key), F.col(text).cast("string").alias(f"{key} text"))
    return rows.mapInArrow(run, f"`{key}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
