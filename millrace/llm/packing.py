"""Packing of tokenised documents into sequences, neighbours along a space-filling curve together.

Each document's token ids are hashed into a vector, projected at random to three
dimensions and placed on a Hilbert curve. Documents are range-sorted by curve key and
laid end to end; every ``length`` tokens begin a sequence, so that only the very last
one is padded. Places come from sums per range partition (one number each) and a
running sum within; ids are joined to them and cut.

Edge cases: a null or empty text is the closing id alone; equal keys are ordered by
id, then by place in the input; repeated rows are packed each on its own.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import staged

DIMENSIONS, BITS, SLOTS = 3, 16, 256
_TAME = re.compile(r"[\t\n\r -~¡-ſ]*")


def encoder(path: str) -> Callable[[Sequence[str]], list[np.ndarray]]:
    """Ids by the tokenizer file.

    Where the same vocabulary lies beside it as ranks, a text of ASCII and Latin
    letters goes through tiktoken, which gives equal ids there several times as fast.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    special = [t.content for t in slow.get_added_tokens_decoder().values()]
    ranks, fast = path.removesuffix(".json") + ".tiktoken", None
    if os.path.exists(ranks):
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            pairs = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=pairs, special_tokens={})

    def one(text: str) -> np.ndarray:
        if fast and _TAME.fullmatch(text) and not any(s in text for s in special):
            return np.array(fast.encode_ordinary(text), np.uint32)
        return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)

    return lambda texts: [one(t) for t in texts]


def projected(ids: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """The document's hashed, normalised token counts times the projection matrix."""
    counts = np.sqrt(np.bincount((ids * np.uint32(2654435761)) >> np.uint32(24), minlength=SLOTS))
    return (counts / np.sqrt((counts * counts).sum())) @ matrix


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The place along the Hilbert curve of rows of cell coordinates below 2**bits."""
    x = cells.T.astype(np.int64)
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[n - 1] & q) > 0, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def _tokenise(path: str, closing: int):
    matrix = np.random.default_rng(3).normal(size=(SLOTS, DIMENSIONS))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                ids = [np.append(x, np.uint32(closing)) for x in encode([t or "" for t in part["text"]])]
                width = np.uint16 if all(x.max() < 1 << 16 for x in ids) else np.uint32
                yield pd.DataFrame(
                    {
                        "row": part["row"].to_numpy(),
                        "doc_id": part["doc_id"].array,
                        "tokens": [len(x) for x in ids],
                        "bytes_per_id": np.dtype(width).itemsize,
                        "ids": [x.astype(width).tobytes() for x in ids],
                        "at": [projected(x, matrix).tolist() for x in ids],
                    }
                )

    return run


def _place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The tokens before each document in this task's sorted rows."""
    before, part = 0, TaskContext.get().partitionId()
    for batch in batches:
        ends = before + batch["tokens"].cumsum().to_numpy(np.int64)
        yield pd.DataFrame({"row": batch["row"], "part": part, "before": ends - batch["tokens"], "tokens": batch["tokens"]})
        before = int(ends[-1]) if len(ends) else before


def _cut(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                ids = np.frombuffer(r.ids, np.uint16 if r.bytes_per_id == 2 else np.uint32).astype("<u4")
                start = 0
                while start < len(ids):
                    sequence, offset = divmod(r.place + start, length)
                    n = min(length - offset, len(ids) - start)
                    rows.append((r.doc_id, start, n, zlib.crc32(ids[start : start + n].tobytes()), len(ids), sequence, offset))
                    start += n
            yield pd.DataFrame(rows, columns=names)

    return run


def pack(docs: DataFrame, tokenizer: str, length: int = 1024, closing: int = 0) -> DataFrame:
    """The pieces of all documents: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)."""
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select(F.col("doc_id").cast("string"), "text", F.monotonically_increasing_id().alias("row"))
    schema = "row long, doc_id string, tokens long, bytes_per_id int, ids binary, at array<double>"
    # Ids pass through pandas as text, since a null among integers would turn them into doubles there.
    ids = staged(rows.mapInPandas(_tokenise(tokenizer, closing), schema), "ids")
    x = [F.col("at")[i] for i in range(DIMENSIONS)]
    spread = ids.agg(*(f(c).alias(f"{n}{i}") for i, c in enumerate(x) for n, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    top = (1 << BITS) - 1
    cells = [
        F.least(F.greatest((c - (spread[f"m{i}"] or 0.0)) / (6 * (spread[f"s{i}"] or 1.0)) + 0.5, F.lit(0.0)), F.lit(1.0)) * top
        for i, c in enumerate(x)
    ]

    @F.pandas_udf("long")
    def key(*columns: pd.Series) -> pd.Series:
        return pd.Series(hilbert_key(np.column_stack([c.to_numpy(np.float64) for c in columns]).astype(np.int64)))

    along = ids.select("row", F.col("doc_id").cast(kind), "tokens", key(*cells).alias("key"))
    along = along.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "key", "doc_id", "row")
    along = along.sortWithinPartitions("key", "doc_id", "row").select("row", "tokens")
    placed = staged(along.mapInPandas(_place, "row long, part int, before long, tokens long"), "places")
    total, first = 0, {}
    for r in placed.groupBy("part").agg(F.sum("tokens").alias("n")).orderBy("part").collect():
        first[r["part"]], total = total, total + r["n"]
    firsts = spark.createDataFrame(list(first.items()) or [(0, 0)], "part int, first long")
    places = placed.join(F.broadcast(firsts), "part").select("row", (F.col("before") + F.col("first")).alias("place"))
    pieces = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return ids.select("row", "doc_id", "bytes_per_id", "ids").join(places, "row").drop("row").mapInPandas(_cut(length), pieces).withColumn(
        "doc_id", F.col("doc_id").cast(kind)
    )
