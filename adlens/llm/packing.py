"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted, each with a cost. Pieces are placed by
decreasing length into the open bin, of whatever capacity, that leaves the
least room; when none has room, a bin is opened with the capacity whose cost
per token that can still fill it is least. At the end each bin is downsized to
the smallest permitted length that holds its contents.

Documents are dealt over blocks by hash; a block is packed in one task. A block
holds a bounded number of pieces, thousands of bins' worth, so that its last
unfilled bins do not count.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm.common import map_texts, read, save

CAPACITIES = (512, 1024, 2048, 4096, 8192)
PIECES_PER_BLOCK = 20_000
# Attention reads a sequence's tokens quadratically: at this length as much work
# as the linear part. Each sequence also costs a fixed number of tokens' work.
QUADRATIC_AT = 32_768
SEQUENCE_OVERHEAD = 32


def cost(capacity: int) -> float:
    return capacity * (1 + capacity / QUADRATIC_AT) + SEQUENCE_OVERHEAD


def pack(lengths: np.ndarray, capacities: tuple[int, ...] = CAPACITIES) -> tuple[
        np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pack pieces of 1 to max(capacities) tokens.

    Returns bin and offset of each piece, and capacity (after downsizing) and
    used tokens of each bin. Equal lengths are placed in the order given.
    """
    caps = sorted(set(capacities))
    lengths = np.asarray(lengths, np.int64)
    bins = np.zeros(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)
    used: list[int] = []
    room: dict[int, list[int]] = defaultdict(list)
    open_rooms = 0  # bit r: some bin has room for exactly r more tokens
    left = int(lengths.sum())
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        fitting = open_rooms >> n
        if fitting:
            r = n + (fitting & -fitting).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                open_rooms &= ~(1 << r)
        else:
            # what can still come into a bin of capacity c is all that is left
            r = min((c for c in caps if c >= n), key=lambda c: (cost(c) / min(c, left), c))
            b = len(used)
            used.append(0)
        bins[i], offsets[i] = b, used[b]
        used[b] += n
        left -= n
        if r > n:
            room[r - n].append(b)
            open_rooms |= 1 << (r - n)
    filled = np.array(used, np.int64)
    sizes = np.array(caps, np.int64)[np.searchsorted(caps, filled)] if used else filled
    return bins, offsets, sizes, filled


def _encoder(path: str | None):
    import base64

    import public_tokenizers as public
    import tiktoken
    with open(path or public.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=public.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def token_counts(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
                 tokenizer_path: str | None = None, end_tokens: int = 1) -> DataFrame:
    """``keep`` plus ``n_tokens``: byte-level BPE tokens of the whole text and an
    end mark (null and empty texts: the mark alone).

    ``tokenizer_path``: a tiktoken rank file on the workers (default: the
    installed public one).
    """
    loaded = {}  # once a task

    def count(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        if not loaded:
            loaded["encoder"] = _encoder(tokenizer_path)
        encode = loaded["encoder"].encode_ordinary
        texts = batch.column(batch.num_columns - 1).to_pylist()
        return {"n_tokens": pa.array([len(encode(t)) + end_tokens if t else end_tokens
                                      for t in texts], pa.int64())}

    return map_texts(docs, text_col, list(keep), "n_tokens long", count)


def pack_documents(counts: DataFrame, capacities: tuple[int, ...] = CAPACITIES,
                   id_col: str = "doc_id", pieces_per_block: int = PIECES_PER_BLOCK) -> DataFrame:
    """Place every token of every document in a sequence.

    ``counts``: (id, n_tokens), n_tokens at least 1. A document longer than the
    largest capacity is cut into pieces of that capacity and a rest. Result, a
    row for each piece: id, piece, start (token offset in the document),
    n_tokens, block, bin, offset, capacity, used. Rows repeated, or with a null
    id, are packed like any other.
    """
    biggest = max(capacities)
    # numbered once and written, so the numbers hold; they deal out repeated rows too
    counts = save(counts.select(F.col(id_col).alias("doc_id"), "n_tokens",
                                F.monotonically_increasing_id().alias("row")), "pack_counts")
    total = counts.agg(F.sum(F.ceil(F.col("n_tokens") / biggest))).first()[0] or 0
    blocks = max(1, -(-int(total) // pieces_per_block))
    pieces = counts.withColumn("piece", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("n_tokens") - 1) / biggest)))).select(
        "doc_id", "row", "piece", (F.col("piece") * biggest).alias("start"),
        F.least(F.lit(biggest).cast("long"),
                F.col("n_tokens") - F.col("piece") * biggest).alias("n_tokens"))
    pieces = pieces.withColumn("block", F.pmod(F.xxhash64("row", "piece"), F.lit(blocks)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "row", "piece"], ascending=[False, True, True],
                              kind="stable").reset_index(drop=True)
        b, at, sizes, filled = pack(pdf["n_tokens"].to_numpy(), capacities)
        return pdf.drop(columns="row").assign(bin=b, offset=at, capacity=sizes[b],
                                              used=filled[b])

    id_type = counts.schema["doc_id"].dataType.simpleString()
    return pieces.groupBy("block").applyInPandas(run, (
        f"doc_id {id_type}, piece long, start long, n_tokens long, block long, bin long, "
        "offset long, capacity long, used long")).withColumnRenamed("doc_id", id_col)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequences that hold all ``documents``, by ``packed_sequences``."""
    return pack_documents(token_counts(read(spark, sf_dir, "documents")))


def packed_sequences(docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES,
                     tokenizer_path: str | None = None, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """One row for each piece in its sequence; see ``pack_documents``."""
    return pack_documents(token_counts(docs, text_col, (id_col,), tokenizer_path),
                          capacities, id_col)
