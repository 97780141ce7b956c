"""Tokens under an existing byte-pair vocabulary."""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How byte-level vocabularies cut a text before pairs are merged, in the regex dialect of their library.
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


def bpe_counts(df: DataFrame, ranks_file: str, text: str = "text", name: str = "n_tokens", pieces: str = PIECES) -> DataFrame:
    """``df`` with the number of tokens of a text under a vocabulary of ranks; 0 of a null or empty text.

    The file has a token in base 64 and its rank on each line; it is read on
    the driver and sent to the workers, each of which builds the encoder once.
    Special tokens in a text are ordinary text. Texts are counted whole.
    """
    with open(ranks_file, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())
    known: dict[str, object] = {}

    def run(batches):  # noqa: ANN001, ANN202
        if "encoder" not in known:
            import tiktoken

            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in shared.value.splitlines() if line)}
            known["encoder"] = tiktoken.Encoding("given", pat_str=pieces, mergeable_ranks=ranks, special_tokens={})
        encode = known["encoder"].encode_ordinary
        for batch in batches:
            counts = [len(encode(t)) if t else 0 for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64())], names=[*batch.schema.names, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", `{name}` bigint"
    return df.mapInArrow(run, schema)


def bpe_totals(df: DataFrame, ranks_file: str, by: list[str], text: str = "text") -> DataFrame:
    """(by, n_docs, n_tokens): texts and their tokens by group."""
    return bpe_counts(df.select(*by, text), ranks_file, text).groupBy(*by).agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
