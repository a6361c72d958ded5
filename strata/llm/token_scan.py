"""Token counts of flat, unindexed token files (operator 9).

A token file is nothing but token ids (little-endian, two or four bytes), each document closed by the
end-of-document id. :func:`count_tokens` reads the files in blocks, finds the separators of a block
with one vectorised comparison, and stitches documents that cross block boundaries with a prefix scan
over the blocks' sums: a block's first document gets the tokens since the last separator before it,
wherever that is.

:func:`write_tokens` makes such files from texts. Every task writes files of its own under fresh names
in the shared folder and reports them in its rows, so files of lost or repeated attempts are never
read.

Scale: a task holds one batch of texts or one block of a file. The scan's windows run over one file's
block sums. Nothing is collected.

Defined cases: null and empty texts have 0 tokens; an unterminated rest at a file's end is a last
document; an empty file has none; texts are encoded whole, special tokens' names as ordinary text.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh_path
from .common import materialize, spread

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SEPARATOR = 50256
# Fixed value: the pre-tokenisation pattern that belongs to the vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Runs of white space too long for the pattern's look-ahead, which keeps a place a character.
LONG_SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{50000,}")
BLOCK_BYTES = 1 << 20
FILE_BYTES = 256 << 20


def encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(encoder, text: str) -> list[int]:
    """Tokens of a whole text. A very long run of white space is one piece by the pattern, less its last
    character where a word follows; it is encoded as such without the pattern."""
    out, at = [], 0
    for run in LONG_SPACE.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        out += encoder.encode_ordinary(text[at : run.start()])
        out += encoder._encode_single_piece(text[run.start() : end])
        at = end
    return out + encoder.encode_ordinary(text[at:])


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_tokens(docs: DataFrame, tokenizer: str = TOKENIZER, separator: int = SEPARATOR) -> DataFrame:
    """Encodes ``docs`` (doc_id, text) into flat files. A row per document: file, bytes, ordinal (its place in
    the file), doc_id; and per file one row with ordinal -1 and the file's bytes."""
    folder = fresh_path(docs.sparkSession, "tokens")
    schema = pa.schema([("file", pa.string()), ("bytes", pa.int64()), ("ordinal", pa.int64()), ("doc_id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(tokenizer)
        system, path = open_folder(folder)
        system.create_dir(path, recursive=True)
        name, out, size, ordinal = "", None, 0, 0
        end = np.array([separator], "<u2").tobytes()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = []
            for doc_id, text in zip(ids, batch.column(1).to_pylist()):
                if out is None:
                    name, size, ordinal = f"{path}/{uuid.uuid4().hex}.bin", 0, 0
                    out = system.open_output_stream(name)
                tokens = np.array(encode(encoder, text or ""), "<u2").tobytes()
                out.write(tokens + end)
                rows.append((name, None, ordinal, doc_id))
                size, ordinal = size + len(tokens) + 2, ordinal + 1
                if size >= FILE_BYTES:
                    out.close()
                    out = None
                    rows.append((name, size, -1, None))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist(
                [{"file": name, "bytes": size, "ordinal": -1, "doc_id": None}], schema=schema
            )

    columns = docs.select(F.col("doc_id").cast("long"), "text")
    return materialize(columns.mapInArrow(run, "file string, bytes long, ordinal long, doc_id long")).withColumn(
        "folder", F.lit(folder)
    )


def block_separators(data: bytes, separator: int, width: int) -> tuple[list[int], int]:
    """Lengths closed by a separator inside the block, and the tokens after the last one."""
    tokens = np.frombuffer(data, f"<u{width}")
    at = np.flatnonzero(tokens == separator)
    lengths = np.diff(at, prepend=-1) - 1
    return lengths.tolist(), len(tokens) - (int(at[-1]) + 1 if len(at) else 0)


def count_tokens(
    files: DataFrame, folder: str, separator: int = SEPARATOR, width: int = 2, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(file, ordinal, n_tokens) of every document in ``files`` (file, bytes), read from ``folder``'s store."""
    schema = pa.schema(
        [("file", pa.string()), ("block", pa.int64()), ("closed", pa.list_(pa.int64())), ("n_closed", pa.int64()),
         ("tokens", pa.int64()), ("open", pa.int64())]
    )
    step = block_bytes // width * width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = open_folder(folder)
        for batch in batches:
            for r in batch.to_pylist():
                with system.open_input_file(r["file"]) as f:
                    data = f.read_at(min(step, r["bytes"] - r["block"] * step), r["block"] * step)
                closed, rest = block_separators(data, separator, width)
                row = {"file": r["file"], "block": r["block"], "closed": closed, "n_closed": len(closed),
                       "tokens": len(data) // width, "open": rest}
                yield pa.RecordBatch.from_pylist([row], schema=schema)

    files = files.where("bytes > 0")
    last = F.floor((F.col("bytes") - 1) / step)
    n_blocks = files.agg(F.sum(last + 1)).first()[0] or 0
    blocks = files.select("file", "bytes", F.explode(F.sequence(F.lit(0), last)).alias("block"))
    scanned = materialize(
        spread(blocks, n_blocks, "file", "block").mapInArrow(
            run, "file string, block long, closed array<long>, n_closed long, tokens long, open long"
        )
    )
    # prefix scan over counts alone, so that a file's separators never meet in one task: tokens up to each block's
    # end, and where the last separator before a block stood
    order = Window.partitionBy("s_file").orderBy("s_block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    sums = scanned.select(
        F.col("file").alias("s_file"), F.col("block").alias("s_block"), "n_closed", "tokens", F.col("open").alias("left")
    )
    sums = (
        sums.withColumn("upto", F.sum("tokens").over(order))
        .withColumn("restart", F.when(F.col("n_closed") > 0, F.col("upto") - F.col("left")))
        .select(
            "s_file",
            "s_block",
            (F.coalesce(F.lag("upto").over(order), F.lit(0))
             - F.coalesce(F.last("restart", ignorenulls=True).over(before), F.lit(0))).alias("carried"),
            F.coalesce(F.sum("n_closed").over(before), F.lit(0)).alias("first"),
            F.lead("s_block").over(order).isNull().alias("final"),
        )
    )
    stitched = scanned.select("file", "block", "closed", "open").join(
        sums, (F.col("file") == F.col("s_file")) & (F.col("block") == F.col("s_block"))
    )
    rest = F.when(F.size("closed") > 0, F.col("open")).otherwise(F.col("open") + F.col("carried"))
    closed = stitched.select(
        "file", "first", "carried", F.posexplode("closed").alias("place", "inside")
    ).select(
        "file",
        (F.col("first") + F.col("place")).alias("ordinal"),
        (F.col("inside") + F.when(F.col("place") == 0, F.col("carried")).otherwise(0)).alias("n_tokens"),
    )
    unclosed = stitched.where(F.col("final") & (rest > 0)).select(
        "file", (F.col("first") + F.size("closed")).alias("ordinal"), rest.alias("n_tokens")
    )
    return closed.unionByName(unclosed)


def document_tokens(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id and n_tokens of every row of ``docs``: written as token files, then counted from them."""
    spark = docs.sparkSession
    written = write_tokens(docs, tokenizer)
    folder = fresh_path(spark, "tokens")  # any path in the same store
    counted = count_tokens(written.where("ordinal = -1").select("file", "bytes"), folder)
    names = written.where("ordinal >= 0").select(
        F.col("file").alias("d_file"), F.col("ordinal").alias("d_ordinal"), "doc_id"
    )
    # the planner sees only the blocks' small files, and would broadcast the counts of all documents
    return counted.hint("merge").join(
        names, (F.col("file") == F.col("d_file")) & (F.col("ordinal") == F.col("d_ordinal"))
    ).select("doc_id", "n_tokens")
