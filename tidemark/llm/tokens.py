"""Byte-level BPE encoding and decoding with tiktoken.

The rank file is read on the driver and broadcast (its size is checked), so executors need no
copy. Long texts are cut where a match of the pattern is sure to begin, so that the pieces'
ids together are those of the whole text. A long run of white space is one match, less its last
character where the text goes on; the pattern would need a stack as deep as the run, so
such a match is found outside and merged as bytes. Rows are encoded a few at a time, so that a task
never holds more ids than those of ``STEP_BYTES`` of text, or of one text.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import documents

RANKS = "byte_bpe_multi_50k.tiktoken"
MOST_BYTES = 16 << 20  # of a rank file
LONG = 1 << 16  # code points
STEP_ROWS, STEP_BYTES = 256, 1 << 20  # of texts that are encoded before their ids are handed on
#: No match of the pattern holds white space after anything else: one ends before a blank or line
#: feed that follows a character which is not white space.
SAFE = re.compile(r"(?<=\S)[ \n]")
#: White space as the pattern has it (its characters are fixed by Unicode), in runs too long for it.
RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")


@lru_cache(2)
def encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    pairs = (line.split() for line in ranks.splitlines() if line)
    table = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def parts(text: str, limit: int = LONG) -> Iterator[str]:
    """The text cut at safe boundaries, at least ``limit`` code points apart."""
    at = 0
    while len(text) - at > limit:
        found = SAFE.search(text, at + limit)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def matches(text: str) -> Iterator[tuple[str, bool]]:
    """The text in pieces, each with whether it is one match of the pattern, a long run of white space."""
    at = 0
    for run in RUN.finditer(text):
        if run.start() > at:
            yield text[at : run.start()], False
        at = run.end() if run.end() == len(text) else run.end() - 1
        yield text[run.start() : at], True
    if at < len(text):
        yield text[at:], False


def encode(text: str | None, enc: tiktoken.Encoding) -> np.ndarray:
    """The ids of a text; none of an empty or null one."""
    made = []
    for piece, whole in matches(text or ""):
        if whole:
            made.append(np.array(enc._encode_single_piece(piece), "<u4"))
        else:
            made += [np.array(enc.encode_ordinary(part), "<u4") for part in parts(piece)]
    return made[0] if len(made) == 1 else np.concatenate([np.zeros(0, "<u4"), *made])


def decode(ids: np.ndarray, enc: tiktoken.Encoding) -> bytes:
    """The bytes that the ids stand for, whether or not they are UTF-8."""
    return enc.decode_bytes(ids.tolist())


def rank_file(path: str) -> bytes:
    ranks = Path(path).read_bytes()
    if len(ranks) > MOST_BYTES:
        raise ValueError(f"{path} has {len(ranks)} bytes, over the {MOST_BYTES} that are broadcast")
    return ranks


def _shared(docs: DataFrame, path: str | None):
    ranks = rank_file(path or public_tokenizers.path(RANKS))
    return docs.sparkSession.sparkContext.broadcast((ranks, public_tokenizers.PATTERN))


def few(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``STEP_ROWS`` rows and about ``STEP_BYTES`` of the column ``text``."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, at = np.cumsum(sizes), 0
    while at < batch.num_rows:
        held = ends[at - 1] if at else 0
        end = max(at + 1, min(at + STEP_ROWS, int(np.searchsorted(ends, held + STEP_BYTES, "right"))))
        yield batch.slice(at, end - at)
        at = end


def encoded(docs: DataFrame, text: str = "text", path: str | None = None, keep_ids: bool = True) -> DataFrame:
    """``docs`` without ``text``, with n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids.

    A null or empty text has no tokens. Columns of these names are replaced; repeated rows are
    encoded each, and an empty table gives an empty result.
    """
    shared = _shared(docs, path)
    names = ("n_tokens", "ids_sha256", "decoded_sha256") + ("ids",) * keep_ids
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in names and c != text], F.col(text).cast("string").alias(text))
    made = T.StructType.fromDDL("n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(*shared.value)
        for batch in batches:
            for part in few(batch, batch.num_columns - 1):
                ids = [encode(one, enc) for one in part.column(part.num_columns - 1).to_pylist()]
                out = [pa.array([len(row) for row in ids], pa.int64()),
                       pa.array([hashlib.sha256(row.tobytes()).hexdigest() for row in ids]),
                       pa.array([hashlib.sha256(decode(row, enc)).hexdigest() for row in ids])]
                if keep_ids:
                    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(ends, np.concatenate(ids).view(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *out], names=[*part.schema.names[:-1], *names])

    return rows.mapInArrow(run, T.StructType(rows.schema.fields[:-1] + made.fields))


def texts(encoded: DataFrame, column: str = "ids", path: str | None = None) -> Column:
    """The bytes that each array of ids decodes to; none of a null or empty one."""
    shared = _shared(encoded, path)

    @F.pandas_udf("binary")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(*shared.value)
        for arrays in batches:
            yield pd.Series([decode(np.asarray(one if one is not None else [], np.int64), enc) for one in arrays])

    return of(F.col(column))


def op6_bpe(spark, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    return encoded(documents(spark, sf_dir).select("doc_id", "text"), keep_ids=False)
