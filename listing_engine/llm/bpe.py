"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

The driver reads the rank file (under 1 MB, the same at every input size) and
broadcasts its bytes, so executors need no file of their own.  Texts are
encoded whole.  A text longer than `piece_chars` is cut first, only where a
cut cannot change the result: a white-space character after another
character starts a new match of the pattern, whatever stands around it.

A single match that is itself very long (a run of letters, of digits, of
other characters or of white space) has no such place inside.  Such runs are
found with the same pattern by the `regex` module, which has no backtracking
limit, and handed to the merges one match at a time.

Defined results: NULL text is the empty text (no ids); repeated rows are
encoded once per row; every other column of the input is left out unless
named in `keep`; an empty table gives an empty table.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

PIECE_CHARS = 1 << 16
SLICE_ROWS = 128


def _load_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _encoding(rank_bytes: bytes, pattern: str):
    """The encoding of a rank file; a worker builds it once, whatever tasks it runs."""
    import base64
    import hashlib

    import tiktoken
    from tiktoken.registry import ENCODINGS

    name = "local-" + hashlib.sha256(pattern.encode() + b"\0" + rank_bytes).hexdigest()
    if name in ENCODINGS:
        return ENCODINGS[name]
    ranks = {base64.b64decode(token): int(rank)
             for token, rank in (line.split() for line in rank_bytes.splitlines() if line)}
    ENCODINGS[name] = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return ENCODINGS[name]


def safe_pieces(text: str, limit: int):
    """Cut `text` into pieces of about `limit` characters that encode alone."""
    import re

    start = 0
    boundary = re.compile(r"(?<=\S)[ \t\n\r]")  # white space to every regex library
    while len(text) - start > limit:
        cut = boundary.search(text, start + limit)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(encoding, text: str, matcher, limit: int) -> list[int]:
    if len(text) <= limit:
        return encoding.encode_ordinary(text)
    ids: list[int] = []
    for piece in safe_pieces(text, limit):
        if len(piece) <= 2 * limit:
            ids += encoding.encode_ordinary(piece)
        else:
            for match in matcher.finditer(piece):
                ids += encoding._encode_single_piece(match[0].encode())
    return ids


def _in_slices(batches):
    """Arrow batches of a few rows, so that the ids held as Python objects stay few."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


def _ids(encoding, matcher, texts, piece_chars: int) -> list[list[int]]:
    return [encode_text(encoding, text or "", matcher, piece_chars) for text in texts.to_pylist()]


def _bytes(encoding, ids: list[list[int] | None]) -> list[bytes]:
    return [encoding.decode_bytes(x or []) for x in ids]


def encode(docs: DataFrame, ranks_path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",),
           piece_chars: int = PIECE_CHARS, round_trip: bool = False) -> DataFrame:
    """`keep` columns plus `ids array<int>`, the tokens of `text`; with
    `round_trip` also `bytes binary`, decoded from these ids in the same pass."""
    import pyarrow as pa

    ranks = docs.sparkSession.sparkContext.broadcast(_load_ranks(ranks_path))
    rows = docs.select(*keep, F.col("text").alias("__text"))
    made = [T.StructField("ids", T.ArrayType(T.IntegerType()))]
    made += [T.StructField("bytes", T.BinaryType())] * round_trip

    def run(batches):
        import regex

        encoding, matcher = _encoding(ranks.value, pattern), regex.compile(pattern)
        for batch in _in_slices(batches):
            ids = _ids(encoding, matcher, batch.column(batch.num_columns - 1), piece_chars)
            out = [pa.array(ids, pa.list_(pa.int32()))]
            if round_trip:
                out.append(pa.array(_bytes(encoding, ids), pa.binary()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *out],
                                             [*batch.schema.names[:-1], *(f.name for f in made)])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], *made]))


def decode(tokens: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """The input with `bytes binary`, the raw bytes its `ids` stand for.

    Bytes, not text: a list of ids may end within a character.
    """
    import pyarrow as pa

    ranks = tokens.sparkSession.sparkContext.broadcast(_load_ranks(ranks_path))

    def run(batches):
        encoding = _encoding(ranks.value, pattern)
        for batch in _in_slices(batches):
            raw = pa.array(_bytes(encoding, batch.column("ids").to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, raw], [*batch.schema.names, "bytes"])

    return tokens.mapInArrow(run, T.StructType([*tokens.schema, T.StructField("bytes", T.BinaryType())]))


def digests(tokens: DataFrame) -> DataFrame:
    """One row per document: token count and hashes of its ids and of its bytes."""
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


cloudpickle.register_pickle_by_value(sys.modules[__name__])
