"""Cross-tokenizer alignment: which tokens of two tokenizers end together.

Tokenizer A (a byte-level BPE) reads a space and the text, B (a sentence-piece
BPE) the text, to which it adds the space itself.  Where a token of A and one
of B end at the same byte, both sequences are cut into groups and the two
tokens are linked.  A pair of ids counts as many times as the corpus links it.

1. First pass.  Every task aligns its documents and adds up its own pairs.
2. Keys.  The distinct pairs are hashed minimally and perfectly.  Of two linked
   tokens one's bytes end the other's, so their number is bounded by the two
   vocabularies (`pair_bound`: every suffix of every token, a few 100,000),
   whatever the corpus; the driver reads them and checks that bound.
3. Sums.  Each task's pairs become a dense vector of counts indexed by the
   hash, in chunks, which are added up as a tree: FAN vectors of a chunk at a
   time, until one is left.
4. Second pass.  Documents are aligned again, their links looked up in the
   dense counts by the hash, with the keys verified.

A text is aligned in pieces that no token of either tokenizer crosses: a piece
begins at white space after another character.  That is safe for A because its
pattern starts a match there, and for B if no entry of its vocabulary has
that white space behind another character, which is checked; a text with other
white space (beyond ASCII, or \\r where B has tokens like `;\\r`) is aligned whole.  Pieces repeat, so a
task remembers the alignment of up to MEMO of them.

Defined results: texts that are NULL, empty, or that the tokens of either side
don't spell byte for byte have no tokens and count nowhere; special tokens'
strings are plain text; equal rows count once each; an empty table gives an
empty table; other columns are passed on only if named in `keep`.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import cut_lineage
from .perfect_hash import MinimalPerfectHash

MEMO = 400_000       # pieces a task remembers
LONG_PIECE = 256     # characters beyond which a piece is not remembered
HELD_CHARS = 1 << 25   # of text counted, before its distinct pieces are aligned
BATCH_CHARS = 1 << 22  # of text described at a time
ALIGNED = 1 << 14      # pieces aligned at a time
CHUNK = 1 << 14      # counts in a chunk of a dense vector
FAN = 32             # vectors added at a time
PAIR_SHIFT = 32

# White space beyond ASCII's, which the two tokenizers' patterns see differently.
# Fixed value: the split of the byte-level pre-tokenizer.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
COMMON_END = "\u0530"  # the Latin, Greek and Cyrillic blocks lie before
SPACES = " \t\n\x0b\x0c\r"
WIDE_SPACE = "\x1c-\x1f\x85\xa0  -     　"

COUNTS = [("n_a", T.LongType()), ("n_b", T.LongType()), ("n_groups", T.LongType()), ("n_links", T.LongType()),
          ("n_best", T.LongType()), ("count_sum", T.LongType())]


def read_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def byte_of_symbol() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable ones stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, from the bytes of their files, and the bytes of each of their tokens."""

    def __init__(self, a_file: bytes, b_file: bytes):
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import numpy as np
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_file.decode())
        self.a.encode_special_tokens = True
        self.ranks = self._as_ranks(a_file)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        symbol = byte_of_symbol()
        self.a_bytes = {i: bytes(symbol[c] for c in token) for token, i in self.a.get_vocab(with_added_tokens=False).items()
                        if all(c in symbol for c in token)}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_len, self.b_len = (np.zeros(1 + max(k for k, _ in x), dtype=np.int64) for x in (self.a_bytes.items(), [*enumerate(self.b_bytes)]))
        for lengths, side in ((self.a_len, self.a_bytes.items()), (self.b_len, enumerate(self.b_bytes))):
            for i, token in side:
                lengths[i] = len(token)
        spelt = [p.replace("▁", " ") for p in pieces]
        # White space that no token of B has behind another character (nor, as the added space, before it).
        uncut = [c for c in SPACES if any(re.search(f"[^{SPACES}]{c}", p) or c != " " and " " + c in p for p in spelt)]
        self.cuts_are_safe = " " not in uncut
        self.wide, self.piece = re.compile(f"[{''.join(uncut)}{WIDE_SPACE}]"), re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")

    @staticmethod
    def _as_ranks(a_file: bytes):
        """A as ranks for tiktoken, if it is a plain byte-level BPE whose ids are in the order of its merges, else None."""
        import json

        import tiktoken

        whole = json.loads(a_file)
        model, split = whole["model"], whole["pre_tokenizer"] or {}
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if any(split.get(k) != v for k, v in plain.items()) or whole["normalizer"] or model["type"] != "BPE" or model.get("ignore_merges"):
            return None
        symbol, vocab = byte_of_symbol(), model["vocab"]
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        special = {t["content"] for t in whole["added_tokens"]}
        ranks = {bytes(symbol[c] for c in token): i for token, i in vocab.items() if token not in special}
        if merged != sorted(merged) or len(ranks) != 256 + len(merged):
            return None
        return tiktoken.Encoding("a", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def pieces(self, text: str) -> list[str]:
        """The pieces of a space and the text, which no token crosses."""
        if not self.cuts_are_safe or self.wide.search(text):
            return [" " + text]
        return self.piece.findall(" " + text)

    def _ids_of_a(self, pieces: list[str]) -> list[list[int]]:
        """The same ids by the quicker of two libraries: `self.ranks` reads the
        common alphabets, whose letters both know alike, the tokenizer's own the rest."""
        if self.ranks is None:
            return [x.ids for x in self.a.encode_batch_fast(pieces, add_special_tokens=False)]
        out = [self.ranks.encode_ordinary(p) if p.isascii() or max(p) < COMMON_END else None for p in pieces]
        rare = [i for i, ids in enumerate(out) if ids is None]
        for i, x in zip(rare, self.a.encode_batch_fast([pieces[i] for i in rare], add_special_tokens=False)):
            out[i] = x.ids
        return out

    def align(self, pieces: list[str]) -> "Alignment":
        import numpy as np

        # B adds a space, so a piece that begins with one goes without it; in
        # one that begins otherwise the added space is a token of its own; a
        # space alone is empty text to B.
        added = self.b.piece_to_id("▁")
        of_a = self._ids_of_a(pieces)
        of_b = self.b.encode([p[1:] if p[0] == " " else p for p in pieces], num_threads=1)
        of_b = [b if p[0] == " " and b else [added] if p == " " else b[1:] if b[:1] == [added] else [] for p, b in zip(pieces, of_b)]
        raw = [p.encode() for p in pieces]
        found = Alignment(of_a, of_b, self)
        if not (found.spells(raw, self)):
            bad = [i for i, (a, b, r) in enumerate(zip(of_a, of_b, raw))
                   if b"".join(map(self.a_bytes.__getitem__, a)) != r or b"".join(map(self.b_bytes.__getitem__, b)) != r]
            for i in bad:
                of_a[i], of_b[i] = [], []
            found = Alignment(of_a, of_b, self)
            found.bad[bad] = True
        return found


class Alignment:
    """Pieces aligned together: the flat ids of both sides, how many each piece
    has, and the links as places in them (`at_a`, `at_b`) with their piece."""

    def __init__(self, of_a, of_b, tokenizers: Tokenizers):
        from itertools import chain

        import numpy as np

        self.bad = np.zeros(len(of_a), dtype=bool)
        self.n_a, self.n_b = (np.fromiter(map(len, x), dtype=np.int64, count=len(x)) for x in (of_a, of_b))
        self.a, self.b = (np.fromiter(chain.from_iterable(x), dtype=np.int64) for x in (of_a, of_b))
        self.ends_a, self.ends_b = np.cumsum(tokenizers.a_len[self.a]), np.cumsum(tokenizers.b_len[self.b])
        # Both ends ascend, so the common ones are found by search.
        place = np.searchsorted(self.ends_b, self.ends_a)
        self.at_a = np.flatnonzero(self.ends_b[np.minimum(place, len(self.ends_b) - 1)] == self.ends_a) if len(self.ends_b) else place[:0]
        self.at_b = place[self.at_a]
        self.piece = np.repeat(np.arange(len(of_a)), self.n_a)[self.at_a]
        self.n_links = np.bincount(self.piece, minlength=len(of_a))
        self.pairs = (self.a[self.at_a] << PAIR_SHIFT | self.b[self.at_b]).astype(np.uint64)

    def spells(self, raw: list[bytes], tokenizers: Tokenizers) -> bool:
        """Whether the tokens of both sides spell every piece, byte for byte."""
        import numpy as np

        whole, upto = b"".join(raw), np.cumsum([len(r) for r in raw])
        for ids, n, ends, bytes_of in ((self.a, self.n_a, self.ends_a, tokenizers.a_bytes), (self.b, self.n_b, self.ends_b, tokenizers.b_bytes)):
            last = np.cumsum(n)
            if not n.all() or (ends[last - 1] != upto).any() or b"".join(map(bytes_of.__getitem__, ids.tolist())) != whole:
                return False
        return True

    def groups(self) -> list[str]:
        """The groups of each piece, as text."""
        a, b, out, i, j, low = [*map(str, self.a.tolist())], [*map(str, self.b.tolist())], [], 0, 0, 0
        shown = []
        for to_i, to_j in zip((self.at_a + 1).tolist(), (self.at_b + 1).tolist()):
            shown.append((a[i] if to_i - i == 1 else ",".join(a[i:to_i])) + "|" + (b[j] if to_j - j == 1 else ",".join(b[j:to_j])))
            i, j = to_i, to_j
        for n in self.n_links.tolist():
            out.append(";".join(shown[low:low + n]))
            low += n
        return out


def pair_bound(tokenizers: Tokenizers) -> int:
    """The most pairs that can ever be linked: one token's bytes end the other's."""
    from collections import Counter

    sides = [Counter(tokenizers.a_bytes.values()), Counter(tokenizers.b_bytes)]
    total = 0
    for mine, other in (sides, sides[::-1]):
        for token, n in mine.items():
            total += n * sum(other[token[k:]] for k in range(len(token)))
    return total


def pair_counts(docs: DataFrame, files) -> DataFrame:
    """pair (id of A above id of B) and n, as each task counts them."""

    def run(batches):
        import gc
        from collections import Counter

        import numpy as np
        import pyarrow as pa

        gc.disable()  # many small objects and no cycles
        tokenizers = Tokenizers(*files.value)
        keys, totals = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)

        def add(seen: Counter, texts: list[str]):
            """Count the links of pieces seen; texts with a piece that isn't spelt count nowhere."""
            nonlocal keys, totals
            pieces, found, wrong = list(seen), [], set()
            for low in range(0, len(pieces), ALIGNED):
                some = pieces[low:low + ALIGNED]
                x = tokenizers.align(some)
                wrong.update(p for p, bad in zip(some, x.bad.tolist()) if bad)
                found.append((x.pairs, x.piece + low))
            if wrong:
                seen = Counter()
                for text in texts:
                    of = tokenizers.pieces(text)
                    if wrong.isdisjoint(of):
                        seen.update(of)
            times = np.array([seen[p] for p in pieces], dtype=np.int64)
            every = np.concatenate([keys, *(pairs for pairs, _ in found)])
            weight = np.concatenate([totals, *(times[piece] for _, piece in found)])
            keys, at = np.unique(every, return_inverse=True)
            totals = np.zeros(len(keys), dtype=np.int64)
            np.add.at(totals, at, weight)
            keys, totals = keys[totals > 0], totals[totals > 0]

        seen, texts, held = Counter(), [], 0
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                if not text:
                    continue
                seen.update(tokenizers.pieces(text))
                texts.append(text)
                held += len(text)
                if held >= HELD_CHARS:
                    add(seen, texts)
                    seen, texts, held = Counter(), [], 0
        add(seen, texts)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(totals)], ["pair", "n"])

    return docs.select("text").mapInArrow(run, "pair long, n long")


def dense_counts(partial: DataFrame, hashed) -> list:
    """The sum of all tasks' counts, as a vector indexed by the hash; `hashed` is broadcast."""
    import numpy as np

    def vectors(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        key_of, part = hashed.value, TaskContext.get().partitionId()
        dense = np.zeros(key_of.size, dtype=np.int64)
        for batch in batches:
            np.add.at(dense, key_of.place(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)), batch.column(1).to_numpy(zero_copy_only=False))
        for chunk, low in enumerate(range(0, key_of.size, CHUNK)):
            values = dense[low:low + CHUNK]
            if values.any():
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([part], pa.int32()),
                                                  pa.array([values.tobytes()], pa.binary())], ["chunk", "part", "counts"])

    def add(key, table):
        import pyarrow as pa

        total = sum(np.frombuffer(x.as_py(), dtype=np.int64) for x in table.column("counts"))
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int32()),
                         "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "chunk int, part int, counts binary"
    rows = partial.mapInArrow(vectors, schema)
    parts = (partial.select(F.spark_partition_id().alias("part")).agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:
        rows = (rows.withColumn("part", F.floor(F.col("part") / FAN).cast("int"))
                .groupBy("chunk", "part").applyInArrow(add, schema))
        parts = -(-parts // FAN)
    dense = np.zeros(hashed.value.size, dtype=np.int64)
    for r in rows.collect():  # a bounded number of counts, see pair_bound
        values = np.frombuffer(r.counts, dtype=np.int64)
        dense[r.chunk * CHUNK:r.chunk * CHUNK + len(values)] = values
    return dense


def align(docs: DataFrame, a_path: str, b_path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns plus n_a, n_b, n_groups, n_links, n_best (links whose pair
    is their B id's most frequent), count_sum, and `groups`, the aligned groups
    as `a1,a2|b1;a3|b2,b3` in decimal ids ('' without tokens)."""
    import numpy as np

    spark = docs.sparkSession
    files = spark.sparkContext.broadcast((read_bytes(a_path), read_bytes(b_path)))
    partial = cut_lineage(pair_counts(docs, files))
    most = pair_bound(Tokenizers(*files.value))
    distinct = [r.pair for r in partial.select("pair").distinct().limit(most + 1).collect()]
    if len(distinct) > most:
        raise RuntimeError(f"more than the {most} pairs that these vocabularies allow")
    hashed = spark.sparkContext.broadcast(MinimalPerfectHash(np.array(distinct, dtype=np.uint64)))
    counts = spark.sparkContext.broadcast(dense_counts(partial, hashed))
    rows = docs.select(*keep, F.col("text").alias("__text"))
    kept, names = len(keep), [*keep, *(name for name, _ in COUNTS), "groups"]

    def run(batches):
        import gc

        import pyarrow as pa

        gc.disable()  # many small objects and no cycles
        tokenizers, key_of, n, memo = Tokenizers(*files.value), hashed.value, counts.value, {}
        unknown: set[str] = set()
        b_of = (key_of.keys & np.uint64((1 << PAIR_SHIFT) - 1)).astype(np.int64)
        best = np.zeros(int(b_of.max()) + 1 if len(b_of) else 0, dtype=np.int64)
        np.maximum.at(best, b_of, n)

        def described(pieces: list[str]) -> list[tuple | None]:
            x = tokenizers.align(pieces)
            place = key_of.place(x.pairs)
            # Only in a document that counts nowhere can there be a pair without a count.
            unknown.update(pieces[i] for i in x.piece[place < 0].tolist())
            count, top = np.zeros(len(place), dtype=np.int64), np.zeros(len(place), dtype=np.int64)
            have = place >= 0
            count[have] = n[place[have]]
            top[have] = count[have] == best[b_of[place[have]]]
            sums = [np.zeros(len(pieces), dtype=np.int64) for _ in range(2)]
            for total, values in zip(sums, (top, count)):
                np.add.at(total, x.piece, values)
            entries = zip(x.n_a.tolist(), x.n_b.tolist(), x.n_links.tolist(), *(total.tolist() for total in sums), x.groups())
            return [None if bad else e for bad, e in zip(x.bad.tolist(), entries)]

        def rows_of(texts: list[str], before):
            split = [tokenizers.pieces(t) if t else [] for t in texts]
            if len(memo) > MEMO:
                memo.clear()
            fresh = list({p for pieces in split for p in pieces if p not in memo})
            for low in range(0, len(fresh), ALIGNED):
                some = fresh[low:low + ALIGNED]
                memo.update(zip(some, described(some)))
            out, entry_of = [], memo.__getitem__
            for pieces in split:
                entries = [*map(entry_of, pieces)]
                if not entries or None in entries:
                    out.append((0, 0, 0, 0, 0, 0, ""))
                elif unknown and not unknown.isdisjoint(pieces):
                    raise RuntimeError("the documents changed between the passes")
                else:
                    a, b, links, top, total, groups = zip(*entries)
                    out.append((sum(a), sum(b), sum(links), sum(links), sum(top), sum(total), ";".join(groups)))
            for p in fresh:
                if len(p) > LONG_PIECE:
                    del memo[p]
            columns = list(zip(*out))
            return pa.RecordBatch.from_arrays([*before, *(pa.array(c, pa.int64()) for c in columns[:-1]), pa.array(columns[-1], pa.string())], names)

        for batch in batches:
            texts, low, held = [], 0, 0
            for at, text in enumerate(batch.column(kept), 1):
                texts.append(text.as_py() or "")
                held += len(texts[-1])
                if held >= BATCH_CHARS or at == batch.num_rows:
                    yield rows_of(texts, batch.slice(low, len(texts)).columns[:kept])
                    texts, low, held = [], at, 0

    schema = T.StructType([*rows.schema.fields[:kept], *(T.StructField(name, t) for name, t in COUNTS), T.StructField("groups", T.StringType())])
    return rows.mapInArrow(run, schema)


def digests(aligned: DataFrame) -> DataFrame:
    """The counts of each document and a hash of its groups ('' without tokens)."""
    return aligned.select("doc_id", *(name for name, _ in COUNTS),
                          F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
