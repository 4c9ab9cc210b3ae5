"""Packing by power-of-two decomposition.

Each document's ids are cut into pieces of binary length: as many of the longest length
as fit, then the binary digits of what is left, longest first. Pieces of one length form
a bucket; a sequence is one piece, so no sequence crosses documents and none is padded.
"""

from __future__ import annotations

import functools
import json
import re
import sys
from array import array

from pyspark.sql import DataFrame, SparkSession, functions as F

from crowdtide.llm.common import lean, plain_text, small_batches, table

MAX_LENGTH = 2048
END_ID = 1
SLICE = 1 << 20  # characters that are cut into units at once
CACHED = 100_000  # units, and as many pieces, that a worker remembers


class TokenIds:
    """Ids of a text as little-endian 32-bit numbers, as ``tokenizers`` gives them.

    ``tokenizers`` spends 10 microseconds on a short word, so texts are cut where no token
    can reach across (before a single space) and the units are remembered. A new unit is
    cut by the pre-tokeniser's pattern and its pieces are merged by rank, which is what the
    vocabulary file describes if its merges are in the order of its ids. Where that or the
    kind of the file doesn't hold, and for texts with runs of white space that the cut
    would break, ``tokenizers`` reads the whole text.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.unsafe = re.compile(r"\s (?:\s|\Z)")
        self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        self.merge = self._merge(path)
        self.units: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _merge(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        vocab, merges = model["vocab"], model.get("merges", [])
        joined = ("".join(m if isinstance(m, list) else m.split(" ")) for m in merges)
        if (sys.byteorder != "little" or model.get("type") != "BPE" or spec.get("normalizer") or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True)
                or pre.get("add_prefix_space") or any(vocab.get(m) != 256 + i for i, m in enumerate(joined))):
            return None
        # byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}
        added = {x["content"] for x in spec.get("added_tokens", [])}
        ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items() if token not in added}
        return tiktoken.Encoding("ranks", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def _whole(self, text: str) -> bytes:
        import numpy as np

        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = array("I", self.merge(piece.encode("utf-8", "surrogatepass"))).tobytes()
            if len(self.pieces) < CACHED:
                self.pieces[piece] = ids
        return ids

    def _unit(self, unit: str, space: str = " ") -> bytes:
        """Ids of what stands between single spaces, with the space before it."""
        if unit.isalpha():
            ids = self._piece(space + unit)
        elif unit[:-1].isalpha() and unit[-1] in ".,":
            ids = self._piece(space + unit[:-1]) + self._piece(unit[-1])
        else:
            ids = b"".join(map(self._piece, self.pattern.findall(space + unit)))
        if space and len(self.units) < CACHED:
            self.units[unit] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        if self.merge is None or self.unsafe.search(text):
            return self._whole(text)
        out, known, start = [], self.units, 0
        while start < len(text):
            stop = len(text) if len(text) - start <= SLICE else text.rfind(" ", start, start + SLICE)
            stop = stop if stop > start else text.find(" ", start + SLICE)
            stop = stop if stop > start else len(text)
            # a later slice begins with the space of its first unit
            first, *units = text[start + (start > 0):stop].split(" ")
            if first or start:
                out.append(self._unit(first, " " if start else ""))
            out += [known.get(u) or self._unit(u) for u in units]
            start = stop
        return b"".join(out)


@functools.cache
def token_ids(path: str) -> TokenIds:
    """One for each worker process, which keeps what it has learned between tasks."""
    return TokenIds(path)


def lengths(n: int, longest: int) -> list[int]:
    """Binary lengths that sum to ``n``, longest first."""
    return [longest] * (n // longest) + [1 << b for b in reversed(range(longest.bit_length() - 1)) if n % longest >> b & 1]


def pack(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         max_length: int = MAX_LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, bucket, sequence_id, offset``.

    ``ids`` is binary, little-endian unsigned 32-bit; ``doc_tokens`` counts the document's
    ids with ``end_id``, which closes every document, so a null or empty text is one piece
    of one id. ``bucket`` is the binary logarithm of the length; write by it
    (``write_buckets``) to get batches of equal length. ``max_length`` is a power of two.
    ``sequence_id`` numbers pieces in the order they are read, unique over the table, and
    costs no shuffle; ``offset`` is 0. Rows with one id are packed each for itself; other
    columns are not read; an empty table gives no rows. Bounded memory: batches are read
    in turn, a worker remembers at most ``2 * CACHED`` units.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")

    def cut(batches):
        import numpy as np
        import pyarrow as pa

        encode, end = token_ids(tokenizer), np.asarray([end_id], "<u4").tobytes()
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64())])
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py()) + end
                start, n = 0, len(ids) // 4
                for length in lengths(n, max_length):
                    for column, value in zip(rows, (doc_id, start, length, ids[4 * start:4 * (start + length)], n)):
                        column.append(value)
                    start += length
                if len(rows[0]) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)
                    rows = [[], [], [], [], []]
            if rows[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)

    narrow = small_batches(df).select(F.col(id_col).cast("long").alias("doc_id"), plain_text(F.col(text_col)).alias("text"))
    pieces = narrow.mapInArrow(lean(cut), "doc_id long, start long, length long, ids binary, doc_tokens long")
    return pieces.select(
        "*", F.log2("length").cast("int").alias("bucket"),
        F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """A folder for each length, files of about equal size."""
    pieces.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")
