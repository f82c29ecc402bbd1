"""Byte-level BPE encoding and decoding as a monoid tree reduction (operator 6).

A text is halved down to leaves, leaves are encoded, and neighbours are joined:
the join encodes a window around the boundary anew, grown on both sides until
the tokens outside are provably those of the whole. The proof rests on cuts,
places that are pre-token boundaries whatever stands around them. The pattern's
alternatives are contractions (an apostrophe and letters), runs of one class
(letters, digits, other signs) after at most one blank, and white space; none
looks back. So a cut lies before an ASCII blank after anything but white space,
and between two classes, but for an apostrophe before a letter. Tokens never
cross pre-tokens, so a window from a cut (or the text's end) to a cut changes
nothing outside. A stretch without a cut is not halved: no window short of the
whole would be stable. Characters whose class changed since Unicode 3.2, or
that had none, make no cuts. ``pattern`` must have alternatives of this kind.

The tree of a text is reduced where its row is: memory is a small multiple of
the one text at hand, and texts are independent, so Spark spreads them.
"""

from __future__ import annotations

import base64
import hashlib
import re
import unicodedata
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .wordhash import slices

LEAF_CHARS = 4096
WINDOW_CHARS = 32
#: between classes as given by ``_Classes``
CUT = re.compile("(?<=[LNP'?])(?=s)|(?<=L)(?=[NP'])|(?<=N)(?=[LP'])|(?<=P)(?=[LN])|(?<=')(?=N)")


class _Classes(dict):
    """Code point to class, for ``str.translate``: ``s`` ASCII blank, ``w``
    other white space, ``L`` letter, ``N`` digit, ``'``, ``P`` other sign,
    ``?`` not known for certain."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        kind = unicodedata.category(char)
        if char in " \t\n\x0b\x0c\r":
            name = "s"
        elif char.isspace():
            name = "w"
        elif char == "'":
            name = "'"
        elif kind != unicodedata.ucd_3_2_0.category(char) or kind[0] in "CZ":
            name = "?"
        else:
            name = kind[0] if kind[0] in "LN" else "P"
        self[code] = name
        return name


_classes = _Classes()


def cut_below(text: str, a: int, mid: int, width: int = WINDOW_CHARS) -> int:
    """The last cut in ``(a, mid]``, sought in growing windows; else ``a``."""
    while True:
        lo = max(a, mid - width)
        last = max((m.start() for m in CUT.finditer(text[lo:mid + 1].translate(_classes))), default=0)
        if last or lo == a:
            return lo + last
        width *= 2


def cut_above(text: str, mid: int, b: int, width: int = WINDOW_CHARS) -> int:
    """The first cut in ``[mid, b)``, sought in growing windows; else ``b``."""
    while True:
        hi = min(b, mid + width)
        first = CUT.search(text[mid - 1:hi].translate(_classes))
        if first or hi == b:
            return mid - 1 + first.start() if first else b
        width *= 2


class TreeCodec:
    """Encodes and decodes by halving; ``ranks`` maps token bytes to ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf_chars: int = LEAF_CHARS):
        import tiktoken
        self.leaf = tiktoken.Encoding("leaves", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.bytes_of = {i: token for token, i in ranks.items()}
        self.leaf_chars = max(2, leaf_chars)

    def encode(self, text: str) -> list[int]:
        return self._reduce(text, 0, len(text))

    def _reduce(self, text: str, a: int, b: int) -> list[int]:
        if b - a <= self.leaf_chars:
            return self.leaf(text[a:b])
        mid = (a + b) // 2
        lo, hi = cut_below(text, a, mid), cut_above(text, mid, b)
        if lo == a and hi == b:
            return self.leaf(text[a:b])
        return self._join(text, lo, mid, hi, self._reduce(text, a, mid), self._reduce(text, mid, b))

    def _join(self, text: str, lo: int, mid: int, hi: int, left: list[int], right: list[int]) -> list[int]:
        keep = len(left)
        size = len(text[lo:mid].encode())
        while size > 0:
            keep -= 1
            size -= len(self.bytes_of[left[keep]])
        skip = 0
        over = len(text[mid:hi].encode())
        while over > 0:
            over -= len(self.bytes_of[right[skip]])
            skip += 1
        if size or over:
            raise AssertionError("a cut fell inside a token")
        return left[:keep] + self.leaf(text[lo:hi]) + right[skip:]

    def decode(self, ids: Sequence[int]) -> bytes:
        if len(ids) <= self.leaf_chars:
            return b"".join([self.bytes_of[i] for i in ids])
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks file: a base64 token and its id per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


_codecs: dict[tuple, TreeCodec] = {}


def _codec(key: tuple, ranks: dict[bytes, int], pattern: str) -> TreeCodec:
    if key not in _codecs:  # once per Python worker
        _codecs[key] = TreeCodec(ranks, pattern)
    return _codecs[key]


def byte_bpe(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
             with_ids: bool = False) -> DataFrame:
    """One row per document: ``(id_col, n_tokens, ids_sha256, decoded_sha256)``
    and, with ``with_ids``, the token ids (``ids``).

    The vocabulary (read on the driver from ``ranks_path``, a fixed public file
    of 50,256 tokens) goes to the executors as one broadcast of about 1 MB.

    * null or empty text: no tokens, the digests of the empty string;
    * null ids and rows that repeat an id: every row gives a row;
    * special tokens are ordinary text; other columns play no part; an empty
      table gives no rows.
    """
    from pyspark.sql.types import ArrayType, IntegerType
    ranks = read_ranks(ranks_path)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    key = (ranks_path, pattern, len(ranks))
    fields = [StructField(id_col, docs.schema[id_col].dataType), StructField("n_tokens", LongType()),
              StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
    schema = StructType(fields + ([StructField("ids", ArrayType(IntegerType()))] if with_ids else []))
    names = schema.names

    def run(batches):
        codec = _codec(key, shared.value, pattern)
        number = [str(i) for i in range(max(codec.bytes_of, default=0) + 1)]
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            for a, b in slices(texts):
                counts, id_digests, byte_digests, all_ids = [], [], [], []
                for text in texts[a:b]:
                    ids = codec.encode(text)
                    counts.append(len(ids))
                    id_digests.append(hashlib.sha256(" ".join([number[i] for i in ids]).encode()).hexdigest())
                    byte_digests.append(hashlib.sha256(codec.decode(ids)).hexdigest())
                    if with_ids:
                        all_ids.append(ids)
                arrays = [batch.column(0).slice(a, b - a), pa.array(counts, pa.int64()),
                          pa.array(id_digests, pa.string()), pa.array(byte_digests, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays + ([pa.array(all_ids, pa.list_(pa.int32()))] if with_ids else []),
                                                 names=names)

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text")).mapInArrow(run, schema)
