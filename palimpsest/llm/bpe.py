"""Byte-level BPE through a sentencepiece BPE model written from a rank file.

Each byte maps to one printable character; the model holds the vocabulary as
pieces of such characters, scored by negative rank, with identity
normalisation. Sentencepiece then merges the best-scored neighbours first,
which is the lowest rank first.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import fresh, importable, small_batches

#: What a worker remembers of the ids of pre-tokens before it starts afresh: so many bytes of tokens and ids; longer pre-tokens than ``REMEMBERED`` aren't.
MEMORY, ENTRY, REMEMBERED = 48 << 20, 200, 256


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where Latin-1 prints it, else one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = {b: chr(0x100 + k) for k, b in enumerate(b for b in range(256) if b not in set(plain))}
    return [rest.get(b, chr(b)) for b in range(256)]


_CHARS = byte_characters()
_TO_TEXT = {b: c for b, c in enumerate(_CHARS)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def mapped(token: bytes) -> str:
    return token.decode("latin-1").translate(_TO_TEXT)


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """The vocabulary as a serialised BPE model. Piece numbers follow the ranks; the unknown piece comes last."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        model.pieces.add(piece=mapped(token), score=-float(rank), type=pb.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece="<unk>", score=-float(len(ranks)), type=pb.ModelProto.SentencePiece.UNKNOWN)
    spec, norm = model.trainer_spec, model.normalizer_spec
    spec.model_type, spec.vocab_size, spec.unk_id, spec.bos_id, spec.eos_id, spec.pad_id = pb.TrainerSpec.BPE, len(model.pieces), len(ranks), -1, -1, -1
    norm.name, norm.add_dummy_prefix, norm.remove_extra_whitespaces, norm.escape_whitespaces = "identity", False, False, False
    return model.SerializeToString()


class Codec(dict):
    """Pre-token (bytes) to its ids as packed little-endian 32-bit integers, filled as needed."""

    def __init__(self, model: bytes, ranks: dict[bytes, int], pattern: str):
        self.model, self.ranks, self.pattern, self.held = model, ranks, pattern, 0

    # each is made where it is used: a worker that only decodes needs no model, one that only encodes no pieces
    @cached_property
    def processor(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.model)

    @cached_property
    def find(self):
        import regex

        return regex.compile(self.pattern).findall

    @cached_property
    def order(self) -> np.ndarray:
        return np.array(sorted(self.ranks.values()), "<u4")

    @cached_property
    def piece(self) -> dict[int, bytes]:
        return {rank: token for token, rank in self.ranks.items()}

    def __missing__(self, token: str) -> bytes:
        raw = token.encode()
        rank = self.ranks.get(raw)  # a whole pre-token in the vocabulary is one id, however its merges would go
        ids = np.array([rank], "<u4") if rank is not None else self.order[self.processor.encode(mapped(raw))]
        out = ids.tobytes()
        if len(raw) > REMEMBERED:
            return out
        self.held += ENTRY + len(raw) + len(out)
        if self.held > MEMORY:
            self.clear()
            self.held = ENTRY + len(raw) + len(out)
        self[token] = out
        return out

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, self.find(text or "")))

    def decode(self, packed: bytes | None) -> bytes:
        return b"".join(map(self.piece.__getitem__, np.frombuffer(packed or b"", "<u4").tolist()))


@lru_cache(2)
def _codec(model: bytes, ranks: tuple, pattern: str) -> Codec:
    return Codec(model, dict(ranks), pattern)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in short pieces, so that what a worker holds of its output is small."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


class Tokenizer:
    """Encodes and decodes DataFrames; the vocabulary (a file of fixed size) is broadcast once."""

    def __init__(self, spark, rank_file: str, pattern: str):
        importable(spark)
        ranks = read_ranks(rank_file)
        self.sent = spark.sparkContext.broadcast((sentencepiece_model(ranks), tuple(ranks.items()), pattern))

    def _added(self, rows: DataFrame, source: str, steps: list[tuple[str, Callable[[Codec, str | bytes | None], bytes]]]) -> DataFrame:
        """All columns of ``rows``, and one for each step, made by the codec from column ``source`` or from the step before."""
        sent, at, names = self.sent, rows.columns.index(source), fresh(rows.columns, *(c for c, _ in steps))
        small_batches(rows.sparkSession)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codec = _codec(*sent.value)
            for b in slices(batches):
                made = [b.column(at)]
                for _, make in steps:
                    made.append(pa.array([make(codec, x.as_py()) for x in made[-1]], pa.binary()))
                yield pa.RecordBatch.from_arrays([*b.columns, *made[1:]], names=[*b.schema.names, *names])

        return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *(T.StructField(c, T.BinaryType()) for c in names)]))

    def encode(self, docs: DataFrame, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
        """Every row and column of ``docs`` with ``ids_col``, the ids packed as little-endian unsigned 32-bit integers.

        Null and empty texts have none; repeated rows repeat theirs; texts are
        encoded whole, however long. Where a column of that name is there, the
        new one, which is the last, gets an underscore; so with ``decode`` and
        ``round_trip``.
        """
        return self._added(_as_text(docs, text_col), text_col, [(ids_col, Codec.encode)])

    def decode(self, encoded: DataFrame, ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
        """Every row and column with ``decoded_col``, the bytes of the ids. Null ids decode to no bytes."""
        return self._added(encoded, ids_col, [(decoded_col, Codec.decode)])

    def round_trip(self, docs: DataFrame, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
        """``encode``, then ``decode`` of the ids, by one worker, so that texts go to Python once."""
        return self._added(_as_text(docs, text_col), text_col, [(ids_col, Codec.encode), (decoded_col, Codec.decode)])


def _as_text(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.withColumn(text_col, F.col(text_col).cast("string"))
