"""SentencePiece encoding with the original byte span of every piece, and decoding.

The model's own normaliser is followed step by step so that the place of every normalised byte in the source is
known: at each source byte the compiled character map (a double-array trie inside the model file) is asked for the
longest prefix it rewrites; without one, the character is copied. Pieces are consecutive in the normalised text, so
the lengths of the pieces and that alignment give each piece its span of source bytes. Segmentation itself is the
library's.

Defined results: a null text counts as empty; an empty text has the begin and end ids only, with empty spans.
Rows are independent: repeated rows, ties and any other columns change nothing, an empty table gives an empty one.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.text import in_slices, with_text

# The space's stand-in, and field numbers of the model file.
SPACE_MARK = "▁".encode()
MODEL_PIECES, MODEL_TRAINER, MODEL_NORMALIZER, MODEL_DENORMALIZER = 1, 2, 3, 5
PIECE_TEXT, PIECE_TYPE, TYPE_UNKNOWN, TYPE_CONTROL, TYPE_BYTE = 1, 3, 2, 3, 6
NORM_CHARSMAP, NORM_DUMMY_PREFIX, NORM_EXTRA_SPACES, NORM_ESCAPE = 2, 3, 4, 5
TRAINER_SPACE_AS_SUFFIX = 24

OUTPUT = T.StructType(
    [
        T.StructField("ids", T.BinaryType(), False),
        T.StructField("begins", T.BinaryType(), False),
        T.StructField("ends", T.BinaryType(), False),
        T.StructField("decoded", T.StringType(), False),
    ]
)


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one protocol-buffer message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        else:
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class CharacterMap:
    """The compiled map: a double-array trie from source bytes to the place of their replacement."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.texts = blob[4 + size :] if blob else b""

    def longest(self, data: bytes, at: int) -> tuple[int, bytes]:
        """Length of the longest mapped prefix of `data[at:]` and its replacement; (0, b'') without one."""
        units, found, place = self.units, 0, 0
        node = self._offset(units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found, place = i - at + 1, units[node] & 0x7FFFFFFF
        return (found, self.texts[place : self.texts.index(b"\0", place)]) if found else (0, b"")

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 512) >> 6)


class Normalizer:
    """The model's normaliser with an alignment: place of each normalised byte in the source, then its length."""

    def __init__(self, model: bytes):
        parts = dict(_fields(model))
        spec = dict(_fields(parts.get(MODEL_NORMALIZER, b"")))
        if dict(_fields(parts.get(MODEL_TRAINER, b""))).get(TRAINER_SPACE_AS_SUFFIX, 0):
            raise ValueError("models that mark spaces as suffixes are not supported")
        self.map = CharacterMap(spec.get(NORM_CHARSMAP, b""))
        self.dummy_prefix = bool(spec.get(NORM_DUMMY_PREFIX, 1))
        self.squeeze = bool(spec.get(NORM_EXTRA_SPACES, 1))
        self.mark = SPACE_MARK if spec.get(NORM_ESCAPE, 1) else b" "

    def __call__(self, source: bytes) -> tuple[bytes, np.ndarray]:
        if not self.map.units and not self.squeeze:
            return self._copied(source)
        return self._mapped(source)

    def _copied(self, source: bytes) -> tuple[bytes, np.ndarray]:
        """Without map entries every character is its own longest prefix; only spaces change their length."""
        if not source:
            return b"", np.zeros(1, np.int64)
        sizes = np.where(np.frombuffer(source, np.uint8) == 32, len(self.mark), 1)
        places = np.repeat(np.arange(len(source)), sizes)
        prefix = self.mark if self.dummy_prefix else b""
        places = np.concatenate([np.zeros(len(prefix), np.int64), places, [len(source)]])
        return prefix + source.replace(b" ", self.mark), places

    def _mapped(self, source: bytes) -> tuple[bytes, np.ndarray]:
        out, places, at = bytearray(), [], 0
        steps = []
        while at < len(source):
            size, text = self.map.longest(source, at) if self.map.units else (0, b"")
            if not size:
                lead = source[at]
                size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                text = source[at : at + size]
            steps.append((at, text))
            at += size
        end = len(source)
        if self.squeeze:
            while steps and steps[0][1].strip(b" ") == b"":
                steps.pop(0)
            while steps and steps[-1][1].strip(b" ") == b"":
                end = steps.pop()[0]
        if not steps:
            return b"", np.array([end], np.int64)
        if self.dummy_prefix:
            out += self.mark
            places += [steps[0][0]] * len(self.mark)
        after_space = self.squeeze
        for place, text in steps:
            for byte in text:
                if byte == 32:
                    if self.squeeze and after_space:
                        continue
                    out += self.mark
                    places += [place] * len(self.mark)
                else:
                    out.append(byte)
                    places.append(place)
                after_space = byte == 32
        if self.squeeze:
            while out.endswith(self.mark):
                del out[-len(self.mark) :]
                end = places[-len(self.mark)]
                del places[-len(self.mark) :]
        return bytes(out), np.array([*places, end], np.int64)


class Encoder:
    """A model file with everything needed to encode, align and decode."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as file:
            model = file.read()
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.normalize = Normalizer(model)
        sizes = []
        for field, value in _fields(model):
            if field == MODEL_PIECES:
                piece = dict(_fields(value))
                kind = piece.get(PIECE_TYPE, 1)
                sizes.append(
                    1 if kind == TYPE_BYTE else 0 if kind in (TYPE_CONTROL, TYPE_UNKNOWN) else len(piece[PIECE_TEXT])
                )
        self.sizes = np.array(sizes, np.int64)
        self.unknown = self.processor.unk_id()

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids with begin and end, and the first and the last-but-one source byte of each."""
        text = text or ""
        ids = np.array(self.processor.encode(text, add_bos=True, add_eos=True), np.int64)
        normal, places = self.normalize(text.encode())
        sizes = self.sizes[ids]
        if (ids[1:-1] == self.unknown).any():
            shown = self.processor.encode(text, out_type=str)
            sizes[1:-1] = np.where(ids[1:-1] == self.unknown, [len(p.encode()) for p in shown], sizes[1:-1])
        ends = np.cumsum(sizes)
        if ends[-1] != len(normal):
            raise ValueError("the pieces do not cover the normalised text")
        return ids, places[ends - sizes], places[ends]


def encode_documents(docs: DataFrame, model_path: str, id_column: str = "doc_id") -> DataFrame:
    """`id_column`, `ids`, `begins`, `ends` (little-endian unsigned 32-bit integers) and `decoded` per row.

    `model_path` must be readable where tasks run. Ids start with the begin and end with the end id.
    """

    def run(batches):
        encoder = Encoder(model_path)
        for batch in in_slices(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                ids, begins, ends = encoder.encode(text)
                decoded = encoder.processor.decode(ids.tolist())
                rows.append((*(x.astype("<u4").tobytes() for x in (ids, begins, ends)), decoded))
            packed = [pa.array(column, pa.binary()) for column in list(zip(*rows))[:3]]
            texts = pa.array([row[3] for row in rows], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(id_column), *packed, texts], [id_column, *OUTPUT.names])

    narrow = with_text(docs, id_column, "text")
    return narrow.mapInArrow(run, T.StructType([narrow.schema[id_column], *OUTPUT.fields]))


def digests(encoded: DataFrame) -> DataFrame:
    """Counts and checksums of what `encode_documents` returned."""
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def unpack(packed: bytes) -> list[int]:
    """Ids or offsets of one packed column value."""
    return np.frombuffer(packed, "<u4").tolist()
