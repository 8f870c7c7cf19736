"""SentencePiece encoding that keeps the offsets of every piece in the original text, and decoding.

A text is normalised by the model's compiled character map: at each place the longest entry that is a prefix
of the rest is replaced, and for every normalised byte the source's byte offset is recorded.  Pieces lie end to
end on the normalised text, so the recorded offsets project each of them to a span of original bytes.

The ids are the library's, of whole texts.  The spans of a text's pieces tile it from its first byte to its last;
where they don't, the alignment is wrong and the task fails.

Cases: a null or empty text has the end id alone and decodes to an empty text.  Repeated rows and rows without
an id are encoded each.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import slices, text_bytes

MARK = "▁"
#: Bytes of text whose pieces are held at once; a longer text is held alone.
GROUP_BYTES = 1 << 18
_MARK = MARK.encode()


class CharacterMap:
    """A compiled character map: a double-array trie over UTF-8 prefixes, and what each entry becomes."""

    def __init__(self, blob: bytes) -> None:
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.results = blob[4 + size :] if blob else b""

    def longest(self, text: bytes, at: int) -> tuple[int, int] | None:
        """Length of the longest entry that begins at ``at``, and where its result begins."""
        units, found = self.units, None
        if not units:
            return None
        node = _child(units[0])
        for i in range(at, len(text)):
            node ^= text[i]
            unit = units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= _child(unit)
            if unit >> 8 & 1:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        return found

    def replace(self, text: bytes, at: int) -> tuple[bytes, int]:
        """What stands for the source at ``at``, and how many of its bytes that takes."""
        found = self.longest(text, at)
        if found:
            return self.results[found[1] : self.results.index(b"\0", found[1])], found[0]
        size = 1 + (text[at] >= 0xC0) + (text[at] >= 0xE0) + (text[at] >= 0xF0)
        return text[at : at + size], size


def _child(unit: int) -> int:
    return unit >> 10 << ((unit & 1 << 9) >> 6)


@dataclass
class Normaliser:
    characters: CharacterMap
    dummy_prefix: bool = True
    squeeze: bool = False
    escape: bool = True
    suffix: bool = False

    def normalise(self, source: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised bytes, and for each of them and for their end the offset in ``source``."""
        if not source:
            return b"", np.zeros(1, np.int64)
        if not self.characters.units and not self.squeeze and self.escape and not self.suffix:
            return self._marked(source)
        blank = _MARK if self.escape else b" "
        out, origin, at = bytearray(), [], 0
        if self.squeeze:
            while at < len(source):
                new, size = self.characters.replace(source, at)
                if new != b" ":
                    break
                at += size
            if at == len(source):
                return b"", np.array([at], np.int64)
        if self.dummy_prefix and not self.suffix:
            out += blank
            origin += [at] * len(blank)
        after_blank = self.squeeze
        while at < len(source):
            new, size = self.characters.replace(source, at)
            if after_blank:
                new = new.lstrip(b" ")
            if new:
                after_blank = new.endswith(b" ")
                new = new.replace(b" ", blank)
                out += new
                origin += [at] * len(new)
            at += size
            after_blank = after_blank and self.squeeze
        if self.squeeze:
            while out.endswith(blank):
                at = origin[len(out) - len(blank)]
                del out[-len(blank) :], origin[-len(blank) :]
        if self.dummy_prefix and self.suffix:
            out += blank
            origin += [at] * len(blank)
        return bytes(out), np.array([*origin, at], np.int64)

    def _marked(self, source: bytes) -> tuple[bytes, np.ndarray]:
        raw = np.frombuffer(source, np.uint8)
        origin = np.repeat(np.arange(len(raw)), np.where(raw == 0x20, len(_MARK), 1))
        head = np.zeros(len(_MARK) * self.dummy_prefix, np.int64)
        return _MARK * self.dummy_prefix + source.replace(b" ", _MARK), np.concatenate([head, origin, [len(raw)]])


class PieceCodec:
    """Ids, spans and decoding of one model."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor
        from sentencepiece.sentencepiece_model_pb2 import ModelProto

        self.library = SentencePieceProcessor(model_file=path)
        proto = ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec = proto.normalizer_spec
        self.normaliser = Normaliser(CharacterMap(spec.precompiled_charsmap), spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces, proto.trainer_spec.treat_whitespace_as_suffix)
        kinds = ModelProto.SentencePiece
        self.bytes = [bytes([int(p.piece[3:-1], 16)]) if p.type == kinds.BYTE else b"" if p.type == kinds.CONTROL else p.piece.encode() for p in proto.pieces]
        self.sizes = np.array(list(map(len, self.bytes)), np.int64)
        self.unknown = self.library.unk_id()
        self.end = self.library.eos_id()

    def encode(self, text: str) -> list[int]:
        """The ids of ``text``, the end id last."""
        return [*self.library.encode(text), self.end] if text else [self.end]

    def spans(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Where each id's span of original bytes begins and ends; the end id's span is empty.

        Raises where the pieces, end to end, are not the normalised text.
        """
        normal, origin = self.normaliser.normalise(text.encode())
        if self.unknown in ids:  # its bytes are what the pieces around it leave; the library tells them
            found = self.library.encode(text, return_type="proto").pieces
            bytes_ = [self.bytes[p.id] if p.id != self.unknown else p.piece.encode() for p in found]
            bytes_ += [b""] * (len(ids) - len(bytes_))
            sizes = np.fromiter(map(len, bytes_), np.int64, len(bytes_))
        else:
            bytes_, sizes = map(self.bytes.__getitem__, ids), self.sizes[ids]
        if b"".join(bytes_) != normal:
            raise ValueError("the pieces of a text are not its normalised bytes")
        ends = np.cumsum(sizes)
        return origin[ends - sizes], origin[ends]

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def encode(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", *, decoded: bool = False) -> DataFrame:
    """``(id, ids, starts, ends)`` for every row: ids with the end id, and each one's span of original bytes.

    With ``decoded``, also what the ids decode to, by the same worker.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            for a, b in slices(offsets, GROUP_BYTES):
                ids, starts, ends, sizes, back = [], [], [], [], []
                for i in range(a, b):
                    text = raw[offsets[i] : offsets[i + 1]].tobytes().decode()
                    found = own.encode(text)
                    span = own.spans(text, found)
                    ids.append(np.array(found, np.int32))
                    starts.append(span[0])
                    ends.append(span[1])
                    sizes.append(len(found))
                    if decoded:
                        back.append(own.decode(found))
                at = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                lists = [pa.ListArray.from_arrays(at, pa.array(np.concatenate(x))) for x in (ids, starts, ends)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *lists, *[pa.array(back, pa.string())] * decoded], names=["id", "ids", "starts", "ends", "decoded"][: 4 + decoded])

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, ids array<int>, starts array<long>, ends array<long>{', decoded string' * decoded}").withColumnRenamed("id", id_col)


def decode(df: DataFrame, model: str, ids_col: str = "ids", *, into: str = "text") -> DataFrame:
    """``df`` with the decoded text of ``ids_col`` in the column ``into``."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(model)
        for column in batches:
            at, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            there = column.is_valid().to_pylist()
            # one row's ids at a time: as Python numbers they take ten times their size
            yield pa.array([own.decode(values[a:b].tolist()) if ok else None for a, b, ok in zip(at[:-1], at[1:], there, strict=True)], pa.string())

    return df.withColumn(into, run(F.col(ids_col)))


def digests(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256)`` of every row of ``encode``, a token for each span."""
    rows = encode(df, model, id_col, text_col, decoded=True)
    said = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return rows.select(id_col, F.size("ends").cast("long").alias("n_tokens"), F.sha2(said, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
