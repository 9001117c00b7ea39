"""Offset-preserving subword encoding: longest-prefix normalisation through a compiled character map, BPE, and spans."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import extended, small_batches, table, without

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
OUT = ["ids", "piece_ends", "decoded"]
DIGESTS = ["n_tokens", "ids_sha256", "decoded_sha256", "piece_ends_sha256", "n_covered"]


class CharacterMap:
    """The compiled map of a model: a double array of byte transitions, and the strings that its keys turn into.

    A unit of the array holds a label in its low byte (bit 31 set in a value), bit 8 says that a key ends here, and the
    bits from 10 on, shifted by 8 more if bit 9 is set, lead to the children.
    """

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist() if blob else []
        self.strings = blob[4 + size :]

    def may_begin(self, byte: int) -> bool:
        """Whether a key begins with the byte."""
        if not self.units:
            return False
        node = ((self.units[0] >> 10) << ((self.units[0] & 0x200) >> 6)) ^ byte
        return node < len(self.units) and (self.units[node] & 0x800000FF) == byte

    def longest(self, text: bytes, at: int) -> tuple[bytes, int] | None:
        """What the longest key that begins at ``at`` turns into, and that key's length."""
        if not self.units:
            return None
        units, found = self.units, None
        node = (units[0] >> 10) << ((units[0] & 0x200) >> 6)
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(units) or (units[node] & 0x800000FF) != text[i]:
                break
            unit = units[node]
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit & 0x100:
                found = units[node] & 0x7FFFFFFF, i + 1 - at
        if found is None:
            return None
        place, length = found
        return self.strings[place : self.strings.index(b"\0", place)], length


class Normalizer:
    """Text to normalised text, with the source byte at which each normalised byte began; the last entry is the end.

    The longest key of the character map that begins at a character is replaced; only bytes that can begin a key are
    tried, what lies between is copied as it is. Then blanks are taken out and marked.
    """

    def __init__(self, charsmap: bytes, dummy_prefix: bool, remove_extra: bool, as_suffix: bool = False):
        self.map, self.dummy, self.remove, self.suffix = CharacterMap(charsmap), dummy_prefix, remove_extra, as_suffix
        self.begins = np.array([self.map.may_begin(byte) for byte in range(256)])

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        if not text:
            return "", np.zeros(1, np.int64)
        source, mark = text.encode(), SPACE.encode()
        body, align, before = self._walk(source)
        blank = body == 32
        if self.remove:
            dropped = blank & (before >= -1) & ((before < 0) | blank[np.maximum(before, 0)])
            body, align, blank = body[~dropped], align[~dropped], blank[~dropped]
        out, align, end = body.tobytes().replace(b" ", mark), np.repeat(align, np.where(blank, 3, 1)), len(source)
        if self.remove:
            while out.endswith(mark):
                out, end, align = out[:-3], int(align[len(out) - 3]), align[: len(out) - 3]
            if not out:
                return "", np.zeros(1, np.int64)
        if self.dummy and self.suffix:
            out, align = out + mark, np.append(align, [end] * 3)
        elif self.dummy:
            out, align = mark + out, np.concatenate([[align[0] if self.remove else 0] * 3, align])
        return out.decode(), np.append(align, end).astype(np.int64)

    def _walk(self, source: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The replaced bytes, the source byte of each, and for each the place before its character or key; -2 where a
        blank stays whatever comes before (one inside of what a key turns into)."""
        raw = np.frombuffer(source, np.uint8)
        place = np.arange(len(raw))
        tried = np.flatnonzero(self.begins[raw] & ((raw & 0xC0) != 0x80))
        parts, end, made = [], 0, 0
        for at in tried.tolist():
            found = self.map.longest(source, at) if at >= end else None
            if found is None:
                continue
            to, length = np.frombuffer(found[0], np.uint8), found[1]
            parts.append((raw[end:at], place[end:at], made + np.arange(at - end) - 1))
            made += at - end
            leading = np.cumprod(to == 32).astype(bool)
            parts.append((to, np.full(len(to), at), np.where(leading, made - 1, -2)))
            made += len(to)
            end = at + length
        parts.append((raw[end:], place[end:], made + np.arange(len(raw) - end) - 1))
        return tuple(np.concatenate(column) for column in zip(*parts)) if len(parts) > 1 else parts[0]


class Encoder:
    """Normalises by itself, lets the model's merges cut the normalised text, and projects the pieces to the source."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as file:
            blob = file.read()
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=blob)
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(blob)
        if any(p.type == 4 for p in model.pieces) or not model.trainer_spec.byte_fallback:
            raise ValueError("models with user symbols or without byte pieces are not covered")
        spec = model.normalizer_spec
        self.normalize = Normalizer(
            spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, model.trainer_spec.treat_whitespace_as_suffix
        )
        spec.name, spec.precompiled_charsmap = "identity", b""
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = False
        self.merges = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.lengths = np.array([1 if p.type == 6 else len(p.piece.encode()) for p in model.pieces])

    def __call__(self, texts: list[str]) -> tuple[list[list[int]], list[np.ndarray]]:
        """Ids, and for each piece the source byte at which it ends; it begins where the one before it ends."""
        normal = [self.normalize(t) for t in texts]
        ids = self.merges.encode([t for t, _ in normal], num_threads=1)
        ends = [align[np.cumsum(self.lengths[i])] if i else np.zeros(0, np.int64) for i, (_, align) in zip(ids, normal)]
        return ids, ends

    def decode(self, ids: list[list[int]]) -> list[str]:
        return [self.whole.decode(i) if i else "" for i in ids]


def encode_documents(documents: DataFrame, model: str | None = None) -> DataFrame:
    """Add ``ids`` (array of int), ``piece_ends`` (source byte at which each piece ends; a piece begins where the one
    before ends, the first at 0) and ``decoded`` (the text that the ids give back) for whole texts.

    ``model`` is a path that every worker can read; without it each worker asks the installed vocabulary package. The
    merges and decoding are the model's own; normalisation, alignment and spans are ours. Null and empty texts give no
    ids and an empty text. Row by row: repeated rows get equal results, columns named as the results are replaced.
    """
    rows = without(documents, OUT)

    def encode(batches):
        import public_tokenizers

        coder = Encoder(model or public_tokenizers.path(MODEL))
        for batch in small_batches(batches, "text", 2 << 20):
            ids, ends = coder([t or "" for t in batch.column("text").to_pylist()])
            places = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
            flat = np.fromiter((x for i in ids for x in i), np.int32, int(places[-1]))
            spans = np.concatenate([*ends, np.zeros(0, np.int64)]).astype(np.int32)
            added = [pa.ListArray.from_arrays(places, flat), pa.ListArray.from_arrays(places, spans), pa.array(coder.decode(ids), pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *OUT])

    return rows.mapInArrow(encode, extended(rows, "ids array<int>, piece_ends array<int>, decoded string"))


def digests(encoded: DataFrame, *keep: str) -> DataFrame:
    """Digests of ids, decoded text and spans, and the source bytes that the spans cover: those up to the last end."""
    return encoded.select(
        *keep, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.sha2(F.array_join(F.col("piece_ends").cast("array<string>"), ","), 256).alias("piece_ends_sha256"),
        F.coalesce(F.try_element_at("piece_ends", F.lit(-1)), F.lit(0)).cast("long").alias("n_covered"),
    )


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text")), "doc_id")
