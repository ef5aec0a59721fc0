"""SentencePiece encoding and decoding on the tokenizers library, rebuilt from the model file.

The model protobuf is read field by field: pieces with scores and types, the model kind, and the normaliser's
settings. From them come a tokenizers normaliser (character map, dummy prefix, white space marker), a unigram
model on the pieces' scores or a BPE model whose merges follow the scores, byte fallback, and a decoder.

No piece holds the marker after another character (checked when the model is read), so a text may be cut
wherever a space follows something else, and both kinds of model segment the stretches independently. Each
distinct stretch of a task is encoded once, in multithreaded batches, checked against the sentencepiece
library, and its ids are put together per text by numpy. Every text is decoded again from its ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorepipe.llm import common

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
KNOWN_STRETCHES = 1 << 18
"""Distinct stretches that a task remembers; beyond, it forgets all and goes on."""
CHUNK = 1 << 19
BATCH = 1 << 12
"""Stretches that the tokenizer encodes in one call; its results are large while they last."""


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message; fixed-width values as bytes."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        if kind not in (1, 2, 5):
            raise ValueError(f"not a model file: wire type {kind}")
        size = varint() if kind == 2 else 8 if kind == 1 else 4
        yield tag >> 3, raw[at : at + size]
        at += size


@dataclass
class Model:
    """What a model file says; field numbers are those of the published sentencepiece message."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    char_map: bytes = b""
    dummy_prefix: bool = True
    trim: bool = True

    @staticmethod
    def parse(raw: bytes) -> Model:
        m = Model()
        for number, value in fields(raw):
            if number == 1:  # a piece
                piece = dict(fields(value))
                score = float(np.frombuffer(piece[2], "<f4")[0]) if 2 in piece else 0.0
                m.pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
            elif number == 2:  # trainer
                for n, v in fields(value):
                    m.kind = v if n == 3 else m.kind
                    m.byte_fallback = bool(v) if n == 35 else m.byte_fallback
            elif number == 3:  # normaliser
                for n, v in fields(value):
                    m.char_map = v if n == 2 else m.char_map
                    m.dummy_prefix = bool(v) if n == 3 else m.dummy_prefix
                    m.trim = bool(v) if n == 4 else m.trim
        if m.kind not in (UNIGRAM, BPE):
            raise ValueError(f"model kind {m.kind} is neither unigram nor BPE")
        if any(t == USER_DEFINED for _, _, t in m.pieces):
            raise ValueError("user-defined pieces are not supported")
        if any(MARKER in p.lstrip(MARKER) for p, _, t in m.pieces if t == NORMAL):
            raise ValueError("pieces that cross white space are not supported")
        return m


def tokenizer(model: Model, prefix: bool):
    """A tokenizers Tokenizer of the model; ``prefix`` says whether it adds the dummy prefix."""
    from tokenizers import Tokenizer, decoders, models, normalizers

    unknown = next((i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN), None)
    if model.kind == UNIGRAM:
        vocabulary = [(p, s if t != UNUSED else -1e9) for p, s, t in model.pieces]
        built = Tokenizer(models.Unigram(vocabulary, unknown, model.byte_fallback))
    else:
        ids = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        usable = {p for p, _, t in model.pieces if t == NORMAL}
        merges = []
        for p, score, t in model.pieces:
            if t == NORMAL:
                merges += [(-score, ids[p], p[:i], p[i:]) for i in range(1, len(p)) if p[:i] in usable and p[i:] in usable]
        merges.sort(key=lambda m: (m[0], ids[m[2]], ids[m[3]]))
        name = model.pieces[unknown][0] if unknown is not None else None
        # no cache: every stretch comes once, and the caches of the library's threads outlive the tokenizer
        built = Tokenizer(models.BPE(ids, [(a, b) for _, _, a, b in merges], unk_token=name, fuse_unk=True, byte_fallback=model.byte_fallback, cache_capacity=0))
    steps = [normalizers.Precompiled(model.char_map)] if model.char_map else []
    if model.trim:
        steps += [normalizers.Replace(" {2,}", " "), normalizers.Strip()]
    if prefix and model.dummy_prefix:
        steps.append(normalizers.Prepend(MARKER))
    built.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARKER)])
    ends = [decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []
    built.decoder = decoders.Sequence([decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse(), *ends])
    return built


def piece_bytes(model: Model) -> list[bytes]:
    """What each id stands for in a decoded text."""
    out = []
    for p, _, t in model.pieces:
        out.append(bytes([int(p[3:5], 16)]) if t == BYTE else b"" if t == CONTROL else " ⁇ ".encode() if t == UNKNOWN else p.replace(MARKER, " ").encode())
    return out


def decoded(ids: list[int], table: list[bytes], dummy_prefix: bool) -> str:
    if ids and not (0 <= min(ids) and max(ids) < len(table)):
        raise ValueError(f"ids must lie between 0 and {len(table) - 1}: {min(ids)}, {max(ids)}")
    raw = b"".join([table[i] for i in ids])
    return (raw[1:] if dummy_prefix and raw[:1] == b" " else raw).decode("utf-8", "replace")


class Encoder:
    """Encodes chunks of texts in one task."""

    def __init__(self, raw: bytes):
        import os

        os.environ.setdefault("RAYON_NUM_THREADS", "2")  # a task has one core; more threads mostly wait for each other
        import sentencepiece
        from tokenizers import normalizers

        self.model = Model.parse(raw)
        self.stretches = tokenizer(self.model, prefix=False)
        steps = [normalizers.Precompiled(self.model.char_map)] if self.model.char_map else []
        steps += [normalizers.Replace(" {2,}", " "), normalizers.Strip()] if self.model.trim else []
        self.normal = normalizers.Sequence(steps) if steps else None
        self.judge = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = np.empty(0, np.int32)  # of all known stretches, one after the other
        self.sizes = np.empty(0, np.int64)
        self.agrees = np.empty(0, bool)

    def learn(self, stretches: list[bytes]) -> None:
        if len(self.known) + len(stretches) > KNOWN_STRETCHES:
            self.forget()
        new = [s for s in stretches if s not in self.known]
        ids, sizes, agrees = [self.ids], [], []
        for i in range(0, len(new), BATCH):
            part = new[i : i + BATCH]
            texts = [s.decode() for s in part]
            ours = [e.ids for e in self.stretches.encode_batch_fast(texts, add_special_tokens=False)]
            judged = self.judge.encode([t[1:] if self.model.dummy_prefix else t for t in texts], num_threads=2)
            # a lone marker is the dummy prefix of an empty text, which the other library drops
            agrees += [o == j or (s == b" " and self.model.dummy_prefix) for s, o, j in zip(part, ours, judged)]
            sizes += map(len, ours)
            ids.append(np.fromiter((x for o in ours for x in o), np.int32))
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        self.ids = np.concatenate(ids)
        self.sizes = np.concatenate([self.sizes, np.array(sizes, np.int64)])
        self.agrees = np.concatenate([self.agrees, np.array(agrees, bool)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's ids start and the last ends, whether both libraries agree)."""
        if self.normal is not None:
            texts = [self.normal.normalize_str(t) for t in texts]
        lead = " " if self.model.dummy_prefix else ""
        buffers = [(lead + t).replace(MARKER, " ").encode() if t else b"" for t in texts]
        starts = np.cumsum([0, *map(len, buffers)])
        raw = b"".join(buffers)
        data = np.frombuffer(raw, np.uint8)
        space = data == 32
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        cut[starts[:-1][np.diff(starts) > 0]] = True
        at = np.flatnonzero(cut)
        owner = np.searchsorted(starts, at, "right") - 1
        ends = np.append(at[1:], len(data))
        parts = [raw[i:j] for i, j in zip(at.tolist(), ends.tolist())]
        self.learn(list(dict.fromkeys(parts)))
        which = np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts))
        begin = np.concatenate([[0], np.cumsum(self.sizes)])
        size = self.sizes[which]
        total = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.repeat(begin[which] - total[:-1], size) + np.arange(total[-1])]
        per_text = np.zeros(len(texts), np.int64)
        np.add.at(per_text, owner, size)
        fine = np.ones(len(texts), bool)
        np.logical_and.at(fine, owner, self.agrees[which])
        return ids.astype(np.int32), np.concatenate([[0], np.cumsum(per_text)]), fine


def encode(docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens BIGINT, ids ARRAY<INT>, round_trip, parity) of every row.

    ids are those of the sentencepiece library without special tokens; parity tells that it gave the same ids
    for each stretch of the text, round_trip that decoding the ids gives the whole text back (not so where the
    text holds the white space marker itself or the model's normaliser changes it). A null text has no ids and
    trips to the empty text. Repeated rows and null ids give a row each; extra columns are ignored.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        table = piece_bytes(encoder.model)
        for batch in batches:
            for rows, data, starts in common.text_chunks(batch, "text", CHUNK):
                raw = data.tobytes()
                texts = [raw[i:j].decode("utf-8", "replace") for i, j in zip(starts[:-1].tolist(), starts[1:].tolist())]
                ids, to, fine = encoder.encode(texts)
                same = [decoded(ids[a:b].tolist(), table, encoder.model.dummy_prefix) == t for a, b, t in zip(to[:-1].tolist(), to[1:].tolist(), texts)]
                lists = pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[rows], pa.array(np.diff(to)), lists, pa.array(same, pa.bool_()), pa.array(fine)],
                    ["doc_id", "n_tokens", "ids", "round_trip", "parity"],
                )

    plain = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return plain.mapInArrow(common.lean(work), "doc_id BIGINT, n_tokens BIGINT, ids ARRAY<INT>, round_trip BOOLEAN, parity BOOLEAN")


def decode(tokens: DataFrame, model: bytes, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, text) from ids. Null ids give a null text; ids outside the model, negative ones too, raise a ValueError."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model.parse(model)
        table = piece_bytes(m)
        for batch in batches:
            texts = [None if x is None else decoded(x, table, m.dummy_prefix) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select(F.col(key).cast("bigint").alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(common.lean(work), "doc_id BIGINT, text STRING")


def read_model(path: str = MODEL_PATH) -> bytes:
    """The model file's bytes, read by the driver; they travel to the tasks with the code."""
    with open(path, "rb") as f:
        return f.read()
