"""Byte-level BPE by a sentencepiece model made from the ranks of a vocabulary file.

The model is written directly: each token's bytes become printable characters,
one for each byte, and are a piece scored by its negative rank, so that the
library's "best score first" merges are the vocabulary's "lowest rank first"
ones. Normalisation is the identity. Texts are cut into pre-tokens by a pattern,
each is encoded separately, and ids are decoded by the inverse mapping.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from tidemark.llm.pieces import byte_alphabet, spaced_ids
from tidemark.llm.shared import map_batches, prepare, texts_of

NORMAL, UNKNOWN = 1, 2  # fixed values: kinds of piece in the model format
BPE = 2  # fixed value: kind of model


def read_ranks(vocabulary: bytes) -> dict[bytes, int]:
    """Ranks by token, from lines of a base64 token and its rank."""
    lines = (line.split() for line in vocabulary.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in lines}


def build_model(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece BPE model; the piece of rank r has the id r + 1."""
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without gaps")
    alphabet = byte_alphabet()
    model = model_pb2.ModelProto()
    model.pieces.add(piece="<unk>", score=0.0, type=UNKNOWN)
    for token in sorted(ranks, key=ranks.__getitem__):
        piece = "".join(alphabet[b] for b in token)
        model.pieces.add(piece=piece, score=-float(ranks[token]), type=NORMAL)
    trainer, normalizer = model.trainer_spec, model.normalizer_spec
    trainer.model_type, trainer.vocab_size = BPE, len(model.pieces)
    trainer.unk_id, trainer.bos_id, trainer.eos_id, trainer.pad_id = 0, -1, -1, -1
    normalizer.name = "identity"
    normalizer.add_dummy_prefix = False
    normalizer.remove_extra_whitespaces = False
    normalizer.escape_whitespaces = False
    return model.SerializeToString()


@lru_cache(maxsize=4)
def coder(vocabulary: bytes, split: str) -> tuple[Callable[[str], bytes], Callable[[list[int]], bytes]]:
    """Encoder (text to packed ids) and decoder (ids to bytes) of a vocabulary."""
    ranks = read_ranks(vocabulary)
    processor = sentencepiece.SentencePieceProcessor(model_proto=build_model(ranks))
    alphabet, pre_tokens = byte_alphabet(), regex.compile(split).findall
    to_alphabet = dict(enumerate(alphabet))
    to_byte = {ord(c): b for b, c in enumerate(alphabet)}

    def encode(piece: str) -> list[int]:
        ids: list[int] = []
        for pre_token in pre_tokens(piece):
            mapped = pre_token.encode().decode("latin-1").translate(to_alphabet)
            ids += [i - 1 for i in processor.encode(mapped)]
        return ids

    pieces = [processor.id_to_piece(i + 1) for i in range(len(ranks))]
    token_bytes = [p.translate(to_byte).encode("latin-1") for p in pieces]

    def decode(numbers: list[int]) -> bytes:
        return b"".join(map(token_bytes.__getitem__, numbers))

    # Texts are cut where every match of the pattern ends, too.
    return spaced_ids(encode), decode


def encode_documents(docs: DataFrame, vocabulary: bytes, split: str) -> DataFrame:
    """``doc_id``, ``ids`` (binary, little-endian unsigned 32-bit) of every whole text.

    Null and empty texts have no ids; rows with equal or null ``doc_id`` stay rows
    of their own; other columns of ``docs`` are not used. One pass, no exchange.
    """
    shared = prepare(docs.sparkSession).sparkContext.broadcast(vocabulary)

    def kernel(batch: pa.RecordBatch) -> dict:
        encode, _ = coder(shared.value, split)
        return {"ids": [encode(t) for t in texts_of(batch.column("text"))]}

    return map_batches(docs.select("doc_id", "text"), kernel, "ids binary", keep=("doc_id",))


def decode_documents(encoded: DataFrame, vocabulary: bytes, split: str) -> DataFrame:
    """The bytes of each document's ids, as column ``decoded``; null ids are none."""
    shared = prepare(encoded.sparkSession).sparkContext.broadcast(vocabulary)

    def kernel(batch: pa.RecordBatch) -> dict:
        _, decode = coder(shared.value, split)
        ids = (memoryview(i or b"").cast("I").tolist() for i in batch.column("ids").to_pylist())
        return {"decoded": [decode(i) for i in ids]}

    return map_batches(encoded.select("doc_id", "ids"), kernel, "decoded binary", keep=("doc_id", "ids"))
