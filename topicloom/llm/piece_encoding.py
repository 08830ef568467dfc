"""Exact encoding and decoding with a merge-type piece model, by backtracking.

The merges of a text are not replayed. Instead, an Aho-Corasick automaton gives the pieces
that start at every position; the longest one is taken whose joint with the piece before
it is compatible, that is if merging the two pieces' characters afresh gives these two
pieces again. Where nothing fits, the position is marked in a bitfield as failed and the
piece before it is replaced by a shorter one. A sequence whose neighbours are all
compatible is the one that the merges give, so the first one that reaches the end is it.

Texts are cut where no piece of the model joins the two characters, before any merge could
cross; results of whole words are remembered up to a bound. Characters that are no piece
become byte pieces. Normalisation and decoding are the model's own.

Defined cases: null and empty texts give the begin and end ids alone and decode to the
empty text; equal texts give equal ids. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from topicloom.llm.common import column, slices

_SPACE = "▁"


class MergeEncoder:
    """Pieces, joints and remembered words of one model file."""

    def __init__(self, path: str, words: int = 500_000, joints: int = 1_000_000):
        import ahocorasick
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [
            i
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))
        ]
        self.pieces = {i: model.id_to_piece(i) for i in ids}
        self.scores = {p: (model.get_score(i), i) for i, p in self.pieces.items()}
        self.characters = {c for p in self.scores for c in p}
        if not self.characters <= self.scores.keys():
            raise ValueError("every character of a piece must be a piece")
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.joined = {p[k : k + 2] for p in self.scores for k in range(len(p) - 1)}
        crosses = any(x[0] != _SPACE and x[1] == _SPACE for x in self.joined)
        self.split = re.compile(f"(?s).+" if crosses else f"{_SPACE}*[^{_SPACE}]+|{_SPACE}+").findall
        self.automaton = ahocorasick.Automaton()
        for piece, (_, i) in self.scores.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.words: dict[str, bytes] = {}
        self.joints: dict[tuple[int, int], bool] = {}
        self.most_words, self.most_joints = words, joints

    def merged(self, text: str) -> list[int]:
        """The merges replayed, best score first and leftmost on ties; for short texts."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                found = self.scores.get(parts[k] + parts[k + 1])
                if found is not None and (best is None or found[0] > best):
                    best, at = found[0], k
            if at < 0:
                return [self.scores[p][1] for p in parts]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two pieces stay as they are side by side; ``left`` is -1 at a start."""
        known = self.joints.get((left, right))
        if known is None:
            if len(self.joints) >= self.most_joints:
                self.joints.clear()
            if left < 0:
                known = self.merged(self.pieces[right]) == [right]
            else:
                known = self.merged(self.pieces[left] + self.pieces[right]) == [left, right]
            self.joints[left, right] = known
        return known

    def backtrack(self, text: str) -> list[int]:
        """Pieces of a text of known characters."""
        starts: list[list[tuple[int, int]]] = [[] for _ in range(len(text) + 1)]
        for end, (piece, size) in self.automaton.iter(text):
            starts[end - size + 1].append((piece, size))  # ends ascend, so the longest comes last
        failed = bytearray(len(text) // 8 + 1)
        tokens, choices, at, option = [], [], 0, len(starts[0]) - 1
        while at < len(text):
            before = tokens[-1] if tokens else -1
            options = starts[at]
            while option >= 0:
                piece, size = options[option]
                end = at + size
                if not failed[end >> 3] >> (end & 7) & 1 and self.compatible(before, piece):
                    break
                option -= 1
            if option >= 0:
                tokens.append(piece)
                choices.append(option)
                at += size
                option = len(starts[at]) - 1
            else:
                failed[at >> 3] |= 1 << (at & 7)
                piece, option = tokens.pop(), choices.pop() - 1
                at -= len(self.pieces[piece])
        return tokens

    def _remembered(self, text: str, make) -> bytes:
        ids = self.words.get(text)
        if ids is None:
            ids = make(text)
            if len(text) <= 64:
                if len(self.words) >= self.most_words:
                    self.words.clear()
                self.words[text] = ids
        return ids

    def _part(self, text: str) -> bytes:
        """Ids of characters that may all merge with the next one."""
        if len(text) > 1:
            ids = self.backtrack(text)
        elif text in self.characters:
            ids = [self.scores[text][1]]
        else:
            ids = [self.byte_ids[b] for b in text.encode("utf-8", "surrogatepass")]
        return np.array(ids, "<u4").tobytes()

    def word(self, text: str) -> bytes:
        """Ids of a stretch that no merge leaves, as little-endian 32-bit bytes."""
        cuts = [k for k in range(1, len(text)) if text[k - 1 : k + 1] not in self.joined]
        if not cuts:
            return self._part(text)
        return b"".join(self._remembered(text[a:b], self._part) for a, b in zip([0, *cuts], [*cuts, len(text)]))

    def encode(self, text: str) -> bytes:
        found, known = [], self.words
        for part in self.split(self.model.normalize(text)):
            found.append(known.get(part) or self._remembered(part, self.word))
        ends = np.array([self.model.bos_id(), self.model.eos_id()], "<u4")
        return ends[:1].tobytes() + b"".join(found) + ends[1:].tobytes()

    def decode(self, ids: bytes) -> str:
        return self.model.decode(np.frombuffer(ids, "<u4").tolist())


@lru_cache(maxsize=2)
def encoder(path: str) -> MergeEncoder:
    """Workers keep the encoder from task to task."""
    return MergeEncoder(path)


def encoded(docs: DataFrame, path: str, decode: bool = True) -> DataFrame:
    """``(doc_id, ids, n_tokens, decoded)``: ids as little-endian 32-bit integers in a binary,
    with begin and end ids, and the text that they decode to."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in slices(batches, 64):
            ids = [own.encode(t or "") for t in column(batch, "text")]
            texts = [own.decode(i) if decode else None for i in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("doc_id")),
                    pa.array(ids, pa.binary()),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array(texts, pa.string()),
                ],
                ["doc_id", "ids", "n_tokens", "decoded"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(convert, "doc_id bigint, ids binary, n_tokens bigint, decoded string")
