"""SentencePiece encoding and decoding: exact merge-type encoding by backtracking.

A sequence of pieces is the encoding of its text exactly if every adjacent pair is compatible, that is, if merging the
pair's own text gives the pair back.  The encoder walks from left to right, takes the longest piece that an Aho-Corasick
automaton found to start at the position, falls back to the next shorter prefix piece if the pair is not compatible, and
steps back when none fits, marking the position as failed in a bitfield.

Text is first cut where no piece can span: before a run of blanks that follows other characters, and around characters
outside the vocabulary.  Runs of several blanks, whose pieces all have one score, are merged by the rule itself.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from shelfstream.llm.ragged import RaggedCache, in_blocks

SPACE = "▁"
SHORT = 32
#: Letters with the blanks before them, or anything else with the blanks before it.
_LETTER = r"(?:(?![\u00b2\u00b3\u00b9\u00bc-\u00be])[^\W\d_])"
SEGMENT = re.compile(f"{SPACE}*{_LETTER}+|{SPACE}*(?:(?!{SPACE}|{_LETTER}).)+|{SPACE}+", re.DOTALL)


def merged(text: str, scores: dict[str, float]) -> list[str]:
    """The text's characters merged by the rule: the best-scored adjacent pair first, the leftmost among equals."""
    import heapq

    parts: list[str | None] = list(text)
    size = len(parts)
    if size <= SHORT:
        while True:
            found = [(-scores[pair], at) for at in range(len(parts) - 1) if (pair := parts[at] + parts[at + 1]) in scores]
            if not found:
                return parts
            at = min(found)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    agenda: list[tuple[float, int, str]] = []

    def offer(left: int) -> None:
        right = after[left]
        if right < size:
            pair = parts[left] + parts[right]
            if pair in scores:
                heapq.heappush(agenda, (-scores[pair], left, pair))

    for left in range(size - 1):
        offer(left)
    while agenda:
        _, left, pair = heapq.heappop(agenda)
        right = after[left] if parts[left] is not None else size
        if right >= size or parts[left] + parts[right] != pair:
            continue
        parts[left], parts[right] = pair, None
        after[left] = after[right]
        if after[left] < size:
            before[after[left]] = left
        if before[left] >= 0:
            offer(before[left])
        offer(left)
    return [p for p in parts if p is not None]


class PieceEncoder:
    def __init__(self, model_path: str):
        import ahocorasick
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_path)
        lib = self.library
        plain = [i for i in range(lib.get_piece_size()) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
        self.id = {lib.id_to_piece(i): i for i in plain}
        self.score = {piece: lib.get_score(i) for piece, i in self.id.items()}
        self.byte = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        odd = [p for p in self.id if SPACE in p.lstrip(SPACE) or (p.startswith(SPACE * 2) and p.strip(SPACE))]
        if odd:
            raise ValueError(f"pieces with inner blanks are not supported: {odd[:3]}")
        self.automaton = ahocorasick.Automaton()
        for piece in self.id:
            self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        self._shorter: dict[str, int] = {}
        self._pairs: dict[tuple[str | None, str], bool] = {}
        self._segments: dict[str, list[int]] = {}
        self._chars = {p for p in self.id if len(p) == 1}
        # Letters never share a piece with other characters: then each such segment is encoded, and remembered, alone.
        self._by_segment = all(SEGMENT.fullmatch(p) for p in self.id)
        self.words = RaggedCache(lambda words: [self.chunk(w) for w in words])

    def shorter(self, piece: str) -> int:
        """Length of the longest piece that is a proper prefix, or zero."""
        known = self._shorter.get(piece)
        if known is None:
            known = self._shorter[piece] = next((n for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.id), 0)
        return known

    def fits(self, left: str | None, piece: str) -> bool:
        """Merging the pair's text gives the pair back; the first piece has to stand for itself."""
        if len(self._pairs) > 500_000:
            self._pairs.clear()
        own = [piece] if left is None else [left, piece]
        known = self._pairs[left, piece] = merged("".join(own), self.score) == own
        return known

    def _known(self, text: str) -> list[int]:
        """Ids of a text whose characters are all pieces and that holds no two blanks in a row."""
        size, pairs = len(text), self._pairs
        longest = [0] * size
        for end, length in self.automaton.iter(text):
            longest[end - length + 1] = length  # ends grow, so the last match from a start is the longest
        failed: bytearray | None = None
        out: list[str] = []
        at, left, length = 0, None, longest[0]
        while at < size:
            while length:
                end = at + length
                piece = text[at:end]
                if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                    fits = pairs.get((left, piece))
                    if fits or fits is None and self.fits(left, piece):
                        break
                length = self.shorter(piece)
            if length:
                out.append(piece)
                at, left = end, piece
                length = longest[at] if at < size else 0
            else:
                failed = failed or bytearray(size // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                last = out.pop()
                at -= len(last)
                left, length = out[-1] if out else None, self.shorter(last)
        return [self.id[p] for p in out]

    def _ids(self, text: str) -> list[int]:
        """Ids of a text with no two blanks in a row; characters outside the vocabulary become bytes."""
        if not self._by_segment:
            return self._segment(text)
        if len(self._segments) > 250_000:
            self._segments.clear()
        ids: list[int] = []
        for segment in SEGMENT.findall(text):
            own = self._segments.get(segment)
            if own is None:
                own = self._segments[segment] = self._segment(segment)
            ids += own
        return ids

    def _segment(self, text: str) -> list[int]:
        if self._chars.issuperset(text):
            return self._known(text)
        ids: list[int] = []
        at = 0
        for k, ch in enumerate(text):
            if ch not in self._chars:
                if at < k:
                    ids += self._known(text[at:k])
                ids += [self.byte[b] for b in ch.encode()]
                at = k + 1
        if at < len(text):
            ids += self._known(text[at:])
        return ids

    def chunk(self, tail: str) -> list[int]:
        """Ids of one blank followed by ``tail``: more blanks, then other characters."""
        word = tail.lstrip(" ")
        blanks = len(tail) - len(word) + 1
        if not word:
            return [self.id[p] for p in merged(SPACE * blanks, self.score)]
        ids = self._ids(SPACE + word)
        if blanks == 1:
            return ids
        # Pieces with other characters outscore those of blanks only, so the word takes its own blank first.
        if ids[0] == self.id[SPACE]:
            return [self.id[p] for p in merged(SPACE * blanks, self.score)] + ids[1:]
        return [self.id[p] for p in merged(SPACE * (blanks - 1), self.score)] + ids

    @staticmethod
    def cut(text: str) -> list[str]:
        """The tails of the text's chunks, the dummy blank in front included."""
        return [m[1:] for m in re.findall(" +[^ ]+| +", " " + text)] if text else []

    def encode_many(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of every text, without begin and end; nulls count as empty."""
        out: list[np.ndarray] = []
        for block in in_blocks(pc.replace_substring(pc.fill_null(texts, ""), SPACE, " ")):
            tails = pc.split_pattern(block, " ")
            runs = pc.match_substring_regex(block, "^$|^ |  | $").to_numpy(zero_copy_only=False)
            if runs.any():
                lists = [self.cut(t) if odd else w for t, w, odd in zip(block.to_pylist(), tails.to_pylist(), runs, strict=True)]
                tails = pa.array(lists, pa.list_(pa.string()))
            out += self.words.encode_lists(tails)
        return out


_encoders: dict[str, PieceEncoder] = {}


def encoder(model_path: str) -> PieceEncoder:
    """One encoder per worker process and model."""
    if model_path not in _encoders:
        _encoders[model_path] = PieceEncoder(model_path)
    return _encoders[model_path]


def encode_pieces(docs: DataFrame, model_path: str, text: str = "text", decode: bool = False) -> DataFrame:
    """``docs`` with a struct ``pieces``: n_tokens, ids (packed little-endian uint32, begin and end included), ids_sha256
    and, with ``decode``, the decoded text.  A null text counts as empty."""

    @F.pandas_udf("n_tokens long, ids binary, ids_sha256 string, decoded string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = encoder(model_path)
        bos, eos = enc.library.bos_id(), enc.library.eos_id()
        for batch in batches:
            rows = []
            for own in enc.encode_many(pa.array(batch, pa.string())):
                ids = np.concatenate(([bos], own, [eos])).astype("<u4")
                packed = ids.tobytes()
                back = enc.library.decode(ids.tolist()) if decode else None
                rows.append((len(ids), packed, hashlib.sha256(packed).hexdigest(), back))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids", "ids_sha256", "decoded"])

    return docs.withColumn("pieces", run(F.col(text)))
