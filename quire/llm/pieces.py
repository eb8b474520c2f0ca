"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the
pieces drives a single-pass Viterbi.

The automaton reads a text once. At each position the pieces that end there
(its state and the output links from it) relax the best score: best[end] =
max(best[start] + score). A character that no piece covers falls back to its
UTF-8 byte pieces. Ties go to the longer last piece. The segmentation is the
one of largest total score of the model's piece scores; for a model of type
BPE that need not be the order of merges of the library's encoder.

No piece of a model may hold the space mark behind another character (checked
when it is loaded), so the best path never crosses the start of a word, and
the words of a text are segmented alone, each distinct one once per task.

Defined cases: a null or empty text has no pieces and decodes to the empty
text; rows that repeat are encoded alike; texts of any length are encoded
whole; extra columns are kept (but for those named like a result).
"""

from __future__ import annotations

import operator
import re
from array import array
from functools import reduce
from struct import pack

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quire.llm import text_arrays as ta
from quire.llm.common import lean

MARK = "▁"
REMEMBERED = 240_000
#: What a byte piece costs below the lowest score of the normal pieces.
FALLBACK = 10.0


class Known(dict):
    """Words with what ``make`` gives for them. It keeps ``most`` words at most, in two
    halves: when the newer one is full, it replaces the older one, and a word found
    there is new again. So words that come often stay, however many others there are."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.half, self.older = make, max(1, most // 2), {}

    def __missing__(self, word: str):
        got = self.older.get(word)
        if got is None:
            got = self.make(word)
        if len(word) <= 64:
            if len(self) >= self.half:
                self.older = dict(self)
                self.clear()
            self[word] = got
        return got


class Pieces:
    """Encoder and decoder for one model file."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.piece = [model.id_to_piece(i) for i in range(n)]
        self.byte = {int(self.piece[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.unknown = model.unk_id()
        self.spelled = [b"" if model.is_control(i) else self.piece[i].replace(MARK, " ").encode("utf-8")
                        for i in range(n)]
        for b, i in self.byte.items():
            self.spelled[i] = bytes([b])
        normal = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)
                                              or model.is_unused(i))]
        self.low = min(model.get_score(i) for i in normal if model.get_score(i) > -1e8) - FALLBACK
        self.automaton = ahocorasick.Automaton()
        for i in normal:
            self.automaton.add_word(self.piece[i], (len(self.piece[i]), model.get_score(i), i))
        self.automaton.make_automaton()
        if any(re.search(f"[^{MARK}]{MARK}", self.piece[i]) for i in normal):
            raise ValueError("a piece crosses the start of a word")
        # line ends are cut off too, where no piece has them
        alone = "" if any("\n" in self.piece[i] for i in normal) else "\n"
        self.words = re.compile(f"{MARK}*[^{MARK}{alone}]+|{MARK}+" + (r"|\n" if alone else "")).findall
        self.known = Known(self.segmented, REMEMBERED)
        self.spelled_size = np.array([len(b) for b in self.spelled], np.int64)
        self.spelled_at = np.cumsum(self.spelled_size) - self.spelled_size
        self.spelled_bytes = np.frombuffer(b"".join(self.spelled), np.uint8)
        self.fallback = np.isin(np.arange(n), [*self.byte.values(), self.unknown])

    def viterbi(self, text: str) -> tuple[list[int], float, int]:
        """(ids, score, byte pieces) of one word."""
        n, low = len(text), self.low
        worst = float("-inf")
        best, sizes, pieces = [worst] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        done = 0        # positions up to here have their final score
        for end, (size, score, i) in self.automaton.iter(text):
            while done < end:
                done += 1
                if best[done] == worst:   # no piece ends here: bytes of one character
                    best[done] = best[done - 1] + low * len(text[done - 1].encode("utf-8", "replace"))
            s = best[end + 1 - size] + score
            end += 1
            if s > best[end] or s == best[end] and 0 < sizes[end] < size:
                best[end], sizes[end], pieces[end] = s, size, i
        while done < n:
            done += 1
            if best[done] == worst:
                best[done] = best[done - 1] + low * len(text[done - 1].encode("utf-8", "replace"))
        ids, at, n_bytes = [], n, 0
        while at:
            if sizes[at]:
                ids.append(pieces[at])
                at -= sizes[at]
            else:
                at -= 1
                own = [self.byte.get(b, self.unknown) for b in text[at].encode("utf-8", "replace")]
                ids.extend(reversed(own))
                n_bytes += len(own)
        return ids[::-1], best[n], n_bytes

    def segmented(self, word: str) -> bytes:
        """Score, as a 64-bit float, and ids, as 32-bit numbers, of one word: as one
        object, a remembered word takes some 80 bytes less."""
        ids, score, _ = self.viterbi(word)
        return pack("=d", score) + array("i", ids).tobytes()

    def encode_packed(self, text: str) -> tuple[bytes, float]:
        """(ids as 32-bit numbers, score)."""
        if not text:
            return b"", 0.0
        found = list(map(self.known.__getitem__, self.words(MARK + text.replace(" ", MARK))))
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        both, at = np.frombuffer(b"".join(found), np.int32), np.cumsum(size) - size
        score = np.stack([both[at], both[at + 1]], 1).view(np.float64)
        ids = np.ones(len(both), bool)
        ids[at] = ids[at + 1] = False
        # word by word; sum() rounds otherwise
        return both[ids].tobytes(), reduce(operator.add, score.ravel().tolist(), 0.0)

    def encode(self, text: str) -> tuple[list[int], float, int]:
        """(ids, score, byte pieces)."""
        packed, score = self.encode_packed(text)
        ids = np.frombuffer(packed, np.int32)
        return ids.tolist(), score, int(self.fallback[ids].sum())

    def spell(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes that the pieces spell, where those of each piece begin; one more than pieces)."""
        size = self.spelled_size[ids]
        cut = np.append(0, np.cumsum(size))
        return self.spelled_bytes[np.arange(cut[-1]) + np.repeat(self.spelled_at[ids] - cut[:-1], size)], cut

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def encode(docs: DataFrame, model: str, text_col="text") -> DataFrame:
    """All columns of ``docs`` with ids, n_pieces, n_byte_pieces, score, and
    round_trip: whether the ids decode to the text (a text that holds the
    space mark itself decodes with spaces in its place)."""
    names = ("ids", "n_pieces", "n_byte_pieces", "score", "round_trip")
    place = docs.columns.index(text_col)
    keep = [i for i, c in enumerate(docs.columns) if c not in names]
    schema = (docs.drop(*names).schema.add("ids", T.ArrayType(T.IntegerType())).add("n_pieces", "long")
              .add("n_byte_pieces", "long").add("score", "double").add("round_trip", "boolean"))

    def run(batches):
        import pyarrow as pa

        coder = None
        for batch in batches:
            coder = coder or Pieces(model)
            for part in ta.slices(batch, text_col, ta.FEW_BYTES):
                texts = [text or "" for text in part.column(place).to_pylist()]
                packed, score = zip(*map(coder.encode_packed, texts))
                cut = np.append(0, np.cumsum([len(p) // 4 for p in packed]))
                ids = np.frombuffer(b"".join(packed), np.int32)
                n_bytes = np.diff(np.append(0, np.cumsum(coder.fallback[ids]))[cut])
                said, at = coder.spell(ids)
                said, at = said.tobytes(), at[cut]
                same = []
                for text, i, j, a, b in zip(texts, cut, cut[1:], at, at[1:]):
                    text = text.replace(MARK, " ")
                    # what is spelled begins with the space that encoding puts before a text
                    same.append(said[a + 1 if a < b and said[a] == 32 else a:b] == text.encode("utf-8")
                                or coder.decode(ids[i:j].tolist()) == text)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keep]
                    + [pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(ids)), pa.array(np.diff(cut)),
                       pa.array(n_bytes, pa.int64()), pa.array(score, pa.float64()), pa.array(same, pa.bool_())],
                    schema.names)

    return docs.mapInArrow(lean(run), schema)


def decode(rows: DataFrame, model: str, ids_col="ids", as_column="text") -> DataFrame:
    """``rows`` with the text of their ids; null ids give a null text."""
    place = rows.columns.index(ids_col)
    keep = [i for i, c in enumerate(rows.columns) if c != as_column]
    schema = rows.drop(as_column).schema.add(as_column, "string")

    def run(batches):
        import pyarrow as pa

        coder = None
        for batch in batches:
            coder = coder or Pieces(model)
            text = [None if i is None else coder.decode(i) for i in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(text, pa.string())], schema.names)

    return rows.mapInArrow(run, schema)
