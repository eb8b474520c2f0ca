"""Token counts of a byte-level BPE vocabulary, by the whole-token shortcut.

Offline, every vocabulary string is run through the merges once; those that
come out as a single token are proven whole. A pre-token of a text that is a
whole string counts one token by a set lookup; only the rest are merged, each
distinct one once per task. Counts equal those of the tokenizer itself.

Defined cases: a null or empty text has no tokens; a special string inside a
text is one token, as by the tokenizer's default; a text of any length is
counted whole; rows that repeat are counted alike; extra columns are kept (but
for those named like a result).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame

from quire.llm import text_arrays as ta

#: The pre-token pattern of byte-level BPE tokenizers, with \s
#: written as the Unicode property it stands for.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: Distinct merged pre-tokens that a task remembers before it starts afresh.
REMEMBERED = 500_000


def byte_letters() -> list[str]:
    """The visible character that stands for each byte in vocabulary files:
    printable Latin-1 bytes stand for themselves, the others, in order, for
    the characters from U+0100."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Counter:
    """Counts the tokens of texts for one vocabulary file."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if (model["type"], pre["type"], spec["normalizer"], pre["add_prefix_space"]) != ("BPE", "ByteLevel", None, False):
            raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {(a, b): i for i, (a, b) in enumerate(merges)}
        letters = byte_letters()
        self.letters = {b: c for b, c in enumerate(letters)}
        back = {c: b for b, c in enumerate(letters)}
        self.find = regex.compile(PATTERN).findall
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        # The proof: a vocabulary string is whole if its own merges give one token.
        self.whole = set()
        for token in model["vocab"]:
            try:
                text = bytes(back[c] for c in token).decode("utf-8")
            except (KeyError, UnicodeDecodeError):
                continue   # no text has it as a pre-token
            if self.merged(text) == 1:
                self.whole.add(text)
        self.known = dict.fromkeys(self.whole, 1)

    def merged(self, text: str) -> int:
        """Tokens of one pre-token: merge the pair of lowest rank, leftmost
        first, until no pair has a rank."""
        part = [self.letters[b] for b in text.encode("utf-8")]
        rank, none = self.rank, len(self.rank)
        if len(part) > 64:
            return self._merged_long(part)
        while len(part) > 1:
            ranks = [rank.get(p, none) for p in zip(part, part[1:])]
            best = min(ranks)
            if best == none:
                break
            i, joined, n = 0, [], len(part)
            while i < n:
                if i < n - 1 and ranks[i] == best:
                    joined.append(part[i] + part[i + 1])
                    i += 2
                else:
                    joined.append(part[i])
                    i += 1
            part = joined
        return len(part)

    def _merged_long(self, part: list[str]) -> int:
        """The same by a heap over a linked list, for pre-tokens of any length."""
        import heapq

        rank = self.rank
        n = len(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank[p], i, p) for i, p in enumerate(zip(part, part[1:])) if p in rank]
        heapq.heapify(heap)
        left = n
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i] if part[i] is not None else n
            if part[i] != pair[0] or j >= n or part[j] != pair[1]:
                continue
            part[i], part[j] = part[i] + part[j], None
            left -= 1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (part[a], part[b]) in rank:
                    heapq.heappush(heap, (rank[part[a], part[b]], a, (part[a], part[b])))
        return left

    def _plain(self, text: str) -> int:
        known, found = self.known, self.find(text)
        try:
            return sum(map(known.__getitem__, found))
        except KeyError:
            pass
        for t in {t for t in found if t not in known}:
            known[t] = self.merged(t)
        n = sum(map(known.__getitem__, found))
        if len(known) > REMEMBERED + len(self.whole):
            self.known = dict.fromkeys(self.whole, 1)
        return n

    def count(self, text: str) -> int:
        if self.special is None:
            return self._plain(text)
        pieces = self.special.split(text)
        return len(pieces) - 1 + sum(map(self._plain, pieces))


def count_tokens(docs: DataFrame, vocabulary: str, text_col="text", limit: int = 512) -> DataFrame:
    """All columns of ``docs`` with n_bytes, n_tokens and over_limit.

    ``vocabulary`` is the file's path on the executors.
    """
    names = ("n_bytes", "n_tokens", "over_limit")
    place = docs.columns.index(text_col)
    keep = [i for i, c in enumerate(docs.columns) if c not in names]
    schema = docs.drop(*names).schema.add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        counter = None
        for batch in batches:
            counter = counter or Counter(vocabulary)
            for part in ta.slices(batch, text_col, 2 << 20):
                text = part.column(place)
                n = np.array([counter.count(t) if t else 0 for t in text.to_pylist()], np.int64)
                size = np.diff(ta.raw(text)[1])
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in keep] + [pa.array(size), pa.array(n), pa.array(n > limit)], schema.names)

    return docs.mapInArrow(run, schema)
