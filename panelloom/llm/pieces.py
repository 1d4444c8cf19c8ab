"""SentencePiece BPE in vectorised merge rounds.

A text gets the dummy prefix and is cut where no piece can cross: before every run of
spaces, and around newlines where no piece holds one. The distinct words of a chunk of
documents are encoded together. Their characters stand in one flat symbol array; every
round looks for the best-ranked pair of each word (a segmented minimum), merges its
occurrences from the left all at once, and compacts the array; words without a pair left
drop out.

The library merges one pair at a time, best score first and leftmost on ties. Merging all
occurrences at once gives the same pieces unless a merge makes a pair that ranks as well
or better; a word where that happens merges only its leftmost occurrence in that round.

The vocabulary comes from a model file of type BPE with identity normalisation. Its
tables have one entry for each way of cutting a piece in two, so their size is bounded by
the vocabulary, and they travel to the tasks with the function.

Null and empty texts have no ids and decode to an empty text; repeated rows are encoded
one by one; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import codecs
import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from panelloom.llm.common import column, per_chunk, sha256_hex, texts

META = "▁"
ENCODE_BYTES = 8 << 20  # larger chunks repeat more words
ROUNDS = 40
NONE = np.int32(2**31 - 1)
UNKNOWN_TEXT = " ⁇ "  # fixed value: how the library shows an unknown id


def _slot(left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
    return (left * 0x9E3779B1 + right * 0x85EBCA77 >> 7) & (size - 1)


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


@dataclass
class Pieces:
    """Tables of one vocabulary. Symbols are piece ids, then characters that only occur inside pieces."""

    size: int
    byte: int  # id of the first of the 256 byte pieces
    raw: list[bytes]  # what each id decodes to
    rank: np.ndarray  # of each piece: 0 is merged first; equal scores share a rank
    chars: np.ndarray  # code point -> symbol, -1 where no piece has the character
    keys: np.ndarray  # open-addressing table: left * 2^32 + right, -1 where empty
    merged: np.ndarray  # of each slot: the piece made

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        text = [model.id_to_piece(i).replace(META, " ") for i in range(n)]
        bytes_ = [i for i in range(n) if model.is_byte(i)]
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        probe = "  a  bﬁ  "
        if (
            len(bytes_) != 256
            or any(model.is_unused(i) for i in plain)
            or any(" " in text[i].lstrip(" ") for i in plain)
            or model.decode(model.encode(probe)) != probe
        ):
            raise ValueError("this needs a BPE model with byte pieces, identity normalisation and no piece across words")
        raw = [b""] * n
        for i in range(n):
            raw[i] = bytes([i - bytes_[0]]) if model.is_byte(i) else UNKNOWN_TEXT.encode() if model.is_unknown(i) else b""
        for i in plain:
            raw[i] = text[i].encode()

        symbol = {text[i]: i for i in plain}
        for i in plain:
            for c in text[i]:
                symbol.setdefault(c, n + len(symbol))
        rank = np.full(n, NONE, dtype=np.int32)
        rank[plain] = np.unique([-model.get_score(i) for i in plain], return_inverse=True)[1]
        pairs = {}
        for i in plain:
            for cut in range(1, len(text[i])):
                left, right = symbol.get(text[i][:cut]), symbol.get(text[i][cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = i
        size = 1 << max(10, (8 * len(pairs)).bit_length())
        keys, merged = np.full(size, -1, dtype=np.int64), np.zeros(size, dtype=np.int32)
        wanted = np.array(list(pairs), dtype=np.int64)
        for key, slot in zip(wanted.tolist(), _slot(wanted >> 32, wanted & 0xFFFFFFFF, size).tolist(), strict=True):
            while keys[slot] != -1:
                slot = (slot + 1) & (size - 1)
            keys[slot], merged[slot] = key, pairs[key]
        chars = np.full(0x110000, -1, dtype=np.int32)
        for c, i in symbol.items():
            if len(c) == 1:
                chars[ord(c)] = i
        return cls(n, bytes_[0], raw, rank, chars, keys, merged)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, -1 where it makes none."""
        left, right = left.astype(np.int64), right.astype(np.int64)
        wanted = left << 32 | right
        slot = _slot(left, right, len(self.keys))
        found = self.keys[slot]
        out = np.where(found == wanted, self.merged[slot], np.int32(-1))
        out[(left < 0) | (right < 0)] = -1
        todo = np.flatnonzero((found != wanted) & (found != -1))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & (len(self.keys) - 1)
            found = self.keys[slot[todo]]
            hit = found == wanted[todo]
            out[todo[hit]] = self.merged[slot[todo[hit]]]
            todo = todo[~hit & (found != -1)]
        return out

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        made = self.pair(left, right)
        return np.where(made >= 0, self.rank[made], NONE)

    def cut(self, texts_: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The words of every text, and each text's first word among them (one entry more than texts)."""
        prefixed = pc.replace_substring(texts_.cast(pa.large_string()), META, " ")
        empty, prefix = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
        prefixed = pc.if_else(pc.equal(prefixed, empty), empty, pc.binary_join_element_wise(prefix, prefixed, empty))
        bounds = np.frombuffer(prefixed.buffers()[1], dtype=np.int64)[prefixed.offset : prefixed.offset + len(prefixed) + 1]
        data = np.frombuffer(prefixed.buffers()[2] or b"", dtype=np.uint8)[: bounds[-1]]
        space = data == 32
        start = space.copy()
        start[1:] &= ~space[:-1]
        if self.chars[10] < 0:
            newline = data == 10
            start |= newline
            start[1:] |= newline[:-1]
        start[bounds[:-1][np.diff(bounds) > 0]] = True
        begins = np.flatnonzero(start)
        words = pa.LargeStringArray.from_buffers(
            len(begins), pa.py_buffer(np.append(begins, bounds[-1])), prefixed.buffers()[2] or pa.py_buffer(b"")
        )
        return words, np.searchsorted(begins, bounds)

    def encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and where each word begins among them."""
        points = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), dtype=np.uint32)
        lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False)
        sym = self.chars[points]
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        origin = np.arange(len(sym), dtype=np.int32)
        rank = np.full(len(sym), NONE, dtype=np.int32)
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner] = self.pair_rank(sym[inner], sym[inner + 1])

        done, rounds = [], 0
        while len(sym):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            if rounds == ROUNDS:
                done.append(self._one_by_one(sym, word, origin, starts))
                break
            rounds += 1
            sizes = np.diff(np.r_[starts, len(sym)])
            best = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            over = best == NONE
            if over.any():
                done.append((sym[over], word[over], origin[over]))
                sym, word, origin, rank, best = (x[~over] for x in (sym, word, origin, rank, best))
                if not len(sym):
                    break
            at = np.flatnonzero(rank == best)
            # Of touching occurrences every second one is merged, beginning with the leftmost.
            runs = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1])
            place = np.arange(len(at)) - np.repeat(runs, np.diff(np.r_[runs, len(at)]))
            sym, word, origin, rank = self._merge(sym, word, origin, rank, at[place % 2 == 0])
        if not done:
            return np.zeros(0, dtype=np.int32), np.zeros(len(words) + 1, dtype=np.int64)
        sym, word, origin = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(origin, kind="stable")
        ids, word = self._spell_out(sym[order], word[order], points[origin[order]])
        return ids, np.searchsorted(word, np.arange(len(words) + 1))

    def _one_by_one(self, sym, word, origin, starts):
        """The rest of some words' merges, best pair first, leftmost on ties."""
        known: dict[tuple[int, int], tuple[int, int]] = {}

        def pair(left: int, right: int) -> tuple[int, int]:
            if (left, right) not in known:
                made = self.pair(np.array([left]), np.array([right]))
                known[left, right] = (int(self.rank[made[0]]), int(made[0])) if made[0] >= 0 else (int(NONE), -1)
            return known[left, right]

        stay = np.zeros(len(sym), dtype=bool)
        out = sym.copy()
        for begin, end in zip(starts.tolist(), [*starts[1:].tolist(), len(sym)], strict=True):
            now = sym[begin:end].tolist()
            n = len(now)
            after, before = list(range(1, n + 1)), list(range(-1, n - 1))
            heap = [(pair(a, b)[0], i, a, b) for i, (a, b) in enumerate(zip(now, now[1:])) if pair(a, b)[1] >= 0]
            heapq.heapify(heap)
            while heap:
                _, i, left, right = heapq.heappop(heap)
                j = after[i]
                if now[i] != left or j >= n or now[j] != right:
                    continue  # one of them is gone
                now[i], now[j] = pair(left, right)[1], -2
                after[i] = after[j]
                if after[i] < n:
                    before[after[i]] = i
                for k in (before[i], i):
                    if k >= 0 and after[k] < n and pair(now[k], now[after[k]])[1] >= 0:
                        heapq.heappush(heap, (pair(now[k], now[after[k]])[0], k, now[k], now[after[k]]))
            out[begin:end] = now
            stay[begin:end] = [s != -2 for s in now]
        return out[stay], word[stay], origin[stay]

    def _merge(self, sym, word, origin, rank, at):
        """One round: merge the pairs that begin at ``at``, which do not overlap."""
        while True:
            made = self.pair(sym[at], sym[at + 1])
            after = sym.copy()
            after[at] = made
            gone = np.zeros(len(sym), dtype=bool)
            gone[at + 1] = True
            # The left neighbour as it is after the round, the right one as it is before it.
            left = np.maximum(at - 1, 0)
            left = np.where(gone[left], left - 1, left)
            right = np.minimum(at + 2, len(sym) - 1)
            left_rank = np.where((at > 0) & (word[left] == word[at]), self.pair_rank(after[left], made), NONE)
            right_rank = np.where((at + 2 < len(sym)) & (word[right] == word[at]), self.pair_rank(made, sym[right]), NONE)
            unsafe = np.minimum(left_rank, right_rank) <= rank[at]
            owner = word[at]
            first = np.r_[True, owner[1:] != owner[:-1]]
            if first.all() or not unsafe.any():
                break
            groups = np.flatnonzero(first)
            alone = np.repeat(np.logical_or.reduceat(unsafe, groups), np.diff(np.r_[groups, len(at)]))
            if first[alone].all():
                break
            at = at[first | ~alone]
        rank = rank.copy()
        rank[at] = right_rank
        inside = (at > 0) & (word[left] == owner)
        rank[left[inside]] = left_rank[inside]  # second, as it is the later one for touching merges
        stay = ~gone
        return after[stay], word[stay], origin[stay], rank[stay]

    def _spell_out(self, sym: np.ndarray, word: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that are no piece become byte pieces."""
        odd = np.flatnonzero((sym < 0) | (sym >= self.size))
        if not len(odd):
            return sym, word
        raw = [chr(p).encode() for p in points[odd].tolist()]
        counts = np.ones(len(sym), dtype=np.int64)
        sizes = counts[odd] = [len(b) for b in raw]
        out = np.repeat(sym, counts)
        begins = np.cumsum(counts)[odd] - sizes
        flat = np.frombuffer(b"".join(raw), dtype=np.uint8).astype(np.int32)
        inside = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[np.repeat(begins, sizes) + inside] = self.byte + flat
        return out, np.repeat(word, counts)

    def encode(self, texts_: pa.Array) -> pa.ListArray:
        """Ids of every text."""
        words, first = self.cut(texts_)
        coded = words.dictionary_encode()
        ids, begins = self.encode_words(coded.dictionary)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        sizes = np.diff(begins)[codes]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(begins[codes] - (ends - sizes), sizes)
        bounds = np.r_[0, ends][first]
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids[at], pa.int32()))

    def decode(self, ids: pa.ListArray) -> list[str]:
        """Each list's pieces joined, meta symbols as spaces, without the dummy prefix."""
        codecs.register_error("each_byte", _each_byte)
        bounds = ids.offsets.to_numpy()
        flat = ids.values
        shown = pa.array(self.raw, pa.large_binary()).take(flat)
        at = np.frombuffer(shown.buffers()[1], dtype=np.int64) if len(shown) else np.zeros(1, dtype=np.int64)
        data = memoryview(shown.buffers()[2] or b"") if len(shown) else b""
        numbers = flat.to_numpy(zero_copy_only=False)
        out = []
        for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            text = str(data[at[begin] : at[end]], "utf-8", "each_byte")
            prefixed = end > begin and text[:1] == " " and not self.byte <= numbers[begin] < self.byte + 256
            out.append(text[1:] if prefixed else text)
        return out


def encode(docs: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids``: the ids of every text."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pieces.encode(column(batch, "text"))], ["doc_id", "ids"]
            )

        return work

    return texts(docs, id_col, text_col).mapInArrow(per_chunk(make, ENCODE_BYTES), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, pieces: Pieces) -> DataFrame:
    """``doc_id``, ``text`` of rows as ``encode`` returns them; null ids are no ids."""

    def run(batches):
        for batch in batches:
            lists = [x or [] for x in column(batch, "ids").to_pylist()]
            decoded = pieces.decode(pa.array(lists, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(decoded, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` of encoding and decoding every text."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = pieces.encode(column(batch, "text"))
            shown = pa.ListArray.from_arrays(ids.offsets, ids.values.cast(pa.string()))
            return pa.RecordBatch.from_arrays(
                [
                    column(batch, "doc_id"),
                    pc.list_value_length(ids).cast(pa.int64()),
                    pa.array([sha256_hex(x) for x in pc.binary_join(shown, ",").cast(pa.binary()).to_pylist()], pa.string()),
                    pa.array([sha256_hex(x.encode()) for x in pieces.decode(ids)], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

        return work

    return texts(docs, id_col, text_col).mapInArrow(
        per_chunk(make, ENCODE_BYTES), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
