"""SentencePiece encoding and decoding by a shared-prefix forward pass.

A text becomes marked words (white space is the mark, and starts a word). Distinct words are sorted, which lists the
trie's paths depth-first; consecutive words share their common prefix's forward states and only the rest is computed.

A unigram model's state at a prefix is its best score and last piece (Viterbi); of paths of one score, as of the same pieces
in another order, the one with the longer piece first counts, where the library goes by rounding of the text's sum. A BPE model's scores are merge ranks,
whose best sum is not what merging gives, so its state at a prefix is the last piece of that prefix's own encoding: a
piece may follow the encoding of what stands before it if the two pieces, merged alone, stay as they are. That is the
same forward pass with another transition, and gives exactly the merged result. Which pieces a prefix ends in is known from
the longest end of it that begins a piece, which is part of its state. Characters outside of the vocabulary
become byte pieces, or the unknown piece where the model has none.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Words (twice), pairs of pieces and steps from an open end a worker keeps. It changes no result.
WORDS_KEPT, PAIRS_KEPT, STEPS_KEPT = 200_000, 200_000, 100_000
UNIGRAM, BPE = 1, 2
#: What any piece may follow: an unknown character (-1) and nothing (-2).
ANY = {-1: True, -2: True}


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a protocol buffer message's fields."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            n = {1: 8, 5: 4}.get(key & 7) or number()
            yield key >> 3, raw[at : at + n]
            at += n


def model_kind(raw: bytes) -> int:
    """A model file's ``model_type`` (field 3 of its trainer specification, field 2): unigram where it is not stated."""
    kind = UNIGRAM
    for field, value in _fields(raw):
        if field == 2 and isinstance(value, bytes):
            kind = next((v for f, v in _fields(value) if f == 3), kind)
    if kind not in (UNIGRAM, BPE):
        raise ValueError("neither a unigram nor a BPE model")
    return kind


class Model:
    """The pieces and flags of a model file, as the sentencepiece library reads it."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        sp, n = self.library, self.library.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.unknown = sp.unk_id()
        special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in special and not sp.is_byte(i)}
        self.scores = [sp.get_score(i) for i in range(n)]
        with open(path, "rb") as f:
            self.kind = model_kind(f.read())
        self.beginnings = {p[:k] for p in self.ids for k in range(len(p) + 1)}
        # By open end, itself at "" and steps by the next character; how many such steps.
        self.states: dict[str, dict] = {"": {"": ""}}
        self.steps = 0
        self.crossing = any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids)
        # By piece: its length, id, id as bytes, what it may follow or not. How many such pairs; how each piece merges.
        self.entries: dict[int, tuple[int, int, bytes, dict[int, bool]]] = {}
        self.pairs = 0
        self.merged: dict[int, tuple[list[str], list[tuple[float, str, str]]]] = {}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.high = np.zeros(n, bool)
        self.high[[i for b, i in self.bytes.items() if b > 127]] = True
        self.texts = ["" if i in special else chr(self.byte_of[i]) if i in self.byte_of else p.replace(MARK, " ") for i, p in enumerate(self.pieces)]
        if self.unknown >= 0:
            self.texts[self.unknown] = " ⁇ "
        self.dummy = sp.normalize("a").startswith(MARK)
        self.words: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}

    def normalize(self, text: str) -> str:
        """The library's normalisation of a text: what its marked words are cut from."""
        return self.library.normalize(text)

    # -- BPE: which pieces may follow each other --

    def merge(self, text: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """Merged symbols of a short string: the best-scoring neighbours first, leftmost of equals.

        With them, in order, each merge's cost (less is earlier) and the first and last symbols after it; before the first one, both characters.
        """
        parts: list[str | None] = list(text)
        left, right = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        heap: list = []
        tail, done = len(parts) - 1, [(0.0, text[:1], text[-1:])]

        def offer(i: int, j: int) -> None:
            if 0 <= i and j < len(parts):
                p = parts[i] + parts[j]
                if p in self.ids:
                    heapq.heappush(heap, (-self.scores[self.ids[p]], i, j, p))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            cost, i, j, p = heapq.heappop(heap)
            if parts[i] is None or parts[j] is None or parts[i] + parts[j] != p or right[i] != j:
                continue
            parts[i], parts[j] = p, None
            right[i] = right[j]
            if right[i] < len(parts):
                left[right[i]] = i
            else:
                tail = i
            done.append((cost, parts[0], parts[tail]))
            offer(left[i], i)
            offer(i, right[i])
        return [p for p in parts if p is not None], done

    def merge_piece(self, i: int) -> tuple[list[str], list[tuple[float, str, str]]]:
        if (found := self.merged.get(i)) is None:
            found = self.merged[i] = self.merge(self.pieces[i])
        return found

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether two pieces, merged alone, stay as they are: no merge across their border comes before the next one within either.

        Until then each merges as it does by itself, the left one first at equal cost, and one across after it but before the right one.
        """
        x, y = self.merge_piece(a)[1], self.merge_piece(b)[1]
        p = q = 0
        while True:
            i = self.ids.get(x[p][2] + y[q][1])
            across = math.inf if i is None else -self.scores[i]
            within_x = x[p + 1][0] if p + 1 < len(x) else math.inf
            within_y = y[q + 1][0] if q + 1 < len(y) else math.inf
            if within_x <= within_y:
                if across < within_x:
                    return False
                if p + 1 == len(x):
                    return True
                p += 1
            else:
                if across <= within_y:
                    return False
                q += 1

    def may_follow(self, a: int, b: int) -> bool:
        if self.pairs >= PAIRS_KEPT:
            for *_, known in self.entries.values():
                known.clear()
                known.update(ANY)
            self.pairs = 0
        self.pairs += 1
        found = self.entries[b][3][a] = self.stay_apart(a, b)
        return found

    # -- the forward pass --

    def _unknown_char(self, c: str) -> bytes:
        raw = c.encode("utf-8", "surrogatepass")
        return array("I", [self.bytes[x] for x in raw] if self.bytes else [self.unknown]).tobytes()

    def step(self, state: dict, c: str) -> tuple[dict, tuple]:
        """After a state and the next character: the state of the longest end that begins a piece, and the pieces it ends in, longest first.

        A BPE piece that merging doesn't give is left out.
        """
        if self.steps >= STEPS_KEPT:
            for end, known in self.states.items():
                known.clear()
                known[""] = end
            self.steps = 0
        self.steps += 1
        read, at = state[""] + c, 0
        while read[at:] not in self.beginnings:
            at += 1
        ends = []
        for k in range(at, len(read)):
            i = self.ids.get(read[k:])
            if i is not None and (self.kind != BPE or len(self.merge_piece(i)[0]) == 1):
                if i not in self.entries:
                    self.entries[i] = (len(read) - k, i, i.to_bytes(4, "little"), dict(ANY))
                ends.append(self.entries[i])
        found = state[c] = self.states.setdefault(read[at:], {"": read[at:]}), tuple(ends)
        return found

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words (32-bit little-endian), sorted so that common prefixes are passed once."""
        out: dict[str, bytes] = {}
        # State at prefix length k: score, last piece (-1: an unknown character, -2: none), its length, its ids as bytes, its open end's.
        longest = max(map(len, words), default=0) + 1
        score, last, size, made, open_at = [0.0] * longest, [-2] * longest, [0] * longest, [b""] * longest, [self.states[""]] * longest
        before = ""
        scores, bpe, worst = self.scores, self.kind == BPE, min(self.scores, default=0.0) - 10.0
        for word in sorted(words):
            end = 0
            for c, d in zip(word, before):  # noqa: B905
                if c != d:
                    break
                end += 1
            at = open_at[end]
            for c in word[end:]:
                end += 1
                at, ends = at.get(c) or self.step(at, c)
                open_at[end] = at
                if bpe:
                    for n, i, ids, follows in ends:
                        a = last[end - n]
                        if (may := follows.get(a)) or may is None and self.may_follow(a, i):
                            last[end], size[end], made[end] = i, n, ids
                            break
                    else:
                        last[end] = -1
                else:
                    last[end], score[end] = -1, score[end - 1] + worst
                    for n, i, ids, _ in ends:
                        if (total := score[end - n] + scores[i]) > score[end] or last[end] < 0 and n == 1:
                            last[end], size[end], made[end], score[end] = i, n, ids, total
                if last[end] < 0:
                    # Neighbouring unknown characters are one piece, where there are no bytes.
                    size[end], made[end] = 1, b"" if last[end - 1] == -1 and not self.bytes else self._unknown_char(c)
            before = word
            found = []
            while end:
                found.append(made[end])
                end -= size[end]
            found.reverse()
            out[word] = b"".join(found)
        return out

    def split(self, normal: str) -> list[str]:
        """Marked words: a mark after another character starts a word, unless the vocabulary has pieces across it."""
        if self.crossing:
            return [normal]
        if MARK + MARK in normal or " " in normal:
            return _WORDS.findall(normal)
        words = normal.replace(MARK, " " + MARK).split(" ")
        return words if words[0] else words[1:]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.split(self.normalize(t)) for t in texts]
        known = [list(map(self.words.get, ws)) for ws in split]
        missing = {w for ws, ids in zip(split, known, strict=True) for w, x in zip(ws, ids, strict=True) if x is None}
        if len(self.words) + len(missing) > WORDS_KEPT:  # the kept words become the older ones, and stay if they are used again
            self.old_words, self.words = self.words, {}
        words, old, fresh = self.words, self.old_words, []
        for w in missing:
            if (ids := old.get(w)) is None:
                fresh.append(w)
            else:
                words[w] = ids
        words.update(self.encode_words(fresh))
        for ws, ids in zip(split, known, strict=True):
            if None in ids:
                ids[:] = [words[w] if x is None else x for w, x in zip(ws, ids, strict=True)]
        return [np.frombuffer(b"".join(ids), "<u4") for ids in known]

    def decode(self, ids: np.ndarray) -> str:
        """Pieces joined, byte pieces as UTF-8 (a malformed byte becomes U+FFFD), marks as spaces without the first."""
        if not self.high[ids].any():
            text = "".join(map(self.texts.__getitem__, ids.tolist()))
        else:
            out, raw = [], bytearray()
            for i in ids.tolist():
                if i in self.byte_of:
                    raw.append(self.byte_of[i])
                    continue
                if raw:
                    out.append(raw.decode("utf-8", "replace"))
                    raw.clear()
                out.append(self.texts[i])
            text = "".join(out) + raw.decode("utf-8", "replace")
        return text[1:] if self.dummy and text.startswith(" ") else text


_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+$|{MARK}+")
_models: dict[str, Model] = {}


def model(path: str) -> Model:
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def _batches(b: pa.RecordBatch, most: int = 1 << 21) -> Iterator[tuple[int, list[str]]]:
    """Rows of a batch in runs of a bounded number of characters (or one text)."""
    at, run, held = 0, [], 0
    for k, t in enumerate(b.column(1)):
        text = t.as_py() or ""
        if run and held + len(text) > most:
            yield at, run
            at, run, held = k, [], 0
        run.append(text)
        held += len(text)
    if run:
        yield at, run


def encode(docs: DataFrame, model_path: str, digest: bool = False) -> DataFrame:
    """``doc_id, n_pieces, ids_crc32, round_trip`` for every row, and ``ids array<int>`` unless ``digest`` is set.

    Null texts are empty and have no ids; repeated rows and rows with a null id are encoded each; an empty table gives none;
    other columns are ignored. ``round_trip``: the ids decode to the text. ``ids_crc32`` is the unsigned crc32
    of the ids as little-endian 32-bit integers. ``model_path`` must exist on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(model_path)
        for b in batches:
            for at, texts in _batches(b):
                ids = m.encode(texts)
                columns = {
                    "doc_id": b.column(0).slice(at, len(texts)), "n_pieces": pa.array([len(x) for x in ids], pa.int64()), "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                    "round_trip": pa.array([m.decode(x) == t for x, t in zip(ids, texts, strict=True)]),
                }
                if not digest:
                    columns["ids"] = pa.array(ids, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, n_pieces long, ids_crc32 long, round_trip boolean" + ("" if digest else ", ids array<int>")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, text`` of every row with ``doc_id, ids``; null ids give a null text, no ids the empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(model_path)
        for b in batches:
            texts = [None if x.as_py() is None else m.decode(np.array(x.as_py(), "<u4")) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(run, "doc_id long, text string")
