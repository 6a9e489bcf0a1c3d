"""Alignment of the tokens of two tokenizers: whitespace-token anchors, and windows of token ids aligned once.

Each text is tokenised in full by both. Wherever a token of each that begins with a space starts at one byte, the tokens before
both end there; such shared ends cut the document into windows, most of them a word. What a window's alignment is depends on
its ids alone, so a worker keeps it by the two tuples of ids: its groups, its links and their text.

The windows of a text that are not kept are aligned in one sweep over both sides' ends: two tokens overlap in one stretch of bytes, so
links are the stretches between neighbouring ends of either side, and a group closes where both end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .tokenbin import WordEncoder, byte_characters

#: Windows a worker keeps, twice; longer ones than KEPT_IDS aren't kept. They change no result.
WINDOWS_KEPT, KEPT_IDS = 200_000, 64
#: Distinct pairs of ids sent to all tasks (about 100 bytes each in a hash table), beyond which both sides are shuffled.
SENT_PAIRS = 1_000_000
#: Bits of the second tokenizer's ids in a pair's code.
SHIFT = 32


class Tokens:
    """Ids of whole texts by one tokenizer, strings of special tokens taken as plain text, and what each id stands for.

    ``exact``: the tokens give back every text, so this needs no proof text by text."""

    def __init__(self, encode, table: list[bytes], exact: bool = False):
        self.encode, self.bytes, self.exact = encode, table, exact
        self.lengths = np.array([len(x) for x in table], np.int64)
        self.spaced = np.array([x[:1] == b" " for x in table], bool)


def byte_level(path: str) -> Tokens:
    """A byte-level BPE file of the tokenizers library; a space goes before the text."""
    words = WordEncoder(path)
    words.find_added = lambda text: None
    words.tokenizer.encode_special_tokens = True
    of = {c: i for i, c in enumerate(byte_characters())}
    names = [words.tokenizer.id_to_token(i) or "" for i in range(words.vocab_size)]
    table = [bytes(of[c] for c in x) if all(c in of for c in x) else x.encode() for x in names]
    # With a token for each byte, and its split keeping all characters, merging never loses any.
    return Tokens(lambda text: words(" " + text).astype("<i4"), table, words.by_word and {bytes([i]) for i in range(256)} <= set(table))


def pieces(path: str) -> Tokens:
    """A model of the sentencepiece library, which adds the space itself."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    piece = lambda i: bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
    return Tokens(lambda text: np.array(sp.encode(text), "<i4"), [piece(i) for i in range(sp.get_piece_size())])


#: Ids of the second tokenizer in a window's key, so that it is clear where the first one's end.
SECOND = 1 << 30


class Windows(dict):
    """Alignments of windows by their key, the ids of one side and those of the other as 32-bit numbers: text of the groups, codes of the
    links."""

    def __init__(self, a: Tokens, b: Tokens):
        self.a, self.b, self.old = a, b, {}
        # Each id as text before the next one of its group, before the other side's, and before the next group.
        self.text = [str(i) + sign for i in range(max(len(a.bytes), len(b.bytes))) for sign in ",|;"]
        self.text_lengths = np.array([len(x) for x in self.text], np.int64)

    def of(self, keys: list[bytes]) -> list[tuple[str | None, bytes]]:
        """The alignments of windows in order; those that are not kept are aligned together, each once."""
        found = list(map(self.get, keys))
        if at := [i for i, x in enumerate(found) if x is None]:
            missing = {keys[i] for i in at}
            if len(self) + len(missing) > WINDOWS_KEPT:
                self.old = dict(self)
                self.clear()
            got = {k: self.old[k] for k in missing if k in self.old}
            if new := [k for k in missing if k not in got]:
                got.update(zip(new, self.align(new), strict=True))
            for i in at:
                found[i] = got[keys[i]]
            self.update([(k, x) for k, x in got.items() if len(k) <= 4 * KEPT_IDS])
        return found

    def align(self, keys: list[bytes]) -> list[tuple[str | None, bytes]]:
        """One sweep over the tokens of all windows, of which both sides have the same number of bytes; no text where these are not the same."""
        ids = np.frombuffer(b"".join(keys), "<i4").astype(np.int64)
        sizes = np.array([len(k) >> 2 for k in keys], np.int64)
        second = ids >= SECOND
        a, b = ids[~second], ids[second] - SECOND
        end_a, end_b = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        # A link for each end of either side.
        ends = np.unique(np.concatenate((end_a, end_b)))
        codes = (a[np.searchsorted(end_a, ends)] << SHIFT) + b[np.searchsorted(end_b, ends)]
        closes_a, closes_b = end_b[np.searchsorted(end_b, end_a)] == end_a, end_a[np.searchsorted(end_a, end_b)] == end_b
        # Ids of a group stand behind those of all groups before, the first side's first.
        group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
        last_a, last_b = np.flatnonzero(closes_a) + 1, np.flatnonzero(closes_b) + 1
        words = np.empty(len(ids), np.int64)
        words[np.arange(len(a)) + np.concatenate(([0], last_b))[group_a]] = 3 * a + closes_a
        words[np.arange(len(b)) + last_a[group_b]] = 3 * b + 2 * closes_b
        text = "".join(map(self.text.__getitem__, words.tolist()))
        stops = np.cumsum(sizes)
        cuts = np.cumsum(self.text_lengths[words])[stops - 1].tolist()
        byte_ends = end_a[np.cumsum(np.add.reduceat((~second).astype(np.int64), stops - sizes)) - 1]
        link_cuts = (8 * np.searchsorted(ends, byte_ends, "right")).tolist()
        raw, found, at, link = codes.tobytes(), [], 0, 0
        for cut, link_cut in zip(cuts, link_cuts, strict=True):
            found.append((text[at : cut - 1], raw[link:link_cut]))
            at, link = cut, link_cut
        left, right = b"".join(map(self.a.bytes.__getitem__, a.tolist())), b"".join(map(self.b.bytes.__getitem__, b.tolist()))
        if left != right:
            start = 0
            for i, stop in enumerate(byte_ends.tolist()):
                if left[start:stop] != right[start:stop]:
                    found[i] = None, b""
                start = stop
        return found


class Aligner:
    def __init__(self, a: Tokens, b: Tokens):
        self.a, self.b, self.windows = a, b, Windows(a, b)

    def __call__(self, text: str | None) -> tuple[int, int, int, int, str, np.ndarray, np.ndarray]:
        """n_a, n_b, n_groups, n_links, digest of the groups, distinct codes of links, and how often each stands."""
        none = (0, 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64))
        if not text:
            return none
        a, b = self.a.encode(text), self.b.encode(text)
        size = len(text.encode("utf-8", "surrogatepass")) + 1
        length_a, length_b = self.a.lengths[a], self.b.lengths[b]
        if not len(a) or length_a.sum() != size or length_b.sum() != size:
            return none
        if not self.a.exact and b"".join(map(self.a.bytes.__getitem__, a.tolist())) != b" " + text.encode("utf-8", "surrogatepass"):
            return none
        # Places of tokens with a space in front, and which of them begin where one of the other side does.
        at_a, at_b = np.flatnonzero(self.a.spaced[a]), np.flatnonzero(self.b.spaced[b])
        start_a, start_b = (np.cumsum(length_a) - length_a)[at_a], (np.cumsum(length_b) - length_b)[at_b]
        here_a, here_b = np.zeros(size, bool), np.zeros(size, bool)
        here_a[start_a], here_b[start_b] = True, True
        at_a, at_b = at_a[here_b[start_a]], at_b[here_a[start_b]]
        if not len(at_a) or at_a[0] or at_b[0]:
            at_a, at_b = np.concatenate(([0], at_a[at_a > 0])), np.concatenate(([0], at_b[at_b > 0]))
        cut_a, cut_b, raw_a, raw_b = (4 * np.append(at_a, len(a))).tolist(), (4 * np.append(at_b, len(b))).tolist(), a.tobytes(), (b + SECOND).astype("<i4").tobytes()
        found = self.windows.of([raw_a[i:j] + raw_b[k:n] for i, j, k, n in zip(cut_a, cut_a[1:], cut_b, cut_b[1:], strict=False)])
        groups = [x[0] for x in found]
        # The first side gives back the text, so where each window's bytes are the same the second one does, too.
        if None in groups:
            return none
        codes = np.frombuffer(b"".join([x[1] for x in found]), "<i8")
        # A group of p and q tokens has p + q - 1 links.
        return len(a), len(b), len(a) + len(b) - len(codes), len(codes), hashlib.sha256(";".join(groups).encode()).hexdigest(), *np.unique(codes, return_counts=True)


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(byte_level(a_path), pieces(b_path))
    return _aligners[a_path, b_path]


PAIR = "struct<code:bigint,times:bigint>"


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs`` of every row of ``docs (doc_id, text)``; ``pairs`` holds each
    distinct pair of linked ids with its number of links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(a_path, b_path)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                rows = [align(t.as_py()) for t in part.column(1)]
                numbers = [pa.array([x[i] for x in rows], pa.int64()) for i in range(4)]
                ends = np.concatenate(([0], np.cumsum([len(x[5]) for x in rows]))).astype(np.int32)
                flat = pa.StructArray.from_arrays([pa.array(np.concatenate([x[i] for x in rows]).astype(np.int64)) for i in (5, 6)], ["code", "times"])
                yield pa.RecordBatch.from_arrays([part.column(0), *numbers, pa.array([x[4] for x in rows]), pa.ListArray.from_arrays(pa.array(ends), flat)], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, f"doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<{PAIR}>")


def pair_counts(rows: DataFrame) -> DataFrame:
    """``code, n, best``: links of each pair of ids over all rows, and whether no pair of its second id has more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = b.column(0).flatten()
            codes, place = np.unique(flat.field("code").to_numpy(), return_inverse=True)
            times = np.zeros(len(codes), np.int64)
            np.add.at(times, place, flat.field("times").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(times)], names=["code", "n"])

    counts = stored(rows.select("pairs").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")), "pair-counts")
    second = F.col("code").bitwiseAND(F.lit((1 << SHIFT) - 1))
    most = counts.groupBy(second.alias("b")).agg(F.max("n").alias("most"))
    return counts.join(most, second == F.col("b")).select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def align_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``docs (doc_id, text)``.

    ``a_path`` is a byte-level BPE of the tokenizers library, run over a space and the text, ``b_path`` a sentencepiece model, run over the text. A
    pair's count is the number of links of its ids over all rows; ``n_best`` counts the links of which no other pair of the second
    id has a greater count (ties count), ``count_sum`` sums counts over links. Texts that are null or empty, or that the tokens'
    bytes don't give back, have zeros and an empty digest. Repeated rows and rows with null ids each count and stay; an empty
    table gives none; other columns are ignored. Both files must exist on every executor.
    """
    rows = stored(aligned(docs, a_path, b_path).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = stored(pair_counts(rows), "pair-bests")
    links = rows.select("row", F.explode("pairs").alias("p")).select("row", "p.*")
    sums = links.join(F.broadcast(counts) if counts.count() <= SENT_PAIRS else counts, "code").groupBy("row").agg(F.sum(F.col("times") * F.col("n")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return rows.drop("pairs").join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
