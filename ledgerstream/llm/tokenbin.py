"""Token-id files: fixed-width bit packing with block offsets for vectorised unpacking and random access.

File format. A file is a sequence of blocks, each followed by one newline byte. A block holds the ids of some
consecutive documents, every id in ``bits`` bits, least significant bit first, without gaps between ids::

    magic 'LSTB' | version u8 | bits u8 | reserved u16 | n_docs u32 | n_ids u64
    doc_id      i64[n_docs]
    is_null     u8[n_docs]          1 where the document id is null
    first id    u64[n_docs + 1]     offset of each document's first id in the block, and the end
    packed ids  u8[ceil(n_ids * bits / 8)]

Id ``i`` of a block starts at bit ``i * bits``, so any slice is unpacked without reading what precedes it. Files
sort by their part and roll numbers; documents ascend by id (null first, repeated ids in order of their texts).
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEAD = struct.Struct("<4sBBHIQ")
MAGIC = b"LSTB"
IDS_PER_BLOCK, DOCS_PER_BLOCK, BLOCKS_PER_FILE = 1 << 20, 2048, 16
#: Words whose ids a worker keeps, twice. It changes no result.
WORDS_KEPT = 500_000


def bits_for(vocab_size: int) -> int:
    return max(1, int(vocab_size - 1).bit_length())


def pack_ids(ids: np.ndarray, bits: int) -> bytes:
    """Ids (unsigned 32 bits) in ``bits`` bits each, least significant bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    out = []
    shifts = np.arange(bits, dtype=np.uint32)
    for i in range(0, len(ids), 1 << 16):  # a multiple of 8, so each piece ends on a byte
        out.append(np.packbits(((ids[i : i + (1 << 16), None] >> shifts) & 1).astype(np.uint8).ravel(), bitorder="little").tobytes())
    return b"".join(out)


def unpack_ids(data: bytes | memoryview, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start:stop`` of a packed run; reads only the bytes that hold them."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", stop - start, start * bits // 8).astype(np.uint32)
    weights = np.uint32(1) << np.arange(bits, dtype=np.uint32)
    out = [np.empty(0, np.uint32)]
    for i in range(start, stop, 1 << 16):
        j = min(stop, i + (1 << 16))
        lo, hi = i * bits // 8, -(-j * bits // 8)
        flat = np.unpackbits(np.frombuffer(data, np.uint8, hi - lo, lo), bitorder="little")[i * bits - lo * 8 :][: (j - i) * bits]
        out.append(flat.reshape(-1, bits).astype(np.uint32) @ weights)
    return np.concatenate(out)


def pack_block(doc_ids: list[int | None], ids: list[np.ndarray], bits: int) -> bytes:
    offsets = np.zeros(len(ids) + 1, "<u8")
    np.cumsum([len(x) for x in ids], out=offsets[1:])
    return b"".join((
        HEAD.pack(MAGIC, 1, bits, 0, len(ids), int(offsets[-1])),
        np.array([x or 0 for x in doc_ids], "<i8").tobytes(), bytes(x is None for x in doc_ids), offsets.tobytes(),
        pack_ids(np.concatenate(ids) if ids else np.empty(0, np.uint32), bits),
    ))


class Block:
    """One block inside ``data`` at ``at``: ``ids(k)`` gives document ``k``'s ids."""

    def __init__(self, data: bytes | memoryview, at: int = 0):
        magic, _, self.bits, _, self.n_docs, self.n_ids = HEAD.unpack_from(data, at)
        if magic != MAGIC:
            raise ValueError(f"no block at byte {at}")
        at += HEAD.size
        self.doc_ids = np.frombuffer(data, "<i8", self.n_docs, at)
        self.is_null = np.frombuffer(data, np.uint8, self.n_docs, at + 8 * self.n_docs)
        self.offsets = np.frombuffer(data, "<u8", self.n_docs + 1, at + 9 * self.n_docs).astype(np.int64)
        at += 17 * self.n_docs + 8
        self.end = at + -(-self.n_ids * self.bits // 8) + 1
        self.packed = memoryview(data)[at : self.end - 1]

    def ids(self, k: int) -> np.ndarray:
        return unpack_ids(self.packed, self.bits, int(self.offsets[k]), int(self.offsets[k + 1]))


# The split of the byte-level pre-tokenizer: contractions, letters, numbers, other signs, white space. Latin-1 texts
# have its letters and numbers spelled out, which the standard library's matcher reads several times as fast.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_L, _N, _S = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
LATIN_SPLIT = f" ?[{_L}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable Latin-1 ones for themselves, the others from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Words(dict):
    """Ids of pre-tokens by the library's own model, kept while they are in use: two generations of WORDS_KEPT."""

    def __init__(self, model, kind: str):
        self.tokenize, self.kind, self.old = model.tokenize, kind, {}
        self.chars = byte_characters()

    def __missing__(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            chars = self.chars
            found = np.array([t.id for t in self.tokenize("".join([chars[b] for b in word.encode("utf-8", "surrogatepass")]))], self.kind).tobytes()
        if len(self) >= WORDS_KEPT:
            self.old = dict(self)
            self.clear()
        self[word] = found
        return found


class WordEncoder:
    """Encodes whole texts with a byte-level BPE of the tokenizers library, one pre-token at a time.

    Its merges never cross the pre-tokens of its split pattern, so a text's ids are its pre-tokens' ids in order; the
    library's model encodes each pre-token that is not kept. Texts that hold the string of an added token, and all texts of
    a tokenizer of another build, are encoded whole by the library, which gives such strings their own id.
    """

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.by_word = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec.get("normalizer") and spec["model"]["type"] == "BPE" and all(t.get("special") for t in spec.get("added_tokens", ()))
        added = [re.escape(t["content"]) for t in spec.get("added_tokens", ())]
        self.find_added = re.compile("|".join(added)).search if added else lambda text: None
        self.vocab_size = self.tokenizer.get_vocab_size()
        self.kind = "<u2" if self.vocab_size <= 1 << 16 else "<u4"
        self.find_latin, self.find_any = re.compile(LATIN_SPLIT).findall, regex.compile(SPLIT).findall
        self.known = Words(self.tokenizer.model, self.kind)

    def __call__(self, text: str) -> np.ndarray:
        if not self.by_word or self.find_added(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return np.frombuffer(b"".join(map(self.known.__getitem__, self.find(text))), self.kind)

    def find(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.find_any(text)
        return self.find_latin(text)


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int | None = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text and write the ids, in ascending document order, as token files under ``path``.

    Null texts count as empty; an empty text has the end id only. The files are written by Spark's own writer,
    so ``path`` may be in any store and a lost task is run again. ``tokenizer_path`` must exist on every executor.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        bits = bits_for(enc.vocab_size)
        end = np.array([] if end_id is None else [end_id], np.uint32)
        doc_ids: list = []
        ids: list = []
        held = 0
        emit = lambda: pa.RecordBatch.from_arrays([pa.array([pack_block(doc_ids, ids, bits)], pa.binary())], ["block"])
        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                x = np.concatenate([enc(t.as_py() or "").astype(np.uint32), end])
                doc_ids.append(d)
                ids.append(x)
                held += len(x)
                if held >= IDS_PER_BLOCK or len(ids) >= DOCS_PER_BLOCK:
                    yield emit()
                    doc_ids, ids, held = [], [], 0
        if ids:
            yield emit()

    rows = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).cast("string").alias("t"))
    packed = rows.repartitionByRange("d").sortWithinPartitions("d", "t").mapInArrow(blocks, "block binary")
    # The text writer puts a string's bytes as they are, and one newline after each.
    packed.select(F.col("block").cast("string")).write.option("lineSep", "\n").option("maxRecordsPerFile", BLOCKS_PER_FILE).text(path)


def read_token_files(spark: SparkSession, path: str, per_doc=None, schema: str = "ids_crc32 long") -> DataFrame:
    """One row per document: ``part, roll, pos, doc_id, start, n_tokens`` and what ``per_doc(ids)`` returns.

    ``start`` counts the ids of all documents before it, over all files. ``per_doc`` gets a document's ids as a
    numpy array and returns a tuple of ``schema``'s columns; the default is the unsigned crc32 of the ids as
    little-endian 32-bit integers. An empty folder gives no rows.
    """
    from .common import stored

    per_doc = per_doc or (lambda ids: (zlib.crc32(ids.astype("<u4").tobytes()),))
    names = [x.split()[0] for x in schema.split(",")]

    def docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, roll, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                data = memoryview(data.as_buffer())
                at = start = pos = 0
                while at < len(data):
                    block = Block(data, at)
                    n = block.n_docs
                    more = [per_doc(block.ids(k)) for k in range(n)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([part] * n, pa.int64()), pa.array([roll] * n, pa.int64()), pa.array(range(pos, pos + n), pa.int64()),
                        pa.array(block.doc_ids, pa.int64(), mask=block.is_null.astype(bool)), pa.array(block.offsets[:-1] + start, pa.int64()), pa.array(np.diff(block.offsets), pa.int64()),
                        *(pa.array([x[k] for x in more]) for k in range(len(names))),
                    ], names=["part", "roll", "pos", "doc_id", "at", "n_tokens", *names])
                    at, start, pos = block.end, start + block.n_ids, pos + n

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    number = lambda p: F.regexp_extract(F.element_at(F.split("path", "/"), -1), p, 1).cast("long")
    rows = files.select(number(r"^part-(\d+)").alias("part"), F.coalesce(number(r"-c(\d+)"), F.lit(0).cast("long")).alias("roll"), "content").mapInArrow(docs, "part long, roll long, pos long, doc_id long, at long, n_tokens long, " + schema)
    rows = stored(rows, "tokens-read")
    # One row a file (tens of MB of ids) is ordered in one window: its input is the number of files, not of documents.
    totals = rows.groupBy("part", "roll").agg(F.sum("n_tokens").alias("n"))
    firsts = totals.selectExpr("part", "roll", "coalesce(sum(n) over (order by part, roll rows between unbounded preceding and 1 preceding), 0) as first")
    return rows.join(firsts, ["part", "roll"]).select("part", "roll", "pos", "doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", *names)


def token_spans(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Write ``docs (doc_id, text)`` as token files in the shared folder, read them back: doc_id, start, n_tokens, ids_crc32.

    Null and empty texts have the end id only; repeated rows stay, rows of one id in order of their texts, null ids first; an empty
    table gives none; columns of other names, whatever they are, are ignored.
    """
    from .common import scratch_path

    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_token_files(docs, path, tokenizer_path, end_id)
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")
