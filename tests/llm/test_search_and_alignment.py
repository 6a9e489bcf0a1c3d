"""Ranked search, token alignment and near vectors against brute force: nulls, ties, repeats, empty tables, other columns."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("ledgerstream.llm")
from ledgerstream.llm import alignment, ranked, vectors  # noqa: E402
from ledgerstream.llm.queries import tokenizer_file  # noqa: E402

rng = random.Random(11)
WORDS = ["".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(1, 7))) for _ in range(120)]
text = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
LONG = text(20_000)
T = [None, "", " \n ", "one", "Two WORDS two", LONG, text(300), "日本語 ñandú 😀 É x", "a-b_c\x00d'e " + text(5), "1 22 333 " + text(9), "x" * 900]
T += [T[6], text(40), text(40) + " " + T[4], T[4], T[4].lower()] + [text(rng.randint(1, 60)) for _ in range(150)]
DOCS = [(i, t) for i, t in enumerate(T)] + [(None, T[6]), (None, T[4]), (6, T[6])]
ITEMS = [(1, "two words"), (2, T[6]), (3, None), (4, "zzz unknown"), (5, text(6)), (5, text(3)), (5, "Two two"), (5, "Two two"), (None, "ñandú x"), (7, "É"), (8, LONG)]


@pytest.fixture(scope="module")
def docs(spark):
    names = "doc_id long, text string, n long, m long, item string, terms string, row long, pairs string, code long"
    return spark.createDataFrame([(d, t, 1, 2, "x", "y", 3, "z", 4) for d, t in DOCS], names).repartition(3)


def best_of(docs, items, k=10):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda x: x[0].lower(), t or ""))
    counts = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, length = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, t in set(items):
        found = []
        for d, c in counts:
            m = 10 + (90 * sum(c.values()) * n_docs) // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((10**9 * c[x]) // (1000 * c[x] + 8 * m)) for x in set(terms(t)) if x in c)
            found.append((-score, d is None, d or 0))
        out += [(item, i + 1, None if null else d, -s) for i, (s, null, d) in enumerate(sorted(f for f in found if f[0])[:k])]
    return sorted(out, key=repr)


def test_ranked_search(spark, docs, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = best_of(DOCS, ITEMS)
    assert sorted((tuple(r) for r in ranked.search(docs, items).collect()), key=repr) == want
    monkeypatch.setattr(ranked, "ITEM_CHARS", 60_000)
    monkeypatch.setattr(ranked, "FIRST", 1)
    monkeypatch.setattr(ranked, "SENT_VISITS", 0)
    assert sorted((tuple(r) for r in ranked.search(docs, items).collect()), key=repr) == want
    assert sorted((tuple(r) for r in ranked.search(docs, items, 2).collect()), key=repr) == best_of(DOCS, ITEMS, 2)


def test_ranked_search_of_empty_tables(spark, docs):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranked.search(none, items).count() == 0
    assert ranked.search(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert ranked.search(docs.where("doc_id in (0, 1, 2)"), items).count() == 0


def test_strata_below_the_threshold_are_not_visited(spark, monkeypatch):
    # One short document that holds the item; long ones hold one word of it each.
    rows = [(0, "alpha beta gamma")] + [(i, "alpha " + text(50 + i)) for i in range(1, 60)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    query = ranked.Query([(1, "alpha beta gamma")])
    held = ranked.postings(d, query)
    query.weights[:] = [1, 4000, 4000]
    index = held.selectExpr("n as m", "doc_id", "terms", "tfs")
    bounds = {r.m: r.bound for r in ranked.stratum_bounds(index, query).collect()}
    top = max(bounds, key=bounds.get)
    assert top == 3 and sorted(bounds.values())[-2] < bounds[3]
    seen = []
    score = ranked.Segment.scores
    monkeypatch.setattr(ranked.Segment, "scores", lambda self, terms: seen.append(1) or score(self, terms))
    # In this process: a batch of all strata, visited with the best score as the least one.
    import pyarrow as pa

    batch = pa.RecordBatch.from_pandas(index.toPandas(), schema=pa.schema([("m", pa.int64()), ("doc_id", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))]))
    for _, _, segment in ranked._segments(batch, query.weights):
        if segment.bounds(query)[0] >= bounds[3]:
            segment.scores(query.of[0])
    assert len(seen) == 1


def aligned_by_bytes(a, b, a_bytes, b_bytes):
    """Groups and links by comparing byte ranges of every two tokens."""
    spans = lambda ids, of: [(sum(len(of[x]) for x in ids[:i]), sum(len(of[x]) for x in ids[: i + 1])) for i in range(len(ids))]
    sa, sb = spans(a, a_bytes), spans(b, b_bytes)
    links = [(x, y) for x, (s, e) in zip(a, sa, strict=True) for y, (t, f) in zip(b, sb, strict=True) if s < f and t < e]
    groups, i, j = [], 0, 0
    for end in sorted({e for _, e in sa} & {e for _, e in sb}):
        x, y = sum(e <= end for _, e in sa), sum(e <= end for _, e in sb)
        groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
        i, j = x, y
    return groups, links


def test_token_alignment(spark, docs):
    import sentencepiece
    from tokenizers import Tokenizer

    a_path, b_path = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    t = Tokenizer.from_file(a_path)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=b_path)
    from ledgerstream.llm.tokenbin import byte_characters

    back = {c: i for i, c in enumerate(byte_characters())}
    special = [(900, "x <|endoftext|> y <s></s><unk> z"), (901, "a▁b ▁ c"), (902, "  two  spaces\n\n\tand\r\nlines  "), (903, "é" * 40 + "x y"), (904, " lead"), (905, "a" * 300 + " 你好 世界")]
    rows = [(d, t if t is None or len(t) < 5000 else t[:400]) for d, t in DOCS] + special
    want, counts = [], Counter()
    for d, x in rows:
        a, b = (t.encode(" " + x, add_special_tokens=False).ids, sp.encode(x)) if x else ([], [])
        of_a = {i: bytes(back[c] for c in t.id_to_token(i)) for i in a}
        of_b = {i: bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b}
        whole = (" " + (x or "")).encode()
        if not x or b"".join(of_a[i] for i in a) != whole or b"".join(of_b[i] for i in b) != whole:
            want.append((d, 0, 0, [], []))
            continue
        groups, links = aligned_by_bytes(a, b, of_a, of_b)
        counts.update(links)
        want.append((d, len(a), len(b), groups, links))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    want = sorted(((d, n_a, n_b, len(g), len(x), sum(counts[p] == best[p[1]] for p in x), sum(counts[p] for p in x), hashlib.sha256(";".join(g).encode()).hexdigest() if n_a else "") for d, n_a, n_b, g, x in want), key=repr)
    assert sum(w[1] == 0 for w in want) == 3 and any(w[0] == 900 and w[1] > 10 for w in want)
    given = spark.createDataFrame([(d, x, 1, "p", 2, 3) for d, x in rows], "doc_id long, text string, row long, pairs string, code long, n long").repartition(3)
    assert sorted((tuple(r) for r in alignment.align_documents(given, a_path, b_path).collect()), key=repr) == want
    assert alignment.align_documents(docs.where("false"), a_path, b_path).count() == 0


def test_token_alignment_by_shuffle_and_windows(spark, docs, monkeypatch):
    paths = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    want = sorted((tuple(r) for r in alignment.align_documents(docs, *paths).collect()), key=repr)
    monkeypatch.setattr(alignment, "SENT_PAIRS", 0)
    assert sorted((tuple(r) for r in alignment.align_documents(docs, *paths).collect()), key=repr) == want
    # Windows are words, and a repeated one is aligned once.
    align = alignment.Aligner(alignment.byte_level(paths[0]), alignment.pieces(paths[1]))
    made = []
    one = align.windows.align
    monkeypatch.setattr(align.windows, "align", lambda key: made.append(1) or one(key))
    align(" ".join(["walking", "talking", "about"] * 50))
    assert len(made) <= 4


def test_windows_of_a_text_are_aligned_together(monkeypatch):
    """One sweep for all windows of a text that are not kept, also where few are kept, and no text for windows of other bytes."""
    paths = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    align = alignment.Aligner(alignment.byte_level(paths[0]), alignment.pieces(paths[1]))
    texts = [" ".join(f"{w}{i}zqx" for w in ("walking", "unkept", "é" * 3) for i in range(n)) for n in (40, 60, 50)] + ["b" * 900 + " a b"]
    want = []
    for x in texts:
        a, b = align.a.encode(x).tolist(), align.b.encode(x).tolist()
        groups, links = aligned_by_bytes(a, b, align.a.bytes, align.b.bytes)
        want.append((len(a), len(b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    made = []
    one = align.windows.align
    monkeypatch.setattr(align.windows, "align", lambda keys: made.append(1) or one(keys))
    monkeypatch.setattr(alignment, "WINDOWS_KEPT", 100)
    assert [align(x)[:5] for x in texts] == want and len(made) <= len(texts)
    ids = {x: i for i, x in enumerate(align.b.bytes)}
    key = lambda x, y: np.array([align.a.bytes.index(x), ids[y] + alignment.SECOND], "<i4").tobytes()
    found = one([key(b"a", b"a"), key(b"a", b"b"), key(b"b", b"b")])
    assert [x[0] is None for x in found] == [False, True, False]


def linked(rows, cosine=0.9):
    ok = [v is not None and None not in v and len(v) > 0 and np.isfinite(v).all() and np.any(np.array(v) != 0) for _, v in rows]
    n = len(rows)
    link = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and ok[i] and ok[j] and len(rows[i][1]) == len(rows[j][1]):
                x, y = np.array(rows[i][1], float), np.array(rows[j][1], float)
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                link[i, j] = x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= cosine
    of = list(range(n))
    for _ in range(n):
        new = [min([of[i], *(of[j] for j in np.flatnonzero(link[i]))]) for i in range(n)]
        if new == of:
            break
        of = new
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if of[j] == of[i] and rows[j][0] is not None]
        low = min(ids) if ids and link[i].any() else d
        out.append((d, int(link[i].sum()), low, d is not None and d == low))
    return sorted(out, key=repr)


def odd_vectors(dim, kind):
    r = np.random.default_rng(3)
    x = r.normal(size=(160, dim)).astype(kind)
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)]
    rows += [(200 + i, (x[5] + 0.05 * r.normal(size=dim)).astype(kind).tolist()) for i in range(40)]  # a group of near copies
    chain = [np.cos(0.35 * i) * x[7] / np.linalg.norm(x[7]) + np.sin(0.35 * i) * np.eye(dim)[0] for i in range(5)] if dim > 2 else []
    rows += [(300 + i, v.astype(kind).tolist()) for i, v in enumerate(chain)]
    rows += [(400 + i, x[9].tolist()) for i in range(6)] + [(None, x[9].tolist()), (None, (x[9] * 3).tolist()), (9, x[9].tolist())]
    rows += [(500, None), (501, []), (502, [0.0] * dim), (503, [float("nan")] + [1.0] * (dim - 1)), (504, [float("inf")] + [1.0] * (dim - 1)), (505, [None] + [1.0] * (dim - 1)), (506, [-0.0] * dim), (None, None)]
    rows += [(507, x[0].tolist()[:-1]), (508, x[0].tolist()[:-1]), (509, (x[3] * kind(1e-20)).tolist()), (510, (-x[3]).tolist())]
    return rows


@pytest.mark.parametrize("dim,kind,cell,piece", [(64, np.float32, 8192, 4096), (64, np.float32, 12, 7), (10, np.float64, 20, 5), (3, np.float64, 30, 1000)])
def test_near_vectors(spark, monkeypatch, dim, kind, cell, piece):
    monkeypatch.setattr(vectors, "CELL", cell)
    monkeypatch.setattr(vectors, "PIECE", piece)
    rows = odd_vectors(dim, kind)
    schema = f"vec_id long, embedding array<{'float' if kind is np.float32 else 'double'}>, label int, node string, n long, k long"
    df = spark.createDataFrame([(d, v, 0, "x", 1, 2) for d, v in rows], schema).repartition(3)
    got = sorted((tuple(r) for r in vectors.near_duplicates(df).collect()), key=repr)
    assert got == linked(rows)
    assert max(g[1] for g in got) >= 40


def test_near_vectors_of_an_empty_table(spark):
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert [tuple(r) for r in vectors.near_duplicates(spark.createDataFrame([(4, None)], "vec_id long, embedding array<float>")).collect()] == [(4, 0, 4, True)]


def test_a_pair_at_the_bound_counts_once():
    # All of the difference in one block, or the same part of it in each: every block decides alone, one of them finds the pair.
    near = vectors.Near(0.9, 4)
    r = np.random.default_rng(1)
    for _ in range(300):
        x = r.normal(size=16)
        y = r.normal(size=16)
        x /= np.linalg.norm(x)
        y -= x * (x @ y)
        y /= np.linalg.norm(y)
        both = np.stack((x, 0.9 * x + np.sqrt(1 - 0.81) * y))
        found = [near.shard(both, np.ones(2, np.int64), np.arange(1), np.arange(1, 2), k)[0][0] for k in range(4)]
        assert sum(found) == int(near.linked(both[:1], both[1:])[0])
