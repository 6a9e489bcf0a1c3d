"""The pipeline stage by stage against brute force, on the smallest tables."""

import pytest

pytest.importorskip("ledgerstream.llm")
import corpus_pipeline  # noqa: E402
from ledgerstream.llm import quality, secrets, sentencepiece  # noqa: E402
from ledgerstream.llm.common import read_table, stored  # noqa: E402
from ledgerstream.llm.queries import tokenizer_file  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = read_table(spark, SF, "documents")
    columns, bench = docs.columns, [r.text for r in read_table(spark, SF, "benchmark").collect()]
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF), "t")
        seen.append((name, docs.collect(), out.collect()))
        docs = out
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
    model = quality.train(read_table(spark, SF, "documents"), read_table(spark, SF, "labels"))
    _, before, after = seen[0]
    assert {r.doc_id for r in after} == {r.doc_id for r in before if model.score(quality.feature_matrix([r.text]))[0] >= 0.3}
    _, before, after = seen[1]
    cut = {r.doc_id: {tuple(w[i : i + 5]) for w in [r.text.lower().split()] for i in range(max(1, len(w) - 4))} for r in before}
    group = {d: d for d in sorted(cut)}
    alike = [(a, b) for a in cut for b in cut if a < b and len(cut[a] & cut[b]) >= 0.8 * len(cut[a] | cut[b])]
    changed = True
    while changed:
        changed = False
        for a, b in alike:
            low = min(group[a], group[b])
            changed = changed or group[a] != low or group[b] != low
            group[a] = group[b] = low
    assert len(alike) > 10 and {r.doc_id for r in after} == set(group.values())
    _, before, after = seen[2]
    assert {r.doc_id for r in after} == {r.doc_id for r in before if not any(t in (r.text or "") for t in bench)}
    _, before, after = seen[3]
    assert {r.doc_id for r in before} == {r.doc_id for r in after}
    assert all(not secrets.base_spans(r.text or "") and r.n_chars == len(r.text or "") for r in after)
    m = sentencepiece.model(tokenizer_file("piece_bpe_32k.model"))
    _, before, after = seen[4]
    texts = {r.doc_id: r.text for r in before}
    assert all(r.ids == m.library.encode(texts[r.doc_id]) and r.round_trip for r in after)


@pytest.fixture
def odd_tables(spark, tmp_path):
    """The smallest tables with nulls, repeated rows and ids, and columns that stages use inside."""
    from pyspark.sql import functions as F

    docs = read_table(spark, SF, "documents").limit(80)
    one = docs.orderBy("doc_id").limit(1)
    odd = [docs, one, one.withColumn("text", F.lit("another text under a repeated id, long enough to have some words in it")), one.withColumn("doc_id", F.lit(None).cast("long"))]
    odd += [one.withColumn("doc_id", F.lit(1_000_001).cast("long")).withColumn("text", F.lit(x).cast("string")) for x in (None, "", " \n ")] + [one.withColumn("doc_id", F.lit(1_000_009).cast("long")).withColumn("source", F.lit(None).cast("string")).withColumn("lang", F.lit(None).cast("string"))]
    rows = odd[0]
    for x in odd[1:]:
        rows = rows.unionByName(x)
    rows = rows.withColumn("h", F.lit(1)).withColumn("row", F.lit("r")).withColumn("fp", F.lit("f")).withColumn("spans", F.lit(2))
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    rows.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    for name in ("labels", "benchmark"):
        for to in (tmp_path, tmp_path / "none"):
            read_table(spark, SF, name).write.parquet(str(to / f"{name}.parquet"))
    return str(tmp_path)


def test_run_is_the_chain_of_stages(spark, odd_tables):
    docs = read_table(spark, odd_tables, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, odd_tables), "t")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns, name
    row = lambda r: (r.doc_id is None, r.doc_id, r.n_pieces, r.ids_crc32, r.round_trip, r.ids)
    want = sorted(map(row, docs.collect()), key=repr)
    got = sorted(map(row, corpus_pipeline.run(spark, odd_tables).collect()), key=repr)
    assert got == want and 20 < len(got) < 90


def test_run_on_an_empty_table(spark, odd_tables):
    assert corpus_pipeline.run(spark, f"{odd_tables}/none").count() == 0
