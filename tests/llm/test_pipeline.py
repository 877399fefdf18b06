"""The pipeline stage by stage against brute force."""

from collections import Counter, defaultdict

import corpus_pipeline as cp
from test_mixing import targets
from test_near_text import brute as near_brute
from test_packing import check as packed
from test_substrings import WORD, brute as repeats_brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    before = {r.doc_id: r for r in docs.collect()}
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near duplicates", "repeated passages", "mixing", "packing"]
    (_, tox), (_, near), (_, cut), (_, mix), (_, pack) = cp.STAGES

    df = cp.Staged(tox(spark, docs, folder), "t").df
    assert df.columns == COLUMNS
    rows = {r.doc_id: r for r in df.collect()}
    gone = before.keys() - rows.keys()
    assert all(labels.get(d, 1) == 1 for d in gone) and len(gone) > 10
    assert sum(labels[d] == 1 for d in rows if d in labels) <= 0.1 * sum(labels.values())

    df = cp.Staged(near(spark, df, folder), "t").df
    want = {d for d, _, _, kept in near_brute([(d, r.text) for d, r in sorted(rows.items())], 80) if kept}
    assert df.columns == COLUMNS
    rows = {r.doc_id: r for r in df.collect()}
    assert rows.keys() == want

    df = cp.Staged(cut(spark, df, folder), "t").df
    left = {d: (n, gone) for d, n, gone, _ in repeats_brute([(d, r.text) for d, r in rows.items()], cp.WINDOW)}
    after = {r.doc_id: r for r in df.collect()}
    assert df.columns == COLUMNS and after.keys() == {d for d, (n, gone) in left.items() if not gone or n > gone}
    for d, r in after.items():
        n, gone = left[d]
        assert r.text == rows[d].text if not gone else len(WORD.findall(r.text)) == n - gone and r.n_chars == len(r.text)
    assert any(gone for _, gone in left.values())

    df = cp.Staged(mix(spark, df, folder), "t").df
    assert df.columns == COLUMNS
    copies, taken, sizes = Counter(), defaultdict(int), defaultdict(int)
    for r in after.values():
        sizes[r.source] += len(WORD.findall(r.text))
    for r in df.collect():
        assert r == after[r.doc_id]
        copies[r.doc_id] += 1
        taken[r.source] += len(WORD.findall(r.text))
    assert max(copies.values()) <= 3
    assert all(abs(taken[s] - t) <= 250 for s, t in targets(sizes).items())

    pieces = pack(spark, df, folder).collect()
    assert sum(p.start == 0 for p in pieces) == sum(copies.values())
    single = [p for p in pieces if copies[p.doc_id] == 1]
    assert packed([(d, after[d].text) for d, n in copies.items() if n == 1], single_gapless(single)) < 1


def single_gapless(pieces):
    """Pieces of documents taken once, their offsets closed up over those left out."""
    out, at = [], defaultdict(int)
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        out.append((p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens, p.sequence_id, at[p.sequence_id]))
        at[p.sequence_id] += p.length
    return out


def test_run_over_odd_rows(spark, tmp_path):
    odd = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, None, None, None, None), (3, "x y z", "en", "a", 5),
           (3, "x y z", "en", "a", 5), (4, "w " * 300, "en", "b", 600), (None, "q r s", None, "a", 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    folder = f"{tmp_path}/odd"
    extra = spark.createDataFrame(odd, schema).selectExpr("*", "1 AS rid", "'x' AS kept", "2 AS size")
    extra.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(3, 1, 0), (None, 1, 1), (1, 0, None)], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    assert cp.run(spark, folder).count() > 0


def test_one_row_of_repeated_rows_stays(spark, tmp_path):
    texts = [" ".join(f"{name}{i}" for i in range(100)) for name in "abcd"]
    rows = [(7, texts[0]), (7, texts[0]), (None, texts[1]), (9, texts[1]), (None, texts[2]), (None, texts[2]),
            (5, texts[3]), (4, texts[3] + " more"), (5, "quite another text"), (None, None), (None, "")]
    folder = f"{tmp_path}/repeated"
    spark.createDataFrame([(d, t, "en", "a", len(t or "")) for d, t in rows],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{folder}/documents.parquet")
    spark.createDataFrame([(7, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = sorted(map(repr, [(7, texts[0]), (9, texts[1]), (None, texts[2]), (4, texts[3] + " more"),
                             (5, "quite another text"), (None, None), (None, "")]))
    near = cp.Staged(cp.drop_near_duplicates(spark, docs, folder), "t").df
    assert sorted(repr((r.doc_id, r.text)) for r in near.collect()) == want
    cut = cp.cut_repeats(spark, near, folder)
    assert sorted(repr((r.doc_id, r.text)) for r in cut.collect()) == want
    assert {7, 9, None} <= {r.doc_id for r in cp.run(spark, folder).collect()}
