"""The pipeline against a brute-force version of its stages."""
import corpus_pipeline
from cases import awkward_rows, documents
from tickwise.llm.language_id import language_id
from test_best_fit_packing import brute_pieces, check_places
from test_decontamination import brute as brute_contamination
from test_line_dedup import brute as brute_lines
from test_simhash_dedup import brute_fp, brute_groups

SF = "/root/testdata/sf0.001"


def brute(spark, docs, items):
    """Rows (doc_id, text, lang, source) after the first four stages; ids are distinct."""
    found = {r.doc.doc_id: r for r in language_id(docs, background=True).collect()}
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    rows = [r for r in rows if found[r[0]].lang_pred != "und" and found[r[0]].score >= 1 / 3]
    cut = {i: (removed, left) for i, _, removed, left in brute_lines(rows, 10)}
    rows = [(i, cut[i][1], lang, s) for i, _, lang, s in rows if not (cut[i][0] and not cut[i][1].strip(" "))]
    fps = {}
    for i, text, *_ in rows:
        fps.setdefault(brute_fp(text), []).append(i)
    keep = {min(i for f in group for i in fps[f]) for group in set(brute_groups(fps).values())}
    rows = [r for r in rows if r[0] in keep]
    bad = {r[0] for r in brute_contamination(rows, items) if r[4]}
    return [r for r in rows if r[0] not in bad]


def test_run_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute(spark, docs, items)
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == brute_pieces(want, 4096)
    check_places(got, 4096)
    assert 0 < len(want) < docs.count()


def test_stages_return_the_columns_of_documents(spark):
    docs = documents(spark, awkward_rows())
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.dtypes == docs.dtypes, name
        assert 0 < kept.count() <= n, name
        assert stage(spark, documents(spark, []), SF).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= n


def test_stages_are_operators_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
