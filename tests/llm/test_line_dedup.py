from collections import defaultdict

from cases import awkward_rows, documents
from tickwise.llm import line_dedup as op


def brute(rows, min_sites):
    sites, keeper = defaultdict(set), {}
    for doc_id, text, _, site in rows:
        for line in (text or "").split("\n"):
            line = line.strip(" ")
            if line:
                sites[line] |= {site} - {None}
                if doc_id is not None:
                    keeper[line] = min(keeper.get(line, doc_id), doc_id)
    out = []
    for doc_id, text, _, site in rows:
        lines = text.split("\n") if text is not None else []
        kept = [x for x in lines if len(sites.get(x.strip(" "), ())) < min_sites or doc_id == keeper.get(x.strip(" "))]
        out.append((doc_id, len(lines), len(lines) - len(kept), None if text is None else "\n".join(kept)))
    return sorted(out, key=repr)


def rows():
    shared = [(100 + i, f"own {i}\nshared everywhere\n{'wide' if i < 9 else 'own'} line", "en", f"s{i}") for i in range(25)]
    return awkward_rows() + shared + [(400, "shared everywhere\n shared everywhere ", "en", None)]


def run(spark, rows, min_sites):
    got = op.line_dedup(documents(spark, rows), min_sites).select("doc.doc_id", "n_lines", "n_removed", "left")
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_matches_brute_force(spark):
    for min_sites in (2, 9, 10):
        assert run(spark, rows(), min_sites) == brute(rows(), min_sites)


def test_spread_far_above_the_threshold_needs_no_exact_count(spark):
    many = [(i, "footer\nbody " + str(i), "en", f"site{i % 150}") for i in range(300)]
    assert run(spark, many, 10) == brute(many, 10)


def test_documents_of_boilerplate_only_go(spark):
    docs = documents(spark, rows())
    got = op.without_boilerplate(docs, 10)
    want = [r for r in brute(rows(), 10) if not (r[2] and not (r[3] or "").strip(" "))]
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(((r[0], r[3]) for r in want), key=repr)


def test_passages_of_a_few_sites_go(spark):
    """In the pipeline's form a line of over 50 words goes from 3 sites on; short lines and op6 keep to 10."""
    docs, passages = [], {}
    for sites in (2, 3, 5, 9):
        passages[sites] = " ".join(f"p{sites}w{i}" for i in range(51))
        short = " ".join(f"q{sites}w{i}" for i in range(50))
        docs += [(100 * sites + i, f"own {sites} {i}\n{passages[sites]}\n{short}", "en", f"s{i}") for i in range(sites)]
    got = {r.doc_id: r.text for r in op.without_boilerplate(documents(spark, docs)).collect()}
    for i, text, *_ in docs:
        sites, place = divmod(i, 100)
        want = text if sites == 2 or place == 0 else text.replace(passages[sites] + "\n", "")
        assert got[i] == want, i
    assert run(spark, docs, 10) == brute(docs, 10)


def test_empty_table(spark):
    assert op.line_dedup(documents(spark, [])).count() == 0
