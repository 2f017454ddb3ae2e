import re
from collections import defaultdict

from attesta.llm import line_spread as ls


def brute(rows, min_sites):
    sites, first = defaultdict(set), {}
    for doc, text, site in rows:
        for line in (text or "").split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                sites[line].add(site)
                if doc is not None:
                    first[line] = min(doc, first.get(line, doc))
    bad = {x for x, s in sites.items() if len(s - {None}) >= min_sites}
    out = []
    for doc, text, _ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (x in bad and x in first and first[x] != doc)]
        out.append((doc, None if text is None else "\n".join(kept), len(lines) - len(kept)))
    return sorted(out, key=repr)


def test_against_exact_counts_around_the_threshold(documents):
    rows, doc = [], 0
    for spread in range(1, 40):
        for site in range(spread):
            rows.append((doc, f"line on {spread} sites\nown line {doc}\n\nline on {spread} sites", f"s{site}"))
            doc += 1
    for least in (3, 10, 20):
        got = ls.drop_boilerplate(documents(*rows), least).collect()
        assert sorted(((r.doc_id, r.text, r.n_removed) for r in got), key=repr) == brute(rows, least)


def test_one_site_is_no_spread(documents):
    got = ls.drop_boilerplate(documents(*[(i, "same line", "one") for i in range(50)]), 2).collect()
    assert all(r.n_removed == 0 for r in got)


def test_awkward_rows(documents, awkward):
    rows = [(1, None, "a"), (2, "", "b"), (3, "x\n \nx", "a"), (4, "x", "b"), (4, "x", "b"), (None, "x\ny", "c"), (5, "y", None), (6, " ", "a"), (3, "x", "c")]
    got = ls.drop_boilerplate(documents(*rows), 2).collect()
    assert sorted(((r.doc_id, r.text, r.n_removed) for r in got), key=repr) == brute(rows, 2)
    wide = ls.drop_boilerplate(awkward, 1)
    assert wide.count() == awkward.count() and set(awkward.columns) <= set(wide.columns)
    assert {r.n_lines for r in wide.filter("doc_id = 10").collect()} == {4}
    assert ls.drop_boilerplate(awkward.limit(0), 2).count() == 0
