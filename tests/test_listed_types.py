"""Queries over every listed type against brute force: substrings instead of the grammar, loops instead of joins."""

import os
from collections import Counter, defaultdict

import duckdb
import pytest

from termweave.plans import resource_queries as r

D = "/root/testdata/sf0.001"
if not os.path.isdir(D):
    pytest.skip("no data", allow_module_level=True)


def read(name, cols):
    return duckdb.sql(f"SELECT {cols} FROM '{D}/{name}.parquet'").fetchall()


def clean(cui):
    return "".join(c for c in cui.upper() if c.isalnum())


def brute(group):
    """(cui, tui, sty): no type name or code is part of another, so a list holds what it contains."""
    known = read("semtypes", "tui, sty")
    assert not any(a != b and (a[0] in b[0] or a[1] in b[1]) for a in known for b in known)
    return {(clean(cui), t, s) for cui, stys, tuis in read("labelinfo", "cui, stys, tuis") if cui is not None for t, s in known if (s in (stys or "") or t in (tuis or "")) and (group == "BMH" or t <= "T441")}


@pytest.mark.parametrize("suffix, group", [("", "KCX"), ("_bmh", "BMH")])
def test_listed_types(spark, rows, suffix, group):
    q, want = r.queries(), brute(group)
    of = defaultdict(set)
    for cui, t, s in want:
        of[cui].add((t, s))
    assert rows(q[f"semantic_group_filter{suffix}"](spark, D)) == sorted(want) and len(want) > len(of)
    atoms = [(clean(a[0]), *a[1:]) for a in read("mrconso", "cui, sab, str") if a[0] is not None and a[2] is not None]
    n = Counter(cui for cui, sab, _ in atoms if sab is not None)
    info = {x.cui: (x.tuis, x.stys, x.vocabcount) for x in q[f"concept_info{suffix}"](spark, D).collect()}
    assert info == {c: (",".join(sorted(t for t, _ in ts)), ",".join(sorted(s for _, s in ts)), len(ts) * n[c]) for c, ts in of.items()}
    docs = Counter(clean(cui) for cui, in read("documents", "cui") if cui is not None and clean(cui) in of)
    assert Counter(x.cui for x in q[f"abstracts_export{suffix}"](spark, D).collect()) == {c: k * len(of[c]) for c, k in docs.items()}


def test_the_most_frequent_concepts(spark):
    kept = {x.cui for x in r.queries()["concept_info_bmh"](spark, D).collect()}
    assert {c for c, _ in Counter(clean(c) for c, in read("mrconso", "cui") if c).most_common(3)} <= kept
