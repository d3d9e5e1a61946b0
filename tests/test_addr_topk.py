"""addr_topk keeps the 100 best targets of a record, as the operator does."""

from collections import defaultdict

from kindred.plans import registry


def test_a_hundred_targets_stay(spark, sf_dir):
    found = registry.queries()
    of = defaultdict(list)
    for r in found["addr_token_overlap"](spark, sf_dir).collect():
        of[r.s1_id].append((-r.token_overlap, r.matched_id))
    want = {(s1, m, -o) for s1, rows in of.items() for o, m in sorted(rows)[:100]}
    assert max(map(len, of.values())) > 10
    got = [tuple(r) for r in found["addr_topk"](spark, sf_dir).select("s1_id", "matched_id", "token_overlap").collect()]
    assert len(got) == len(want) and set(got) == want
