import hashlib
from collections import defaultdict

from conftest import LOWER

from playtide.llm import exact_dedup


def test_membership_equals_grouping(whole, texts):
    groups = defaultdict(list)
    for i, t in texts.items():
        groups[t.translate(LOWER)].append(i)
    rows = {r.doc_id: r for r in exact_dedup.membership(whole.repartition(70)).collect()}
    assert len(rows) == len(texts)
    for text, ids in groups.items():
        for i in ids:
            r = rows[i]
            assert (r.keep_id, r.group_size, r.kept) == (max(ids), len(ids), i == max(ids))
            assert r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_odd_rows_keep_one_row_of_each_text(odd):
    rows = exact_dedup.membership(odd).collect()
    assert len(rows) == 11 and sum(r.kept for r in rows) == 7
    same = [r for r in rows if r.group_size == 4]
    assert len(same) == 4 and {r.keep_id for r in same} == {5} and [r.doc_id for r in same if r.kept] == [5]
    kept = exact_dedup.deduplicated(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 5, 6, 7, 8, 9]


def test_the_smallest_can_stay_and_repeated_rows_leave_one(docs):
    df = docs((4, "a"), (4, "a"), (4, "A"), (9, "a"), (None, "b"), (None, "b"))
    assert sorted((str(r.doc_id), r.text.lower()) for r in exact_dedup.deduplicated(df, "smallest").collect()) == [("4", "a"), ("None", "b")]
    assert sorted((str(r.doc_id), r.text.lower()) for r in exact_dedup.deduplicated(df).collect()) == [("9", "a"), ("None", "b")]
    assert exact_dedup.membership(df, "smallest").filter("kept").count() == 2


def test_empty_table(odd):
    assert exact_dedup.membership(odd.limit(0)).count() == 0 and exact_dedup.deduplicated(odd.limit(0)).count() == 0


def test_main_path_runs_no_python(whole):
    plan = exact_dedup.membership(whole)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
