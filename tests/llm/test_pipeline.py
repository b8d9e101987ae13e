import __spark_entry__ as spark_entry
import corpus_pipeline
from conftest import EXTRA, SF

from playtide.llm.common import stored


def test_stages_keep_clean_documents(spark, whole):
    """Each stage on its predecessor's rows: columns stay, only copies go, personal data goes."""
    docs, counts = whole, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, SF))
        assert after.columns == docs.columns, name
        counts.append((docs.count(), after.count()))
        docs = after
    assert counts[0][1] == sum(any(c.isalpha() for c in r.text or "") for r in whole.select("text").collect())
    assert counts[1][1] < counts[1][0] and counts[2][1] <= counts[2][0]
    assert counts[3][0] == counts[3][1]
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert rows.select("doc_id").distinct().count() == docs.count()


def test_run_and_registration(spark):
    rows = spark_entry.queries()["pipeline"](spark, SF)
    assert rows.count() > 500 and "pipeline" not in spark_entry.oracle_sql()


def test_odd_rows_pass_all_stages(spark, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF))
        if stage is not corpus_pipeline.pack:  # clashing names keep their values
            assert docs.columns == odd.columns
            assert all(r[c] == v for r in docs.collect() for c, v in EXTRA.items())
    docs.count()
    empty = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stored(stage(spark, empty, SF))
    assert empty.count() == 0


def test_near_copies_from_080_go(docs):
    """Pairs at 176 of 216 shingles (0.815) are one document, at 166 of 226 (0.735) two."""
    rows = []
    for i in range(60):
        words = [f"w{i}x{k}" for k in range(200)]
        other = list(words)
        for at in range(20, 20 + 30 * (4 if i % 2 else 6), 30):
            other[at] = f"new{i}x{at}"
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    kept = {r.doc_id for r in corpus_pipeline.near(None, docs(*rows), SF).collect()}
    assert kept == {2 * i for i in range(60)} | {2 * i + 1 for i in range(0, 60, 2)}
