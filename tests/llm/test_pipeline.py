import corpus_pipeline as C
import pytest
from odd import documents, empty
from test_decontaminate import brute as contaminated
from test_simhash import brute as near_groups
from test_token_files import brute as token_rows

from loomcart.llm import mixing, quality

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage takes and gives, as the pipeline runs them."""
    docs, out = C.table(spark, SF, "documents"), []
    for name, stage in C.STAGES:
        after = C.stored(stage(spark, docs, SF), name)
        out.append((docs, after))
        docs = after
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns(stages):
    for before, after in stages[:-1]:
        assert after.columns == before.columns


def test_quality(spark, stages):
    before, after = stages[0]
    score = quality.scored(before, C.table(spark, SF, "labels"))
    assert sorted(r.doc_id for r in score.where("predicted = 1").collect()) == sorted(i for i, _ in rows(after))


def test_near_duplicates(stages):
    before, after = stages[1]
    assert sorted(i for i, _ in rows(after)) == sorted({c for _, _, c in near_groups(rows(before))})


def test_decontamination(spark, stages):
    before, after = stages[2]
    items = [(r.item_id, r.text) for r in C.table(spark, SF, "benchmark").collect()]
    assert sorted(i for i, _ in rows(after)) == sorted(r[0] for r in contaminated(rows(before), items) if not r[-1])


def test_mixing(stages):
    before, after = stages[3]
    size = lambda table: sum(len((t or "").split()) for _, t in rows(table))
    assert size(after) == pytest.approx(1.5 * size(before), rel=0.1)
    times = [rows(after).count(r) for r in rows(before)]
    assert max(times) <= 2 and set(rows(after)) <= set(rows(before))


def in_order(df):
    """Rows of a stored table in the order of its files."""
    placed = df.select("doc_id", "text", "_metadata.file_name", "_metadata.row_index").collect()
    return [(r.doc_id, r.text) for r in sorted(placed, key=lambda r: (r.file_name, r.row_index))]


def test_mixing_stands_in_training_order(stages):
    before, after = stages[3]
    plan = {(r.doc_id, r.text_hash): r.positions for r in mixing.mix(before).collect()}
    hashes = {(r[0], r[1]): r[2] for r in before.select("doc_id", "text", C.text_hash(before["text"])).collect()}
    want = sorted((p, i, hashes[i, t], t) for i, t in rows(before) for p in plan[i, hashes[i, t]])
    assert in_order(after) == [(i, t) for _, i, _, t in want]


def test_token_files_keep_the_training_order(stages):
    """Copies of a document stand apart, as the mix has them."""
    before, after = stages[4]
    found = sorted((tuple(r) for r in after.collect()), key=lambda r: r[1])
    start, want = 0, []
    alone = {r[0]: r[2:] for r in token_rows(sorted(set(rows(before))))}
    for doc_id, _ in in_order(before):
        want.append((doc_id, start, *alone[doc_id]))
        start += alone[doc_id][0]
    assert found == want
    assert [r[0] for r in found] != sorted(r[0] for r in found)


def test_token_stage_on_rows_without_files(spark):
    docs = documents(spark)
    assert sorted((tuple(r) for r in C.token_stage(spark, docs, SF).collect()), key=lambda r: r[1]) == token_rows(rows(docs))
    assert C.token_stage(spark, empty(spark), SF).collect() == []


def test_run_is_the_stages(spark, stages):
    assert sorted(map(tuple, C.run(spark, SF).collect())) == sorted(map(tuple, stages[-1][1].collect()))


@pytest.mark.parametrize("name,stage", C.STAGES[1:4])
def test_odd_rows(spark, name, stage):
    docs = documents(spark)
    out = stage(spark, docs, SF)
    assert out.columns == docs.columns
    found, given = rows(out), rows(docs)
    assert set(found) <= set(given)
    if name == "near_duplicates":
        groups = near_groups(given)
        assert len(found) == len({g[2] for g in groups})
        assert len(set(found)) == len(found)
    if name == "decontamination":
        assert sorted(found, key=repr) == sorted(given, key=repr)
    assert stage(spark, empty(spark), SF).collect() == []


def test_quality_stage_on_odd_rows(spark):
    assert C.quality_stage(spark, empty(spark), SF).collect() == []
    assert len(rows(C.quality_stage(spark, documents(spark), SF))) <= 14


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    docs = documents(spark)
    want = [sorted(rows(stage(spark, docs, SF)), key=repr) for _, stage in C.STAGES[1:4]]
    monkeypatch.setattr("loomcart.llm.common.BROADCAST_ROWS", -1)
    assert [sorted(rows(stage(spark, docs, SF)), key=repr) for _, stage in C.STAGES[1:4]] == want
