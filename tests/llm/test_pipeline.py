"""Each stage of the pipeline against a plain version of it, on its own input."""

import data
import plain
import pytest
from data import SF
from pyspark.sql import functions as F

import corpus_pipeline
from adcube.llm import toxicity
from adcube.llm.common import id_remainder


@pytest.fixture(scope="module")
def steps(llm, tmp_path_factory):
    """``(input rows, output rows)`` by stage, over documents with awkward rows added."""
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    more = data.documents(llm).select(F.col("doc_id") + 100_000, "text", "lang", "source", "n_chars").toDF(*docs.columns)
    docs = docs.unionByName(more)
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        folder = str(tmp_path_factory.mktemp(name) / "out")
        stage(llm, docs, SF).write.parquet(folder)
        after = llm.read.parquet(folder)
        out[name] = (docs, after)
        docs = after
    return out


def test_near_duplicates_of_80_percent(llm):
    """Of 110 shingles 100 and 95 stay when two or three words of a copy change: 83.3 and 76 % of the union."""
    base = [f"w{k}" for k in range(114)]
    one, two = list(base), list(base)
    for k in (20, 60):
        one[k] = "other"
    for k in (20, 60, 100):
        two[k] = "another"
    docs = llm.createDataFrame([(1, " ".join(base)), (2, " ".join(one)), (3, " ".join(f"x{w}" for w in base)), (4, " ".join(f"x{w}" for w in two))], "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.drop_near_duplicates(llm, docs, SF).collect()} == {1, 3, 4}
    assert [g[2] for g in plain.near(listed(docs), 80)] == [1, 1, 3, 4]


def test_nothing_but_the_result_stays_behind(llm):
    import os

    from adcube.session import ensure_checkpoint_dir
    shared = ensure_checkpoint_dir(llm).removeprefix("file:")
    before = set(os.listdir(shared))
    out = corpus_pipeline.run(llm, SF)
    assert len(set(os.listdir(shared)) - before) == 1 and out.count() > 0


def listed(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def key(row):
    return (row[0] is None, row[0] or 0, row[1] is None, row[1] or "")


def test_columns(steps):
    for name, (before, after) in steps.items():
        if name != "pieces":
            assert after.columns == before.columns


def test_toxic_rows_go(llm, steps):
    before, after = steps["toxicity"]
    labels = llm.read.parquet(f"{SF}/labels.parquet").where(id_remainder("doc_id", 5) != 0)
    stays = toxicity.classify(before, toxicity.train(before, labels)).where("score < 0.5")
    assert sorted(listed(after), key=key) == sorted(listed(stays), key=key)
    assert after.count() >= 0.8 * before.count()


def test_one_of_each_group_stays(steps):
    before, after = (listed(d) for d in steps["near_duplicates"])
    groups = plain.near(before, 80)
    empty = [r for r, g in zip(before, groups) if not g[1]]
    kept_empty = [r for r in after if not plain.words(r[1])]
    assert sorted(kept_empty, key=key) == sorted(empty, key=key)
    # One row for each component, with the component's smallest id.
    of = {}
    for row, (_, n, component, _) in zip(before, groups):
        if n:
            of.setdefault(row, component)
    full = [r for r in after if plain.words(r[1])]
    assert len(full) == len(set(full))
    components = [of[r] for r in full]
    known = {c for c in of.values() if c is not None}
    assert {c for c in components if c is not None} == known
    assert all(r[0] == of[r] for r in full)


def test_contaminated_rows_go(llm, steps):
    before, after = (listed(d) for d in steps["decontamination"])
    items = [tuple(r) for r in llm.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    clean = [r for r, c in zip(before, plain.contaminated(before, items)) if not c[-1]]
    assert sorted(after, key=key) == sorted(clean, key=key) and len(clean) < len(before)


def test_secrets_are_masked(steps):
    before, after = (listed(d) for d in steps["secrets"])
    assert len(after) == len(before)
    changed = set(after) - set(before)
    assert changed and all("[secret]" in t for _, t in changed)
    assert not any('token = "' in (t or "") and '"[secret]"' not in t for _, t in after)


def test_texts_decode_again(steps):
    before, after = steps["pieces"]
    assert after.count() == before.count() and after.where("not round_trip").count() == 0
