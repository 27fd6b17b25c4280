"""Stages of the pipeline whose work must not change its kind, or be done again, as tables grow."""

from vigil.llm import mixing, near_dedup


def test_copies_join_the_texts_in_one_way_at_every_size(spark):
    docs = spark.createDataFrame([(i, "ab"[i % 2], f"some words of {i} " * 30) for i in range(40)], "doc_id long, source string, text string")
    plan = mixing.copies(docs)._jdf.queryExecution().executedPlan().toString()
    texts = next(line for line in plan.splitlines() if "Join" in line)  # the uppermost join is that with the texts
    assert "SortMergeJoin" in texts


def test_groups_that_were_closed_are_not_read_again(spark, monkeypatch):
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base[:k] + [f"other{k}"] + base[k + 1:]) for k in range(0, 200, 20)]
    docs = spark.createDataFrame(list(enumerate(texts * 2)), "doc_id long, text string")
    read, written = [], near_dedup.written

    def spy(df, name):
        if name == "open-groups":
            read.append(any("band-groups" in f for f in df.inputFiles()))
        return written(df, name)

    monkeypatch.setattr(near_dedup, "written", spy)
    found = near_dedup.near_duplicates(docs).collect()
    assert {r.component_id for r in found} == {0} and [r.doc_id for r in found if r.kept] == [0]
    assert read == [True, False, False, False]
