import pyarrow as pa

from waypost.llm import jaccard
from waypost.llm.batches import in_slices


def test_functions_get_few_rows_at_once_and_all_of_them():
    seen = []

    def sizes(batches):
        for batch in batches:
            seen.append(batch.num_rows)
            yield batch

    batches = [pa.record_batch([pa.array(range(n), pa.int64())], ["id"]) for n in (0, 2500, 1)]
    out = list(in_slices(sizes, 1000)(iter(batches)))
    assert seen == [1000, 1000, 500, 1]
    assert [v for b in out for v in b.column(0).to_pylist()] == [*range(2500), 0]


def test_the_products_tasks_take_one_python_worker_each(spark, monkeypatch):
    """Links are written before components are made of them by a second function."""
    plans = []
    components = jaccard.components

    def noted(links):
        plans.append(links._jdf.queryExecution().toString())
        return components(links)

    monkeypatch.setattr(jaccard, "components", noted)
    text = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(1, text), (2, text + " x"), (3, "y")], "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 3}
    assert len(plans) == 2 and not any("InArrow" in p for p in plans)
