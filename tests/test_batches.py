import pyarrow as pa

from feedmill.operators import clippings as C
from feedmill.operators import scoring as S


def test_a_task_holds_a_few_pages_at_a_time(spark):
    plan = spark.createDataFrame([("<p>x</p>",)], "html string").select(C.main_content("html"))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan


def test_a_task_asks_in_parts_of_an_arrow_batch():
    batch = pa.record_batch([pa.array(range(1000)), pa.array([f"p{i}" for i in range(1000)])], ["batch_id", "prompt"])
    out = list(S._answer_task(lambda p: p.upper(), None, "batch_id", 1)(iter([batch])))
    assert max(b.num_rows for b in out) <= 256
    assert [x for b in out for x in b.column("response").to_pylist()] == [f"P{i}" for i in range(1000)]
    assert [x for b in out for x in b.column("batch_id").to_pylist()] == list(range(1000))
