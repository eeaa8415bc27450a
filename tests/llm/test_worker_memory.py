"""What a Python worker of the pipeline holds: bounded arrays, one operator's cache at a time."""

import random
import re
import tracemalloc

import numpy as np

import corpus_pipeline
from pagelake.llm import common, jaccard, toxicity
from pagelake.llm.pieces import PieceEncoder
from pagelake.llm.queries import model_path
from tests.conftest import SF
from tests.llm.test_operators import prose


def long_units(n):
    rng = random.Random(3)
    return ["".join(rng.choice("abcdefgh") for _ in range(toxicity.WIDTH)) for _ in range(n)]


def test_margins_of_many_long_units_take_little_memory():
    units = long_units(4096)
    model = toxicity.fit_units(units[:40], units[40:400])
    tracemalloc.start()
    margins = model.margins(units)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 48 << 20
    assert np.allclose(margins, np.concatenate([model.margins([u]) for u in units[:300]] + [model.margins(units[300:])]))


def test_a_worker_keeps_one_operator_s_cache():
    a = common.held("a", dict)
    assert common.held("a", dict) is a
    b = common.held("b", dict)
    assert common.held("b", dict) is b and common.held("a", dict) is not a
    model = toxicity.fit_units(["badword"], ["good"])
    model.of_units(["some badword"])
    assert list(common._HELD) == [f"toxicity-{model.name}"]


def test_few_kept_words_encode_alike():
    rng = random.Random(4)
    texts = [prose(rng, 60) for _ in range(30)]
    few, many = PieceEncoder(model_path(), kept=10), PieceEncoder(model_path())
    assert [few.encode_batch([t]) for t in texts] == [many.encode_batch([t]) for t in texts]
    assert len(few.memo) + len(few.past) < len(many.memo)


def test_batches_are_small_in_every_stage(spark):
    docs = spark.createDataFrame([(1, "a b c", "en", "s", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    corpus_pipeline.encode(spark, docs, "")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) <= 2 << 20


def test_a_group_of_near_duplicates_takes_little_memory():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 2**63, 400, dtype=np.uint64)) for _ in range(500)]
    sets += [np.append(s[5:], np.uint64(2**63 + 1)) for s in sets]
    tracemalloc.start()
    edges = jaccard.forest(sets, 80)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 << 20 and {tuple(sorted(e)) for e in edges} == {(i, i + 500) for i in range(500)}


def chained(plan):
    """Python operators of a plan that another one of the same Spark stage reads from."""
    out, above = [], []
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        above = [(d, python) for d, python in above if d < depth]
        cut = re.search(r"Exchange|QueryStage|Scan |Subquery", line)
        python = re.match(r"[\s:+*()\d-]*(\w*EvalPython|\w*In(Arrow|Pandas))\b", line)
        if python and above and above[-1][1]:
            out.append(line.strip())
        above.append((depth, bool(python) or bool(above and above[-1][1] and not cut)))
    return out


def test_no_task_takes_two_python_workers(spark):
    """A second worker a task stays for all later stages and keeps its memory."""
    seen = spark._jsparkSession.sharedState().statusStore()
    before, docs = seen.executionsCount(), spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.format("noop").mode("overwrite").save()
    runs = seen.executionsList(before, 10_000)
    plans = [runs.apply(i).physicalPlanDescription().split("\n\n(1) ")[0] for i in range(runs.size())]
    assert sum("Python" in p or "InArrow" in p for p in plans) > 10
    assert [x for p in plans for x in chained(p)] == []
