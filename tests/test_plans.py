"""What the model plans are asked for, and how their rows are dealt."""

import pytest
from pyspark.sql import functions as F

from catalog import plans
from farebox.plans import training


class Asked(Exception):
    pass


def test_the_export_plan_exports_a_quarter_of_the_test_rows(spark, sf, monkeypatch):
    def asked(gold, out, id_col, fraction=0.01, **settings):
        raise Asked(fraction)

    monkeypatch.setattr(plans, "layers_of", lambda *_: type("Layers", (), {"rows": None}))
    monkeypatch.setattr(plans, "tune_check_export", asked)
    with pytest.raises(Asked, match="^0.25$"):
        plans.plan_export(spark, f"{sf}/")
    assert "< 0.25e0" in plans.EXPORT_PLAN_SQL


@pytest.mark.parametrize("plan, step", [(training.train_compare_save, "models.fit"), (training.tune_check_export, "tuning.tune")])
def test_rows_of_one_file_are_dealt_to_all_cores_in_order(spark, tmp_path, monkeypatch, plan, step):
    def asked(kind, rows, *more, **settings):
        raise Asked(next(x for x in (rows, *more) if hasattr(x, "rdd")))

    owner, name = step.split(".")
    monkeypatch.setattr(getattr(training, owner), name, asked)
    one_file = spark.range(6000).coalesce(1).select("id", F.array("id").alias("features"), F.col("id").cast("double").alias("label"))
    with pytest.raises(Asked) as seen:
        plan(one_file, str(tmp_path), "id")
    parts = [p for p in seen.value.args[0].select("label").rdd.glom().collect()]
    sizes = [len(p) for p in parts]
    assert len(parts) == 3 * spark.sparkContext.defaultParallelism and max(sizes) < 2 * sum(sizes) / len(sizes)
    assert all([r.label for r in p] == sorted(r.label for r in p) for p in parts)
