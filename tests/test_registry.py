"""Rankings over the metric registry take every row of it, single sites too."""

import pytest

from occuspark.plans import q_maintain, registry


class Rows:
    """Stands for the registry's sources: one pooled model and a better single site."""

    def __init__(self, spark, sf_dir):
        self.spark = spark


@pytest.fixture
def listed(spark, monkeypatch):
    rows = [("baseline", "previous_observation", "occupancy_people", "real_holdout", 10, 5.0, 6.0, 0.5),
            ("per_gym_profile", "calendar_gym_001", "occupancy_people", "single_gym", 4, 2.0, 3.0, 0.2)]
    schema = "family string, model string, target string, dataset_scope string, rows long, mae double, rmse double, wape double"
    monkeypatch.setattr(q_maintain, "_registry", lambda c: spark.createDataFrame(rows, schema))
    monkeypatch.setattr(registry.V, "Ctx", Rows)
    return registry.all_queries()


def test_single_sites_are_ranked(spark, listed):
    got = [(r["rank"], r["model"]) for r in listed["topk_registry"](spark, "").orderBy("rank").collect()]
    assert got == [(1, "calendar_gym_001"), (2, "previous_observation")]


def test_single_sites_can_be_best(spark, listed):
    assert [r["model"] for r in listed["topk_best_model"](spark, "").collect()] == ["calendar_gym_001"]


def test_deltas_list_every_family(spark, listed):
    got = {r["family"]: (r["mae_delta_vs_previous"], r["mae_delta_vs_best"]) for r in listed["ml_research_deltas"](spark, "").collect()}
    assert got == {"baseline": (0.0, 3.0), "per_gym_profile": (-3.0, 0.0)}
