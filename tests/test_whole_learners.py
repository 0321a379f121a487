"""The learners' queries take the whole seed and the operators' own repeats and iterations."""

from tabfidelity.operators import tstr as T
from tabfidelity.plans import q_tstr
from tabfidelity.plans.bindings import seed


def test_perm_importance_takes_the_whole_seed(spark, sf_dir, monkeypatch):
    seen = []
    monkeypatch.setattr(T, "permutation_importance", lambda m, df, *a, **k: seen.append((df.count(), k)))
    q_tstr.perm_importance(spark, sf_dir)
    assert seen == [(seed(spark, sf_dir).count(), {})]


def test_calibrated_boosts_as_the_operator_does(spark, sf_dir, monkeypatch):
    seen = []

    def train(*a, **k):
        seen.append(k)
        raise InterruptedError

    monkeypatch.setattr(T, "train", train)
    try:
        q_tstr.calibrated(spark, sf_dir)
    except InterruptedError:
        pass
    assert seen == [{}]
