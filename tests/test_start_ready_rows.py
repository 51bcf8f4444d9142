"""Starting runs moves whole rows only of those that wait."""

import json

from cascadia.operators import graph as G
from cascadia.operators import lifecycle as L
from cascadia.operators.lifecycle import start_ready


def _inputs(runs):
    rows = start_ready(runs).inputs.collect()
    return sorted((r.execution_id, json.loads(r.input_json)["cfg_path"], json.loads(r.input_json)["status"]) for r in rows)


def test_rows_of_one_id_start_together(make_runs):
    runs = make_runs(
        dict(execution_id="a", cfg_path="a"),
        dict(execution_id="a", cfg_path="again", status="succeeded"),
        dict(execution_id="a", cfg_path="unknown", status=None),
        dict(execution_id="b", cfg_path="b", cfg_deps=["a"]),
        dict(execution_id="c", cfg_path="c", status="succeeded"),
        dict(execution_id=None, cfg_path="d"),
        dict(execution_id=None, cfg_path="e", status="succeeded"),
    )
    assert _inputs(runs) == [("a", "a", "running"), ("a", "again", "running"), ("a", "unknown", "running")]


def test_runs_are_stored_narrow_and_once(make_runs, monkeypatch):
    stored = []
    for module in (G, L):
        kept = module.kept
        monkeypatch.setattr(module, "kept", lambda df, kept=kept: stored.append(df) or kept(df))
    runs = make_runs(
        dict(execution_id="a", cfg_path="a"),
        dict(execution_id="b", cfg_path="b", cfg_deps=["a"]),
        dict(execution_id="c", cfg_path="c", status="succeeded"),
    )
    assert _inputs(runs) == [("a", "a", "running")]
    assert len(stored) == 2 and all(len(df.columns) < 10 for df in stored)
    assert stored[0].count() == 2
