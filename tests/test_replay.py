"""Dead letters run again after the configuration was mended."""

import importlib
import json
from pathlib import Path

from labweave.operators import sinks, snapshots
from labweave.plans import pipeline, replay
from tests import sample

TIMES = {"processed_at", "ingested_at", "occurred_at", "run", "raw"}


def rows(df):
    return sorted(str([r[c] for c in sorted(set(df.columns) - TIMES)]) for r in df.collect())


def tables(spark, out):
    audit = sinks.read_table(spark, f"{out}/audit").selectExpr(
        "source_file", "clinic_id", "document_id", "dedup_key", "content_hash", "size(rows) as n")
    return {
        "records": rows(sinks.read_table(spark, f"{out}/records")),
        "letters": rows(sinks.error_log(spark, f"{out}/dead_letter")),
        "suppressed": rows(sinks.read_table(spark, f"{out}/suppressed")),
        "audit": rows(audit),
        "stats": rows(pipeline.stored_stats(spark, out)),
        "quality": rows(pipeline.stored_quality(spark, out, "clinic_id", "date_str")),
    }


def poor_config(folder: Path) -> str:
    """Without one source's layout and two tests of the dictionary."""
    config = sample.write_config(folder)
    (folder / "clinics" / "river.json").unlink()
    file = folder / "test_dictionary.json"
    known = json.loads(file.read_text())
    known["tests"] = [t for t in known["tests"] if t["canonical_name"] not in ("Odour", "Manganese")]
    file.write_text(json.dumps(known))
    return config


def test_replay_equals_a_full_run_by_the_new_configuration(spark, tmp_path):
    source = sample.write_reports(tmp_path / "in")
    odd = tmp_path / "in" / "river_hospital" / "2024 [late] {x}" / "a tree.json"  # no glob, no escape
    odd.parent.mkdir()
    (tmp_path / "in" / "river_hospital/2024-11-05/tree.json").rename(odd)
    good = sample.write_config(tmp_path / "good")
    whole, out = str(tmp_path / "whole"), str(tmp_path / "out")
    pipeline.run(spark, source, good, whole)
    pipeline.run(spark, source, poor_config(tmp_path / "poor"), out)
    want = tables(spark, whole)
    poor = tables(spark, out)
    assert poor["records"] != want["records"] and poor["letters"] != want["letters"]

    result = replay(spark, source, good, out)
    assert tables(spark, out) == want
    # Only files with letters were run, and the run is in the log.
    files = {r[0] for r in result.documents.select("file_path").collect()}
    assert len(files) < len(sample.REPORTS) and any("a tree" in f for f in files)
    assert sinks.read_table(spark, f"{out}/runs").count() == 2

    # What is left fails again and changes nothing; nor does folding the retractions away.
    assert replay(spark, source, good, out, reasons=["unknown_clinic"]) is not None
    for name in pipeline.LAYOUT:
        snapshots.fold(spark, out, name, ratio=0)
    assert not any(d.gone for ds in snapshots.snapshot(spark, out).tables.values() for d in ds)
    assert tables(spark, out) == want
    assert replay(spark, source, good, out, reasons=["no such reason"]) is None


def test_replay_beyond_the_broadcast_bound_sorts_and_moves_no_bodies(spark, tmp_path, monkeypatch):
    source, good = sample.write_reports(tmp_path / "in"), sample.write_config(tmp_path / "good")
    whole, out = str(tmp_path / "whole"), str(tmp_path / "out")
    pipeline.run(spark, source, good, whole)
    pipeline.run(spark, source, poor_config(tmp_path / "poor"), out)
    module, landed = importlib.import_module("labweave.plans.replay"), {}
    kept = module.checkpoint

    def noted(df, name="stage", **options):
        landed.setdefault(name, df)
        return kept(df, name, **options)

    monkeypatch.setattr(module, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(module, "checkpoint", noted)
    assert replay(spark, source, good, out) is not None
    plan = landed["documents"]._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin [file_path" in plan and "SortMergeJoin [file_path" not in plan
    # Of what was there before only what is counted: neither bodies nor whole rows.
    assert landed["before"].columns == ["source_file", "clinic_id", *module._COUNTED]
    assert tables(spark, out) == tables(spark, whole)
