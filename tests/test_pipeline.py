"""Report folders end to end, in bulk and as a stream."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from labweave.operators import sinks, snapshots
from labweave.plans import pipeline, reports
from labweave.sources.config import dims_from_folder
from labweave.sources.files import read_files
from labweave.streaming import ingest
from tests import sample

@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("world")
    config = sample.write_config(root / "cfg")
    reports_dir = sample.write_reports(root / "in")
    out = str(root / "out")
    result = pipeline.run(spark, reports_dir, config, out)
    return {"root": root, "config": config, "in": reports_dir, "out": out, "result": result}


FLAGGED = {"Outlier", "Invalid", "Above Range", "Below Range"}
STATUSES = [row[-1] for rows in sample.EXPECTED.values() for row in rows]
#: Equal name, value and unit in one document make one id.
DISTINCT = len({(p, *row[1:4]) for p, rows in sample.EXPECTED.items() for row in rows})
#: Lab rows, the summary row and the medications.
STORED = DISTINCT + 1 + len(sample.MEDICINES_TAKEN)
FILES = len(sample.REPORTS) + len(sample.COPIES) + len(sample.BROKEN)
SOURCES = {p.split("/")[0] for p in [*sample.REPORTS, *sample.BROKEN]}


def place(path):
    return "/".join(path.split("/in/")[-1].split("/")).replace("%20", " ")


def test_measurements(world):
    got = {}
    for r in world["result"].rows.filter("record_type = 'lab_test'").collect():
        got.setdefault(place(r["file_path"]), []).append((
            r["test_name_original"], r["test_name_canonical"], r["result_value"], r["unit_canonical"],
            r["test_analytics"]))
    assert {p: sorted(rows, key=str) for p, rows in got.items()} == {
        p: sorted(rows, key=str) for p, rows in sample.EXPECTED.items() if rows}


def test_run_counts(world):
    assert world["result"].summary.first().asDict() == {
        "files_seen": FILES, "files_processed": len(sample.REPORTS), "files_failed": len(sample.BROKEN),
        "duplicates_suppressed": len(sample.COPIES), "rows_loaded": STORED,
        "rows_flagged": sum(x in FLAGGED for x in STATUSES)}


def test_suppressed_copies(world):
    gone = {place(r["file_path"]) for r in world["result"].suppressed.collect()}
    assert gone == set(sample.COPIES)


def test_dedup_can_be_switched_off(spark, world):
    dims = dims_from_folder(spark, world["config"])
    result = pipeline.process(read_files(spark, world["in"]), dims, dedup=False)
    assert result.suppressed.count() == 0
    assert result.documents.count() == len(sample.REPORTS) + len(sample.COPIES)


LETTERS = sorted(
    [(p.split("/")[0], "ingestion", reason) for p, (_, reason) in sample.BROKEN.items()]
    + [("north_lab", "unit_validation", "unit_mismatch_excluded")] * len(sample.MISMATCHES)
    + [("north_lab", "test_name_normalisation", "unresolved_test_name")] * len(sample.UNKNOWN)
    + [("hill_labs", "test_name_normalisation", "unresolved_test_name")]
    + [("north_lab", "block_routing", r) for r in (
        "unknown_classifier", "unhandled_record_type_imaging", *["block_is_not_an_object"] * 3)])


def test_dead_letters(world):
    got = sorted((r["clinic_id"], r["stage"], r["reason"]) for r in world["result"].errors.collect())
    assert got == LETTERS


def test_a_layout_without_the_needed_part_is_logged(spark, world):
    dims = dims_from_folder(spark, world["config"])
    import json
    from labweave.sources.files import split_path
    doc = sample.bundle("t", "D", "C", [sample.STAY])
    files = spark.createDataFrame(
        [("/in/well_lab/2026-01-01/x.json", json.dumps(doc))], "file_path string, content string")
    files = files.select(*split_path("file_path", "/in"), "file_path", "content")
    errors = pipeline.process(files, dims).errors.collect()
    assert [(r["stage"], r["reason"]) for r in errors] == [
        ("discharge_summary", "no_discharge_summary_spec_for_clinic")]


def test_demographics_and_lineage(world):
    rows = world["result"].rows
    r = rows.filter("clinic_id = 'well_lab'").first()  # day first with dashes; an impossible day
    assert (r["age_years"], r["age_months"], r["gender"]) == (71.0, None, "?")
    assert str(r["reports_date"]) == "2024-08-09" and r["bill_date"] is None
    r = rows.filter("clinic_id = 'river_hospital'").first()  # month first; the other order as a fallback
    assert (r["gender"], str(r["bill_date"]), str(r["reports_date"])) == ("Male", "2024-11-04", "2024-04-13")
    tagged = rows.filter("document_id = 'paper tags'").first()
    assert (tagged["claim_no"], tagged["source_system_reported"], tagged["nt_code"]) == tuple(sample.TAGS.values())
    assert (tagged["age_years"], tagged["age_months"], tagged["age_days"]) == (5.0, 0.0, 30.0)
    assert (tagged["gender"], str(tagged["reports_date"]), tagged["bill_date"]) == ("Female", "2024-01-02", None)


def test_discharge_and_medications(world):
    rows = world["result"].rows
    s = rows.filter("record_type = 'discharge_summary'").first()
    assert str(s["admission_date"]) == "2023-12-31" and str(s["discharge_date"]) == "2024-01-04"
    assert s["course_during_hospitalisation"] == "calm"
    assert s["medicine_injections_investigation"] == "BATH"
    meds = rows.filter("record_type = 'medication'").select("generic_name", "medicine_type").collect()
    assert sorted(map(tuple, meds), key=str) == sorted(sample.MEDICINES_TAKEN, key=str)


def test_repeats_are_flagged_then_collapse_by_id(world):
    flagged = world["result"].rows.filter("duplicate_within_report").collect()
    assert len(flagged) == len(STATUSES) - DISTINCT
    pages = {r["page_number"]: r["flag_reason"] for r in flagged if r["document_id"] == "paper repeated"}
    assert sorted(pages) == ["6", "9"] and all("on page 4 of" in x for x in pages.values())
    # their ids equal the first one's, so the table holds that one only
    loaded = pipeline.load_rows(world["result"].rows)
    assert sorted(r[0] for r in loaded.filter("document_id = 'paper repeated'").select(
        "result_value").collect()) == [2.5, 2.75]


def test_ids_and_the_reference_option(spark, world):
    dims = dims_from_folder(spark, world["config"])
    docs = world["result"].documents
    same, _ = pipeline.standardise(docs, dims, reference_ids=True)
    meds = same.filter("record_type = 'medication'")
    assert meds.select("id").distinct().count() == 1
    assert world["result"].rows.filter("record_type = 'medication'").select("id").distinct().count() == len(
        sample.MEDICINES_TAKEN)
    again, _ = pipeline.standardise(docs, dims)
    assert sorted(r[0] for r in again.select("id").collect()) == sorted(
        r[0] for r in world["result"].rows.select("id").collect())


def test_options_compare_converted_values_and_reported_ranges(spark, world):
    dims = dims_from_folder(spark, world["config"])
    docs = world["result"].documents
    rows, _ = pipeline.standardise(docs, dims, compare_on="converted", range_from="reported_first")
    got = {(r["document_id"], r["test_name_original"]): r["test_analytics"]
           for r in rows.filter("record_type = 'lab_test'").collect()}
    assert got["paper units", "Electrical Conductivity"] == "Within Range"  # 900 and not 0.9
    assert got["paper units", "Sampling Depth Below The Water Table"] == "Outlier"  # 0.05 and not 5
    assert got["sheet 6", "coliform plate result"] == "Above Range"


def test_tables_and_reruns(spark, world):
    before = sinks.read_table(spark, f"{world['out']}/records")
    assert before.count() == STORED
    ids = sorted(r[0] for r in before.select("id").collect())
    pipeline.run(spark, world["in"], world["config"], world["out"])
    records = sinks.read_table(spark, f"{world['out']}/records")
    assert sorted(r[0] for r in records.select("id").collect()) == ids
    assert sinks.read_table(spark, f"{world['out']}/runs").count() == 2
    seen = {r["clinic_id"]: r["files_seen"] for r in pipeline.stored_stats(spark, world["out"]).collect()}
    assert seen.keys() == SOURCES and sum(seen.values()) == 2 * FILES
    assert sinks.error_log(spark, f"{world['out']}/dead_letter").count() == 2 * len(LETTERS)
    pipeline.run(spark, world["in"], world["config"], world["out"], reset=True)
    assert sinks.read_table(spark, f"{world['out']}/runs").count() == 1
    assert sinks.error_log(spark, f"{world['out']}/dead_letter").count() == len(LETTERS)


def test_reports(spark, world):
    records = pipeline.load_rows(world["result"].rows)
    view = {(r["clinic_id"], r["Test_Name"]): r for r in reports.five_column_view(records).collect()}
    row = view["hill_labs", "Coliform Colonies"]
    assert (row["Test_Name_Result"], row["Test_Name_Range"], row["Test_Name_Unit"]) == (
        "14.0", "0.0-9.5", "cfu")
    assert view["river_hospital", "Odour"]["Test_Name_Result"] == "sweet"
    queue = reports.flagged_queue(records).collect()
    order = {"Outlier": 0, "Invalid": 1}
    ranks = [order.get(r["test_analytics"], 2) for r in queue]
    assert ranks == sorted(ranks) and len(queue[0]) == 16
    assert {r["test_analytics"] for r in reports.flagged_queue(records, flag="Invalid").collect()} == {"Invalid"}
    assert reports.flagged_queue(records, clinic="hill_labs").count() == 1
    assert [r["document_id"] for r in reports.record_search(records, "ole BERG").collect()] == ["nr 5"]
    assert reports.record_search(records, "p_per tags").count() == 1  # _ is a wildcard
    audit = sinks.audit_rows(world["result"].documents, world["result"].rows)
    detail = reports.record_detail(records, audit, "paper stay").collect()
    assert [r["record_type"] for r in detail] == sorted(r["record_type"] for r in detail)
    assert '"paper":"paper stay"' in detail[0]["raw_json"]
    parts = reports.dashboard(records, world["result"].summary.withColumns(
        {"run_id": F.lit("r"), "finished_at": F.current_timestamp()}), world["result"].errors)
    assert parts["total_records"].first()[0] == STORED and parts["error_count"].first()[0] == len(LETTERS)
    assert parts["last_run"].count() == 1 and parts["recent_errors"].count() == min(10, len(LETTERS))


def test_stream_equals_batch(spark, world):
    """Files arriving in two parts, the second repeating documents of the first."""
    root = world["root"] / "stream"
    landing, out, state = root / "in", str(root / "out"), str(root / "state")
    dims = dims_from_folder(spark, world["config"])
    source = world["root"] / "in"
    first = [sample.UNITS_PATH, "river_hospital/2024-11-05/tree.json"]
    files = sorted(p.relative_to(source) for p in source.rglob("*.json"))
    for part in (files and [p for p in files if str(p) in first], [p for p in files if str(p) not in first]):
        for p in part:
            (landing / p).parent.mkdir(parents=True, exist_ok=True)
            (landing / p).write_bytes((source / p).read_bytes())
        ingest.start_ingest(spark, str(landing), dims, out, checkpoint_location=state).awaitTermination()
    streamed = sinks.read_table(spark, f"{out}/records").drop(
        "processed_at", "ingested_at", "file_path")
    batch = pipeline.load_rows(world["result"].rows).select(*streamed.columns)
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))
    assert sinks.read_table(spark, f"{out}/suppressed").count() == len(sample.COPIES)
    assert sinks.error_log(spark, f"{out}/dead_letter").filter("reason is not null").count() == len(LETTERS)
    runs = sinks.read_table(spark, f"{out}/runs")
    assert runs.count() == 2 and runs.agg(F.sum("files_seen")).first()[0] == FILES
    assert pipeline.stored_stats(spark, out).count() == len(SOURCES)
    assert sinks.read_table(spark, f"{out}/audit").count() == len(sample.REPORTS)


def test_replaying_a_batch_changes_nothing(spark, world):
    out = str(world["root"] / "replay")
    dims = dims_from_folder(spark, world["config"])
    files = read_files(spark, world["in"])
    for _ in range(2):
        ingest.ingest_batch(files, 0, dims, out)
    assert sinks.read_table(spark, f"{out}/records").count() == STORED
    assert sinks.read_table(spark, f"{out}/kept_keys").count() == len(sample.REPORTS)
    assert sinks.error_log(spark, f"{out}/dead_letter").count() == len(LETTERS)
    assert sinks.read_table(spark, f"{out}/runs").count() == 1


def test_batch_and_stream_statistics_add_up(spark, world):
    """A source that a run and a stream both saw has the counts of both."""
    out = str(world["root"] / "both")
    dims = dims_from_folder(spark, world["config"])
    pipeline.run(spark, world["in"], world["config"], out, run_id="first")
    ingest.ingest_batch(read_files(spark, world["in"]), 0, dims, out)
    once = {r["clinic_id"]: r["files_seen"] for r in world["result"].stats.collect()}
    both = {r["clinic_id"]: r["files_seen"] for r in pipeline.stored_stats(spark, out).collect()}
    assert both == {c: 2 * n for c, n in once.items()}
    pipeline.run(spark, world["in"], world["config"], out, run_id="first")  # replaces itself
    again = {r["clinic_id"]: r["files_seen"] for r in pipeline.stored_stats(spark, out).collect()}
    assert again == both


@pytest.mark.parametrize("broken", [0, 3, 6])
def test_a_run_that_fails_leaves_every_table_as_it_was(spark, world, monkeypatch, broken):
    """The write of one table fails after others are done: nothing of the run is visible."""
    out = str(world["root"] / "atomic")
    if snapshots.snapshot(spark, out).number == 0:
        pipeline.write_result(replace(world["result"], run_id="good"), out)
    before = snapshots.snapshot(spark, out)
    writes, plain = [], snapshots.write_delta

    def breaking(df, root, table, **options):
        if len(writes) == broken:
            raise OSError("disk full")
        writes.append(table)
        return plain(df, root, table, **options)

    def failing(*args):
        raise OSError("no manifest")

    if broken < 6:
        monkeypatch.setattr(snapshots, "write_delta", breaking)
    else:
        monkeypatch.setattr(snapshots, "_publish", failing)
    with pytest.raises(OSError):
        pipeline.write_result(replace(world["result"], run_id="bad"), out)
    assert snapshots.snapshot(spark, out) == before
    assert sinks.read_table(spark, f"{out}/runs").select("run_id").collect() == [("good",)]


def test_rolling_error_rate(spark):
    df = spark.sql("""select * from values (timestamp'2024-01-01 00:10:00', true),
        (timestamp'2024-01-01 00:50:00', false), (timestamp'2024-01-01 01:10:00', false) t(ts, bad)""")
    out = ingest.rolling_error_rate(df, "ts", F.col("bad")).orderBy("window_start").collect()
    assert [(r["seen"], r["failed"], r["error_rate"]) for r in out] == [(2, 1, 0.5), (1, 0, 0.0)]


def test_blocks_that_are_no_list_go_to_the_dead_letters(spark, world):
    import json

    from labweave.sources.files import split_path
    dims = dims_from_folder(spark, world["config"])
    bodies = [sample.bundle(f"t{i}", f"D{i}", f"C{i}", parts) for i, parts in enumerate(
        [sample.panel({}, [(1, "", "5", "Manganese", "")]), "words", 7, None, []])]
    files = spark.createDataFrame(
        [(f"/in/north_lab/2025-01-01/{i}.json", json.dumps(b)) for i, b in enumerate(bodies)],
        "file_path string, content string")
    files = files.select(*split_path("file_path", "/in"), "file_path", "content")
    result = pipeline.process(files, dims)
    assert sorted((r["file_path"][-6:], r["reason"]) for r in result.errors.collect()) == [
        (f"{i}.json"[-6:], "blocks_are_not_a_list") for i in range(3)]
    assert result.rows.count() == 0 and result.summary.first()["files_processed"] == 5


def test_roots_and_paths(spark, world, tmp_path):
    from labweave.sources.files import split_path

    def parts(path, root):
        df = spark.createDataFrame([(path,)], "p string")
        return [*df.select(*split_path("p", root)).first()][:2]

    assert parts("hdfs://main/in/alpha/2026-01-01/x.json", "hdfs://main/in/") == ["alpha", "2026-01-01"]
    assert parts("/my-reports/reports/b/d/x.json", "/my-reports/reports") == ["b", "d"]
    assert parts("/in/x.json", "/in") == ["unknown-clinic", "unknown-date"]
    with pytest.raises(Exception, match="is not below"):
        parts("hdfs://main/in/alpha/2026-01-01/x.json", "/in")
    some = read_files(spark, world["in"], clinics=["hill_labs", "nobody"], dates=["2024-11-06"])
    assert {(r["clinic_id"], r["date_str"]) for r in some.collect()} == {("hill_labs", "2024-11-06")}
    some = read_files(spark, world["in"] + "/", clinics=["hill_labs"])
    assert some.count() == 2 and read_files(spark, world["in"], dates=["2024-12-05"]).count() == 5


def test_files_without_ids_are_documents_of_their_own(spark, world):
    dims = dims_from_folder(spark, world["config"])
    from labweave.sources.files import split_path
    import json
    rows = [{"Quantity": "Manganese", "Reading": "33"}]
    bodies = [{"Readings": rows, "Full Name": n} for n in ("a", "b")]
    files = spark.createDataFrame(
        [(f"/in/hill_labs/2025-01-01/{i}.json", json.dumps(b)) for i, b in enumerate(bodies)],
        "file_path string, content string")
    files = files.select(*split_path("file_path", "/in"), "file_path", "content")
    got = pipeline.process(files, dims, scope="document").rows
    assert got.count() == 2 and got.filter("duplicate_within_report").count() == 0
    assert got.filter("ingested_at is null").count() == 0
